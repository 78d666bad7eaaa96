"""Best-fit packing: best-two-fit (operator 5).

Documents become token ids plus an end id; only documents longer than the
sequence are cut (a shorter first piece, then full ones). Packing needs only
how many pieces there are of each length: a table of at most ``capacity`` rows
is the one thing that reaches the driver. There bins are filled greedily,
largest fitting piece first; then the smallest piece of a bin is taken out if two
unpacked pieces fit the larger gap more tightly. A bin's pattern is used as
often as the counts allow, so the plan's size depends on the capacity and not
on the corpus. Pieces get their place by their rank within their length; ranks
come from counts per (partition, length), never from one task.

Defined results: null text is empty and gives one piece with the end id;
repeated rows are packed as often as they occur; null doc_ids are kept; an
empty table gives an empty table; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from widetab.llm.common import map_rows, text_column, write_shared
from widetab.llm.tokens import default_tokenizer_path, encoder

CAPACITY = 1024
END_ID = 2


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; a shorter one comes first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenised pieces: key, piece, start, length, ids_crc32, and ``ids``
    (packed little-endian unsigned 32-bit) when asked for."""
    path = tokenizer or default_tokenizer_path()
    kind = dict(docs.dtypes)[key]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        enc = encoder(path)
        for p in parts:
            out: dict[str, list] = {c: [] for c in ("k", "piece", "start", "length", "ids_crc32", "ids")}
            for k, t in zip(p["k"], p["t"]):
                ids = enc.encode(t) + end
                for i, (s, n) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * s:4 * (s + n)]
                    for c, v in zip(out, (k, i, s, n, zlib.crc32(part), part if with_ids else None)):
                        out[c].append(v)
            yield out
    got = map_rows(docs.select(F.col(key).alias("k"), text_column(text).alias("t")),
                   f"k {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary", run)
    return got if with_ids else got.drop("ids")


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how often), for ``counts`` pieces of each length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    bins: list[tuple[list[int], int]] = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return bins
        used = np.zeros(capacity + 1, dtype=np.int64)
        rest = left.copy()
        lengths, gap = [], capacity
        while True:                                      # greedy: the largest piece that fits
            fits = np.flatnonzero(rest[:gap + 1])
            if not len(fits):
                break
            n = int(fits[-1])
            lengths.append(n)
            rest[n] -= 1
            gap -= n
        while gap and len(lengths) > 1:                  # two for the smallest, while it tightens the bin
            small = lengths[-1]
            room = small + gap
            avail = np.flatnonzero(rest[:room])
            if not len(avail):
                break
            upto = np.zeros(room + 1, dtype=np.int64)    # largest available length up to here
            upto[avail] = avail
            upto = np.maximum.accumulate(upto)
            a = avail
            b = upto[room - a]
            b = np.where((b == a) & (rest[a] < 2), upto[np.maximum(a - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            best = int(total.argmax())
            if total[best] <= small:
                break
            lengths.pop()
            rest[small] += 1
            for n in (int(a[best]), int(b[best])):
                lengths.append(n)
                rest[n] -= 1
            lengths.sort(reverse=True)
            gap = room - int(total[best])
        for n in lengths:
            used[n] += 1
        on = np.flatnonzero(used)
        times = int((left[on] // used[on]).min())
        left[on] -= used[on] * times
        bins.append((lengths, times))


def _segments(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, pieces per bin, first sequence, first offset
    of each stretch of ranks that one pattern takes."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in bins:
        at = 0
        for n in sorted(set(lengths), reverse=True):
            per = lengths.count(n)
            rows.setdefault(n, []).append((taken.get(n, 0), per, sequence, at))
            taken[n] = taken.get(n, 0) + per * times
            at += per * n
        sequence += times
    return {n: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for n, r in rows.items()}


def pack(parts: DataFrame, key: str = "k", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (with ``length``)."""
    spark = parts.sparkSession
    laid = write_shared(parts.withColumn("pid", F.spark_partition_id()), "pack-pieces")
    per = write_shared(laid.groupBy("pid", "length").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(_segments(best_two_fit(counts, capacity)))
    base = per.select("pid", "length", (F.sum("n").over(W.partitionBy("length").orderBy("pid")) - F.col("n")).alias("base"))
    order = [F.col(c) for c in (key, "piece", "start", "ids_crc32")]
    ranked = (laid.withColumn("rank", F.row_number().over(W.partitionBy("pid", "length").orderBy(*order)) - 1)
              .join(base, ["pid", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("pid", "base"))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
            for length in np.unique(n):
                on = np.flatnonzero(n == length)
                first, per_bin, sequence, at = plan.value[int(length)]
                i = np.searchsorted(first, r[on], side="right") - 1
                step = r[on] - first[i]
                seq[on] = sequence[i] + step // per_bin[i]
                off[on] = at[i] + (step % per_bin[i]) * length
            names = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(seq), pa.array(off)],
                                             names=[*names, "sequence_id", "offset"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Pieces of all documents with their places: key, piece, start, length,
    ids_crc32, sequence_id, offset (and ids when asked for)."""
    got = pack(pieces(docs, key, text, **options), capacity=options.get("capacity", CAPACITY))
    return got.select(F.col("k").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                      *(["ids"] if options.get("with_ids") else []))
