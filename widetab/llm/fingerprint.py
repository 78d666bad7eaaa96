"""Document fingerprints: quartile bucket digest (operator 2).

Byte triplets of the UTF-8 text (adjacent and with one gap) are hashed into
buckets and counted. The digest is the length code and, for each bucket, two
bits that say in which quartile of the bucket counts it lies. Two digests are
compared by a bounded difference: the sum of quartile steps over all buckets
plus a capped length step, scaled so that 0 is equal and 1 the most.

``with_next`` pairs each document with the next one in descending doc_id
order without a global sort in one task: doc_id quantiles cut the order into
ranges (a bounded number of edges), each range is sorted by itself, and only
each range's first document is copied into the range before it.

Defined results: null text is empty (all buckets in the lowest quartile);
equal texts have equal digests; a table of one row is its own next document;
documents of equal doc_id are ordered by text; null doc_ids come last; an
empty table gives an empty table; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.session import shuffle_partitions

BUCKETS = 1024
# (gap to second, gap to third byte, odd multiplier) of each triplet form.
FORMS = ((1, 2, 0x9E3779B1), (1, 3, 0x85EBCA6B), (2, 3, 0xC2B2AE35))
LENGTH_STEPS = 24
CHUNK = 1 << 20


def bucket_counts(data: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed byte triplets, chunk by chunk (bounded memory)."""
    shift = np.uint32(32 - int(math.log2(buckets)))
    total = np.zeros(buckets, dtype=np.int64)
    for at in range(0, len(data), CHUNK):
        a = np.frombuffer(data[at:at + CHUNK + 3], dtype=np.uint8).astype(np.uint32)
        for g1, g2, mul in FORMS:
            n = min(len(a) - g2, CHUNK)
            if n > 0:
                h = a[:n] | (a[g1:g1 + n] << np.uint32(8)) | (a[g2:g2 + n] << np.uint32(16))
                h *= np.uint32(mul)
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                total += np.bincount(h >> shift, minlength=buckets)
    return total


def digest(data: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Length code, then one quartile (0-3) per bucket."""
    c = bucket_counts(data, buckets)
    s = np.sort(c)
    q1, q2, q3 = s[buckets // 4 - 1], s[buckets // 2 - 1], s[3 * buckets // 4 - 1]
    code = (c > q1).astype(np.uint8) + (c > q2) + (c > q3)
    return np.concatenate([[min(255, round(8 * math.log2(len(data) + 1)))], code]).astype(np.uint8)


def to_hex(d: np.ndarray) -> str:
    """Two hex digits of length code, then two bits per bucket."""
    q = d[1:].reshape(-1, 4)
    return bytes([d[0], *(q[:, 0] << 6 | q[:, 1] << 4 | q[:, 2] << 2 | q[:, 3])]).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 − bounded difference of two digests."""
    steps = np.abs(a[1:].astype(np.int16) - b[1:]).astype(np.float64)
    length = min(LENGTH_STEPS, abs(int(a[0]) - int(b[0])))
    most = 3.0 * (len(a) - 1) + LENGTH_STEPS
    return 1.0 - float(steps.sum() + length) / most


def edited_text(text: str, following: str) -> str:
    """The last half replaced by as much of the next text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def ranges(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts − 1`` cut values of ``key`` near its quantiles."""
    cuts = df.select(F.percentile_approx(key, F.array(*[F.lit(i / parts) for i in range(1, parts)]), 10_000)
                     .alias("q")).first()["q"] if parts > 1 else None
    return sorted(set(cuts or []))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Partitions in which every document (``carry`` false) is followed by its
    next one in descending key order. Columns k, t, range, carry."""
    parts = parts or 4 * shuffle_partitions(df.sparkSession)
    src = df.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    cuts = ranges(src, "k", parts)

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        # Range 0 holds the largest keys; nulls go to the last range.
        below = np.searchsorted(np.asarray(cuts, dtype=np.float64), k.to_numpy(dtype=np.float64), side="right")
        return pd.Series(np.where(k.isna(), len(cuts), len(cuts) - below).astype(np.int32))
    src = src.withColumn("range", range_of("k") if cuts else F.lit(0))
    # First document of each range: largest key, then smallest text hash.
    # One row per range, so at most len(cuts) + 1 rows reach the driver.
    order = F.struct(F.coalesce(F.col("k"), F.lit(-(1 << 63))), F.sha2("t", 256))
    heads = {r["range"]: (r["first"][0], r["first"][1]) for r in
             src.groupBy("range").agg(F.max(order).alias("first")).collect()}
    if not heads:
        return src.withColumn("h", F.sha2("t", 256)).withColumn("carry", F.lit(False))
    full = sorted(heads)
    before = {r: full[i - 1] for i, r in enumerate(full)}   # the first range's head goes to the last
    head_rows = df.sparkSession.createDataFrame(
        [(r, k, h, before[r]) for r, (k, h) in heads.items()], "r int, hk bigint, hh string, to int")
    src = src.withColumn("h", F.sha2("t", 256))
    heads_found = (src.join(F.broadcast(head_rows), (F.col("range") == F.col("r")) & (F.col("h") == F.col("hh"))
                            & (F.coalesce("k", F.lit(-(1 << 63))) == F.col("hk")))
                   .select("k", "t", F.col("to").alias("range"), "h").dropDuplicates(["range"])
                   .withColumn("carry", F.lit(True)))
    return src.withColumn("carry", F.lit(False)).unionByName(heads_found)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per document its digest, its edited text's digest, and the likeness of
    its digest to the edited text's and to the next document's."""
    pairs = with_next(df, key, text, parts)
    laid = pairs.repartition(shuffle_partitions(df.sparkSession), "range").sortWithinPartitions(
        "range", "carry", F.desc_nulls_last("k"), F.desc("h")).select("range", "carry", "k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        held = None
        for b in batches:
            out: list[list] = [[] for _ in names]
            for i in range(b.num_rows):
                carry, k, t = b[1][i].as_py(), b[2][i].as_py(), b[3][i].as_py()
                mine = digest(t.encode())
                if held is not None:
                    pk, pt, pd = held
                    new = edited_text(pt, t)
                    raw = new.encode()
                    nd = digest(raw)
                    row = (pk, len(pt), hashlib.sha256(raw).hexdigest(), to_hex(pd), to_hex(nd),
                           likeness(pd, nd), likeness(pd, mine))
                    for col, v in zip(out, row):
                        col.append(v)
                held = None if carry else (k, t, mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64() if n in ("doc_id", "n_chars") else pa.float64()
                          if n.startswith("near") else pa.string()) for n, c in zip(names, out)], names=names)
    return laid.mapInArrow(run, SCHEMA)
