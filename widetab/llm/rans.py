"""Token-ID binary output: static range asymmetric numeral system (operator 6).

One table of symbol frequencies, counted over the whole corpus and scaled to
2^SCALE, is shared by all blocks. A block holds whole documents in ascending
doc_id order. Its ids are dealt over interleaved lanes, each lane an rANS
state with 32-bit renormalisation into one common word stream; numpy encodes
and decodes all lanes at a time. A block is read by itself: its header has
the document table, the lanes' first states, a checksum of the ids, and
checkpoints (all states and the place in the stream every ``CHECK_STEPS``
steps), from which parts of a block decode in parallel.

Files: Spark's text sink writes the blocks' bytes, ended by ``MARK`` (a block
whose bytes contain the mark is masked with another byte until it does not),
so readers split files at any point and recover from lost tasks like any text
job. The frequency table is a Parquet file beside them.

Defined results: null text is empty (its document is the end id alone);
documents of equal doc_id follow each other, ordered by text hash; null doc_ids
come first; an empty table writes no block and reads back empty; very long
documents make a block of their own; other input columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from widetab.llm.common import drop_shared, small_or_shuffled, text_column, write_shared
from widetab.llm.tokens import default_tokenizer_path, encoder
from widetab.session import shuffle_partitions

SCALE = 20
LANES = 4096
BLOCK_IDS = 1 << 18
CHECK_STEPS = 32
ROWS = 256
LOW = np.uint64(1 << 31)
MARK = "\r\n\x1dRANS-BLOCK\x1d\r\n"
HEAD = struct.Struct("<4sBBHIIQQII")    # magic, version, mask, lanes, docs, checkpoints, ids, start, crc of ids, words
MAGIC = b"TRNS"
BLOCKS_PER_FILE = 64


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2^scale, at least 1 for every symbol seen."""
    total, size = int(counts.sum()), 1 << scale
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    seen = counts > 0
    if int(seen.sum()) > size:
        raise ValueError("more symbols than slots")
    f = np.where(seen, np.maximum(1, np.floor(counts / total * size)), 0).astype(np.int64)
    while (d := size - int(f.sum())):
        order = np.argsort(-f, kind="stable")      # the most frequent symbols take up the difference
        if d > 0:
            f[order[0]] += d
        else:
            take = np.minimum(f[order] - 1, np.maximum(1, (-d * f[order]) // size)) * (f[order] > 1)
            take = np.where(np.cumsum(take) <= -d, take, np.maximum(0, -d - (np.cumsum(take) - take)))
            f[order] -= take
    return f


class Tables:
    """Shared frequency tables of one archive."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        # The narrowest type keeps the table in the processor's cache.
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)


def encode_ids(ids: np.ndarray, t: Tables, lanes: int = LANES, every: int = CHECK_STEPS):
    """(first states, words, checkpoints) of one block's ids; a checkpoint is
    (step, place in the words, states) before that step is decoded."""
    lanes = min(lanes, max(1, len(ids)))
    steps = -(-len(ids) // lanes)
    x = np.full(lanes, LOW, dtype=np.uint64)
    chunks: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    shift, scale = np.uint64(63 - SCALE), np.uint64(SCALE)
    for step in range(steps - 1, -1, -1):
        s = ids[step * lanes:(step + 1) * lanes]
        f, c = t.freq[s], t.start[s]
        y = x[:len(s)]
        full = y >= (f << shift)
        if full.any():
            out = (y[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            chunks.append(out)
            written += len(out)
            y[full] >>= np.uint64(32)
        q = y // f
        x[:len(s)] = (q << scale) + (y - q * f) + c
        if step % every == 0 and step:
            marks.append((step, written, x.copy()))
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, dtype="<u4")
    return x, words, [(s, len(words) - w, st) for s, w, st in reversed(marks)]


def decode_ids(n: int, lanes: int, states: np.ndarray, words: np.ndarray, t: Tables,
               from_step: int = 0, to_step: int | None = None) -> np.ndarray:
    """Ids of steps [from_step, to_step) given the states before from_step and
    the words from its place on. At the last step all states must be back at
    the encoder's start and all words used."""
    steps = -(-n // lanes)
    last = steps if to_step is None else min(to_step, steps)
    x, at = states.astype(np.uint64).copy(), 0
    out = np.empty(max(0, min(n, last * lanes) - from_step * lanes), dtype=np.uint32)
    mask, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for step in range(from_step, last):
        k = min(lanes, n - step * lanes)
        y = x[:k]
        slot = y & mask
        s = t.slots[slot]
        y = t.freq[s] * (y >> scale) + slot - t.start[s]
        low = y < LOW
        m = int(low.sum())
        if m:
            y[low] = (y[low] << np.uint64(32)) | words[at:at + m]
            at += m
        x[:k] = y
        out[(step - from_step) * lanes:(step - from_step) * lanes + k] = s
    if last == steps and ((x != LOW).any() or at != len(words)):
        raise ValueError("block does not decode to its start")
    return out


def pack_block(keys: list, counts: np.ndarray, ids: np.ndarray, start: int, t: Tables) -> bytes:
    """Bytes of one block (without the mark)."""
    states, words, marks = encode_ids(ids, t)
    nulls = np.packbits(np.array([k is None for k in keys], dtype=bool)).tobytes()
    head = HEAD.pack(MAGIC, 1, 0, len(states), len(keys), len(marks), len(ids), start,
                     zlib.crc32(ids.astype("<u4")), len(words))
    body = b"".join([np.array([k or 0 for k in keys], dtype="<i8").tobytes(), nulls, counts.astype("<u4").tobytes(),
                     states.astype("<u8").tobytes(),
                     *[struct.pack("<II", s, w) + st.astype("<u8").tobytes() for s, w, st in marks],
                     words.astype("<u4").tobytes()])
    mark = MARK.encode()
    for mask in range(256):
        masked = body if not mask else (np.frombuffer(body, dtype=np.uint8) ^ np.uint8(mask)).tobytes()
        data = head[:5] + bytes([mask]) + head[6:] + masked
        if mark not in data + mark[:-1]:
            return data
    raise ValueError("no mask keeps the mark out of the block")


class Block:
    """A block's parts, read from its bytes."""

    def __init__(self, data: bytes):
        magic, version, mask, lanes, docs, marks, self.n, self.start, self.crc, n_words = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token block")
        body = data[HEAD.size:]
        if mask:
            body = (np.frombuffer(body, dtype=np.uint8) ^ np.uint8(mask)).tobytes()
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(body, dtype=kind, count=n, offset=at)
            at += got.nbytes
            return got
        self.lanes = lanes
        keys, nulls = take("<i8", docs), np.unpackbits(take("u1", -(-docs // 8)))[:docs]
        self.keys = [None if z else int(k) for k, z in zip(keys, nulls)]
        self.counts = take("<u4", docs)
        self.states = take("<u8", lanes)
        self.marks = []
        for _ in range(marks):
            step, place = struct.unpack_from("<II", body, at)
            at += 8
            self.marks.append((step, place, take("<u8", lanes)))
        self.words = take("<u4", n_words)

    def part(self, i: int, t: Tables) -> np.ndarray:
        """Ids from checkpoint i (0: the block's start) to the next one."""
        points = [(0, 0, self.states), *self.marks]
        step, place, states = points[i]
        end = points[i + 1][0] if i + 1 < len(points) else None
        return decode_ids(self.n, self.lanes, states, self.words[place:], t, step, end)

    def ids(self, t: Tables) -> np.ndarray:
        """All ids; raises if the checksum differs."""
        got = decode_ids(self.n, self.lanes, self.states, self.words, t)
        if zlib.crc32(got.astype("<u4")) != self.crc:
            raise ValueError("block checksum differs")
        return got


RAW = "seq bigint, n bigint, keys array<bigint>, counts array<bigint>, ids binary"


def narrow(ids: np.ndarray) -> bytes:
    """Ids as bytes: two each after b"2" if they fit, else four after b"4"."""
    return b"2" + ids.astype("<u2").tobytes() if not len(ids) or int(ids.max()) < 1 << 16 else b"4" + ids.astype("<u4").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2" if data[:1] == b"2" else "<u4", offset=1).astype("<u4")


def id_blocks(docs: DataFrame, key: str, text: str, end_id: int, tokenizer: str, block_ids: int) -> DataFrame:
    """Ids in blocks of whole documents, in ascending key order (pid, seq), and
    for each task a row of its symbols' counts (seq null; keys are ids)."""
    parts = shuffle_partitions(docs.sparkSession)
    src = (docs.select(F.col(key).cast("bigint").alias("k"), text_column(text).alias("t"))
           .repartitionByRange(parts, "k").sortWithinPartitions("k", F.xxhash64("t")))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, pid, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys: list = []
        got: list[bytes] = []
        held, total = 0, np.zeros(0, dtype=np.int64)

        def row(seq, n, keys, counts, ids) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([seq], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([ids], pa.binary())], names=["pid", "seq", "n", "keys", "counts", "ids"])

        def block() -> pa.RecordBatch:
            nonlocal total
            ids, counts = np.frombuffer(b"".join(got), dtype="<u4"), [len(g) // 4 for g in got]
            c = np.bincount(ids, minlength=len(total))
            c[:len(total)] += total
            total = c
            return row(seq, len(ids), keys, counts, narrow(ids))
        for whole in it:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                for k, t in zip(b.column("k").to_pylist(), b.column("t").to_pylist()):
                    ids = enc.encode(t)
                    if got and held + len(ids) // 4 + 1 > block_ids:
                        yield block()
                        keys, got, held, seq = [], [], 0, seq + 1
                    keys.append(k)
                    got.append(ids + end)
                    held += len(ids) // 4 + 1
        if got:
            yield block()
            on = np.flatnonzero(total)
            yield row(None, None, on.tolist(), total[on].tolist(), None)
    return src.mapInArrow(run, "pid int, " + RAW)


def symbol_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks: the tasks' own counts, summed by id."""
    return blocks.filter("seq is null").select(F.explode(F.arrays_zip("keys", "counts")).alias("c")) \
        .groupBy(F.col("c.keys").alias("id")).agg(F.sum("c.counts").alias("n"))


def load_tables(spark: SparkSession, path: str) -> Tables:
    """The archive's table: one row per vocabulary entry, held by every task."""
    rows = spark.read.parquet(f"{path}/table").collect()
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return Tables(freq)


def write_ids(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
              tokenizer: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Write all documents' ids (with an end id each) in the block format."""
    spark = docs.sparkSession
    made = write_shared(id_blocks(docs, key, text, end_id, tokenizer or default_tokenizer_path(), block_ids), "rans-ids", "zstd")
    blocks = made.filter("seq is not null")
    counts = symbol_counts(made).collect()               # at most one row per vocabulary entry
    freq = np.zeros(max((r["id"] for r in counts), default=-1) + 1, dtype=np.int64)
    for r in counts:
        freq[r["id"]] = r["n"]
    freq = scaled(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id bigint, freq bigint") \
        .coalesce(1).write.parquet(f"{path}/table")
    # Start of a block: ids of the partitions before it (one row per partition), then of the blocks before it.
    sums = sorted((r["pid"], r["n"]) for r in blocks.groupBy("pid").agg(F.sum("n").alias("n")).collect())
    first = np.concatenate([[0], np.cumsum([n for _, n in sums])]).astype(int)
    base = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(sums, first)], "bp int, base bigint")
    starts = (blocks.select("pid", "seq", "n")
              .withColumn("at", F.sum("n").over(W.partitionBy("pid").orderBy("seq")) - F.col("n"))
              .join(F.broadcast(base), F.col("pid") == F.col("bp"))
              .select(F.col("pid").alias("sp"), F.col("seq").alias("ss"), (F.col("base") + F.col("at")).alias("start")))
    shared = spark.sparkContext.broadcast(Tables(freq))
    starts = write_shared(starts, "rans-starts")
    ready = blocks.join(small_or_shuffled(starts, 24),
                        (F.col("pid") == F.col("sp")) & (F.col("seq") == F.col("ss"))).select("keys", "counts", "ids", "start")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(b.num_rows):
                data = pack_block(b.column("keys")[i].as_py(), np.array(b.column("counts")[i].as_py()),
                                  widened(b.column("ids")[i].as_py()),
                                  b.column("start")[i].as_py(), shared.value)
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])
    (ready.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", MARK).option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/blocks"))
    drop_shared(made, starts)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, read from the files: key, start, n_tokens, ids_crc32 (and
    the packed ids when asked for). Every block decodes by itself."""
    shared = spark.sparkContext.broadcast(load_tables(spark, path))
    raw = spark.read.option("lineSep", MARK).text(f"{path}/blocks").select(F.col("value").cast("binary").alias("value"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for v in b.column("value"):
                block = Block(v.as_buffer().to_pybytes())
                data = block.ids(shared.value).astype("<u4").tobytes()
                ends = np.cumsum(block.counts.astype(np.int64))
                parts = [data[4 * (e - c):4 * e] for e, c in zip(ends.tolist(), block.counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.keys, pa.int64()), pa.array(ends - block.counts + block.start),
                     pa.array(block.counts.astype(np.int64)), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                     pa.array(parts if with_ids else [None] * len(parts), pa.binary())],
                    names=["k", "start", "n_tokens", "ids_crc32", "ids"])
    got = raw.mapInArrow(run, "k bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    return got.withColumnRenamed("k", key) if with_ids else got.drop("ids").withColumnRenamed("k", key)
