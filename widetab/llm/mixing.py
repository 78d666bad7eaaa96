"""Mixing sources to target weights: Sainte-Laguë apportionment (operator 4).

The mix is as large as the corpus (in words). Sources in code point order
(null last) weigh 5, 2, 1, repeating; a source's target stops at ``most``
times its size and the excess is shared again by weight. The words of the mix
are dealt as equal blocks of ``block`` words: sources get block counts by
Sainte-Laguë's highest quotients (with the cap), each source's blocks go to
its shards the same way, and within a shard every block is taken quota //
blocks times, plus once more for a seeded systematic choice of the rest. Blocks
are never listed: a document's taken words follow from its place in its shard.

A source is cut into shards of about ``shard_words`` words by a seeded hash
of the document, so a hot source is many shards. The driver holds one row per
source (refused above ``MAX_SOURCES``); shard quotas are computed per source
from one row per shard, document places by a window per shard.

Defined results: null text has size 0 and takes 0; null sources are one
source, last; equal rows are interchangeable (the two get the same words as a
pair, in either order); an empty table, or one without words, gives targets of
0; other input columns are ignored by ``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from widetab.llm.common import small_or_shuffled, word_count, write_shared

WEIGHTS = (5.0, 2.0, 1.0)
MAX_SOURCES = 1_000_000


def capped_targets(sizes: np.ndarray, weights: np.ndarray, most: float = 3.0) -> np.ndarray:
    """Shares of sum(sizes) by weight, none above ``most`` × its size; the
    excess is shared again by weight until none is above."""
    sizes = np.asarray(sizes, dtype=np.float64)
    total, caps = sizes.sum(), most * sizes
    held = np.zeros(len(sizes), dtype=bool)
    out = np.zeros(len(sizes))
    while not held.all():
        rate = (total - caps[held].sum()) / weights[~held].sum()
        out = np.where(held, caps, rate * weights)
        over = ~held & (out > caps)
        if not over.any():
            return out
        held |= over
    return caps


def sainte_lague(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients w / (2k + 1), none above its cap. A rate is
    bisected to just under the seats (rounding w × rate is the same rule) and
    the last few seats go one by one to the highest quotient, ties to the
    first entry."""
    w, caps = np.asarray(weights, dtype=np.float64), np.asarray(caps, dtype=np.int64)
    seats = int(min(seats, caps.sum()))
    w = np.where(caps > 0, w, 0.0)
    given = np.zeros(len(w), dtype=np.int64)
    if seats <= 0 or not (w > 0).any():
        return given

    def at(rate: float) -> np.ndarray:
        return np.minimum(caps, np.floor(np.minimum(w * rate, 4e18) + 0.5).astype(np.int64))
    low, high = 0.0, 1.0
    while at(high).sum() < min(seats, caps[w > 0].sum()):
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if at(mid).sum() <= seats else (low, mid)
    given = at(low)
    heap = [(-w[i] / (2 * int(given[i]) + 1), i) for i in np.flatnonzero((given < caps) & (w > 0))]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(heap, (-w[i] / (2 * int(given[i]) + 1), i))
    return given


def source_plan(sizes: DataFrame, block: int, most: int, weights: tuple[float, ...] = WEIGHTS) -> pd.DataFrame:
    """One row per source: source, source_size, target, blocks (seats)."""
    rows = sizes.orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    size = np.array([r["source_size"] for r in rows], dtype=np.int64)
    w = np.array([weights[i % len(weights)] for i in range(len(rows))])
    caps = np.array([most * r["blocks"] for r in rows], dtype=np.int64)
    seats = sainte_lague(w, caps, round(int(size.sum()) / block)) if len(rows) else size
    return pd.DataFrame({"source": [r["source"] for r in rows], "source_size": size,
                         "target": capped_targets(size, w, most) if len(rows) else size.astype(float),
                         "seats": seats})


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = 16,
        most: int = 3, shard_words: int = 1 << 20, seed: int = 17, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per document: key, size, source, source_size, target, taken."""
    spark = docs.sparkSession
    sized = write_shared(docs.select(
        F.col(key).alias("k"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("h")), "mix-sizes")
    cuts = F.ceil(F.sum("size") / F.lit(float(shard_words))).cast("bigint")
    shard_count = write_shared(sized.groupBy(F.col("source").alias("cs")).agg(F.greatest(cuts, F.lit(1)).alias("cuts")),
                               "mix-cuts")
    sharded = sized.join(small_or_shuffled(shard_count, 200), F.col("source").eqNullSafe(F.col("cs"))).select(
        "k", "source", "size", "h", F.pmod("h", "cuts").alias("shard"))
    shards = write_shared(sharded.groupBy("source", "shard").agg(F.sum("size").alias("words"))
                          .withColumn("blocks", F.ceil(F.col("words") / block).cast("bigint")), "mix-shards")
    plan = source_plan(shards.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("blocks").alias("blocks")),
                       block, most, weights)
    schema = "ps string, source_size bigint, target double, seats bigint"
    plan_df = spark.createDataFrame([(s, int(a), float(t), int(n)) for s, a, t, n in plan.itertuples(index=False)], schema)

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard").reset_index(drop=True)
        # Partial last blocks weigh their words, so every block of a source is as likely.
        pdf["quota"] = sainte_lague(pdf["words"].to_numpy(float), most * pdf["blocks"].to_numpy(), int(pdf["seats"].iloc[0]))
        return pdf[["source", "shard", "words", "blocks", "source_size", "target", "seats", "quota"]]
    dealt = shards.join(small_or_shuffled(plan_df, 200), F.col("source").eqNullSafe(F.col("ps"))).drop("ps")
    dealt = write_shared(dealt.groupBy("source").applyInPandas(
        quotas, "source string, shard bigint, words bigint, blocks bigint, source_size bigint, target double, "
                "seats bigint, quota bigint"), "mix-quotas")
    order = W.partitionBy("source", "shard").orderBy("h", "k", "size")
    placed = sharded.withColumn("end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
    q = dealt.withColumnRenamed("source", "qs").withColumnRenamed("shard", "qn")
    placed = placed.join(q, F.col("source").eqNullSafe(F.col("qs")) & (F.col("shard") == F.col("qn")))
    m = F.greatest("blocks", F.lit(1))
    full, rest = F.floor(F.col("quota") / m), F.col("quota") % m
    phase = F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), m)
    whole = lambda n: F.floor((n.cast("decimal(38,0)") * F.col("rest") + F.col("phase")) / F.col("m")).cast("bigint")
    placed = placed.withColumns({"m": m, "full": full.cast("bigint"), "rest": rest.cast("bigint"), "phase": phase})

    def before(x):
        """Words of chosen blocks before word x of the shard."""
        b = F.floor(x / block).cast("bigint")
        done = whole(b) - whole(F.lit(0))
        here = whole(b + 1) - whole(b)
        return done * block + here * (x - b * block)
    start = F.col("end") - F.col("size")
    return placed.select(
        F.col("k").alias(key), "size", "source", "source_size", "target",
        (F.col("full") * F.col("size") + before(F.col("end")) - before(start)).cast("bigint").alias("taken"))


def apply_mix(docs: DataFrame, key: str = "doc_id", seed: int = 17, **options) -> DataFrame:
    """The corpus in the mix's proportions: each document as often as its
    taken words say, taken / size copies rounded up or down by a seeded hash
    (documents without words stay once). Columns and types stay the same."""
    taken = mix(docs, key=key, seed=seed, **options)
    draw = (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(1 << 20)) / F.lit(float(1 << 20)))
    # Rows of the same key are equal or share a mean number of copies.
    copies = taken.groupBy(key).agg(F.sum("size").alias("s"), F.sum("taken").alias("t"))
    copies = copies.select(F.col(key).alias("mk"), F.when(F.col("s") == 0, 1).otherwise(
        F.floor(F.col("t") / F.col("s") + draw)).cast("int").alias("mn"))
    copies = small_or_shuffled(write_shared(copies, "mix-copies"), 24)
    # Rows travel whole in one column, so no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("rowkey"))
    rows = rows.join(copies, F.col("rowkey").eqNullSafe(F.col("mk"))).filter("mn > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("mn")))).select("row.*")
