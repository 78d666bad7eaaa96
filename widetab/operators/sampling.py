"""Repeatable splits, folds, bags and samples.

Every random choice is a hash of ``(key, seed)`` (see
``widetab.functions.hashing``), so it does not depend on partitioning, is
stable under task retries and can be reproduced in SQL. Exact-count choices
use ``ordering.nth_smallest`` (histogram passes, no global sort); per-class
row numbers use ``ordering.row_number`` (bucketed windows).
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.functions.hashing import U32, key_hash
from widetab.operators._util import broadcast_if_small
from widetab.operators.ordering import first_n, row_number

SHARE_SCALE = 10000


def _scale(*shares: float) -> int:
    """Modulus that shares are cut at: the smallest power of ten from 10^4 on
    at which all of them are whole numbers, else the full hash range."""
    exact = [Fraction(str(s)) for s in shares]
    scale = SHARE_SCALE
    while scale < U32:
        if all((x * scale).denominator == 1 for x in exact):
            return scale
        scale *= 10
    return U32


def with_hash(df: DataFrame, key: str, seed=0, fn: str = "md5", name: str = "h") -> DataFrame:
    return df.withColumn(name, key_hash(key, seed, fn))


def holdout_n(df: DataFrame, key: str, n: int, seed=0, fn: str = "md5",
              flag: str = "is_holdout") -> DataFrame:
    """Exactly ``n`` rows flagged: the n smallest by (hash(key, seed), key)."""
    hashed = with_hash(df, key, seed, fn, "__h")
    return first_n(hashed, ["__h", key], n, flag).drop("__h")


def split(df: DataFrame, key: str, shares: Sequence[float], seed=0, fn: str = "md5",
          name: str = "part") -> DataFrame:
    """Share split into parts 0..len(shares)-1 by the hash modulo 10000, or
    a finer modulus if the shares ask for it (D2).

    Share boundaries are cumulative; stable across layouts, unlike
    ``randomSplit``.
    """
    exact = [Fraction(str(s)) for s in shares]
    cuts = [sum(exact[:i + 1]) / sum(exact) for i in range(len(exact) - 1)]
    scale = _scale(*[float(c) for c in cuts])
    edges = [round(c * scale) for c in cuts]
    u = F.pmod(key_hash(key, seed, fn), F.lit(scale))
    expr = F.lit(len(shares) - 1)
    for i, e in reversed(list(enumerate(edges))):
        expr = F.when(u < e, F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr.cast("int"))


def head_tail(df: DataFrame, key: str, k: int, flag: str = "is_head") -> DataFrame:
    """First ``k`` rows by key flagged, the rest not (D3)."""
    return first_n(df, [key], k, flag)


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed=0, fn: str = "md5",
                     exact: bool = True, name: str = "fold") -> DataFrame:
    """Stratified k folds.

    Exact form: within each class rows are numbered by (hash, key) and dealt
    round-robin, so per class the fold sizes differ by at most one. Rows
    without a label are a class of their own.
    Scale form (``exact=False``): ``pmod(hash, k)``, balanced in expectation,
    no shuffle at all.
    """
    if not exact:
        return df.withColumn(name, F.pmod(key_hash(key, seed, fn), F.lit(k)).cast("int"))
    hashed = with_hash(df, key, seed, fn, "__h")
    numbered = row_number(hashed, ["__h", key], [label], "__rn")
    return numbered.withColumn(name, F.pmod(F.col("__rn") - 1, F.lit(k)).cast("int")) \
        .drop("__h", "__rn")


def stratified_split(df: DataFrame, key: str, label: str, share: float, seed=0, fn: str = "md5",
                     flag: str = "is_test") -> DataFrame:
    """Stratified shuffle split (D5): in every class exactly
    ``round(share * class size)`` rows (half up) go to the test side, chosen
    by (hash, key). Rows without a label are a class of their own."""
    hashed = with_hash(df, key, seed, fn, "__h")
    numbered = row_number(hashed, ["__h", key], [label], "__rn")
    sizes = df.groupBy(F.col(label).alias("__label")).agg(
        F.floor(F.count(F.lit(1)) * F.lit(share) + F.lit(0.5)).cast("bigint").alias("__n_test"))
    joined = numbered.join(broadcast_if_small(sizes), F.col(label).eqNullSafe(F.col("__label")))
    return joined.withColumn(flag, F.col("__rn") <= F.col("__n_test")).drop("__h", "__rn", "__n_test", "__label")


def every_nth(df: DataFrame, key: str, n: int, flag: str = "is_valid") -> DataFrame:
    """Every n-th row in key order (1-based) flagged for validation."""
    numbered = row_number(df, [key], (), "__rn")
    return numbered.withColumn(flag, F.pmod(F.col("__rn"), F.lit(n)) == 0).drop("__rn")


def shuffle(df: DataFrame, key: str, seed=0, fn: str = "md5", partitions: int | None = None) -> DataFrame:
    """Rows in a seeded pseudo-random order (D7): range-partitioned and sorted
    by (hash, key), so a partition-ordered reader sees a stable shuffle."""
    hashed = with_hash(df, key, seed, fn, "__h")
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    return hashed.repartitionByRange(n, "__h", key).sortWithinPartitions("__h", key).drop("__h")


def folds(df: DataFrame, key: str, k: int, seed=0, fn: str = "md5", name: str = "fold") -> DataFrame:
    """Plain k folds by ``pmod(hash(key, seed), k)``."""
    return df.withColumn(name, F.pmod(key_hash(key, seed, fn), F.lit(k)).cast("int"))


def _thresholds_for_seeds(keys: DataFrame, key: str, n: int, seeds: Sequence, fn: str = "md5",
                          small: int = 200_000, bins: int = 4096) -> dict:
    """For every seed s, the (hash, key) of the n-th smallest row by
    (hash(key, s), key), found for all seeds together: each refinement
    level is one scan and one aggregate keyed by (seed index, bucket), so
    the number of scans does not grow with the number of seeds."""
    seeds = list(seeds)
    k = len(seeds)
    total = keys.count()
    if n <= 0 or total < n:
        return {s: None for s in seeds}
    lo = {i: 0 for i in range(k)}
    hi = {i: U32 - 1 for i in range(k)}
    m = {i: n for i in range(k)}
    cnt = {i: total for i in range(k)}
    hash_of = F.element_at(F.array(*[key_hash(key, s, fn) for s in seeds]), F.col("__i") + 1)
    exploded = keys.select(key, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("__i")) \
        .withColumn("__h", hash_of)

    def in_range(active):
        cond = F.lit(False)
        for i in active:
            cond = cond | ((F.col("__i") == i) & F.col("__h").between(lo[i], hi[i]))
        return cond

    active = [i for i in range(k) if cnt[i] > small and lo[i] != hi[i]]
    while active:
        lo_e = F.element_at(F.array(*[F.lit(float(lo[i])) for i in range(k)]), F.col("__i") + 1)
        hi_e = F.element_at(F.array(*[F.lit(float(hi[i])) for i in range(k)]), F.col("__i") + 1)
        bucket = F.width_bucket(F.col("__h").cast("double"), lo_e, hi_e, F.lit(bins))
        rows = (exploded.filter(in_range(active)).groupBy("__i", bucket.alias("b"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("__h").alias("lo"), F.max("__h").alias("hi"))
                .orderBy("__i", "b").collect())
        seen = {i: 0 for i in active}
        done = set()
        for r in rows:
            i = r["__i"]
            if i in done:
                continue
            if seen[i] + r["n"] >= m[i]:
                m[i] -= seen[i]
                cnt[i], lo[i], hi[i] = r["n"], r["lo"], r["hi"]
                done.add(i)
            else:
                seen[i] += r["n"]
        active = [i for i in active if cnt[i] > small and lo[i] != hi[i]]
    # Final step on the small candidate sets: row_number per seed (bounded
    # by ``small`` rows per seed, or by ties of one hash value).
    from pyspark.sql import Window
    w = Window.partitionBy("__i").orderBy("__h", key)
    cands = exploded.filter(in_range(range(k))).withColumn("__rn", F.row_number().over(w))
    want = F.element_at(F.array(*[F.lit(m[i]) for i in range(k)]), F.col("__i") + 1)
    picked = {r["__i"]: (r["__h"], r[key]) for r in cands.filter(F.col("__rn") == want)
              .select("__i", "__h", key).collect()}
    return {s: picked.get(i) for i, s in enumerate(seeds)}


def bags(df: DataFrame, key: str, n_bags: int, row_share: float = 0.8, valid_share: float = 0.1,
         seed=0, fn: str = "md5", exact: bool = True) -> DataFrame:
    """Long bag membership table ``(bag, key, is_valid)``.

    Bag b holds exactly ``floor(row_share * n)`` rows (without replacement),
    those with the smallest (hash(key, seed + b), key). Inside the bag a share
    ``valid_share`` is marked for validation by a second hash. Column
    sub-samples are schema-level: use ``profile.sample_columns(cols, k, seed + b)``.
    """
    total = df.count()
    size = int(Fraction(str(row_share)) * total)  # exact floor, no float rounding
    seeds = [seed + b for b in range(n_bags)]
    thresholds = _thresholds_for_seeds(df.select(key), key, size, seeds, fn) if exact else {}
    share_scale, valid_scale = _scale(row_share), _scale(valid_share)
    entries = []
    for b, s in enumerate(seeds):
        h = key_hash(key, s, fn)
        if exact:
            t = thresholds[s]
            member = (F.lit(size >= total) if t is None
                      else (h < F.lit(t[0])) | ((h == F.lit(t[0])) & (F.col(key) <= F.lit(t[1]))))
        else:
            member = F.pmod(h, F.lit(share_scale)) < round(Fraction(str(row_share)) * share_scale)
        vh = F.pmod(key_hash(key, f"{s}_valid", fn), F.lit(valid_scale))
        entries.append(F.when(member, F.struct(
            F.lit(b).alias("bag"), (vh < round(Fraction(str(valid_share)) * valid_scale)).alias("is_valid"))))
    # One scan: a row's memberships are one array, exploded.
    return (df.select(key, F.explode(F.array_compact(F.array(*entries))).alias("__m"))
            .select(F.col("__m.bag").alias("bag"), key, F.col("__m.is_valid").alias("is_valid")))
