"""Correlation screens.

The correlation matrix is computed by Spark, every pair of columns over the
rows that have both, for any number of columns: each task sums masked products
of its rows about their first means, one row per pair leaves it, and a grouped
sum moves them to the means of all rows and adds them: one pass over the rows.
Only the p × p matrix reaches the driver, where the pruning runs on numpy:
O(p²) numbers, no rows. Spearman is Pearson on average ranks, each column
ranked over its own values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.operators._util import materialize, qcol


def average_ranks(df: DataFrame, cols: Sequence[str], strategy: str = "auto",
                  broadcast_rows: int = 500_000) -> DataFrame:
    """Replace each column by its average rank (ties share the mean rank),
    over the column's own values; missing cells stay missing.

    Ranks come from per-column value counts and a distributed prefix sum
    (no global sort). They are joined back column by column, and rows are never
    taken apart: columns of few values by broadcast, ``broadcast_rows`` values
    in all at most; the others by a shuffle of the rows on the value, in which
    missing cells spread over the partitions. ``strategy`` ``"broadcast"`` or
    ``"long"`` (shuffle) does all columns one way, ``"auto"`` by their counts.
    """
    from widetab.operators.ordering import prefix_sum
    cols = list(cols)
    base = df.select(*[F.nanvl(qcol(c).cast("double"), F.lit(None)).alias(f"v{i}") for i, c in enumerate(cols)])
    vc = (base.select(F.posexplode(F.array(*[F.col(f"v{i}") for i in range(len(cols))])).alias("c", "v"))
          .filter("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).cast("double").alias("cnt")))
    ranked = prefix_sum(vc, ["v"], {"below": F.col("cnt")}, ["c"], inclusive=False, materialize_input=True)
    ranks = materialize(ranked.select("c", "v", (F.col("below") + (F.col("cnt") + F.lit(1.0)) / F.lit(2.0)).alias("rank")))
    sizes = {r["c"]: r["n"] for r in ranks.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    left = broadcast_rows
    out = base
    for i in sorted(range(len(cols)), key=lambda i: (sizes.get(i, 0), i)):
        r = ranks.filter(F.col("c") == i).select(F.col("v").alias("__v"), F.col("rank").alias(f"r{i}"))
        left -= sizes.get(i, 0)
        if strategy == "broadcast" or strategy == "auto" and left >= 0:
            out = out.join(F.broadcast(r), F.col(f"v{i}") == F.col("__v"), "left").drop("__v", f"v{i}")
        else:
            spread = F.when(F.col(f"v{i}").isNull(), F.floor(F.rand() * 1024).cast("int")).otherwise(F.lit(0))
            out = out.withColumn("__s", spread).join(
                r.withColumn("__t", F.lit(0) + F.floor(F.lit(0.0)).cast("int")).hint("merge"),
                (F.col(f"v{i}") == F.col("__v")) & (F.col("__s") == F.col("__t")), "left").drop("__v", "__s", "__t", f"v{i}")
    return out.select(*[F.col(f"r{i}").alias(c) for i, c in enumerate(cols)])


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> np.ndarray:
    """p × p correlation matrix on the driver: Pearson over the rows that have
    both columns, pair by pair; Spearman is Pearson on average ranks."""
    cols = list(cols)
    if method == "spearman":
        return correlation_matrix(average_ranks(df, cols), cols, "pearson")
    if method != "pearson":
        raise ValueError(f"unknown method {method!r}")
    p = len(cols)
    m = np.eye(p)
    names = [f"x{i}" for i in range(p)]
    x = df.select(*[F.nanvl(qcol(c).cast("double"), F.lit(None)).alias(n) for c, n in zip(cols, names)])
    if p < 2:
        return m
    i, j = np.triu_indices(p)

    def products(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, near = None, np.zeros(p)
        for batch in it:
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            has = ~np.isnan(v)
            if total is None:
                # Sums of a task are taken about the means of its first rows.
                near = np.where(has, v, 0.0).sum(axis=0) / np.maximum(1, has.sum(axis=0))
                near = np.where(np.isfinite(near), near, 0.0)
            v, has = np.where(has, v - near, 0.0), has.astype(float)
            part = [has.T @ has, v.T @ has, (v * v).T @ has, v.T @ v]
            total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            n, s, q, c = total
            yield pa.RecordBatch.from_arrays(
                [pa.array(k) for k in (i, j, n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j], near[i], near[j])],
                names=["i", "j", "n", "si", "sj", "qi", "qj", "c", "ai", "aj"])
    spark = df.sparkSession
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    # Many columns make one generated method that HotSpot does not compile (over 8000
    # bytes); with this limit Spark splits their projection instead.
    spark.conf.set(limit, "8000")
    try:
        parts = materialize(x.mapInArrow(products, "i bigint, j bigint, n double, si double, sj double, qi double, qj double, "
                                                   "c double, ai double, aj double"))       # one row per task and pair of columns
    finally:
        spark.conf.set(limit, before)
    mean = np.zeros(p)
    for r in parts.filter("i = j and n > 0").groupBy("i").agg((F.sum(F.expr("si + n * ai")) / F.sum("n")).alias("mean")).collect():
        mean[r["i"]] = r["mean"]
    # A task's sums about the means of all rows.
    mean_of = F.array(*[F.lit(float(v)) for v in mean])
    moved = parts.filter("i < j").withColumns({"di": F.col("ai") - F.get(mean_of, F.col("i").cast("int")),
                                              "dj": F.col("aj") - F.get(mean_of, F.col("j").cast("int"))})
    about = {"n": "n", "si": "si + n * di", "sj": "sj + n * dj", "qi": "qi + 2 * di * si + n * di * di",
             "qj": "qj + 2 * dj * sj + n * dj * dj", "c": "c + di * sj + dj * si + n * di * dj"}
    sums = moved.groupBy("i", "j").agg(*[F.sum(F.expr(e)).alias(k) for k, e in about.items()])
    i, j = np.triu_indices(p, 1)
    m[i, j] = m[j, i] = np.nan
    for r in sums.collect():                     # one row per pair of columns
        if r["n"]:
            vi, vj = r["qi"] - r["si"] ** 2 / r["n"], r["qj"] - r["sj"] ** 2 / r["n"]
            # A spread that is only rounding of the mean is a constant column.
            if vi > 1e-20 * r["n"] * mean[r["i"]] ** 2 and vj > 1e-20 * r["n"] * mean[r["j"]] ** 2:
                m[r["i"], r["j"]] = m[r["j"], r["i"]] = (r["c"] - r["si"] * r["sj"] / r["n"]) / np.sqrt(vi * vj)
    return m


def correlation(df: DataFrame, cols: Sequence[str], method: str = "pearson", digits: int | None = None) -> DataFrame:
    """Long form ``(col_a, col_b, r)`` for every pair a before b."""
    cols = list(cols)
    m = correlation_matrix(df, cols, method)
    rows = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            v = float(m[i, j])
            v = None if np.isnan(v) else (round(v, digits) if digits is not None else v)
            rows.append((cols[i], cols[j], v))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def pruning_order(m: np.ndarray, digits: int = 9) -> list[tuple[float, int]]:
    """(|r|, column) of every column that pairwise pruning ever drops, in order.

    Pairs are visited from the largest |r| down (equal ones, rounded to
    ``digits``, in column order). Of a pair whose columns are both still there, the
    one with the larger mean |r| with the columns still there goes (of equal
    ones the later), and the others' means are brought up to date. Pairs above a cutoff
    come before all others, so one sweep holds the result for every cutoff.
    Missing correlations count as 0. O(p² log p) on the matrix alone.
    """
    a = np.round(np.abs(np.nan_to_num(np.asarray(m, dtype=float), nan=0.0)), digits)
    np.fill_diagonal(a, 0.0)
    i, j = np.triu_indices(len(a), 1)
    left, sums = np.ones(len(a), dtype=bool), a.sum(axis=1)
    out: list[tuple[float, int]] = []
    for e in np.lexsort((j, i, -a[i, j])).tolist():
        x, y = int(i[e]), int(j[e])
        if left[x] and left[y]:
            # Both means have the same divisor.
            gone = x if round(sums[x] - sums[y], digits) > 0 else y
            left[gone] = False
            sums -= a[gone]
            out.append((float(a[x, y]), gone))
    return out


def prune_correlated(m: np.ndarray, cols: Sequence[str], cutoff: float = 0.95) -> list[str]:
    """Columns that pairwise pruning drops at a cutoff (B23), in order."""
    return [cols[c] for r, c in pruning_order(m) if r > cutoff]


def columns_in_both(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """Columns present in both lists, in the order of ``a``."""
    sb = set(b)
    return [c for c in a if c in sb]


def prune_curve(m: np.ndarray, cols: Sequence[str], steps: int = 101) -> list[tuple[float, int]]:
    """Number of columns pruned at cutoffs 0.00 … 1.00 (B25), from one sweep."""
    dropped = np.array([r for r, _ in pruning_order(m)])
    return [(round(k / (steps - 1), 4), int((dropped > k / (steps - 1)).sum())) for k in range(steps)]
