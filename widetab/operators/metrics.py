"""Evaluation: AUC, log loss, progressive reports, score tables.

AUC is computed from counts per distinct score. Rows are first reduced to
``(group, score) → (pos, neg)`` with a partial aggregate (a hot score value
becomes one row), then laid out by ranges of (group, score): each partition sums
its own pairs, and one row per (group, partition) is left to put together. With ties:
AUC = Σ pos·(neg_below + neg/2) / (P·N), which equals the average-rank
formula (Σ ranks of positives − P(P+1)/2) / (P·N).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.functions.exprs import safe_ratio
from widetab.operators.ordering import prefix_sum

# Fixed value: probability clip of the log loss (written 10e-15 in the
# reference, i.e. 1e-14).
LOGLOSS_EPS = 1e-14


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by…, __s, __pos, __neg)`` per distinct score; rows with a missing
    (NULL or NaN) score or label are left out."""
    by = list(by)
    s = F.col(score).cast("double")
    df = df.filter(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
    return df.groupBy(*by, s.alias("__s")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("__pos"),
        F.count_if(F.col(label) != 1).cast("double").alias("__neg"))


def _partition_ranks(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per (group, partition) of counts laid out by (group, score): P, N and U, the
    positive-negative pairs in order within the partition (ties by half)."""
    by = list(by)
    laid = counts.select(*by, "__s", "__pos", "__neg").repartitionByRange(*by, "__s").sortWithinPartitions(*by, "__s")
    fields = [laid.schema[c] for c in by]
    schema = T.StructType([*fields, T.StructField("__part", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in "PNU"]])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, sums = TaskContext.get().partitionId(), None, np.zeros(3)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v.as_py()], v.type) for v in held], pa.array([part], pa.int32()),
                 *[pa.array([float(x)]) for x in sums]], names=schema.names)
        for b in it:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, dtype=bool)
            for c in by:
                codes = b.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                codes = np.nan_to_num(codes.astype(float), nan=-1.0)
                new[1:] |= codes[1:] != codes[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
            pos, neg = b.column("__pos").to_numpy(), b.column("__neg").to_numpy()
            for i, j in zip(starts, starts[1:]):
                group = [b.column(c)[i] for c in by]
                if held is None or not all(x.equals(y) for x, y in zip(held, group)):
                    if held is not None:
                        yield row()
                    held, sums = group, np.zeros(3)
                p, n = pos[i:j], neg[i:j]
                below = sums[1] + np.cumsum(n) - n
                sums = sums + [p.sum(), n.sum(), (p * (below + n / 2)).sum()]
        if held is not None:
            yield row()
    return laid.mapInArrow(run, schema)


def auc_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC per group from a ``(by…, __s, __pos, __neg)`` count table: one range
    repartition, partial sums per (group, partition), and those put together in
    partition order (a partition's positives stand above all negatives of the
    partitions before it)."""
    by = list(by)
    parts = _partition_ranks(counts, by)                 # at most groups + partitions rows
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("__below", F.coalesce(F.sum("N").over(before), F.lit(0.0)))
    agg = placed.groupBy(*by).agg(F.sum("P").alias("P"), F.sum("N").alias("N"),
                                  F.sum(F.col("U") + F.col("P") * F.col("__below")).alias("U"))
    if not by:
        # No rows at all still give one row, as any aggregate without groups.
        agg = agg.select(F.coalesce("P", F.lit(0.0)).alias("P"), F.coalesce("N", F.lit(0.0)).alias("N"), "U")
    return agg.select(*by, F.col("P").cast("bigint").alias("n_pos"), F.col("N").cast("bigint").alias("n_neg"),
                      F.try_divide(F.col("U"), F.col("P") * F.col("N")).alias("auc"))


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """AUC per group with average ranks for ties (F1). NULL when a class is
    empty. Output: ``*by, n_pos, n_neg, auc``."""
    return auc_from_counts(score_counts(df, score, label, by), by)


def logloss(df: DataFrame, p: str, label: str, by: Sequence[str] = (), eps: float = LOGLOSS_EPS) -> DataFrame:
    """Mean binary log loss with p clipped to [eps, 1 − eps] (F2)."""
    pc = F.greatest(F.least(F.col(p).cast("double"), F.lit(1.0 - eps)), F.lit(eps))
    y = F.col(label).cast("double")
    ll = -(y * F.ln(pc) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - pc))
    return df.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.avg(ll).alias("logloss"))


def row_logloss(p, label, eps: float = LOGLOSS_EPS):
    pc = F.greatest(F.least(F.col(p).cast("double"), F.lit(1.0 - eps)), F.lit(eps))
    y = F.col(label).cast("double")
    return -(y * F.ln(pc) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - pc))


def score_table(preds: DataFrame, label: str, score: str = "target",
                by: Sequence[str] = ("model", "split"),
                eps: float = LOGLOSS_EPS) -> DataFrame:
    """AUC and log loss per (model, split) in one table.

    One pass over the rows builds the per-distinct-score counts (written
    once); AUC and log loss both come from that small table, since the loss
    of a row depends only on its score and label.
    """
    by = list(by)
    from widetab.operators._util import materialize
    counts = materialize(score_counts(preds, score, label, by))
    a = auc_from_counts(counts, by)
    pc = F.greatest(F.least(F.col("__s"), F.lit(1.0 - eps)), F.lit(eps))
    ll = counts.groupBy(*by).agg(
        (F.sum(F.col("__pos") * -F.ln(pc) + F.col("__neg") * -F.ln(F.lit(1.0) - pc))
         / F.sum(F.col("__pos") + F.col("__neg"))).alias("logloss"))
    ll = ll.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], "logloss")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return a.join(ll, same, "left").drop(*[f"__g{i}" for i in range(len(by))])


def progress(preds: DataFrame, order: str, label: str, score: str, step: int,
             valid_flag: str = "is_valid", by: Sequence[str] = ()) -> DataFrame:
    """Progressive report (F3): for each block of ``step`` rows in ``order``
    (an integer position, e.g. a row number), the running train loss, running
    hold-out loss and hold-out row count up to the end of the block.

    One aggregate reduces rows to blocks (n/step rows); the running sums over
    blocks are a distributed prefix sum, so a long pass never puts all
    blocks into one task.
    """
    by = list(by)
    block = F.floor((F.col(order) - 1) / F.lit(step)).cast("bigint")
    ll = row_logloss(score, label)
    per = preds.groupBy(*by, block.alias("block")).agg(
        F.coalesce(F.sum(F.when(~F.col(valid_flag), ll)), F.lit(0.0)).alias("tl"),
        F.count_if(~F.col(valid_flag)).cast("double").alias("tn"),
        F.coalesce(F.sum(F.when(F.col(valid_flag), ll)), F.lit(0.0)).alias("vl"),
        F.count_if(F.col(valid_flag)).cast("double").alias("vn"),
        F.max(order).alias("rows"))
    run = prefix_sum(per, ["block"], {"ctl": F.col("tl"), "ctn": F.col("tn"), "cvl": F.col("vl"),
                                      "cvn": F.col("vn")}, by, inclusive=True)
    return run.select(
        *by, "block", F.col("rows").cast("bigint").alias("rows"),
        safe_ratio(F.col("ctl"), F.col("ctn")).alias("train_logloss"),
        safe_ratio(F.col("cvl"), F.col("cvn")).alias("valid_logloss"),
        F.col("cvn").cast("bigint").alias("n_valid"))


def best_run(log: DataFrame, metric: str, higher_is_better: bool = True,
             by: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """Row(s) with the best metric (F7); ties go to the smallest ``tiebreak``
    values. Per group when ``by`` is given (row_number ≤ 1 lets Spark limit
    each group before the shuffle)."""
    by = list(by)
    o = F.col(metric).desc_nulls_last() if higher_is_better else F.col(metric).asc_nulls_last()
    rest = [F.col(c).asc() for c in tiebreak]
    if not by:
        return log.orderBy(o, *rest).limit(1)
    w = Window.partitionBy(*by).orderBy(o, *rest)
    return log.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def best_round(curve: DataFrame, metric: str = "auc", round_col: str = "round",
               higher_is_better: bool = True) -> DataFrame:
    """The round with the best validation metric from a per-round curve (F8);
    ties go to the earliest round."""
    o = F.col(metric).desc_nulls_last() if higher_is_better else F.col(metric).asc_nulls_last()
    return curve.orderBy(o, F.col(round_col).asc()).limit(1)
