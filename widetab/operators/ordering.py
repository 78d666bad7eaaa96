"""Order statistics without a global sort (distributed ranks and prefix sums).

Spark's ``Window.orderBy`` without ``partitionBy`` moves every row into one
task. The two helpers here avoid that:

* ``nth_smallest`` finds the exact n-th row of a total order by repeated
  histograms: each pass is a scan plus an aggregate into at most ``bins``
  groups, and narrows the candidate range to one bucket. Only bucket counts
  (and finally one row) reach the driver.
* ``prefix_sum`` computes running sums (row numbers, ranks, "negatives
  below") by range-partitioning the rows by (group, order), running a window
  inside each (partition, group) and adding what the partitions before hold,
  which is at most one row per group and partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from widetab.operators._util import NUMERIC_TYPES, broadcast_if_small, materialize
from widetab.session import shuffle_partitions

SMALL_RANGE_ROWS = 200_000
HIST_BINS = 4096


def _lex_le(cols: Sequence[str], values: Sequence) -> Column:
    """(cols) <= (values) lexicographically."""
    expr = F.col(cols[-1]) <= F.lit(values[-1])
    for c, v in zip(reversed(cols[:-1]), reversed(values[:-1])):
        expr = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & expr)
    return expr


def nth_smallest(df: DataFrame, order_cols: Sequence[str], n: int,
                 small: int = SMALL_RANGE_ROWS, bins: int = HIST_BINS):
    """Values of ``order_cols`` at the n-th smallest row (1-based), or None
    when the table has fewer than n rows. ``order_cols`` must form a total
    order (end with a unique key). Numeric columns are narrowed by histograms;
    if one is of another type, the row is found by its distributed row number."""
    if n <= 0:
        return None
    order_cols = list(order_cols)
    base = df.select(*order_cols)
    if not all(isinstance(base.schema[c].dataType, NUMERIC_TYPES) for c in order_cols):
        row = row_number(base, order_cols, name="__rn").filter(F.col("__rn") == n).first()
        return None if row is None else tuple(row[c] for c in order_cols)
    prefix: list = []
    m = n
    cols = order_cols
    while True:
        first = cols[0]
        stats = base.agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("lo"),
                         F.max(first).alias("hi")).first()
        total, lo, hi = stats["n"], stats["lo"], stats["hi"]
        if total < m:
            return None
        while total > small and lo != hi:
            # One histogram pass over the current range.
            bucket = F.width_bucket(F.col(first).cast("double"), F.lit(float(lo)), F.lit(float(hi)),
                                    F.lit(bins))
            rows = (base.filter(F.col(first).between(lo, hi)).groupBy(bucket.alias("b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("lo"),
                         F.max(first).alias("hi"))
                    .orderBy("b").collect())
            seen = 0
            for r in rows:
                if seen + r["n"] >= m:
                    m -= seen
                    total, lo, hi = r["n"], r["lo"], r["hi"]
                    break
                seen += r["n"]
            base = base.filter(F.col(first).between(lo, hi))
        if lo == hi and total > small and len(cols) > 1:
            # Many ties on this column: fix it and continue on the next one.
            prefix.append(lo)
            base = base.filter(F.col(first) == F.lit(lo)).drop(first)
            cols = cols[1:]
            continue
        cand = base.filter(F.col(first).between(lo, hi)) if lo is not None else base
        row = (cand.orderBy(*cols).limit(m)
               .agg(F.max(F.struct(*cols)).alias("t")).first()["t"])
        return tuple(prefix) + tuple(row[c] for c in cols)


def first_n(df: DataFrame, order_cols: Sequence[str], n: int, flag: str) -> DataFrame:
    """``df`` with boolean ``flag`` true on the n smallest rows of the order."""
    t = nth_smallest(df, order_cols, n)
    if t is None:
        return df.withColumn(flag, F.lit(n > 0))
    return df.withColumn(flag, _lex_le(list(order_cols), list(t)))


def prefix_sum(df: DataFrame, order_cols: Sequence[str], values: dict[str, Column],
               partition_cols: Sequence[str] = (), inclusive: bool = True,
               n_buckets: int | None = None, materialize_input: bool = False) -> DataFrame:
    """Running sums of ``values`` along ``order_cols`` within ``partition_cols``.

    Adds one column per entry of ``values`` (name → expression), holding the
    sum over all earlier rows (and the row itself when ``inclusive``). Ties in
    ``order_cols`` are broken arbitrarily, so pass a total order. Columns of any
    sortable type will do; NULL groups are a group, NULL order values come
    first.

    Rows are range-partitioned by (group, order) and written once, so every
    group, wide or narrow, is cut by its own rows. Each partition sums its own
    part of each group; what comes before it is one row per (partition, group)
    it holds, at most groups + partitions rows. ``materialize_input`` writes an
    input that is costly to compute first (range partitioning samples it).
    """
    spark = df.sparkSession
    order_cols, partition_cols = list(order_cols), list(partition_cols)
    if materialize_input:
        df = materialize(df)
    parts = n_buckets or max(16, 4 * shuffle_partitions(spark))
    staged = df.withColumns({f"__v_{n}": e for n, e in values.items()})
    laid = materialize(staged.repartitionByRange(parts, *partition_cols, *order_cols)
                       .withColumn("__part", F.spark_partition_id()))
    totals = laid.groupBy(*partition_cols, "__part").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in values])
    before = Window.partitionBy(*partition_cols).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__part").alias("__op"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(partition_cols)],
                            *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in values])
    same = F.col("__part") == F.col("__op")
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    out = laid.join(broadcast_if_small(offsets), same)
    w = Window.partitionBy("__part", *partition_cols).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sel = [F.col(c) for c in df.columns]
    for n in values:
        run = F.sum(f"__v_{n}").over(w)
        if not inclusive:
            run = run - F.col(f"__v_{n}")
        sel.append((F.col(f"__o_{n}") + run).alias(n))
    return out.select(*sel)


def row_number(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
               name: str = "rn", **kw) -> DataFrame:
    """1-based row number along a total order, without a single-task sort."""
    out = prefix_sum(df, order_cols, {name: F.lit(1).cast("bigint")}, partition_cols, True, **kw)
    return out.withColumn(name, F.col(name).cast("bigint"))
