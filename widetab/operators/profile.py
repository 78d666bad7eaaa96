"""Column profiling and screening of wide tables.

The shared work is one *value-count table*: the wide table is unpivoted
(numbers and text separately, so ``0.0`` and ``-0.0`` never become different
strings) and grouped by ``(column, value)``. Partial aggregation runs before
the shuffle, so low-cardinality columns cost almost nothing to move. Distinct
counts, constants, near-zero variance, top values and missing-pattern groups
are all read from that one table; only p-row results reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from widetab.functions.exprs import null_if_token, safe_ratio, DEFAULT_NA_TOKENS
from widetab.operators._util import (
    bounded_broadcast, broadcast_if_small, chunks, columns_by_type, materialize, qcol, sum_columns,
)

# Library-default cut-offs of the near-zero-variance rule (caret): the ratio
# of the commonest to the second commonest value must exceed 95/5, and the
# share of distinct values (in percent) must be at most 10.
NZV_FREQ_CUT = 95 / 5
NZV_UNIQUE_CUT = 10.0

VC_SCHEMA_COLS = ["col_name", "kind", "v_num", "v_txt", "cnt"]
UNPIVOT_CHUNK = 400


def _profile_columns(df: DataFrame, exclude: Iterable[str]) -> tuple[list[str], list[str]]:
    kinds = columns_by_type(df, exclude)
    return kinds["numeric"], kinds["text"]


def _unpivot(df: DataFrame, cols: list[str], cast: str, value: str) -> DataFrame:
    sel = df.select(*[qcol(c).cast(cast).alias(c) for c in cols])
    return sel.unpivot([], cols, "col_name", value)


def long_values(df: DataFrame, exclude: Iterable[str] = (), numeric: Sequence[str] | None = None,
                text: Sequence[str] | None = None) -> DataFrame:
    """Wide → long ``(col_name, kind, v_num, v_txt)`` with one row per cell.

    One ``unpivot`` (a single Expand over one scan): every cell becomes a
    struct of a double and a string, one of them NULL, so numbers are never
    turned into text.
    """
    if numeric is None or text is None:
        num, txt = _profile_columns(df, exclude)
        numeric = num if numeric is None else numeric
        text = txt if text is None else text
    numeric, text = list(numeric), list(text)
    if not numeric and not text:
        raise ValueError("no numeric or text columns to profile")
    # The cast makes both struct fields nullable for every column: unpivot
    # takes the struct type of the first column, and a non-nullable field
    # there would turn the other columns' NULLs into 0.0.
    cell = "struct<v_num:double,v_txt:string>"
    cells = {c: F.struct(qcol(c).cast("double").alias("v_num"), F.lit(None).cast("string").alias("v_txt"))
             .cast(cell).alias(c) for c in numeric}
    cells |= {c: F.struct(F.lit(None).cast("double").alias("v_num"), qcol(c).cast("string").alias("v_txt"))
              .cast(cell).alias(c) for c in text}
    # Very wide tables are unpivoted in column chunks (one Expand each) so
    # the generated code per operator stays bounded.
    out = None
    for part in chunks(numeric + text, UNPIVOT_CHUNK):
        long = df.select(*[cells[c] for c in part]).unpivot([], list(part), "col_name", "cell")
        part_num = [c for c in part if c in set(numeric)]
        kind = F.when(F.col("col_name").isin(part_num), F.lit("numeric")).otherwise(F.lit("text"))
        long = long.select("col_name", kind.alias("kind"), F.col("cell.v_num").alias("v_num"),
                           F.col("cell.v_txt").alias("v_txt"))
        out = long if out is None else out.unionByName(long)
    return out


def value_counts(df: DataFrame, exclude: Iterable[str] = (), numeric: Sequence[str] | None = None,
                 text: Sequence[str] | None = None) -> DataFrame:
    """Counts per ``(column, value)``; a missing cell is the value NULL."""
    return (long_values(df, exclude, numeric, text)
            .groupBy("col_name", "kind", "v_num", "v_txt")
            .agg(F.count(F.lit(1)).alias("cnt")))


def approx_column_stats(df: DataFrame, numeric: Sequence[str], text: Sequence[str],
                        rsd: float = 0.02) -> DataFrame:
    """Per column in one wide aggregate (chunks of 200 columns, no value
    shuffle): rows, missing count, HyperLogLog++ distinct count of the
    non-missing values, min and max of numbers."""
    out = None
    for kind, cols in (("numeric", list(numeric)), ("text", list(text))):
        for part in chunks(cols, 200):
            exprs = [F.count(F.lit(1)).alias("__n")]
            for c in part:
                v = qcol(c).cast("double") if kind == "numeric" else qcol(c)
                exprs += [F.count_if(qcol(c).isNull()).alias(f"z::{c}"),
                          F.approx_count_distinct(v, rsd).alias(f"d::{c}"),
                          (F.min(v) if kind == "numeric" else F.lit(None).cast("double")).alias(f"lo::{c}"),
                          (F.max(v) if kind == "numeric" else F.lit(None).cast("double")).alias(f"hi::{c}")]
            row = df.agg(*exprs)
            stack = ", ".join(f"'{c}', `z::{c}`, `d::{c}`, `lo::{c}`, `hi::{c}`" for c in part)
            long = row.selectExpr(
                "__n", f"stack({len(part)}, {stack}) as (col_name, n_null, n_dnn_approx, min_value, max_value)") \
                .select("col_name", F.lit(kind).alias("kind"), F.col("__n").cast("bigint").alias("n_rows"),
                        F.col("n_null").cast("bigint").alias("n_null"),
                        F.col("n_dnn_approx").cast("bigint").alias("n_dnn_approx"),
                        F.col("min_value").cast("double").alias("min_value"),
                        F.col("max_value").cast("double").alias("max_value"))
            out = long if out is None else out.unionByName(long)
    return out


def column_profile(df: DataFrame, exclude: Iterable[str] = (), vc: DataFrame | None = None,
                   freq_cut: float = NZV_FREQ_CUT, unique_cut: float = NZV_UNIQUE_CUT,
                   exact: bool = True, rsd: float = 0.02) -> DataFrame:
    """One row per column.

    ``n_distinct`` counts a missing value as one value (as ``unique`` does);
    ``n_distinct_nonnull`` does not. ``top1`` / ``top2`` are the counts of the
    commonest and second commonest non-missing values. ``zero_var`` and
    ``nzv`` follow the near-zero-variance rule, ``is_constant`` the
    one-distinct-value rule (missing counted).

    ``exact=False`` first runs one approximate pass (no value shuffle). A
    column whose approximate share of distinct values is above
    ``unique_cut`` with a margin of 5 standard errors cannot be constant or
    near-zero-variance; it keeps exact null counts and min/max, an
    approximate ``n_distinct`` and NULL top counts, and is left out of the
    value-count shuffle, whose size near-unique columns would otherwise
    dominate. The other columns get the exact profile.
    """
    if vc is None and not exact:
        num, txt = _profile_columns(df, exclude)
        stats = materialize(approx_column_stats(df, num, txt, rsd))
        rows = stats.collect()  # p rows
        cut = unique_cut / 100.0 * (1.0 + 5.0 * rsd)
        wide_cols = {r["col_name"] for r in rows
                     if r["n_rows"] and r["n_dnn_approx"] > max(1, r["n_rows"] * cut + 1)}
        keep_num = [c for c in num if c not in wide_cols]
        keep_txt = [c for c in txt if c not in wide_cols]
        approx_rows = stats.filter(F.col("col_name").isin(sorted(wide_cols))).select(
            "col_name", "kind", "n_rows", "n_null",
            (F.col("n_dnn_approx") + F.when(F.col("n_null") > 0, 1).otherwise(0)).cast("bigint").alias("n_distinct"),
            F.col("n_dnn_approx").alias("n_distinct_nonnull"), "min_value", "max_value",
            F.lit(None).cast("bigint").alias("top1"), F.lit(None).cast("bigint").alias("top2"),
            F.lit(None).cast("double").alias("freq_ratio"),
            (F.lit(100.0) * safe_ratio(F.col("n_dnn_approx"), F.col("n_rows"))).alias("pct_unique"),
            F.lit(False).alias("is_constant"), F.lit(False).alias("zero_var"), F.lit(False).alias("nzv"))
        if not keep_num and not keep_txt:
            return approx_rows
        exact_rows = column_profile(df.select(*[qcol(c) for c in keep_num + keep_txt]),
                                    freq_cut=freq_cut, unique_cut=unique_cut)
        return exact_rows.unionByName(approx_rows)
    # The value counts feed two passes below; write them once.
    vc = materialize(value_counts(df, exclude)) if vc is None else vc
    isnull = F.col("v_num").isNull() & F.col("v_txt").isNull()
    first = (vc.groupBy("col_name", "kind").agg(
        F.sum("cnt").alias("n_rows"),
        F.sum(F.when(isnull, F.col("cnt")).otherwise(0)).alias("n_null"),
        F.count_if(~isnull).alias("n_distinct_nonnull"),
        F.min("v_num").alias("min_value"),
        F.max("v_num").alias("max_value"),
        F.max(F.when(~isnull, F.col("cnt"))).alias("top1"),
    ))
    # Second pass over the counts for the runner-up, joined to a p-row table.
    p_bound = len(df.columns)
    tops = bounded_broadcast(first.select("col_name", "top1"), p_bound)
    second = (vc.filter(~isnull).join(tops, "col_name")
              .groupBy("col_name").agg(
                  F.count_if(F.col("cnt") == F.col("top1")).alias("n_at_top"),
                  F.max(F.when(F.col("cnt") < F.col("top1"), F.col("cnt"))).alias("below_top")))
    prof = first.join(bounded_broadcast(second, p_bound), "col_name", "left")
    top2 = F.when(F.col("n_at_top") >= 2, F.col("top1")).otherwise(F.col("below_top"))
    freq_ratio = F.when(F.col("n_distinct_nonnull") <= 1, F.lit(0.0)) \
        .otherwise(safe_ratio(F.col("top1"), top2))
    pct_unique = F.lit(100.0) * safe_ratio(F.col("n_distinct_nonnull"), F.col("n_rows"))
    zero_var = (F.col("n_distinct_nonnull") <= 1)
    n_distinct = F.col("n_distinct_nonnull") + F.when(F.col("n_null") > 0, 1).otherwise(0)
    return prof.select(
        "col_name", "kind",
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("n_null").cast("bigint").alias("n_null"),
        n_distinct.cast("bigint").alias("n_distinct"),
        F.col("n_distinct_nonnull").cast("bigint").alias("n_distinct_nonnull"),
        "min_value", "max_value",
        F.col("top1").cast("bigint").alias("top1"),
        top2.cast("bigint").alias("top2"),
        freq_ratio.alias("freq_ratio"),
        pct_unique.alias("pct_unique"),
        (n_distinct == 1).alias("is_constant"),
        zero_var.alias("zero_var"),
        (((freq_ratio > F.lit(freq_cut)) & (pct_unique <= F.lit(unique_cut))) | zero_var).alias("nzv"),
    )


def distinct_counts(df: DataFrame, exclude: Iterable[str] = (), approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct values per column, a missing value counted once.

    ``approx=True`` uses HyperLogLog++ in one wide aggregate (no value-count
    shuffle), chunked by 200 columns.
    """
    if not approx:
        return column_profile(df, exclude).select("col_name", "kind", "n_distinct")
    num, txt = _profile_columns(df, exclude)
    out = None
    for kind, cols in (("numeric", num), ("text", txt)):
        for part in chunks(cols, 200):
            exprs = []
            for c in part:
                exprs += [F.approx_count_distinct(qcol(c), rsd).alias(f"d::{c}"),
                          F.max(qcol(c).isNull().cast("int")).alias(f"n::{c}")]
            row = df.agg(*exprs)
            stack = ", ".join(f"'{c}', `d::{c}` + `n::{c}`" for c in part)
            long = row.selectExpr(f"stack({len(part)}, {stack}) as (col_name, n_distinct)") \
                .select("col_name", F.lit(kind).alias("kind"), F.col("n_distinct").cast("bigint"))
            out = long if out is None else out.unionByName(long)
    return out


def constant_columns(profile: DataFrame) -> DataFrame:
    """Columns with a single value, a missing value counted as a value."""
    return profile.filter("is_constant").select("col_name")


def drop_constant(train: DataFrame, test: DataFrame | None = None, exclude: Iterable[str] = ()):
    """Drop columns constant on ``train`` from both tables.

    The p-row list of constant names is the only thing collected.
    """
    names = [r["col_name"] for r in constant_columns(column_profile(train, exclude)).collect()]
    keep = [c for c in train.columns if c not in set(names)]
    train2 = train.select(*[qcol(c) for c in keep])
    if test is None:
        return train2, names
    return train2, test.select(*[qcol(c) for c in test.columns if c not in set(names)]), names


def near_zero_variance(df: DataFrame, exclude: Iterable[str] = (), freq_cut: float = NZV_FREQ_CUT,
                       unique_cut: float = NZV_UNIQUE_CUT) -> DataFrame:
    """Per-column near-zero-variance metrics and flags."""
    return column_profile(df, exclude, freq_cut=freq_cut, unique_cut=unique_cut).select(
        "col_name", "freq_ratio", "pct_unique", "zero_var", "nzv")


def zero_variance(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Numeric columns whose non-missing values are all equal.

    ``min = max`` on the non-missing values (exact, unlike ``var_samp = 0``);
    an all-missing column counts as zero variance. One wide aggregate, no
    shuffle beyond the partial aggregate.
    """
    num = columns_by_type(df, exclude)["numeric"]
    out = None
    for part in chunks(num, 200):
        exprs = []
        for c in part:
            exprs += [F.min(qcol(c).cast("double")).alias(f"lo::{c}"),
                      F.max(qcol(c).cast("double")).alias(f"hi::{c}")]
        row = df.agg(*exprs)
        stack = ", ".join(
            f"'{c}', coalesce(`lo::{c}` = `hi::{c}`, true)" for c in part)
        long = row.selectExpr(f"stack({len(part)}, {stack}) as (col_name, zero_var)")
        out = long if out is None else out.unionByName(long)
    return out


def missing_share(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Share of missing cells in the table (B1): one row."""
    cols = [c for c in df.columns if c not in set(exclude)]
    per_row = sum_columns([F.when(qcol(c).isNull(), 1).otherwise(0) for c in cols])
    p = len(cols)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(per_row).cast("bigint").alias("n_missing")).select(
        "n_rows", F.lit(p).cast("bigint").alias("n_cols"), "n_missing",
        safe_ratio(F.col("n_missing"), F.col("n_rows") * F.lit(p)).alias("missing_share"))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, exclude: Iterable[str] = (),
                   hashed: bool = False) -> DataFrame:
    """Rows minus distinct rows over ``cols`` (B2): one row.

    With ``hashed``, for wide rows, each row is first reduced to two independent
    hashes (xxhash64 + md5), so the shuffle moves 2 values per row instead of
    p; -0.0 counts as 0.0 and all NaN are one value, as when grouping.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in set(exclude)]
    if hashed:
        kinds = dict(df.dtypes)
        cells = [F.when(qcol(c) == 0, F.lit(0).cast(kinds[c])).otherwise(qcol(c)) if kinds[c] in ("double", "float")
                 else qcol(c) for c in cols]
        row_txt = F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cells])
        keyed = df.select(F.xxhash64(*cells).alias("h1"), F.md5(row_txt).alias("h2"))
        groups = keyed.groupBy("h1", "h2").count()
    else:
        groups = df.groupBy(*[qcol(c) for c in cols]).count()
    return groups.agg(F.sum("count").cast("bigint").alias("n_rows"),
                      F.count(F.lit(1)).cast("bigint").alias("n_distinct_rows")).select(
        "n_rows", "n_distinct_rows",
        (F.col("n_rows") - F.col("n_distinct_rows")).alias("n_duplicates"))


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None, k: int = 10,
                    exclude: Iterable[str] = ()) -> DataFrame:
    """The k commonest values of each column, ties by value.

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the shuffle (WindowGroupLimit), so a near-unique column does not move all
    of its values to one task.
    """
    num, txt = _profile_columns(df, exclude)
    if cols is not None:
        num = [c for c in num if c in cols]
        txt = [c for c in txt if c in cols]
    vc = value_counts(df, numeric=num, text=txt)
    value = F.coalesce(F.col("v_txt"), F.col("v_num").cast("string"))
    w = Window.partitionBy("col_name").orderBy(F.col("cnt").desc(), F.col("v_num").asc_nulls_first(),
                                             F.col("v_txt").asc_nulls_first())
    return (vc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("col_name", "kind", "rank", value.alias("value"), F.col("cnt").alias("count")))


def null_tokens(df: DataFrame, cols: Sequence[str] | None = None,
                tokens: Iterable[str] = DEFAULT_NA_TOKENS) -> DataFrame:
    """Missing tokens (``-1``, empty, ``[]``) in text columns → NULL."""
    txt = columns_by_type(df)["text"] if cols is None else list(cols)
    tokens = list(tokens)
    return df.select(*[(null_if_token(qcol(c), tokens).alias(c) if c in txt else qcol(c))
                       for c in df.columns])


# Fixed value: the reference detected date columns by looking for these
# month-and-day fragments inside the values.
LEGACY_DATE_PATTERN = "JAN1|FEB1|MAR1"
# Our default: the full ddMONyy:HH:MM:SS layout.
TEXT_DATE_PATTERN = r"^\d{2}[A-Z]{3}\d{2}:\d{2}:\d{2}:\d{2}$"


def detect_date_columns(df: DataFrame, cols: Sequence[str] | None = None,
                        pattern: str = TEXT_DATE_PATTERN, min_share: float = 0.0) -> DataFrame:
    """Text columns whose values look like dates.

    A column qualifies when at least one non-missing value matches and the
    matching share of non-missing values is at least ``min_share``.
    """
    txt = columns_by_type(df)["text"] if cols is None else list(cols)
    long = _unpivot(df, txt, "string", "v")
    stats = long.groupBy("col_name").agg(
        F.count("v").alias("n_values"),
        F.count_if(F.col("v").rlike(pattern)).alias("n_match"))
    share = safe_ratio(F.col("n_match"), F.col("n_values"))
    return stats.select("col_name", F.col("n_values").cast("bigint"), F.col("n_match").cast("bigint"),
                        share.alias("match_share"),
                        ((F.col("n_match") > 0) & (share >= F.lit(min_share))).alias("is_date"))


def week_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per (column, week starting Monday) over timestamp columns."""
    long = df.select(*[qcol(c).cast("timestamp_ntz").alias(c) for c in cols]).unpivot([], list(cols), "col_name", "ts")
    return (long.filter(F.col("ts").isNotNull())
            .groupBy("col_name", F.date_trunc("week", "ts").alias("week"))
            .agg(F.count(F.lit(1)).alias("count")))


def hour_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per (column, hour 0-23) with empty hours kept as 0."""
    long = df.select(*[F.hour(qcol(c)).alias(c) for c in cols]).unpivot([], list(cols), "col_name", "hour")
    counts = long.filter(F.col("hour").isNotNull()).groupBy("col_name", "hour") \
        .agg(F.count(F.lit(1)).alias("cnt"))
    grid = (df.sparkSession.createDataFrame([(c,) for c in cols], "col_name string")
            .select("col_name", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
    return (grid.join(counts, ["col_name", "hour"], "left")
            .select("col_name", "hour", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("count")))


def counts_with_lookup(df: DataFrame, col: str, lookup: DataFrame, lookup_key: str,
                       lookup_name: str, lower: bool = True) -> DataFrame:
    """Value counts of ``col`` beside a lookup of full names.

    Every lookup row is kept; a code absent from ``df`` gets count NULL
    (the two ``match()`` calls of the reference form a left join).
    """
    counts = df.groupBy(qcol(col).alias(lookup_key)).agg(F.count(F.lit(1)).alias("count"))
    name = F.lower(qcol(lookup_name)) if lower else qcol(lookup_name)
    lk = lookup.select(qcol(lookup_key), name.alias("name"))
    return (broadcast_if_small(lk).join(counts, lookup_key, "left")
            .select(lookup_key, "name", F.col("count").cast("bigint").alias("count")))


def bin_counts(profile: DataFrame, value: str = "n_distinct", width: int = 1, lo: int = 0,
               hi: int = 100, wide_width: int = 100) -> DataFrame:
    """Histogram of a profile metric by type: width ``width`` on [lo, hi],
    width ``wide_width`` above (B16)."""
    v = F.col(value)
    b = F.when(v <= hi, F.floor((v - lo) / width) * width + lo) \
        .otherwise(F.floor(v / wide_width) * wide_width)
    return (profile.filter(v.isNotNull()).groupBy("kind", b.cast("bigint").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_columns")))


# Log-scale bin edges for missing counts.
MISSING_BREAKS = (1, 5, 10, 50, 100, 500, 1000, 5000, 10000, 20000)


def log_bins(profile: DataFrame, value: str = "n_null", breaks: Sequence[int] = MISSING_BREAKS) -> DataFrame:
    """Columns with value > 0, counted per (type, bin) where bin is the largest
    break not above the value (B17)."""
    v = F.col(value)
    expr = None
    for b in sorted(breaks, reverse=True):
        expr = F.when(v >= b, F.lit(b)) if expr is None else expr.when(v >= b, F.lit(b))
    expr = expr.otherwise(F.lit(0))
    return (profile.filter(v > 0).groupBy("kind", expr.cast("bigint").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_columns")))


def missing_counts(profile: DataFrame) -> DataFrame:
    """Columns with at least one missing value and their counts."""
    return profile.filter(F.col("n_null") > 0).select("col_name", "kind", "n_null")


def missing_pattern_groups(profile: DataFrame) -> DataFrame:
    """Two-valued columns (missing counted) grouped by how many rows fall
    outside the commonest value, missing included (B27)."""
    mode = F.greatest(F.coalesce(F.col("top1"), F.lit(0)), F.col("n_null"))
    return (profile.filter(F.col("n_distinct") == 2)
            .groupBy((F.col("n_rows") - mode).cast("bigint").alias("m"))
            .agg(F.count(F.lit(1)).alias("n_columns")))


def label_summary(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Class counts, optionally per group, with the neg/pos ratio."""
    by = list(by)
    return (df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.count_if(F.col(label) == 0).alias("n_neg"))
        .select(*by, F.col("n_rows").cast("bigint"), F.col("n_pos").cast("bigint"),
                F.col("n_neg").cast("bigint"), safe_ratio("n_neg", "n_pos").alias("neg_pos_ratio")))


def sample_columns(columns: Sequence[str], k: int, seed: int = 0) -> list[str]:
    """k columns chosen by a seeded hash of their names (B18, schema only)."""
    ranked = sorted(columns, key=lambda c: (hashlib.md5(f"{c}_{seed}".encode()).hexdigest(), c))
    chosen = set(ranked[:k])
    return [c for c in columns if c in chosen]


def head_rows(df: DataFrame, n: int, order: Sequence[str] | str) -> DataFrame:
    """First n rows by key (A2); plans as a TakeOrderedAndProject."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """Number of data rows (A3), as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def with_sample(df: DataFrame, key: str, rows: int, cols: int, seed: int = 0,
                keep: Sequence[str] = ()) -> DataFrame:
    """Screen on a sample (B28): the first ``rows`` rows by a seeded key hash
    and ``cols`` hashed-chosen columns (plus ``keep``)."""
    from widetab.operators.sampling import holdout_n
    cand = [c for c in df.columns if c != key and c not in set(keep)]
    chosen = sample_columns(cand, cols, seed)
    part = holdout_n(df, key, rows, seed=seed)
    return part.filter("is_holdout").select(key, *keep, *chosen)
