"""Profiling and screening queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import profile as P
from widetab.plans.registry import register
from widetab.plans.tables import (
    KEY, LABEL, WIDE_NUMERIC, WIDE_SQL, WIDE_TEXT, read, wide,
)

EXCLUDE = (KEY, LABEL)


def _vc_sql(num=WIDE_NUMERIC, txt=WIDE_TEXT, src="w") -> str:
    parts = [f"SELECT '{c}' AS col_name, 'numeric' AS kind, CAST({c} AS DOUBLE) AS v_num, "
             f"CAST(NULL AS VARCHAR) AS v_txt FROM {src}" for c in num]
    parts += [f"SELECT '{c}' AS col_name, 'text' AS kind, CAST(NULL AS DOUBLE) AS v_num, "
              f"CAST({c} AS VARCHAR) AS v_txt FROM {src}" for c in txt]
    return ("SELECT col_name, kind, v_num, v_txt, count(*) AS cnt FROM ("
            + " UNION ALL ".join(parts) + ") GROUP BY col_name, kind, v_num, v_txt")


NONNULL = "(v_num IS NOT NULL OR v_txt IS NOT NULL)"

PROFILE_CTES = f"""
WITH w AS ({WIDE_SQL}),
vc AS ({_vc_sql()}),
f AS (
    SELECT col_name, kind, CAST(sum(cnt) AS BIGINT) AS n_rows,
           CAST(sum(CASE WHEN {NONNULL} THEN 0 ELSE cnt END) AS BIGINT) AS n_null,
           CAST(count(*) FILTER (WHERE {NONNULL}) AS BIGINT) AS n_dnn,
           min(v_num) AS min_value, max(v_num) AS max_value,
           max(cnt) FILTER (WHERE {NONNULL}) AS top1
    FROM vc GROUP BY col_name, kind),
s AS (
    SELECT vc.col_name, count(*) FILTER (WHERE vc.cnt = f.top1) AS n_at_top,
           max(vc.cnt) FILTER (WHERE vc.cnt < f.top1) AS below_top
    FROM vc JOIN f ON vc.col_name = f.col_name
    WHERE vc.v_num IS NOT NULL OR vc.v_txt IS NOT NULL GROUP BY vc.col_name),
p0 AS (
    SELECT f.*, CASE WHEN s.n_at_top >= 2 THEN f.top1 ELSE s.below_top END AS top2
    FROM f LEFT JOIN s ON f.col_name = s.col_name),
p1 AS (
    SELECT *, n_dnn + CASE WHEN n_null > 0 THEN 1 ELSE 0 END AS n_distinct,
           CASE WHEN n_dnn <= 1 THEN CAST(0 AS DOUBLE)
                ELSE CAST(top1 AS DOUBLE) / CAST(top2 AS DOUBLE) END AS freq_ratio,
           CAST(100 AS DOUBLE) * (CAST(n_dnn AS DOUBLE) / CAST(n_rows AS DOUBLE)) AS pct_unique
    FROM p0),
prof AS (
    SELECT col_name, kind, n_rows, n_null, CAST(n_distinct AS BIGINT) AS n_distinct,
           n_dnn AS n_distinct_nonnull, min_value, max_value,
           CAST(top1 AS BIGINT) AS top1, CAST(top2 AS BIGINT) AS top2, freq_ratio, pct_unique,
           n_distinct = 1 AS is_constant, n_dnn <= 1 AS zero_var,
           (freq_ratio > CAST(19 AS DOUBLE) AND pct_unique <= CAST(10 AS DOUBLE)) OR n_dnn <= 1 AS nzv
    FROM p1)
"""


def _profile(spark, d):
    return P.column_profile(wide(spark, d), exclude=EXCLUDE)


@register("column_profile", PROFILE_CTES + "SELECT * FROM prof",
          ("B3", "B5", "B15", "B17", "B19", "B20"))
def column_profile(spark, d):
    return _profile(spark, d)


@register("distinct_counts", PROFILE_CTES + "SELECT col_name, kind, n_distinct FROM prof", ("B3",))
def distinct_counts(spark, d):
    return P.distinct_counts(wide(spark, d), exclude=EXCLUDE)


@register("constant_columns", PROFILE_CTES + "SELECT col_name FROM prof WHERE is_constant", ("B4",))
def constant_columns(spark, d):
    return P.constant_columns(_profile(spark, d))


@register("drop_constant", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, price_na, near_const, sentinel, prio_tok, status, priority, segment, nation, acctbal,
       custkey, date_txt, target FROM w
""", ("B4",))
def drop_constant(spark, d):
    train, _names = P.drop_constant(wide(spark, d), exclude=EXCLUDE)
    return train


@register("nzv_columns", PROFILE_CTES + "SELECT col_name, freq_ratio, pct_unique, zero_var, nzv FROM prof",
          ("B20",))
def nzv_columns(spark, d):
    return P.near_zero_variance(wide(spark, d), exclude=EXCLUDE)


@register("missing_pattern_groups", PROFILE_CTES + """
SELECT CAST(n_rows - greatest(coalesce(top1, 0), n_null) AS BIGINT) AS m, count(*) AS n_columns
FROM prof WHERE n_distinct = 2 GROUP BY 1
""", ("B27",))
def missing_pattern_groups(spark, d):
    return P.missing_pattern_groups(_profile(spark, d))


@register("bin_counts", PROFILE_CTES + """
SELECT kind, CAST(CASE WHEN n_distinct <= 100 THEN floor(n_distinct / 1) * 1
                       ELSE floor(n_distinct / 100) * 100 END AS BIGINT) AS bin,
       count(*) AS n_columns
FROM prof GROUP BY 1, 2
""", ("B16",))
def bin_counts(spark, d):
    return P.bin_counts(_profile(spark, d), "n_distinct", width=1, lo=0, hi=100, wide_width=100)


@register("missing_log_bins", PROFILE_CTES + """
SELECT kind, CAST(CASE WHEN n_null >= 20000 THEN 20000 WHEN n_null >= 10000 THEN 10000
    WHEN n_null >= 5000 THEN 5000 WHEN n_null >= 1000 THEN 1000 WHEN n_null >= 500 THEN 500
    WHEN n_null >= 100 THEN 100 WHEN n_null >= 50 THEN 50 WHEN n_null >= 10 THEN 10
    WHEN n_null >= 5 THEN 5 WHEN n_null >= 1 THEN 1 ELSE 0 END AS BIGINT) AS bin,
    count(*) AS n_columns
FROM prof WHERE n_null > 0 GROUP BY 1, 2
""", ("B17",))
def missing_log_bins(spark, d):
    return P.log_bins(_profile(spark, d), "n_null")


@register("missing_counts", PROFILE_CTES + "SELECT col_name, kind, n_null FROM prof WHERE n_null > 0",
          ("B17",))
def missing_counts(spark, d):
    return P.missing_counts(_profile(spark, d))


@register("zero_variance", f"""
WITH w AS ({WIDE_SQL})
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, coalesce(min(CAST({c} AS DOUBLE)) = max(CAST({c} AS DOUBLE)), true) AS zero_var FROM w"
    for c in WIDE_NUMERIC), ("B19",))
def zero_variance(spark, d):
    return P.zero_variance(wide(spark, d), exclude=EXCLUDE)


_ALL_COLS = ["price_na", "k_const", "near_const", "sentinel", "prio_tok", "status", "priority",
             "segment", "nation", "acctbal", "custkey", "date_txt"]


@register("missing_share", f"""
WITH w AS ({WIDE_SQL})
SELECT count(*) AS n_rows, CAST({len(_ALL_COLS)} AS BIGINT) AS n_cols,
       CAST(sum({' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _ALL_COLS)}) AS BIGINT) AS n_missing,
       CAST(sum({' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _ALL_COLS)}) AS DOUBLE)
         / CAST(count(*) * {len(_ALL_COLS)} AS DOUBLE) AS missing_share
FROM w
""", ("B1",))
def missing_share(spark, d):
    return P.missing_share(wide(spark, d), exclude=EXCLUDE)


@register("missing_share_tokens", f"""
WITH w AS ({WIDE_SQL}),
t AS (SELECT CASE WHEN prio_tok IN ('-1', '', '[]') THEN NULL ELSE prio_tok END AS prio_tok,
             price_na, status FROM w)
SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_cols,
       CAST(sum(CASE WHEN prio_tok IS NULL THEN 1 ELSE 0 END + CASE WHEN price_na IS NULL THEN 1 ELSE 0 END
                + CASE WHEN status IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
       CAST(sum(CASE WHEN prio_tok IS NULL THEN 1 ELSE 0 END + CASE WHEN price_na IS NULL THEN 1 ELSE 0 END
                + CASE WHEN status IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) * 3 AS DOUBLE) AS missing_share
FROM t
""", ("B1", "B7"))
def missing_share_tokens(spark, d):
    t = P.null_tokens(wide(spark, d).select("prio_tok", "price_na", "status"), ["prio_tok"])
    return P.missing_share(t)


@register("duplicate_rows", f"""
WITH w AS ({WIDE_SQL}),
g AS (SELECT status, priority, segment, nation, count(*) AS c FROM w GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows,
       CAST(sum(c) - count(*) AS BIGINT) AS n_duplicates FROM g
""", ("B2",))
def duplicate_rows(spark, d):
    return P.duplicate_rows(wide(spark, d), ["status", "priority", "segment", "nation"])


@register("duplicate_rows_hashed", """
WITH g AS (SELECT l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, count(*) AS c
           FROM lineitem GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows,
       CAST(sum(c) - count(*) AS BIGINT) AS n_duplicates FROM g
""", ("B2",))
def duplicate_rows_hashed(spark, d):
    li = read(spark, d, "lineitem")
    return P.duplicate_rows(li, ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"],
                            hashed=True)


@register("top_values", f"""
WITH w AS ({WIDE_SQL}),
vc AS ({_vc_sql(["nation", "near_const"], ["status", "priority", "segment", "prio_tok"])}),
r AS (SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY cnt DESC, v_num ASC NULLS FIRST,
                                   v_txt ASC NULLS FIRST) AS rank FROM vc)
SELECT col_name, kind, CAST(rank AS INTEGER) AS rank,
       coalesce(v_txt, CAST(v_num AS VARCHAR)) AS value, cnt AS count
FROM r WHERE rank <= 3
""", ("B6",))
def top_values(spark, d):
    w = wide(spark, d).select("nation", "near_const", "status", "priority", "segment", "prio_tok")
    return P.distinct_values(w, k=3)


@register("null_tokens", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, CASE WHEN prio_tok IN ('-1', '', '[]') THEN NULL ELSE prio_tok END AS prio_tok, status
FROM w
""", ("B7",))
def null_tokens(spark, d):
    return P.null_tokens(wide(spark, d).select(KEY, "prio_tok", "status"), ["prio_tok"])


@register("detect_date_columns", f"""
WITH w AS ({WIDE_SQL}),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS col_name, {c} AS v FROM w" for c in WIDE_TEXT)})
SELECT col_name, count(v) AS n_values,
       CAST(count(*) FILTER (WHERE regexp_matches(v, '^\\d{{2}}[A-Z]{{3}}\\d{{2}}:\\d{{2}}:\\d{{2}}:\\d{{2}}$')) AS BIGINT) AS n_match,
       CAST(count(*) FILTER (WHERE regexp_matches(v, '^\\d{{2}}[A-Z]{{3}}\\d{{2}}:\\d{{2}}:\\d{{2}}:\\d{{2}}$')) AS DOUBLE)
         / CAST(count(v) AS DOUBLE) AS match_share,
       count(*) FILTER (WHERE regexp_matches(v, '^\\d{{2}}[A-Z]{{3}}\\d{{2}}:\\d{{2}}:\\d{{2}}:\\d{{2}}$')) > 0
         AND CAST(count(*) FILTER (WHERE regexp_matches(v, '^\\d{{2}}[A-Z]{{3}}\\d{{2}}:\\d{{2}}:\\d{{2}}:\\d{{2}}$')) AS DOUBLE)
             / CAST(count(v) AS DOUBLE) >= CAST(0.5 AS DOUBLE) AS is_date
FROM l GROUP BY col_name
""", ("B8",))
def detect_date_columns(spark, d):
    return P.detect_date_columns(wide(spark, d), WIDE_TEXT, min_share=0.5)


@register("label_summary", f"""
WITH w AS ({WIDE_SQL})
SELECT segment, count(*) AS n_rows, CAST(count(*) FILTER (WHERE target = 1) AS BIGINT) AS n_pos,
       CAST(count(*) FILTER (WHERE target = 0) AS BIGINT) AS n_neg,
       CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE)
         / CAST(nullif(count(*) FILTER (WHERE target = 1), 0) AS DOUBLE) AS neg_pos_ratio
FROM w GROUP BY segment
""", ("B26",))
def label_summary(spark, d):
    return P.label_summary(wide(spark, d), LABEL, ["segment"])


@register("row_count", "SELECT count(*) AS n_rows FROM lineitem", ("A3",))
def row_count(spark, d):
    return P.row_count(read(spark, d, "lineitem"))


@register("head_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100
""", ("A2",))
def head_rows(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.head_rows(o, 100, "o_orderkey")


@register("hour_histogram", """
WITH h AS (SELECT 'ts' AS col_name, range AS hour FROM range(24)),
c AS (SELECT hour(ts) AS hour, count(*) AS cnt FROM events GROUP BY 1)
SELECT h.col_name, CAST(h.hour AS INTEGER) AS hour, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM h LEFT JOIN c ON h.hour = c.hour
""", ("B11", "B13"))
def hour_histogram(spark, d):
    return P.hour_histogram(read(spark, d, "events"), ["ts"])


@register("week_histogram", """
SELECT 'ts' AS col_name, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) AS count
FROM events GROUP BY 1, 2
""", ("B12",))
def week_histogram(spark, d):
    h = P.week_histogram(read(spark, d, "events"), ["ts"])
    return h.select("col_name", F.date_format("week", "yyyy-MM-dd").alias("week"), "count")


@register("counts_with_lookup", """
WITH c AS (SELECT s_nationkey AS n_nationkey, count(*) AS cnt FROM supplier GROUP BY 1)
SELECT n.n_nationkey, lower(n.n_name) AS name, CAST(c.cnt AS BIGINT) AS count
FROM nation n LEFT JOIN c ON n.n_nationkey = c.n_nationkey
""", ("B14",))
def counts_with_lookup(spark, d):
    return P.counts_with_lookup(read(spark, d, "supplier"), "s_nationkey", read(spark, d, "nation"),
                                "n_nationkey", "n_name")


@register("read_table_tokens", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, price_na, k_const, near_const, sentinel,
       CASE WHEN prio_tok IN ('-1', '', '[]') THEN NULL ELSE prio_tok END AS prio_tok,
       CASE WHEN status IN ('-1', '', '[]') THEN NULL ELSE status END AS status,
       priority, segment, nation, acctbal, custkey, date_txt, target
FROM w
""", ("A1", "B7"))
def read_table_tokens(spark, d):
    """The wide table written as CSV to the shared folder and read back as a
    labelled table: key first, label last, missing tokens → NULL."""
    from widetab.session import scratch_path
    from widetab.sources import io
    w = wide(spark, d)
    path = scratch_path(spark, "wide-csv")
    w.write.option("header", True).csv(path)
    return io.read_table(spark, path, KEY, LABEL, fmt="csv", schema=w.schema, check_key=True)


@register("read_text_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS ID, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target
FROM orders
""", ("A4",))
def read_text_records(spark, d):
    """Rows read back as all-text records; the label is 1 exactly when its
    text is '1'."""
    from widetab.session import scratch_path
    from widetab.sources import io
    o = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("ID"), "o_custkey", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("target"))
    path = scratch_path(spark, "text-records")
    o.write.option("header", True).csv(path)
    return io.read_text_records(spark, path)


@register("write_variant", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, price_na, sentinel, prio_tok, status, priority, segment, nation, acctbal, custkey, date_txt, target
FROM w
""", ("A5", "C7", "B4", "B20"))
def write_variant(spark, d):
    """Column variants from the profile (constant and near-zero-variance drop
    sets); the variant without both is written key first, label last, and
    read back."""
    from widetab.operators.features import variant_columns
    from widetab.session import scratch_path
    from widetab.sources import io
    w = wide(spark, d)
    prof = P.column_profile(w, exclude=EXCLUDE).select("col_name", "is_constant", "nzv").collect()
    drops = {"constant": [r["col_name"] for r in prof if r["is_constant"]],
             "nzv": [r["col_name"] for r in prof if r["nzv"]]}
    variants = variant_columns(w.columns, drops, keep=[KEY])
    path = scratch_path(spark, "variant")
    io.write_variant(w, path, variants["minus_all"], KEY, LABEL)
    return spark.read.parquet(path)


@register("column_profile_approx", PROFILE_CTES + """
SELECT col_name, kind, n_rows, n_null, min_value, max_value, is_constant, zero_var, nzv FROM prof
""", ("B3", "B20"))
def column_profile_approx(spark, d):
    """Profile with the approximate pre-pass: near-unique columns skip the
    value-count shuffle; the columns compared here are exact in both modes."""
    prof = P.column_profile(wide(spark, d), exclude=EXCLUDE, exact=False)
    return prof.select("col_name", "kind", "n_rows", "n_null", "min_value", "max_value",
                       "is_constant", "zero_var", "nzv")
