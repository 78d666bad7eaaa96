"""Operators on missing cells, labels and groups, text and very large keys,
many columns: the same answers at every size and type."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import features as C
from widetab.operators import metrics as M
from widetab.operators import online as O
from widetab.operators import sampling as D
from widetab.operators import screen as S
from widetab.plans.registry import register
from widetab.plans.tables import KEY, LABEL, WIDE_SQL, read, sql_hash, sql_key_hash, wide

WIDE_COLS = [f"c{i}" for i in range(66)]


def _cell(i: int) -> str:
    """A numeric column of lineitem with one missing cell in 9 (same in both SQLs)."""
    return (f"CASE WHEN (l_orderkey + {i}) % 9 = 0 THEN NULL "
            f"ELSE l_quantity * {i + 1} + l_extendedprice / {2 * i + 3} + l_linenumber * {(i * 37) % 101} END AS c{i}")


def _pair_sql(cols: list[str], source: str) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    cells = ", ".join(f'round(corr({a}, {b}), 6) AS "{a}|{b}"' for a, b in pairs)
    return (f"SELECT split_part(p, '|', 1) AS col_a, split_part(p, '|', 2) AS col_b, r FROM "
            f"(UNPIVOT (SELECT {cells} FROM {source}) ON COLUMNS(*) INTO NAME p VALUE r)")


@register("pearson_missing_wide", f"WITH t AS (SELECT {', '.join(map(_cell, range(66)))} FROM lineitem) " + _pair_sql(WIDE_COLS, "t"),
          ("B21",))
def pearson_missing_wide(spark, d):
    t = read(spark, d, "lineitem").selectExpr(*map(_cell, range(66)))
    return S.correlation(t, WIDE_COLS, "pearson", digits=6)


_FOUR = [f"c{i}" for i in range(4)]


@register("spearman_missing", f"""
WITH t AS (SELECT {', '.join(map(_cell, range(4)))} FROM lineitem),
r AS (SELECT {', '.join(f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (ORDER BY {c} NULLS LAST) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 END AS {c}" for c in _FOUR)} FROM t)
""" + _pair_sql(_FOUR, "r"), ("B22",))
def spearman_missing(spark, d):
    t = read(spark, d, "lineitem").selectExpr(*map(_cell, range(4)))
    return S.correlation(t, _FOUR, "spearman", digits=6)


_GAP_LABEL = "CASE WHEN ID % 4 = 0 THEN NULL ELSE target END"


@register("stratified_folds_missing_label", f"""
WITH w AS (SELECT ID, {_GAP_LABEL} AS target FROM ({WIDE_SQL}))
SELECT ID, target, CAST((row_number() OVER (PARTITION BY target ORDER BY {sql_key_hash('ID', 11)}, ID) - 1) % 5 AS INTEGER) AS fold
FROM w""", ("D4",))
def stratified_folds_missing_label(spark, d):
    w = wide(spark, d).selectExpr("ID", f"{_GAP_LABEL} AS target")
    return D.stratified_folds(w, KEY, LABEL, 5, seed=11)


@register("stratified_split_missing_label", f"""
WITH w AS (SELECT ID, {_GAP_LABEL} AS target FROM ({WIDE_SQL})),
r AS (SELECT ID, target, row_number() OVER (PARTITION BY target ORDER BY {sql_key_hash('ID', 5)}, ID) AS rn,
             count(*) OVER (PARTITION BY target) AS n FROM w)
SELECT ID, target, rn <= floor(n * 0.25 + 0.5) AS is_test FROM r""", ("D5",))
def stratified_split_missing_label(spark, d):
    w = wide(spark, d).selectExpr("ID", f"{_GAP_LABEL} AS target")
    return D.stratified_split(w, KEY, LABEL, 0.25, seed=5)


_GAP_GROUP = "SELECT l.quality, d.n_chars, CASE WHEN d.lang <> 'fr' THEN d.lang END AS lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id"


@register("auc_missing_group", f"""
WITH j AS ({_GAP_GROUP}),
c AS (SELECT lang, n_chars AS s, CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) AS pos,
             CAST(count(*) FILTER (WHERE quality <> 1) AS DOUBLE) AS neg FROM j GROUP BY lang, n_chars),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS nb FROM c)
SELECT lang, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       sum(pos * (nb + neg / CAST(2 AS DOUBLE))) / nullif(sum(pos) * sum(neg), 0) AS auc
FROM r GROUP BY lang""", ("F1",))
def auc_missing_group(spark, d):
    labels, docs = read(spark, d, "labels"), read(spark, d, "documents")
    j = labels.join(docs, "doc_id").select("quality", "n_chars", F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"))
    return M.auc(j, "n_chars", "quality", ["lang"])


# Ten codes in one column, found one after the other.
_CODES = [96, 97, 98, 99, 996, 997, 998, 999, 9996, 9997]
_CODED = "CASE o_orderkey % 20 " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_CODES)) + " ELSE o_orderkey % 90 END"


@register("sentinel_ten_codes", f"""
WITH t AS (SELECT o_orderkey, CAST({_CODED} AS BIGINT) AS v FROM orders)
SELECT o_orderkey, CASE WHEN v < 90 THEN v END AS v, {', '.join(f'CASE WHEN v = {c} THEN 1 ELSE 0 END AS v_{c}' for c in _CODES)} FROM t
""", ("C13",))
def sentinel_ten_codes(spark, d):
    t = read(spark, d, "orders").selectExpr("o_orderkey", f"CAST({_CODED} AS BIGINT) AS v")
    return C.sentinel_flags(t, ["v"])[0]


@register("every_nth_text_key", """
WITH r AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS k, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS rn FROM orders)
SELECT k, rn % 100 = 0 AS is_valid FROM r""", ("D6",))
def every_nth_text_key(spark, d):
    return D.every_nth(read(spark, d, "orders").select(F.md5(F.col("o_orderkey").cast("string")).alias("k")), "k", 100)


@register("head_tail_text_key", """
WITH r AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS k, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS rn FROM orders)
SELECT k, rn <= 500 AS is_head FROM r""", ("D3",))
def head_tail_text_key(spark, d):
    return D.head_tail(read(spark, d, "orders").select(F.md5(F.col("o_orderkey").cast("string")).alias("k")), "k", 500)


_BIG = 5_000_000_000_000_000_000


@register("encode_levels_big_keys", f"""
WITH u AS (SELECT 0 AS src, {_BIG} + o_orderkey AS k, 'a' || (o_custkey % 700) AS v FROM orders WHERE o_orderkey % 3 > 0
           UNION ALL SELECT 1, o_orderkey, 'a' || (o_custkey % 701) FROM orders WHERE o_orderkey % 3 = 0),
f AS (SELECT v, min(src * CAST('100000000000000000000' AS HUGEINT) + k) AS first FROM (SELECT v, CAST(src AS HUGEINT) AS src, CAST(k AS HUGEINT) AS k FROM u) GROUP BY v)
SELECT 'v' AS col_name, v AS value, CAST(row_number() OVER (ORDER BY first) AS INTEGER) AS level FROM f""", ("C4",))
def encode_levels_big_keys(spark, d):
    o = read(spark, d, "orders")
    train = o.filter("o_orderkey % 3 > 0").selectExpr(f"{_BIG} + o_orderkey AS k", "concat('a', o_custkey % 700) AS v")
    test = o.filter("o_orderkey % 3 = 0").selectExpr("o_orderkey AS k", "concat('a', o_custkey % 701) AS v")
    return C.encode_levels(train, test, "k", ["v"])[2]


@register("hash_features_missing", f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN event_type END AS event_type FROM events)
SELECT event_id, {sql_hash("concat('event_type_', coalesce(event_type, ''))")} % 1024 AS idx FROM e""", ("C8",))
def hash_features_missing(spark, d):
    e = read(spark, d, "events").selectExpr("event_id", "CASE WHEN event_id % 7 > 0 THEN event_type END AS event_type")
    return O.hash_features(e, ["event_type"], 1024).select("event_id", F.element_at("idx", 1).alias("idx"))


@register("split_small_share", f"""
SELECT o_orderkey, CASE WHEN {sql_key_hash('o_orderkey', 'tiny')} % 100000 < 7 THEN 0 ELSE 1 END AS part FROM orders""", ("D2",))
def split_small_share(spark, d):
    return D.split(read(spark, d, "orders").select("o_orderkey"), "o_orderkey", [0.00007, 0.99993], seed="tiny")
