"""Sampling, split and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import profile as P
from widetab.operators import sampling as D
from widetab.plans.registry import register
from widetab.plans.tables import KEY, LABEL, WIDE_SQL, read, sql_key_hash, wide


def _orders(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@register("holdout_n", f"""
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice,
                  row_number() OVER (ORDER BY {sql_key_hash('o_orderkey', 7)}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice,
       rn <= (SELECT count(*) // 10 FROM orders) AS is_holdout FROM r
""", ("D1",))
def holdout_n(spark, d):
    o = _orders(spark, d)
    n = o.count() // 10
    return D.holdout_n(o, "o_orderkey", n, seed=7)


@register("split_shares", f"""
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(CASE WHEN {sql_key_hash('o_orderkey', 3)} % 10000 < 5000 THEN 0 ELSE 1 END AS INTEGER) AS part
FROM orders
""", ("D2",))
def split_shares(spark, d):
    return D.split(_orders(spark, d), "o_orderkey", [0.5, 0.5], seed=3)


@register("head_tail", """
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, rn <= (SELECT count(*) // 5 FROM orders) AS is_head FROM r
""", ("D3",))
def head_tail(spark, d):
    o = _orders(spark, d)
    return D.head_tail(o, "o_orderkey", o.count() // 5)


@register("stratified_folds", f"""
WITH w AS ({WIDE_SQL}),
r AS (SELECT ID, target, row_number() OVER (PARTITION BY target ORDER BY {sql_key_hash('ID', 11)}, ID) AS rn FROM w)
SELECT ID, target, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r
""", ("D4",))
def stratified_folds(spark, d):
    w = wide(spark, d).select(KEY, LABEL)
    return D.stratified_folds(w, KEY, LABEL, 5, seed=11)


@register("fold_balance", f"""
WITH w AS ({WIDE_SQL}),
r AS (SELECT ID, target, row_number() OVER (PARTITION BY target ORDER BY {sql_key_hash('ID', 11)}, ID) AS rn FROM w),
f AS (SELECT target, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r)
SELECT fold, count(*) AS n_rows, CAST(count(*) FILTER (WHERE target = 1) AS BIGINT) AS n_pos,
       CAST(count(*) FILTER (WHERE target = 0) AS BIGINT) AS n_neg,
       CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE)
         / CAST(nullif(count(*) FILTER (WHERE target = 1), 0) AS DOUBLE) AS neg_pos_ratio
FROM f GROUP BY fold
""", ("D4", "B26"))
def fold_balance(spark, d):
    folds = D.stratified_folds(wide(spark, d).select(KEY, LABEL), KEY, LABEL, 5, seed=11)
    return P.label_summary(folds, LABEL, ["fold"])


@register("stratified_split", f"""
WITH w AS ({WIDE_SQL}),
r AS (SELECT ID, target, row_number() OVER (PARTITION BY target ORDER BY {sql_key_hash('ID', 5)}, ID) AS rn,
             count(*) OVER (PARTITION BY target) AS n_class FROM w)
SELECT ID, target, rn <= CAST(floor(n_class * 0.05 + 0.5) AS BIGINT) AS is_test FROM r
""", ("D5",))
def stratified_split(spark, d):
    w = wide(spark, d).select(KEY, LABEL)
    return D.stratified_split(w, KEY, LABEL, 0.05, seed=5)


@register("every_nth", """
WITH r AS (SELECT event_id, user_id, value, row_number() OVER (ORDER BY event_id) AS rn FROM events)
SELECT event_id, user_id, value, rn % 100 = 0 AS is_valid FROM r
""", ("D6",))
def every_nth(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "value")
    return D.every_nth(e, "event_id", 100)


@register("shuffle_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", ("D7",))
def shuffle_rows(spark, d):
    return D.shuffle(_orders(spark, d), "o_orderkey", seed=1)


@register("folds", f"""
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST({sql_key_hash('o_orderkey', 2)} % 4 AS INTEGER) AS fold FROM orders
""", ("D9",))
def folds(spark, d):
    return D.folds(_orders(spark, d), "o_orderkey", 4, seed=2)


_BAG_SQL = " UNION ALL ".join(f"""
SELECT {b} AS bag, o_orderkey,
       {sql_key_hash('o_orderkey', f'{b}_valid')} % 10000 < 1000 AS is_valid
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {sql_key_hash('o_orderkey', b)}, o_orderkey) AS rn FROM orders)
WHERE rn <= (SELECT count(*) * 4 // 5 FROM orders)""" for b in range(3))


@register("bags", _BAG_SQL, ("D8",))
def bags(spark, d):
    o = read(spark, d, "orders").select("o_orderkey")
    out = D.bags(o, "o_orderkey", 3, row_share=0.8, valid_share=0.1, seed=0)
    return out.select(F.col("bag").cast("int").alias("bag"), "o_orderkey", "is_valid")


_WIDE_COLS = ["price_na", "k_const", "near_const", "sentinel", "prio_tok", "status", "priority", "segment",
              "nation", "acctbal", "custkey", "date_txt"]
_SAMPLED = P.sample_columns(_WIDE_COLS, 6, seed=1)


@register("with_sample", f"""
WITH w AS ({WIDE_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY {sql_key_hash('ID', 1)}, ID) AS rn FROM w)
SELECT ID, target, {", ".join(_SAMPLED)} FROM r WHERE rn <= (SELECT count(*) // 4 FROM w)
""", ("B28", "B18"))
def with_sample(spark, d):
    w = wide(spark, d)
    n = w.count() // 4
    return P.with_sample(w, KEY, n, 6, seed=1, keep=[LABEL])
