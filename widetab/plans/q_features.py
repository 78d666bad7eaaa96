"""Feature-building queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import ensemble as G
from widetab.operators import features as C
from widetab.operators import sampling as D
from widetab.plans.registry import register
from widetab.plans.tables import (
    KEY, MODEL_SCORES_SQL, MODELS, WIDE_SQL, model_scores, read, sql_key_hash, wide,
)


@register("parse_dates", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, epoch(try_strptime(date_txt, '%d%b%y:%H:%M:%S')) AS date_txt,
       hour(try_strptime(date_txt, '%d%b%y:%H:%M:%S')) AS date_txt_hour
FROM w
""", ("B9", "B10", "B11"))
def parse_dates(spark, d):
    w = wide(spark, d).select(KEY, "date_txt")
    parsed = C.parse_dates(w, ["date_txt"])
    with_hour = C.hour_of_day(parsed, ["date_txt"])
    return C.to_epoch(with_hour, ["date_txt"])


@register("sentinel_flags", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, CASE WHEN sentinel = 999999 THEN NULL ELSE sentinel END AS sentinel, acctbal, price_na,
       CASE WHEN sentinel = 999999 THEN 1 ELSE 0 END AS sentinel_999999
FROM w
""", ("C13",))
def sentinel_flags(spark, d):
    out, _found = C.sentinel_flags(wide(spark, d).select(KEY, "sentinel", "acctbal", "price_na"),
                                   ["sentinel", "acctbal", "price_na"])
    return out


_PAIRS = [("p_size", "p_retailprice"), ("p_size", "p_partkey"), ("p_retailprice", "p_partkey")]


@register("interactions", "SELECT p_partkey AS key, " + ", ".join(
    f"CAST({a} AS DOUBLE) + CAST({b} AS DOUBLE) AS {a}_PLUS_{b}, "
    f"CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS {a}_TIMES_{b}" for a, b in _PAIRS) + " FROM part",
    ("C5",))
def interactions(spark, d):
    p = read(spark, d, "part").select(F.col("p_partkey").alias("key"), "p_size", "p_retailprice", "p_partkey")
    # The repeated name is dropped by the operator (no self pair).
    out = C.interactions(p, ["p_size", "p_retailprice", "p_size", "p_partkey"], keep=True)
    return out.drop("p_size", "p_retailprice", "p_partkey")


_ENC_SRC = f"CASE WHEN {sql_key_hash('o_orderkey', 'enc')} % 10000 < 8000 THEN 0 ELSE 1 END"


@register("encode_levels", f"""
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, {_ENC_SRC} AS src FROM orders),
l AS (SELECT 'o_orderstatus' AS col_name, o_orderstatus AS value, src, o_orderkey FROM o
      UNION ALL SELECT 'o_orderpriority', o_orderpriority, src, o_orderkey FROM o),
f AS (SELECT col_name, value, min(src * 1000000000000 + o_orderkey) AS first_seen FROM l GROUP BY 1, 2),
lv AS (SELECT col_name, value, CAST(row_number() OVER (PARTITION BY col_name ORDER BY first_seen) AS INTEGER) AS level
       FROM f)
SELECT o.o_orderkey, o.src,
       (SELECT level FROM lv WHERE lv.col_name = 'o_orderstatus' AND lv.value = o.o_orderstatus) AS o_orderstatus,
       (SELECT level FROM lv WHERE lv.col_name = 'o_orderpriority' AND lv.value = o.o_orderpriority) AS o_orderpriority
FROM o
""", ("C4",))
def encode_levels(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = D.split(o, "o_orderkey", [0.8, 0.2], seed="enc", name="src")
    train = o.filter("src = 0")
    test = o.filter("src = 1")
    tr, te, _levels = C.encode_levels(train, test, "o_orderkey", ["o_orderstatus", "o_orderpriority"])
    return tr.unionByName(te)


@register("clamp_negative", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CAST(-9999 AS DOUBLE) ELSE c_acctbal END AS c_acctbal
FROM customer
""", ("C2",))
def clamp_negative(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    return C.clamp_negative(c, -9999.0, ["c_acctbal"])


@register("null_negative_products", """
SELECT c_custkey,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
       CAST(c_nationkey AS DOUBLE) * CAST(CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS DOUBLE)
         AS c_nationkey_TIMES_c_acctbal
FROM customer
""", ("C3", "C5"))
def null_negative_products(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nn = C.null_negative(c, ["c_acctbal"])
    return C.interactions(nn, ["c_nationkey", "c_acctbal"], ops=("times",)).drop("c_nationkey")


@register("fill_sentinel", f"""
WITH w AS ({WIDE_SQL})
SELECT ID, coalesce(price_na, CAST(-98989898 AS DOUBLE)) AS price_na, sentinel FROM w
""", ("C1",))
def fill_sentinel(spark, d):
    w = wide(spark, d).select(KEY, "price_na", "sentinel")
    return C.fill_sentinel(w, -98989898, ["price_na", "sentinel"])


@register("standardise", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS c_acctbal FROM customer, s
""", ("C14",))
def standardise(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    z = C.standardise(c, ["c_acctbal"])
    return z.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@register("binarise", """
SELECT p_partkey, CASE WHEN p_size >= 25 THEN 1 ELSE 0 END AS p_size FROM part
""", ("C12",))
def binarise(spark, d):
    return C.binarise(read(spark, d, "part").select("p_partkey", "p_size"), "p_size", 25)


@register("attach_meta_columns", f"""
WITH s AS ({MODEL_SCORES_SQL}),
p AS (SELECT ID, """ + ", ".join(f"max(target) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS) + """
      FROM s GROUP BY ID)
SELECT o.o_orderkey AS ID, o.o_totalprice, """ + ", ".join(f"p.{m}" for m in MODELS) + """
FROM orders o JOIN p ON o.o_orderkey = p.ID
""", ("C6", "C11"))
def attach_meta_columns(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias(KEY), "o_totalprice")
    meta = G.pivot_models(model_scores(spark, d), KEY, MODELS)
    return C.order_columns(C.attach(o, meta, KEY), [KEY])


@register("where_filter", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 1000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""", ("C16",))
def where_filter(spark, d):
    o = read(spark, d, "orders")
    neg = read(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    out = C.where(o, F.col("o_totalprice") > 1000, exclude=neg, key="o_custkey",
                  values=("o_orderpriority", ["1-URGENT", "2-HIGH"]))
    return out.select("o_orderkey", "o_totalprice")


@register("pooled_frequency_score", f"""
WITH w AS ({WIDE_SQL}),
l AS (SELECT ID, status AS v FROM w UNION ALL SELECT ID, priority FROM w UNION ALL SELECT ID, segment FROM w),
f AS (SELECT v, count(*) AS freq FROM l GROUP BY v),
s AS (SELECT l.ID, CAST(sum(f.freq) AS BIGINT) AS freq_sum, count(*) AS freq_count
      FROM l JOIN f ON l.v = f.v GROUP BY l.ID)
SELECT ID, freq_sum, freq_count, CAST(freq_sum AS DOUBLE) / CAST(freq_count AS DOUBLE) AS freq_mean,
       CAST(freq_sum AS VARCHAR) || '/' || CAST(freq_count AS VARCHAR) AS freq_text
FROM s
""", ("C10",))
def pooled_frequency_score(spark, d):
    return C.pooled_frequency_score(wide(spark, d), KEY, ["status", "priority", "segment"])
