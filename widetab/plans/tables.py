"""Input tables for the registered queries.

The driver tables carry no NULLs, text dates, sentinels or several models'
scores, so the wide labelled table is derived from ``orders`` ⋈ ``customer``
with the recipes of FIXTURES.md §3. Each builder here has a SQL twin
(``WIDE_SQL``, ``MODEL_SCORES_SQL``) that produces the same values in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widetab.functions.hashing import raw_hash

KEY = "ID"
LABEL = "target"
# The synthetic model names and their families.
MODELS = ("m1", "m2", "m3", "m4", "m5")
FAMILIES = {"trees": ("m1", "m2", "m3"), "online": ("m4", "m5")}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled wide table keyed by ``ID`` (one row per order)."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        k.alias("ID"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price_na"),
        F.lit(1).alias("k_const"),
        F.when(k % 1000 == 0, 1).otherwise(0).alias("near_const"),
        F.when(k % 11 == 0, F.lit(999999).cast("bigint"))
        .otherwise(F.floor("o_totalprice").cast("bigint")).alias("sentinel"),
        F.when(k % 5 == 0, "-1").when(k % 5 == 1, "").when(k % 5 == 2, "[]")
        .otherwise(F.col("o_orderpriority")).alias("prio_tok"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("o_custkey").alias("custkey"),
        F.when(k % 13 == 0, F.lit("NODATE"))
        .otherwise(F.upper(F.date_format("o_orderdate", "ddMMMyy:HH:mm:ss"))).alias("date_txt"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
    )


WIDE_SQL = """
    SELECT o.o_orderkey AS ID,
           CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice END AS price_na,
           1 AS k_const,
           CASE WHEN o.o_orderkey % 1000 = 0 THEN 1 ELSE 0 END AS near_const,
           CASE WHEN o.o_orderkey % 11 = 0 THEN CAST(999999 AS BIGINT)
                ELSE CAST(floor(o.o_totalprice) AS BIGINT) END AS sentinel,
           CASE o.o_orderkey % 5 WHEN 0 THEN '-1' WHEN 1 THEN '' WHEN 2 THEN '[]'
                ELSE o.o_orderpriority END AS prio_tok,
           o.o_orderstatus AS status,
           o.o_orderpriority AS priority,
           c.c_mktsegment AS segment,
           c.c_nationkey AS nation,
           c.c_acctbal AS acctbal,
           o.o_custkey AS custkey,
           CASE WHEN o.o_orderkey % 13 = 0 THEN 'NODATE'
                ELSE upper(strftime(o.o_orderdate, '%d%b%y:%H:%M:%S')) END AS date_txt,
           CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS target
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

WIDE_NUMERIC = ["price_na", "k_const", "near_const", "sentinel", "nation", "acctbal", "custkey"]
WIDE_TEXT = ["prio_tok", "status", "priority", "segment", "date_txt"]
WIDE_FEATURES = WIDE_NUMERIC + WIDE_TEXT


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table ``(model, ID, target)`` of five synthetic models
    plus the true label ``y`` and a hashed train/valid ``split``: a model's
    score is a hash of (key, model) scaled to [0, 1) in 1/1000 steps."""
    o = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"))
    long = o.select("ID", "y", F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model"))
    h = raw_hash(F.concat(F.col("ID").cast("string"), F.lit("_"), F.col("model")))
    split_h = raw_hash(F.concat(F.col("ID").cast("string"), F.lit("_split")))
    return long.select(
        "model", "ID", (F.pmod(h, F.lit(1000)).cast("double") / F.lit(1000.0)).alias("target"), "y",
        F.when(F.pmod(split_h, F.lit(10)) < 7, "train").otherwise("valid").alias("split"))


MODEL_SCORES_SQL = """
    SELECT m.model AS model, o.o_orderkey AS ID,
           CAST(CAST(concat('0x', substr(md5(concat(CAST(o.o_orderkey AS VARCHAR), '_', m.model)), 1, 8)) AS BIGINT) % 1000 AS DOUBLE)
             / CAST(1000 AS DOUBLE) AS target,
           CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
           CASE WHEN CAST(concat('0x', substr(md5(concat(CAST(o.o_orderkey AS VARCHAR), '_split')), 1, 8)) AS BIGINT) % 10 < 7
                THEN 'train' ELSE 'valid' END AS split
    FROM orders o, (VALUES ('m1'), ('m2'), ('m3'), ('m4'), ('m5')) AS m(model)
"""


def sql_hash(expr: str) -> str:
    """DuckDB twin of ``functions.hashing.raw_hash`` (md5 form)."""
    return f"CAST(concat('0x', substr(md5({expr}), 1, 8)) AS BIGINT)"


def sql_key_hash(col: str, seed) -> str:
    """DuckDB twin of ``functions.hashing.key_hash(col, seed)``."""
    return sql_hash(f"concat(CAST({col} AS VARCHAR), '_{seed}')")
