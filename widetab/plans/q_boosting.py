"""Staged boosting against SQL (E1, E2, E14, F8): depth-one trees on one
feature, where rows of equal value share their margin, so a round is a few
grouped sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import boosting as B
from widetab.operators import learners as L
from widetab.plans.registry import register
from widetab.plans.tables import read

ROUNDS, ETA, LAM = 4, 0.4, 1.0
PARAMS = {"eta": ETA, "nrounds": ROUNDS, "max_depth": 1, "lam": LAM, "min_child_weight": 1.0}
BASE = "(l_quantity - 25) / 40"


def _rounds_sql(margin: str, train: str = "true") -> str:
    """Tables r0..rN of (value, n, pos, margin after the round); cuts are made on
    the rows of ``train``, margins kept for all values."""
    out = [f"""r0 AS (SELECT CAST(l_quantity AS DOUBLE) AS v, CAST(count(*) FILTER ({train}) AS DOUBLE) AS n,
      CAST(count(*) FILTER ({train} AND l_returnflag = 'R') AS DOUBLE) AS pos, CAST({margin} AS DOUBLE) AS m
      FROM lineitem GROUP BY l_quantity)"""]
    for k in range(1, ROUNDS + 1):
        out.append(f"""
g{k} AS (SELECT v, sum(n / (1 + exp(-m)) - pos) OVER w AS gl, sum(n / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))) OVER w AS hl,
      sum(n / (1 + exp(-m)) - pos) OVER () AS g, sum(n / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))) OVER () AS h
      FROM r{k - 1} WINDOW w AS (ORDER BY v)),
c{k} AS (SELECT v AS cut, -gl / (hl + {LAM}) AS lo, -(g - gl) / (h - hl + {LAM}) AS hi FROM g{k}
      WHERE hl >= 1 AND h - hl >= 1
      ORDER BY gl * gl / (hl + {LAM}) + (g - gl) * (g - gl) / (h - hl + {LAM}) DESC, v LIMIT 1),
r{k} AS (SELECT v, n, pos, m + {ETA} * CASE WHEN v <= cut THEN lo ELSE hi END AS m FROM r{k - 1}, c{k})""")
    return "WITH " + ",".join(out)


def _table(spark, d):
    li = read(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), "l_orderkey", "l_quantity", F.expr(BASE).alias("base_margin"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    return L.assemble(li, ["l_quantity"], keep=["key", "l_orderkey", "base_margin", "y"], sentinel=None)


def _by_value(scored):
    return scored.groupBy(F.col("q").alias("l_quantity")).agg(F.count("*").alias("n_rows"), F.round(F.max("margin"), 5).alias("margin"))


def _scored(model, t, base_margin=None):
    from pyspark.ml.functions import vector_to_array
    return _by_value(model.margins(t.withColumn("q", vector_to_array("features")[0]), ["q"], base_margin=base_margin))


def _scored_sql(margin: str) -> str:
    return _rounds_sql(margin) + f"""
SELECT v AS l_quantity, CAST(n AS BIGINT) AS n_rows, round(m, 5) AS margin FROM r{ROUNDS}"""


@register("boosted_stumps", _scored_sql("0"), ("E1", "E2"))
def boosted_stumps(spark, d):
    t = _table(spark, d)
    return _scored(B.fit(t, "y", PARAMS, stage=2, key="key"), t)


@register("boosted_stumps_from_margin", _scored_sql(BASE), ("E14",))
def boosted_stumps_from_margin(spark, d):
    t = _table(spark, d)
    return _scored(L.boost_from_margin(t, "y", "base_margin", PARAMS, key="key"), t, "base_margin")


_TRAIN = "l_orderkey % 3 > 0"
_CURVE = _rounds_sql("0", _TRAIN) + """,
e AS (SELECT CAST(l_quantity AS DOUBLE) AS v, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS p,
             CAST(count(*) FILTER (l_returnflag <> 'R') AS DOUBLE) AS q FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY l_quantity),
s AS (""" + " UNION ALL ".join(
    f"SELECT {k} AS round, m, sum(p) AS p, sum(q) AS q FROM e JOIN r{k} USING (v) GROUP BY m" for k in range(1, ROUNDS + 1)) + """),
b AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY round ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM s)
SELECT CAST(round AS INTEGER) AS round, round(sum(p * ln(1 + exp(-m)) + q * ln(1 + exp(m))) / sum(p + q), 6) AS loss,
       round(sum(p * (below + q / 2)) / (sum(p) * sum(q)), 9) AS auc FROM b GROUP BY round"""


@register("boosted_stumps_curve", _CURVE, ("E1", "F8"))
def boosted_stumps_curve(spark, d):
    t = _table(spark, d)
    curve = L.boosted_curve(t.filter("l_orderkey % 3 > 0"), t.filter("l_orderkey % 3 = 0"), "y", PARAMS, stage=3, key="key")
    return curve.select("round", F.round("loss", 6).alias("loss"), F.round("auc", 9).alias("auc"))
