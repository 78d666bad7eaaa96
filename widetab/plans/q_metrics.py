"""Metric queries (F1-F4, F7) on labelled documents and synthetic model scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import metrics as M
from widetab.plans.registry import register
from widetab.plans.tables import MODEL_SCORES_SQL, MODELS, model_scores, read


def _docs(spark, d):
    lab = read(spark, d, "labels")
    doc = read(spark, d, "documents").select("doc_id", "n_chars", "lang")
    return lab.join(doc, "doc_id")


def _auc_sql(src: str, score: str, label: str, by: list[str]) -> str:
    b = ", ".join(by)
    bsel = (b + ", ") if by else ""
    part = f"PARTITION BY {b} " if by else ""
    return f"""
WITH j AS ({src}),
c AS (SELECT {bsel}CAST({score} AS DOUBLE) AS s,
             CAST(count(*) FILTER (WHERE {label} = 1) AS DOUBLE) AS pos,
             CAST(count(*) FILTER (WHERE {label} <> 1) AS DOUBLE) AS neg
      FROM j GROUP BY {bsel}CAST({score} AS DOUBLE)),
r AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         CAST(0 AS DOUBLE)) AS nb FROM c)
SELECT {bsel}CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       sum(pos * (nb + neg / CAST(2 AS DOUBLE))) / nullif(sum(pos) * sum(neg), 0) AS auc
FROM r {"GROUP BY " + b if by else ""}"""


_DOCS_SQL = "SELECT l.quality, l.toxic, d.n_chars, d.lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id"


@register("auc", _auc_sql(_DOCS_SQL, "n_chars", "quality", []), ("F1",))
def auc(spark, d):
    return M.auc(_docs(spark, d), "n_chars", "quality")


@register("auc_by_group", _auc_sql(_DOCS_SQL, "n_chars", "toxic", ["lang"]), ("F1",))
def auc_by_group(spark, d):
    return M.auc(_docs(spark, d), "n_chars", "toxic", ["lang"])


@register("auc_model_scores", _auc_sql(MODEL_SCORES_SQL, "target", "y", ["model"]), ("F1",))
def auc_model_scores(spark, d):
    return M.auc(model_scores(spark, d), "target", "y", ["model"])


_LL = ("-(CAST(y AS DOUBLE) * ln(greatest(least(target, 1 - 1e-14), 1e-14)) "
       "+ (1 - CAST(y AS DOUBLE)) * ln(1 - greatest(least(target, 1 - 1e-14), 1e-14)))")


@register("logloss", f"""
WITH s AS ({MODEL_SCORES_SQL})
SELECT model, count(*) AS n_rows, round(avg({_LL}), 9) AS logloss FROM s GROUP BY model
""", ("F2",))
def logloss(spark, d):
    out = M.logloss(model_scores(spark, d), "target", "y", ["model"])
    return out.withColumn("logloss", F.round("logloss", 9))


_SCORE_TABLE_SQL = f"""
WITH a AS ({_auc_sql(MODEL_SCORES_SQL, "target", "y", ["model", "split"])}),
s AS ({MODEL_SCORES_SQL}),
l AS (SELECT model, split, round(avg({_LL}), 9) AS logloss FROM s GROUP BY model, split)
SELECT a.model, a.split, a.n_pos, a.n_neg, a.auc, l.logloss
FROM a LEFT JOIN l ON a.model = l.model AND a.split = l.split
"""


@register("score_table", _SCORE_TABLE_SQL, ("F4", "F1", "F2"))
def score_table(spark, d):
    t = M.score_table(model_scores(spark, d), "y", "target", ["model", "split"])
    return t.withColumn("logloss", F.round("logloss", 9))


@register("best_run", f"""
WITH t AS ({_SCORE_TABLE_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY auc DESC NULLS LAST, model) AS rk FROM t)
SELECT model, split, n_pos, n_neg, auc, logloss FROM r WHERE rk = 1
""", ("F7",))
def best_run(spark, d):
    t = M.score_table(model_scores(spark, d), "y", "target", ["model", "split"])
    t = t.withColumn("logloss", F.round("logloss", 9))
    return M.best_run(t, "auc", by=["split"], tiebreak=["model"])


@register("progress", f"""
WITH s AS (SELECT model, ID, target, y FROM ({MODEL_SCORES_SQL})),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ID) AS rn FROM s),
b AS (SELECT model, CAST(floor((rn - 1) / 1500) AS BIGINT) AS block, max(rn) AS rows,
             sum(CASE WHEN rn % 100 <> 0 THEN {_LL} END) AS tl,
             count(*) FILTER (WHERE rn % 100 <> 0) AS tn,
             sum(CASE WHEN rn % 100 = 0 THEN {_LL} END) AS vl,
             count(*) FILTER (WHERE rn % 100 = 0) AS vn
      FROM r GROUP BY 1, 2)
SELECT model, block, CAST(rows AS BIGINT) AS rows,
       round(sum(coalesce(tl, 0)) OVER w / nullif(sum(tn) OVER w, 0), 9) AS train_logloss,
       round(sum(coalesce(vl, 0)) OVER w / nullif(sum(vn) OVER w, 0), 9) AS valid_logloss,
       CAST(sum(vn) OVER w AS BIGINT) AS n_valid
FROM b WINDOW w AS (PARTITION BY model ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""", ("F3", "D6"))
def progress(spark, d):
    s = model_scores(spark, d).select("model", "ID", "target", "y")
    from widetab.operators.ordering import row_number
    numbered = row_number(s, ["ID"], ["model"], "rn")
    flagged = numbered.withColumn("is_valid", F.pmod(F.col("rn"), F.lit(100)) == 0)
    rep = M.progress(flagged, "rn", "y", "target", 1500, by=["model"])
    return rep.select("model", "block", "rows", F.round("train_logloss", 9).alias("train_logloss"),
                      F.round("valid_logloss", 9).alias("valid_logloss"), "n_valid")
