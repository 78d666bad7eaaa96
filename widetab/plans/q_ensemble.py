"""Ensemble queries (G1-G4, G8 grid, G9) and prediction I/O."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import ensemble as G
from widetab.operators.metrics import LOGLOSS_EPS
from widetab.plans.registry import register
from widetab.plans.tables import KEY, MODEL_SCORES_SQL, MODELS, model_scores, read
from widetab.session import scratch_path
from widetab.sources import io

_S = f"WITH s AS ({MODEL_SCORES_SQL})"


def _scores(spark, d):
    return model_scores(spark, d).select("model", KEY, "target")


@register("average", _S + """
SELECT ID, round(sum(target) / CAST(5 AS DOUBLE), 6) AS target FROM s GROUP BY ID
""", ("G1",))
def average(spark, d):
    return G.average(_scores(spark, d), KEY)


# Weights of the weighted blend (2,1,1,1,2 over 7).
WEIGHTS = {"m1": 2.0, "m2": 1.0, "m3": 1.0, "m4": 1.0, "m5": 2.0}


@register("weighted_average", _S + """,
w AS (SELECT * FROM (VALUES ('m1', 2.0), ('m2', 1.0), ('m3', 1.0), ('m4', 1.0), ('m5', 2.0)) AS t(model, w))
SELECT ID, round(sum(CAST(w.w AS DOUBLE) * target) / sum(CAST(w.w AS DOUBLE)), 6) AS target
FROM s JOIN w ON s.model = w.model GROUP BY ID
""", ("G2",))
def weighted_average(spark, d):
    out = G.weighted_average(_scores(spark, d), WEIGHTS, KEY)
    return out.withColumn("target", F.round("target", 6))


# Family blend 0.9 trees (weights 3,1,1) + 0.1 online (1,1).
FAMILY_MODELS = {"trees": {"m1": 3.0, "m2": 1.0, "m3": 1.0}, "online": {"m4": 1.0, "m5": 1.0}}
FAMILY_WEIGHTS = {"trees": 0.9, "online": 0.1}


@register("blend", _S + """,
w AS (SELECT * FROM (VALUES ('m1', 'trees', 3.0), ('m2', 'trees', 1.0), ('m3', 'trees', 1.0),
                            ('m4', 'online', 1.0), ('m5', 'online', 1.0)) AS t(model, fam, w)),
fw AS (SELECT * FROM (VALUES ('trees', 0.9), ('online', 0.1)) AS t(fam, fw)),
f AS (SELECT w.fam, s.ID, sum(CAST(w.w AS DOUBLE) * s.target) / sum(CAST(w.w AS DOUBLE)) AS fs
      FROM s JOIN w ON s.model = w.model GROUP BY w.fam, s.ID)
SELECT f.ID, round(sum(CAST(fw.fw AS DOUBLE) * f.fs) / sum(CAST(fw.fw AS DOUBLE)), 6) AS target
FROM f JOIN fw ON f.fam = fw.fam GROUP BY f.ID
""", ("G3",))
def blend(spark, d):
    out = G.blend(_scores(spark, d), FAMILY_MODELS, FAMILY_WEIGHTS, KEY)
    return out.withColumn("target", F.round("target", 6))


@register("row_mean", _S + """,
p AS (SELECT ID, """ + ", ".join(f"max(target) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS) + """
      FROM s GROUP BY ID)
SELECT ID, """ + ", ".join(MODELS) + """, round((((m1 + m2) + (m3 + m4)) + m5) / CAST(5 AS DOUBLE), 6) AS target FROM p
""", ("G4",))
def row_mean(spark, d):
    wide = G.pivot_models(_scores(spark, d), KEY, MODELS)
    out = G.row_mean(wide, list(MODELS))
    return out.withColumn("target", F.round("target", 6))


@register("minmax", _S + """,
st AS (SELECT model, min(target) AS lo, max(target) AS hi FROM s GROUP BY model)
SELECT s.model, ID, round((target - lo) / nullif(hi - lo, 0), 6) AS target FROM s JOIN st ON s.model = st.model
""", ("G9",))
def minmax(spark, d):
    scores = _scores(spark, d).select("model", KEY, "target")
    return G.minmax(scores, by=["model"]).withColumn("target", F.round("target", 6))


GRID_STEP = 0.1
_GRID = G.weight_grid(MODELS, GRID_STEP)
_GRID_VALUES = ", ".join(f"({i}, {', '.join(repr(g[m]) for m in MODELS)})" for i, g in enumerate(_GRID))
_CLIP = f"greatest(least(p, 1 - {LOGLOSS_EPS!r}), {LOGLOSS_EPS!r})"


@register("blend_weight_grid", _S + """,
p AS (SELECT ID, max(y) AS y, """ + ", ".join(f"max(target) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS) + f"""
      FROM s GROUP BY ID),
g AS (SELECT grid_id, {", ".join(f"CAST(w_{m} AS DOUBLE) AS w_{m}" for m in MODELS)}
      FROM (VALUES {_GRID_VALUES}) AS t(grid_id, {", ".join(f"w_{m}" for m in MODELS)})),
b AS (SELECT g.grid_id, p.y, {" + ".join(f"g.w_{m} * p.{m}" for m in MODELS)} AS p FROM p, g)
SELECT CAST(grid_id AS INTEGER) AS grid_id,
       round(avg(-(CAST(y AS DOUBLE) * ln({_CLIP}) + (1 - CAST(y AS DOUBLE)) * ln(1 - {_CLIP}))), 9) AS logloss,
       {", ".join(f"max(w_{m}) AS w_{m}" for m in MODELS)}
FROM b JOIN g USING (grid_id) GROUP BY grid_id
""", ("G8",))
def blend_weight_grid(spark, d):
    ms = model_scores(spark, d)
    out = G.blend_grid_losses(ms.select("model", KEY, "target", "y"), None, KEY, "y", MODELS, step=GRID_STEP)
    return out.select(F.col("grid_id").cast("int").alias("grid_id"), F.round("logloss", 9).alias("logloss"),
                      *[f"w_{m}" for m in MODELS])


@register("blend_weights_fit", None, ("G8",))
def blend_weights_fit(spark, d):
    ms = model_scores(spark, d)
    fit = G.fit_blend_weights(ms.select("model", KEY, "target", "y"), None, KEY, "y", list(MODELS))
    return spark.createDataFrame([(m, w, fit.loss, fit.steps, fit.gap) for m, w in sorted(fit.weights.items())],
                                 "model string, weight double, logloss double, steps int, gap double")


@register("write_predictions", _S + """,
a AS (SELECT ID, round(sum(target) / CAST(5 AS DOUBLE), 6) AS target FROM s GROUP BY ID)
SELECT o.o_orderkey AS ID, a.target FROM orders o LEFT JOIN a ON o.o_orderkey = a.ID
""", ("A6", "G1"))
def write_predictions(spark, d):
    keys = read(spark, d, "orders").select(F.col("o_orderkey").alias(KEY))
    pred = G.average(_scores(spark, d), KEY)
    return io.write_predictions(pred, keys, KEY)


@register("prediction_files_average", _S + """
SELECT ID, round(sum(target) / CAST(5 AS DOUBLE), 6) AS target FROM s GROUP BY ID
""", ("A6", "A7", "A8", "G1"))
def prediction_files_average(spark, d):
    """Round trip through files: one ``ID,target`` CSV per model written to
    the shared checkpoint folder, read back by glob (model from the folder
    name) and averaged."""
    base = scratch_path(spark, "preds")
    scores = _scores(spark, d)
    keys = read(spark, d, "orders").select(F.col("o_orderkey").alias(KEY))
    for m in MODELS:
        io.write_predictions(scores.filter(F.col("model") == m), keys, KEY, path=f"{base}/model={m}")
    long = io.read_predictions(spark, f"{base}/model=*/*.csv")
    return G.average(long, KEY)


@register("stage_outputs_average", _S + """
SELECT ID, round(sum(target) / CAST(5 AS DOUBLE), 6) AS target FROM s GROUP BY ID
""", ("A9", "G1"))
def stage_outputs_average(spark, d):
    """Each model's output saved under ``model=<name>`` with dynamic
    partition overwrite; a re-run skips models already present."""
    base = scratch_path(spark, "stage")
    scores = _scores(spark, d)
    for m in MODELS:
        if m in io.completed_models(spark, base):
            continue
        io.checkpoint_stage(scores.filter(F.col("model") == m).select(KEY, "target"), base, m)
    # a second pass finds every model done and writes nothing
    assert io.completed_models(spark, base) == sorted(MODELS)
    return G.average(spark.read.parquet(base).select("model", KEY, "target"), KEY)


@register("model_columns_files", _S + """
SELECT ID, """ + ", ".join(f"max(target) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS) + """
FROM s GROUP BY ID
""", ("A8", "A6"))
def model_columns_files(spark, d):
    """Named prediction files (one ``ID,target`` CSV per model) read back one
    column each into the long table, then pivoted to meta columns."""
    base = scratch_path(spark, "named")
    scores = _scores(spark, d)
    keys = read(spark, d, "orders").select(F.col("o_orderkey").alias(KEY))
    paths = {}
    for m in MODELS:
        paths[m] = f"{base}/{m}"
        io.write_predictions(scores.filter(F.col("model") == m), keys, KEY, path=paths[m])
    return G.pivot_models(io.read_model_columns(spark, paths), KEY, MODELS)
