"""Sources and sinks: tokens to NULL, key-joined prediction files, per-model
stage outputs that survive a re-run."""

import tempfile

from pyspark.sql import functions as F

from widetab.sources import io


def test_read_table_tokens_and_order(spark):
    base = tempfile.mkdtemp(prefix="wt-io-", dir="/tmp")
    df = spark.createDataFrame([(1, "a", 0.5, 1), (2, "[]", None, 0), (3, "-1", 2.0, 1), (4, "", 1.0, 0)],
                               "ID long, t string, x double, target int")
    df.select("target", "t", "ID", "x").write.option("header", True).csv(f"{base}/t")
    out = io.read_table(spark, f"{base}/t", "ID", "target", fmt="csv", schema="target int, t string, ID long, x double")
    assert out.columns == ["ID", "t", "x", "target"]
    got = {r["ID"]: r["t"] for r in out.collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None}


def test_write_predictions_keeps_every_key(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "ID long")
    pred = spark.createDataFrame([(1, 0.2), (3, 0.9)], "ID long, target double")
    out = {r["ID"]: r["target"] for r in io.write_predictions(pred, keys).collect()}
    assert out == {1: 0.2, 2: None, 3: 0.9}


def test_stage_outputs_per_model(spark):
    base = tempfile.mkdtemp(prefix="wt-stage-", dir="/tmp") + "/stage"
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "ID long, target double")
    io.checkpoint_stage(a, base, "m1")
    io.checkpoint_stage(a.withColumn("target", F.lit(0.7)), base, "m2")
    io.checkpoint_stage(a.withColumn("target", F.lit(0.3)), base, "m1")  # re-run of m1 replaces m1 only
    assert io.completed_models(spark, base) == ["m1", "m2"]
    rows = {(r["model"], r["ID"]): r["target"] for r in spark.read.parquet(base).collect()}
    assert rows[("m1", 1)] == 0.3 and rows[("m2", 2)] == 0.7 and len(rows) == 4


def test_run_id():
    assert io.run_id({"alpha": 0.1, "beta": 1}, "SGD") == "SGD_alpha_0.1_beta_1"


def test_read_table_nan_is_missing(spark):
    base = tempfile.mkdtemp(prefix="wt-nan-", dir="/tmp")
    spark.createDataFrame([(1, float("nan")), (2, 1.5)], "ID long, x double").write.parquet(f"{base}/p")
    got = {r["ID"]: r["x"] for r in io.read_table(spark, f"{base}/p", "ID", None).collect()}
    assert got == {1: None, 2: 1.5}


def test_strict_average_rejects_gaps(spark):
    import pytest
    from widetab.operators.ensemble import average
    preds = spark.createDataFrame([("a", 1, 0.2), ("b", 1, 0.4), ("a", 2, 0.6)], "model string, ID long, target double")
    assert {r["ID"]: r["target"] for r in average(preds, "ID").collect()} == {1: 0.3, 2: 0.3}
    with pytest.raises(ValueError):
        average(preds, "ID", strict=True)
