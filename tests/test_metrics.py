"""AUC and log loss against brute force and invariants."""

import math
import random

from pyspark.sql import functions as F

from widetab.operators import metrics as M


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else (0.5 if p == n else 0.0)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_complement(spark):
    rnd = random.Random(4)
    rows = [(round(rnd.random(), 1), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(3)
    a = M.auc(df, "s", "y").first()["auc"]
    assert abs(a - _brute_auc(rows)) < 1e-12
    b = M.auc(df.withColumn("s", 1 - F.col("s")), "s", "y").first()["auc"]
    assert abs(a + b - 1.0) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "s double, y int")
    assert M.auc(df, "s", "y").first()["auc"] is None


def test_logloss_clips(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 0), (0.5, 1)], "p double, y int")
    v = M.logloss(df, "p", "y").first()["logloss"]
    want = (-math.log(1e-14) - math.log(1.0 - (1.0 - 1e-14)) - math.log(0.5)) / 3
    assert abs(v - want) < 1e-9


def test_auc_same_for_any_layout(spark):
    rnd = random.Random(9)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1), rnd.randint(0, 2)) for _ in range(600)]
    base = spark.createDataFrame(rows, "s double, y int, g int")
    ref = None
    for parts in (1, 4, 17):
        got = sorted(M.auc(base.repartition(parts), "s", "y", ["g"]).collect())
        ref = ref or got
        assert got == ref


def test_unique_key_check(spark):
    import pytest
    from widetab.operators.features import assert_unique_key
    assert_unique_key(spark.createDataFrame([(1,), (2,)], "k int"), "k")
    with pytest.raises(ValueError):
        assert_unique_key(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_auc_ignores_missing_scores(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (None, 1), (float("nan"), 0), (0.5, None)], "s double, y int")
    r = M.auc(df, "s", "y").first()
    assert r["auc"] == 1.0 and r["n_pos"] == 1 and r["n_neg"] == 1
