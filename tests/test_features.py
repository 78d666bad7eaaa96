"""Feature operators against brute force on small fixtures."""

from pyspark.sql import functions as F

from widetab.operators import features as C


def test_levels_by_first_appearance_train_then_test(spark):
    train = spark.createDataFrame([(3, "b"), (1, "c"), (2, None), (5, "b")], "k int, t string")
    test = spark.createDataFrame([(0, "z"), (4, "c"), (6, "a")], "k int, t string")
    tr, te, levels = C.encode_levels(train, test, "k", ["t"])
    # train in key order: c (k=1), b (k=3); then test in key order: z (k=0), a (k=6)
    want = {"c": 1, "b": 2, "z": 3, "a": 4}
    assert {r["value"]: r["level"] for r in levels.collect()} == want
    assert {r["k"]: r["t"] for r in tr.collect()} == {3: 2, 1: 1, 2: None, 5: 2}
    assert {r["k"]: r["t"] for r in te.collect()} == {0: 3, 4: 1, 6: 4}


def test_sentinel_flags_repeated_passes(spark):
    rows = [(1, 5.0, 3.0), (2, 999999.0, -9999.0), (3, 99.0, 1.0), (4, 7.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    out, found = C.sentinel_flags(df, ["a", "b"])
    # pass 1: a's max 999999 (10^6 - 1) and b's min -9999 (-(10^4 - 1)); pass 2: a's new max 99 (10^2 - 1)
    assert sorted(found) == sorted([("a", 999999.0), ("b", -9999.0), ("a", 99.0)])
    got = {r["k"]: r for r in out.collect()}
    assert got[2]["a"] is None and got[2]["a_999999"] == 1 and got[2]["b"] is None and got[2]["b_neg9999"] == 1
    assert got[3]["a"] is None and got[3]["a_99"] == 1 and got[1]["a"] == 5.0


def test_interaction_pairs_and_self_pair_quirk(spark):
    names = [f"v{i}" for i in range(20)]
    df = spark.range(1).select(*[F.lit(float(i)).alias(n) for i, n in enumerate(names)])
    plain = C.interactions(df, names + ["v3"], ops=("times",), keep=False)
    assert len(plain.columns) == 190
    compat = C.interactions(df, names, ops=("plus", "times"), keep=False, self_pair=True)
    assert len(compat.columns) == 2 * 191 and "v19_TIMES_v19" in compat.columns
    assert compat.first()["v2_PLUS_v5"] == 7.0


def test_fill_and_clamp(spark):
    df = spark.createDataFrame([(1, None, -3.0), (2, float("nan"), 4.0)], "k int, x double, y double")
    filled = {r["k"]: r["x"] for r in C.fill_sentinel(df, -98989898, ["x"]).collect()}
    assert filled == {1: -98989898.0, 2: -98989898.0}
    clamped = {r["k"]: r["y"] for r in C.clamp_negative(df, -9999, ["y"]).collect()}
    assert clamped == {1: -9999.0, 2: 4.0}
    assert C.variant_columns(["ID", "a", "b", "c"], {"nzv": ["a"], "cor": ["b"]}, keep=["ID"])["minus_all"] == ["ID", "c"]
