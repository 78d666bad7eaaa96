"""Profile edge cases: all-NULL, constant, ties, empty table."""

from widetab.operators import profile as P


def test_profile_edges(spark):
    rows = [(1, None, 5, "a", 1.0), (2, None, 5, "a", 2.0), (3, None, 5, "b", None), (4, None, 5, "b", 2.0)]
    df = spark.createDataFrame(rows, "ID int, allnull double, const int, t string, x double")
    prof = {r["col_name"]: r for r in P.column_profile(df, exclude=["ID"]).collect()}
    assert prof["allnull"]["n_distinct"] == 1 and prof["allnull"]["is_constant"] and prof["allnull"]["zero_var"]
    assert prof["const"]["is_constant"] and prof["const"]["nzv"]
    assert prof["t"]["top1"] == 2 and prof["t"]["top2"] == 2 and prof["t"]["freq_ratio"] == 1.0
    assert prof["x"]["n_distinct"] == 3 and prof["x"]["n_null"] == 1 and not prof["x"]["is_constant"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "ID int, x double, t string")
    assert P.column_profile(df, exclude=["ID"]).count() == 0
    assert P.missing_share(df, exclude=["ID"]).first()["missing_share"] is None


def test_drop_constant_applies_train_list_to_test(spark):
    tr = spark.createDataFrame([(1, 1, 2), (2, 1, 3)], "ID int, c int, v int")
    te = spark.createDataFrame([(3, 9, 2)], "ID int, c int, v int")
    a, b, names = P.drop_constant(tr, te, exclude=["ID"])
    assert names == ["c"] and a.columns == ["ID", "v"] and b.columns == ["ID", "v"]


def test_approx_profile_agrees_on_flags(spark):
    from widetab.plans.tables import wide
    from conftest import SMALL
    w = wide(spark, SMALL)
    ex = {r["col_name"]: r for r in P.column_profile(w, exclude=["ID", "target"]).collect()}
    ap = {r["col_name"]: r for r in P.column_profile(w, exclude=["ID", "target"], exact=False).collect()}
    assert set(ex) == set(ap)
    for c in ex:
        assert ex[c]["nzv"] == ap[c]["nzv"] and ex[c]["is_constant"] == ap[c]["is_constant"], c
        assert ex[c]["n_null"] == ap[c]["n_null"], c
        if ap[c]["top1"] is not None:
            assert ex[c]["n_distinct"] == ap[c]["n_distinct"], c


def test_encode_levels_strategies_agree(spark):
    from widetab.operators import features as C
    from conftest import SMALL
    o = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    tr, te = o.filter("o_orderkey % 3 <> 0"), o.filter("o_orderkey % 3 = 0")
    cols = ["o_orderstatus", "o_orderpriority"]
    a, b, _ = C.encode_levels(tr, te, "o_orderkey", cols, strategy="broadcast")
    c, d, _ = C.encode_levels(tr, te, "o_orderkey", cols, strategy="long")
    assert sorted(a.collect()) == sorted(c.collect()) and sorted(b.collect()) == sorted(d.collect())


def test_unpivot_keeps_nulls_after_non_nullable_first_column(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, t string").select(
        F.lit(1).alias("k"), "t")  # k is non-nullable and comes first
    vc = {r["col_name"]: r for r in P.value_counts(df).collect()}
    assert vc["t"]["v_num"] is None
    prof = {r["col_name"]: r for r in P.column_profile(df).collect()}
    assert prof["t"]["min_value"] is None and prof["t"]["max_value"] is None


def test_profile_in_column_chunks(spark, monkeypatch):
    from pyspark.sql import functions as F
    df = spark.range(50).select(F.col("id").alias("ID"), *[(F.col("id") % (i + 2)).alias(f"c{i}") for i in range(7)],
                                F.lit("x").alias("t"))
    whole = sorted(P.column_profile(df, exclude=["ID"]).collect())
    monkeypatch.setattr(P, "UNPIVOT_CHUNK", 3)
    assert sorted(P.column_profile(df, exclude=["ID"]).collect()) == whole


def test_date_detection_and_hour_bins(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("16JAN14:21:16:00", "x"), ("02FEB15:03:00:00", "JAN1"), (None, "y")],
                               "d string, t string")
    full = {r["col_name"]: r["is_date"] for r in P.detect_date_columns(df).collect()}
    assert full == {"d": True, "t": False}
    legacy = {r["col_name"]: r["is_date"] for r in
              P.detect_date_columns(df, pattern=P.LEGACY_DATE_PATTERN).collect()}
    assert legacy == {"d": True, "t": True}
    ts = df.select(F.try_to_timestamp("d", F.lit("ddMMMyy:HH:mm:ss")).alias("ts"))
    hist = {r["hour"]: r["count"] for r in P.hour_histogram(ts, ["ts"]).collect()}
    assert len(hist) == 24 and hist[21] == 1 and hist[3] == 1 and sum(hist.values()) == 2


def test_missing_pattern_groups_brute_force(spark):
    rows = [(i, None if i < 3 else 1.0, "a" if i < 7 else "b", 5.0 if i < 9 else 6.0) for i in range(10)]
    df = spark.createDataFrame(rows, "ID int, x double, t string, y double")
    got = {r["m"]: r["n_columns"] for r in P.missing_pattern_groups(P.column_profile(df, exclude=["ID"])).collect()}
    # x: {NULL×3, 1.0×7} → m = 3; t: {a×7, b×3} → m = 3; y: {5×9, 6×1} → m = 1
    assert got == {3: 2, 1: 1}


def test_top_values_ties_and_lookup_keeps_all(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), ("d",)], "t string")
    top = [(r["rank"], r["value"], r["count"]) for r in P.distinct_values(df, k=3).orderBy("rank").collect()]
    assert top == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]  # ties broken by value
    lk = spark.createDataFrame([(1, "ONE"), (2, "TWO"), (3, "THREE")], "code int, name string")
    facts = spark.createDataFrame([(1,), (1,), (3,)], "code int")
    got = {r["code"]: (r["name"], r["count"]) for r in P.counts_with_lookup(facts, "code", lk, "code", "name").collect()}
    assert got == {1: ("one", 2), 2: ("two", None), 3: ("three", 1)}
