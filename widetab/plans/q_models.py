"""Screening, learner, stacking and search queries.

Model fits have no SQL twin; these queries are checked by rows here and by
invariant tests (keys predicted once, no out-of-fold leak, probabilities in
[0, 1], AUC above chance on a learnable label).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import features as C
from widetab.operators import learners as L
from widetab.operators import metrics as M
from widetab.operators import profile as P
from widetab.operators import sampling as D
from widetab.operators import screen as S
from widetab.operators import search as SE
from widetab.operators import stacking as ST
from widetab.plans.registry import register
from widetab.plans.tables import KEY, LABEL, read, wide

LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(method: str) -> str:
    pairs = [(LI_COLS[i], LI_COLS[j]) for i in range(len(LI_COLS)) for j in range(i + 1, len(LI_COLS))]
    if method == "pearson":
        src = "lineitem"
        sel = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM {src}" for a, b in pairs]
        return " UNION ALL ".join(sel)
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
        for c in LI_COLS)
    sel = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM rk" for a, b in pairs]
    return f"WITH rk AS (SELECT {ranks} FROM lineitem) " + " UNION ALL ".join(sel)


@register("pearson", _corr_sql("pearson"), ("B21",))
def pearson(spark, d):
    return S.correlation(read(spark, d, "lineitem"), LI_COLS, "pearson", digits=6)


@register("spearman", _corr_sql("spearman"), ("B22",))
def spearman(spark, d):
    return S.correlation(read(spark, d, "lineitem"), LI_COLS, "spearman", digits=6)


SCREEN = {**{c: c for c in LI_COLS}, "price2": "l_extendedprice * 2 + l_tax", "qty2": "l_quantity + l_discount"}


def _screen_table(spark, d):
    return read(spark, d, "lineitem").select(*[F.expr(e).alias(c) for c, e in SCREEN.items()])


def _pruned_sql(method: str) -> str:
    """Tables x (rows), e (pairs by falling |r|) and w (the sweep: removed columns
    after each pair) of one measure; the means are taken anew at every pair."""
    cols, k = list(SCREEN), method[0]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    src = ", ".join(f"CAST({e} AS DOUBLE) AS c{i}" for i, e in enumerate(SCREEN.values()))
    if method == "spearman":
        ranks = ", ".join(f"rank() OVER (ORDER BY c{i}) + (count(*) OVER (PARTITION BY c{i}) - 1) / 2.0 AS c{i}" for i in range(len(cols)))
        rows = f"{k}x AS (SELECT {ranks} FROM (SELECT {src} FROM lineitem))"
    else:
        rows = f"{k}x AS (SELECT {src} FROM lineitem)"
    edges = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, round(abs(corr(c{i}, c{j})), 9) AS r FROM {k}x" for i, j in pairs)
    mean = lambda c: (f"round(list_sum(list_transform(list_filter(es, lambda z: (z.i = {c} OR z.j = {c}) AND NOT list_contains(gone, z.i) "  # noqa: E731
                      f"AND NOT list_contains(gone, z.j)), lambda z: z.r)), 9)")
    return f"""{rows},
{k}e AS (SELECT *, row_number() OVER (ORDER BY r DESC, i, j) AS n FROM ({edges})),
{k}l AS (SELECT list({{'i': i, 'j': j, 'r': r}}) AS es FROM {k}e),
{k}w(n, gone, r) AS (SELECT CAST(0 AS BIGINT), CAST([] AS INTEGER[]), CAST(2 AS DOUBLE)
  UNION ALL
  SELECT e.n, CASE WHEN list_contains(gone, e.i) OR list_contains(gone, e.j) THEN gone
                   WHEN {mean('e.i')} > {mean('e.j')} THEN list_append(gone, e.i) ELSE list_append(gone, e.j) END, e.r
  FROM {k}w w JOIN {k}e e ON e.n = w.n + 1, {k}l),
{k}g AS (SELECT unnest(gone) AS c, min(n) AS n, max(r) AS r FROM (SELECT n, r, gone FROM {k}w) GROUP BY 1)"""


_PRUNE = "WITH RECURSIVE " + _pruned_sql("pearson") + ", " + _pruned_sql("spearman")


@register("prune_correlated", _PRUNE + """
SELECT col_name, p.c IS NOT NULL AS pearson, s.c IS NOT NULL AS spearman, p.c IS NOT NULL AND s.c IS NOT NULL AS both
FROM (VALUES """ + ", ".join(f"({i}, '{c}')" for i, c in enumerate(SCREEN)) + """) AS t(id, col_name)
LEFT JOIN (SELECT c FROM pg WHERE r > 0.95) p ON p.c = id LEFT JOIN (SELECT c FROM sg WHERE r > 0.95) s ON s.c = id
""", ("B23", "B24"))
def prune_correlated(spark, d):
    t = _screen_table(spark, d)
    cols = t.columns
    pe = S.prune_correlated(S.correlation_matrix(t, cols, "pearson"), cols, 0.95)
    sp = S.prune_correlated(S.correlation_matrix(t, cols, "spearman"), cols, 0.95)
    both = set(S.columns_in_both(pe, sp))
    return spark.createDataFrame([(c, c in pe, c in sp, c in both) for c in cols],
                                 "col_name string, pearson boolean, spearman boolean, both boolean")


@register("prune_curve", _PRUNE + """,
k AS (SELECT round(g.v / 100.0, 4) AS cutoff FROM range(101) g(v))
SELECT CAST(cutoff AS DOUBLE) AS cutoff, CAST((SELECT count(*) FROM pg WHERE r > cutoff) AS INTEGER) AS pearson,
       CAST((SELECT count(*) FROM sg WHERE r > cutoff) AS INTEGER) AS spearman FROM k
""", ("B25",))
def prune_curve(spark, d):
    t = _screen_table(spark, d)
    cols = t.columns
    pe, sp = (S.prune_curve(S.correlation_matrix(t, cols, m), cols) for m in ("pearson", "spearman"))
    return spark.createDataFrame([(c, a, b) for (c, a), (_, b) in zip(pe, sp)], "cutoff double, pearson int, spearman int")


# ---------------------------------------------------------------- learners

NUM = ["price_na", "near_const", "sentinel", "nation", "acctbal", "custkey"]
FEATS = NUM + ["date_txt", "priority", "segment"]


def learning_table(spark, d):
    """Keyed feature table from the wide fixture: text dates → epoch,
    sentinel codes flagged, text → first-appearance level ids, a hashed
    70/30 train/test split and 4 plain folds."""
    w = wide(spark, d)
    w = C.parse_dates(w, ["date_txt"], as_epoch=True)
    w, _ = C.sentinel_flags(w, ["sentinel"])
    w, _none, _lv = C.encode_levels(w, None, KEY, ["priority", "segment"])
    w = D.split(w, KEY, [0.7, 0.3], seed="tt", name="is_test_part")
    w = D.folds(w, KEY, 4, seed="cv")
    return w.withColumn("is_test", F.col("is_test_part") == 1).drop("is_test_part")


FEATURE_TABLE_VERSION = "1"
_BUILD_LOCK = __import__("threading").Lock()


def _input_signature(spark, d: str) -> str:
    """Key of a written feature table: the application (so each run builds
    it once and shares it only within the run), the input files (size,
    mtime) and the source of the code that builds it."""
    import hashlib
    import os
    from widetab.operators import features, sampling
    from widetab.plans import tables
    parts = [FEATURE_TABLE_VERSION, spark.sparkContext.applicationId, os.path.abspath(d)]
    for mod in (features, sampling, tables):
        with open(mod.__file__, "rb") as fh:
            parts.append(hashlib.md5(fh.read()).hexdigest())
    with open(__file__, "rb") as fh:
        parts.append(hashlib.md5(fh.read()).hexdigest())
    for t in ("orders", "customer"):
        try:
            st = os.stat(f"{d}/{t}.parquet")
            parts.append(f"{t}:{st.st_size}:{int(st.st_mtime)}")
        except OSError:
            parts.append(f"{t}:?")
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


def _fit_table(spark, d):
    """The learning table, built once per input and written to the shared
    checkpoint folder (as a preprocessing step writes its feature files for
    all model steps); later model queries read it. Written spread over the
    shuffle partitions by key, since fits make many passes and a
    single-row-group input would otherwise leave each pass in one task."""
    import os
    from widetab.session import ensure_checkpoint_dir, shuffle_partitions
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    path = os.path.join(base, f"features-{_input_signature(spark, d)}")
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with _BUILD_LOCK:  # queries may run from several driver threads
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(hp, "_SUCCESS")):
            (learning_table(spark, d).repartition(shuffle_partitions(spark), KEY)
             .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def _train_test(spark, d, extra=()):
    t = _fit_table(spark, d)
    cols = FEATS + [c for c in t.columns if c.startswith("sentinel_")]
    keep = [KEY, LABEL, "fold", *extra]
    tr = L.assemble(t.filter(~F.col("is_test")), cols, keep=keep)
    te = L.assemble(t.filter(F.col("is_test")), cols, keep=[KEY, LABEL])
    return tr, te, cols


GBT = {"eta": 0.1, "nrounds": 20, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.8, "seed": 1}
PATIENCE = 5


@register("boosted_scores", None, ("E1", "E2", "E15", "F8"))
def boosted_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    tr = D.holdout_n(tr, KEY, tr.count() * 3 // 10, seed="valid", flag="is_valid")
    chosen = L.fit_boosted_by_auc(tr.filter(~F.col("is_valid")), tr.filter(F.col("is_valid")), LABEL, GBT,
                                  patience=PATIENCE, stage=PATIENCE, key=KEY)
    return L.predict(L.refit_by_auc(tr, LABEL, GBT, chosen.best, key=KEY), te, KEY)


@register("boosted_curve", None, ("F8", "E3"))
def boosted_curve(spark, d):
    tr, te, _ = _train_test(spark, d)
    return L.boosted_curve(tr, te, LABEL, {"eta": 0.03, "nrounds": 15, "max_depth": 4, "subsample": 0.5, "min_rows": 20,
                                           "lam": 0.0, "min_child_weight": 0.0, "seed": 2}, key=KEY)


@register("gbm_scores", None, ("E3",))
def gbm_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    model = L.fit_boosted(tr, LABEL, {"eta": 0.03, "nrounds": 15, "max_depth": 4, "subsample": 0.5, "min_child_weight": 20,
                                      "seed": 2})
    return L.predict(model, te, KEY)


@register("forest_scores", None, ("E5",))
def forest_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    reg = L.fit_forest(tr, LABEL, n_trees=20, depth=6, min_rows=5, regression=True)
    cls = L.fit_forest(tr, LABEL, n_trees=20, depth=6, min_rows=5, regression=False, impurity="entropy")
    a = L.predict(reg, te, KEY, "value").withColumn("model", F.lit("rf_regression"))
    b = L.predict(cls, te, KEY, "prob").withColumn("model", F.lit("rf_entropy"))
    return a.unionByName(b)


@register("linear_one_feature", """
WITH r AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS icept FROM lineitem)
SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, round(icept + slope * l_quantity, 2) AS target
FROM (SELECT DISTINCT l_quantity FROM lineitem), r
""", ("E6",))
def linear_one_feature(spark, d):
    li = read(spark, d, "lineitem").select(F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double").alias("price"))
    rows = L.assemble(li, ["l_quantity"], keep=["price"])
    model = L.fit_linear(rows, "price", alpha=0.0, lam=0.0)
    values = L.assemble(li.select("l_quantity").distinct().withColumn("q", F.col("l_quantity")), ["l_quantity"], keep=["q"])
    return L.predict(model, values, "q", "value").select(F.col("q").alias("l_quantity"), F.round("target", 2).alias("target"))


@register("linear_scores", None, ("E6", "E4"))
def linear_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    lin = L.fit_linear(tr, LABEL, alpha=0.43, lam=1e-5)
    gbr = L.fit_boosted(tr, LABEL, {"eta": 0.12, "nrounds": 10, "max_depth": 3}, regression=True)
    return (L.predict(lin, te, KEY, "value").withColumn("model", F.lit("glm"))
            .unionByName(L.predict(gbr, te, KEY, "value").withColumn("model", F.lit("gbm_regression"))))


@register("logistic_scores", None, ("E7", "E8", "E16", "F4"))
def logistic_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    trw = L.class_weight(tr, LABEL)
    parts = [L.predict(L.fit_logistic(trw, LABEL, weight_col="weight"), te, KEY, keep=[LABEL], name="score")
             .withColumn("model", F.lit("logistic_balanced"))]
    for lam, m in zip((1e-1, 1e-2, 1e-3), L.ridge_path(tr, LABEL, (1e-1, 1e-2, 1e-3))):
        parts.append(L.predict(m, te, KEY, keep=[LABEL], name="score").withColumn("model", F.lit(f"ridge_{lam:g}")))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    return M.score_table(preds.withColumn("split", F.lit("test")), LABEL, "score", ["model", "split"])


@register("mlp_svm_scores", None, ("E11", "E12"))
def mlp_svm_scores(spark, d):
    tr, te, cols = _train_test(spark, d)
    from pyspark.ml.feature import StandardScaler
    sc = StandardScaler(inputCol=L.FEATURES, outputCol="__z", withMean=True).fit(tr)
    trz = sc.transform(tr).drop(L.FEATURES).withColumnRenamed("__z", L.FEATURES)
    tez = sc.transform(te).drop(L.FEATURES).withColumnRenamed("__z", L.FEATURES)
    mlp = L.fit_mlp(trz, LABEL, len(cols), hidden=(16, 16), max_iter=20)
    svm = L.fit_svm_platt(trz, LABEL, reg=0.01, fold_col="fold", k=4, max_iter=8)
    return (L.predict(mlp, tez, KEY).withColumn("model", F.lit("mlp"))
            .unionByName(L.predict(svm, tez, KEY).withColumn("model", F.lit("svm_platt"))))


@register("isotonic_scores", None, ("E13",))
def isotonic_scores(spark, d):
    tr, te, _ = _train_test(spark, d)
    stack = ST.stack_oof(tr, te, KEY, {"lr": lambda df: L.fit_logistic(df, LABEL)})
    oof = stack.filter("set = 'train'").select(KEY, F.col("target").alias("score")) \
        .join(tr.select(KEY, LABEL, "fold"), KEY)
    test = stack.filter("set = 'test'").select(KEY, F.col("target").alias("score"))
    return L.isotonic_calibrate(oof, KEY, LABEL, "fold", score="score", test=test)


@register("boost_from_margin", None, ("E14",))
def boost_from_margin(spark, d):
    tr, te, _ = _train_test(spark, d)
    base = L.fit_logistic(tr, LABEL)
    tr_m = L.predict(base, tr, KEY, "margin", keep=[LABEL, L.FEATURES], name="base_margin")
    te_m = L.predict(base, te, KEY, "margin", keep=[L.FEATURES], name="base_margin")
    more = L.boost_from_margin(tr_m, LABEL, "base_margin", {"eta": 0.1, "nrounds": 5, "max_depth": 3}, key=KEY)
    return more.predict(te_m, KEY, base_margin="base_margin")


@register("top_features", None, ("C15",))
def top_features(spark, d):
    tr, _te, cols = _train_test(spark, d)
    model = L.fit_boosted(tr, LABEL, GBT)
    return spark.createDataFrame(L.top_features(model, cols, 5), "col_name string, importance double")


@register("class_weights", """
WITH w AS (SELECT o_orderkey AS ID, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target FROM orders),
r AS (SELECT CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) AS ratio FROM w)
SELECT ID, target, CASE WHEN target = 1 THEN ratio ELSE CAST(1 AS DOUBLE) END AS weight FROM w, r
""", ("E16",))
def class_weights(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias(KEY),
                                        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(LABEL))
    return L.class_weight(o, LABEL)


# ---------------------------------------------------------------- stacking

BASE = {
    "lr": lambda df: L.fit_logistic(df, LABEL),
    "gbt": lambda df: L.fit_boosted(df, LABEL, {"eta": 0.2, "nrounds": 8, "max_depth": 3, "seed": 3}),
}


@register("stack_oof", None, ("G5",))
def stack_oof(spark, d):
    tr, te, _ = _train_test(spark, d)
    return ST.stack_oof(tr, te, KEY, BASE)


@register("stack_holdout", None, ("G6",))
def stack_holdout(spark, d):
    tr, te, _ = _train_test(spark, d)
    tr = D.split(tr, KEY, [0.5, 0.5], seed="half", name="half")
    return ST.stack_holdout(tr, te, KEY, LABEL, "half", BASE, lambda df: L.fit_logistic(df, LABEL))


@register("stack_meta", None, ("G7",))
def stack_meta(spark, d):
    t = _fit_table(spark, d)
    cols = FEATS
    tr = L.assemble(t.filter(~F.col("is_test")), cols, keep=[KEY, LABEL, "fold"])
    te = L.assemble(t.filter(F.col("is_test")), cols, keep=[KEY])
    stack = ST.stack_oof(tr, te, KEY, BASE)
    raw_tr = D.holdout_n(t.filter(~F.col("is_test")).select(KEY, LABEL, *cols), KEY,
                         t.filter(~F.col("is_test")).count() * 3 // 10, seed="meta", flag="is_valid")
    raw_te = t.filter(F.col("is_test")).select(KEY, *cols)
    preds, _best = ST.stack_meta(raw_tr, raw_te, KEY, LABEL, cols, stack, list(BASE),
                                 {"eta": 0.2, "nrounds": 10, "max_depth": 3}, "is_valid")
    return preds


@register("bagged_scores", None, ("G10", "D8", "B18"))
def bagged_scores(spark, d):
    t = _fit_table(spark, d)
    train = t.filter(~F.col("is_test"))
    test = t.filter(F.col("is_test"))
    members = D.bags(train.select(KEY), KEY, 3, 0.8, 0.1, seed=5)
    bag_cols = {b: P.sample_columns(FEATS, 7, seed=5 + b) for b in range(3)}
    return ST.bag(lambda df: L.fit_boosted(df, LABEL, {"eta": 0.2, "nrounds": 8, "max_depth": 3}),
                  train, test, KEY, LABEL, members, bag_cols,
                  fit_valid=lambda tr, va: L.fit_boosted_by_auc(tr, va, LABEL, {"eta": 0.2, "nrounds": 8, "max_depth": 3},
                                                               patience=4, stage=4, key=KEY))


@register("seed_ensemble", None, ("G11",))
def seed_ensemble(spark, d):
    tr, te, _ = _train_test(spark, d)
    return ST.seed_ensemble(lambda df, s: L.fit_forest(df, LABEL, 10, 5, regression=True, seed=s),
                            tr, te, KEY, n=3, seed=7, out="value")


# ---------------------------------------------------------------- search

@register("grid_search", None, ("F5", "F7"))
def grid_search(spark, d):
    tr, te, _ = _train_test(spark, d)

    def evaluate(s):
        m = L.fit_boosted(tr, LABEL, {**s, "nrounds": int(s["nrounds"])})
        a_tr = M.auc(L.predict(m, tr, KEY, keep=[LABEL], name="score"), "score", LABEL).first()["auc"]
        a_te = M.auc(L.predict(m, te, KEY, keep=[LABEL], name="score"), "score", LABEL).first()["auc"]
        return {"auc_train": a_tr, "auc_test": a_te}
    log = SE.search(spark, SE.grid({"eta": [0.1, 0.3], "max_depth": [2, 4], "nrounds": [5]}), evaluate)
    return M.best_run(log, "auc_test", tiebreak=["i"])


@register("cross_validated_grid", None, ("F5",))
def cross_validated_grid(spark, d):
    from pyspark.ml.classification import LogisticRegression
    tr, _te, _ = _train_test(spark, d)
    _model, log = SE.cross_validate(LogisticRegression(labelCol=LABEL, featuresCol=L.FEATURES),
                                    {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}, tr, LABEL,
                                    fold_col="fold")
    return spark.createDataFrame([(p["regParam"], p["elasticNetParam"], s) for p, s in log],
                                 "regParam double, elasticNetParam double, auc double")


@register("random_search", None, ("F6",))
def random_search(spark, d):
    tr, te, _ = _train_test(spark, d)
    space = {"eta": ("uniform", 0.1, 0.5), "max_depth": ("int", 2, 5), "subsample": ("choice", [0.7, 1.0])}

    def evaluate(s):
        m = L.fit_boosted(tr, LABEL, {**s, "nrounds": 5})
        return {"auc_test": M.auc(L.predict(m, te, KEY, keep=[LABEL], name="score"), "score", LABEL).first()["auc"]}
    return SE.search(spark, SE.random_grid(space, 3, seed=1), evaluate)


SWEEP = [(alpha, beta) for alpha in (0.01, 0.05, 0.1, 0.2) for beta in (0.5, 1.0)]


@register("sweep_online", None, ("F9", "A10"))
def sweep_online(spark, d):
    """Eight settings of the adaptive learner, trained in the same passes."""
    from widetab.operators import online as O
    from widetab.plans.q_online import _prepared
    from widetab.session import scratch_path
    from widetab.sources.io import run_id
    e = _prepared(spark, d)
    settings = {run_id({"alpha": a, "beta": b}, "SGD"): O.OnlineParams(algo="adagrad", alpha=a, beta=b) for a, b in SWEEP}
    state = O.fit_sweep(e, "event_id", "y", scratch_path(spark, "sweep"), list(settings.values()), n_batches=2)
    return M.auc(O.score_sweep(state, e, "event_id", settings, keep=["y"]), "p", "y", ["model"])
