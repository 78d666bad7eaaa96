"""Learners, stacking and blending invariants."""

from pyspark.sql import functions as F

from widetab.operators import ensemble as G
from widetab.operators import learners as L
from widetab.operators import stacking as ST
from widetab.plans.q_models import _train_test
from widetab.plans.tables import KEY, LABEL, model_scores

from conftest import SMALL


def test_stack_oof_no_leak(spark):
    tr, te, _ = _train_test(spark, SMALL)
    seen = []

    def fit(df):
        # record the folds each model was trained on (planted leak check)
        seen.append({r[0] for r in df.select("fold").distinct().collect()})
        return L.fit_logistic(df, LABEL, max_iter=5)
    stack = ST.stack_oof(tr, te, KEY, {"lr": fit}, k=4)
    # every fit saw exactly three folds, and each fold was left out once
    assert all(len(f) == 3 for f in seen)
    assert sorted(({0, 1, 2, 3} - f).pop() for f in seen) == [0, 1, 2, 3]
    train_part = stack.filter("set = 'train'")
    n_tr = tr.count()
    assert train_part.count() == n_tr
    assert train_part.select(KEY).distinct().count() == n_tr
    assert stack.filter("set = 'test'").count() == te.count()


def stack_rows(spark, n=240):
    """Train and test rows; some test keys come twice."""
    rows = [(i, float(i % 13), None if i % 7 == 0 else (i * 37 % 101) / 10, int((i * 5 % 13) + (i % 3) > 7), i % 3) for i in range(n)]
    raw = spark.createDataFrame(rows, f"{KEY} bigint, a double, b double, {LABEL} int, fold int")
    test = raw.filter(f"{KEY} % 4 = 0").unionByName(raw.filter(f"{KEY} % 20 = 0"))
    return raw, test, L.assemble(raw, ["a", "b"], keep=[KEY, LABEL, "fold"]), L.assemble(test, ["a", "b"], keep=[KEY])


LEARNERS = {"lr": lambda df: L.fit_logistic(df, LABEL, max_iter=5),
            "gbt": lambda df: L.fit_boosted(df, LABEL, {"eta": 0.3, "nrounds": 2, "max_depth": 2})}


def test_stack_oof_equals_single_predictions(spark):
    """Scores of one pass over the rows are those of every model by itself, also with boosted trees of ours."""
    _, _, tr, te = stack_rows(spark)
    for learners in (LEARNERS, LEARNERS | {"own": lambda df: L.refit_by_auc(df, LABEL, {"max_depth": 2}, 2, key=KEY)}):
        kept = {}
        spied = {name: (lambda df, name=name, fit=fit: kept.setdefault(name, {}).setdefault(
            3 - sum(r[0] for r in df.select("fold").distinct().collect()), fit(df))) for name, fit in learners.items()}
        got = ST.stack_oof(tr, te, KEY, spied, k=3)
        want = {}
        for name, models in kept.items():
            for i, m in models.items():
                for r in L.predict(m, tr.filter(F.col("fold") == i), KEY).collect():
                    want.setdefault((name, "train", r[KEY]), []).append(r["target"])
                for r in L.predict(m, te, KEY).collect():
                    want.setdefault((name, "test", r[KEY]), []).append(r["target"])
        assert got.columns == ["model", "set", KEY, "target"]
        rows = {(r["model"], r["set"], r[KEY]): r["target"] for r in got.collect()}
        assert got.count() == len(rows) and rows.keys() == want.keys()
        assert all(abs(v - sum(want[x]) / len(want[x])) < 1e-12 for x, v in rows.items())


def test_large_fits_run_one_by_one(spark, monkeypatch):
    """Fits side by side cache their rows side by side: past the bound one runs after the other."""
    import threading
    import time
    _, _, tr, te = stack_rows(spark)

    def most(limit):
        monkeypatch.setattr(ST, "FIT_BYTES_AT_ONCE", limit)
        lock, now, top = threading.Lock(), [0], [0]

        def fit(df):
            with lock:
                now[0] += 1
                top[0] = max(top[0], now[0])
            time.sleep(0.3)
            with lock:
                now[0] -= 1
            return LEARNERS["lr"](df)
        ST.stack_oof(tr, te, KEY, {"lr": fit}, k=3)
        return top[0]
    row = ST.FIT_ROW_BYTES + 8 * 2
    assert most(1) == 1 and most(2 * 240 * row) == 2 and most(6 << 30) == 3


def test_stack_meta_computes_its_rows_once(spark, monkeypatch):
    """Both fits read written rows, not the scores and joins again; the rows are deleted."""
    import os
    from widetab.session import ensure_checkpoint_dir
    raw, test, tr, te = stack_rows(spark)
    raw = raw.withColumn("is_valid", F.col(KEY) % 5 == 0)
    plans = []
    fit = L.boosting.fit

    def spied(df, *a, valid=None, **kw):
        plans.extend(str(x._jdf.queryExecution().optimizedPlan()) for x in (df, valid) if x is not None)
        return fit(df, *a, valid=valid, **kw)
    monkeypatch.setattr(L.boosting, "fit", spied)
    stack = ST.stack_oof(tr, te, KEY, LEARNERS, k=3)
    preds, best = ST.stack_meta(raw.drop("fold"), test.drop("fold", LABEL), KEY, LABEL, ["a", "b"], stack, list(LEARNERS),
                                {"nrounds": 4, "max_depth": 2}, "is_valid")
    assert len(plans) == 3 and not any("Join" in p or "Aggregate" in p for p in plans)
    assert 1 <= best <= 4 and preds.count() == test.count()
    assert not [x for x in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if x.startswith("stack-rows")]


def test_predictions_are_probabilities(spark):
    tr, te, _ = _train_test(spark, SMALL)
    m = L.fit_boosted(tr, LABEL, {"eta": 0.3, "nrounds": 3, "max_depth": 2})
    p = L.predict(m, te, KEY)
    lo, hi = p.agg(F.min("target"), F.max("target")).first()
    assert 0.0 <= lo <= hi <= 1.0
    assert p.count() == te.count()


def test_blend_weights_gap_and_not_worse(spark):
    ms = model_scores(spark, SMALL).select("model", KEY, "target", "y")
    models = ["m1", "m2", "m3", "m4", "m5"]
    fit = G.fit_blend_weights(ms, None, KEY, "y", models)
    w = fit.weights
    assert all(v >= 0 for v in w.values()) and abs(sum(w.values()) - 1) < 1e-9 and 0 <= fit.gap <= 1e-6
    from widetab.operators.metrics import logloss
    wide = G.pivot_models(ms, KEY, models).join(ms.filter("model = 'm1'").select(KEY, "y"), KEY)
    blended = wide.withColumn("b", sum(F.col(m) * w[m] for m in models))
    loss = logloss(blended, "b", "y").first()["logloss"]
    assert abs(loss - fit.loss) < 1e-9
    # Not above the best point of the whole grid, and within the gap of it.
    grid = G.blend_grid_losses(ms, None, KEY, "y", models, step=0.1).agg(F.min("logloss")).first()[0]
    assert loss <= grid + 1e-9


def test_blend_weights_on_a_vertex_and_refusals(spark):
    import pytest
    rows = [(m, i, (0.9 if y else 0.1) if m == "good" else 0.5 + 0.01 * (i % 7), y)
            for i in range(60) for y in [i % 2] for m in ("good", "bad")]
    preds = spark.createDataFrame(rows, "model string, ID bigint, target double, y int")
    fit = G.fit_blend_weights(preds, None, "ID", "y", ["bad", "good"])
    assert fit.weights["good"] == 1.0 and fit.gap <= 1e-6 and fit.steps == 1
    with pytest.raises(ValueError):
        G.fit_blend_weights(preds.limit(0), None, "ID", "y", ["bad", "good"])


def test_simplex_minimum_against_a_fine_grid():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(20):
        a = rng.normal(size=(3, 3))
        h, g, w = a @ a.T, rng.normal(size=3), np.array([0.2, 0.3, 0.5])
        value = lambda x: g @ (x - w) + (x - w) @ h @ (x - w) / 2
        got = G._simplex_minimum(w, g, h)
        best = min(value(np.array([i, j, 100 - i - j]) / 100) for i in range(101) for j in range(101 - i))
        assert abs(got.sum() - 1) < 1e-9 and (got >= 0).all() and value(got) <= best + 1e-9


def test_isotonic_weights_and_test_rows(spark):
    import bisect
    rows = [(i, round((i * 37 % 100) / 25) / 4, int((i * 37 % 100) + (i * 13 % 40) > 70), i % 3) for i in range(300)]
    scores = spark.createDataFrame(rows, "ID bigint, s double, y int, fold int")
    test = spark.createDataFrame([(1000 + i, i / 10) for i in range(11)] + [(2000, None)], "ID bigint, s double")

    def pool(some):
        """Pool adjacent violators over single rows; a function of the score."""
        blocks = []
        for s, y in sorted(some):
            if blocks and blocks[-1][2] == s:
                blocks[-1][0] += y
                blocks[-1][1] += 1
            else:
                blocks.append([y, 1, s, s])
        out = []
        for y, n, a, b in blocks:
            out.append([y, n, a, b])
            while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
                y2, n2, _, b2 = out.pop()
                out[-1] = [out[-1][0] + y2, out[-1][1] + n2, out[-1][2], b2]
        xs = [v for y, n, a, b in out for v in ((a,) if a == b else (a, b))]
        ys = [y / n for y, n, a, b in out for _ in ((a,) if a == b else (a, b))]

        def at(x):
            if x <= xs[0] or x >= xs[-1]:
                return ys[0] if x <= xs[0] else ys[-1]
            i = bisect.bisect_left(xs, x)
            return ys[i] if xs[i] == x else ys[i - 1] + (ys[i] - ys[i - 1]) * (x - xs[i - 1]) / (xs[i] - xs[i - 1])
        return at
    fits = [pool([(s, y) for _, s, y, f in rows if f != i]) for i in range(3)]
    got = {(r["set"], r["ID"]): r["s"] for r in L.isotonic_calibrate(scores, "ID", "y", "fold", "s", test=test).collect()}
    assert len(got) == 312 and got["test", 2000] is None
    assert all(abs(got["train", i] - fits[f](s)) < 1e-9 for i, s, _, f in rows)
    assert all(abs(got["test", 1000 + i] - sum(fit(i / 10) for fit in fits) / 3) < 1e-9 for i in range(11))


def _learnable(spark, n=600):
    """A label made from two features, with some noise."""
    rows = [(i, float((i * 37) % 101), float((i * 53) % 97), float((i * 71) % 89)) for i in range(n)]
    df = spark.createDataFrame(rows, "ID bigint, a double, b double, c double")
    return df.withColumn("y", F.when(F.col("a") + F.col("b") / 2 + F.col("ID") % 7 > 75, 1).otherwise(0))


def test_learners_learn(spark):
    from widetab.operators import metrics as M
    data = L.assemble(_learnable(spark), ["a", "b", "c"], keep=["ID", "y"])
    train, test = data.filter("ID % 3 > 0"), data.filter("ID % 3 = 0")
    for model, out in ((L.fit_logistic(train, "y"), "prob"), (L.fit_boosted(train, "y", {"nrounds": 5, "max_depth": 3}), "prob"),
                       (L.fit_forest(train, "y", 10, 4), "value"), (L.fit_linear(train, "y"), "value")):
        scored = L.predict(model, test, "ID", out).join(test.select("ID", "y"), "ID")
        assert M.auc(scored, "target", "y").first()["auc"] > 0.9, type(model)


def test_weighted_means_refuse_gaps(spark):
    import pytest
    preds = spark.createDataFrame([("m1", 1, 1.0), ("m2", 1, None)], "model string, ID bigint, target double")
    with pytest.raises(ValueError):
        G.weighted_average(preds, {"m1": 1.0, "m2": 1.0}, "ID")
    with pytest.raises(ValueError):
        G.weighted_average(preds.filter("target is not null"), {"m2": 1.0}, "ID")
    with pytest.raises(ValueError):
        G.blend(preds, {"f": {"m1": 1.0, "m2": 1.0}}, {"f": 1.0}, "ID")


def test_blend_weights_with_scores_of_nought(spark):
    """Scores that are 0 for some positive rows (and 1 for negative ones): the
    optimum lies inside, and no other weights are better than the gap allows."""
    import numpy as np
    from widetab.operators import ensemble as G
    rng = np.random.default_rng(7)
    n = 4000
    y = rng.integers(0, 2, n)
    p = np.column_stack([rng.integers(0, 1001, n) / 1000.0 for _ in range(3)])
    p[:, 0] = np.clip(0.6 * y + 0.4 * p[:, 0], 0, 1)
    p[rng.permutation(n)[:20], 0] = 0.0
    rows = [(i, m, float(p[i, j]), int(y[i])) for i in range(n) for j, m in enumerate("abc")]
    rows += [(n, m, 0.0, 1) for m in "abc"]                  # the same loss under all weights
    fit = G.fit_blend_weights(spark.createDataFrame(rows, "ID bigint, model string, target double, y int"), None, "ID", "y", list("abc"))
    p, y = np.vstack([p, np.zeros(3)]), np.append(y, 1)

    def loss(w):
        b = np.clip(p @ w, 1e-14, 1 - 1e-14)
        return -np.log(np.where(y == 1, b, 1 - b)).mean()
    w = np.array([fit.weights[m] for m in "abc"])
    assert abs(fit.loss - loss(w)) < 1e-9 and fit.gap <= 1e-6 and abs(w.sum() - 1) < 1e-12 and (w >= 0).all()
    others = [*np.eye(3), *rng.dirichlet(np.ones(3), 300), *(w + 0.01 * (rng.dirichlet(np.ones(3), 100) - w))]
    assert fit.loss <= min(map(loss, others)) + 1e-6


def test_pivot_spreads_its_groups(spark):
    """One shuffle by key into many partitions; missing models and scores stay missing."""
    from widetab.session import shuffle_partitions
    t = spark.createDataFrame([(1, "a", 0.1), (1, "b", None), (2, "b", 0.4), (None, "a", 0.7)], "ID bigint, model string, target double")
    got = G.pivot_models(t, "ID", ["a", "b"])
    assert {tuple(r) for r in got.collect()} == {(1, 0.1, None), (2, None, 0.4), (None, 0.7, None)}
    assert got._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1
    assert got.rdd.getNumPartitions() == 8 * shuffle_partitions(spark)
