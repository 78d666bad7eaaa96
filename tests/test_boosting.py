"""Staged boosting against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from widetab.operators import boosting as B
from widetab.operators import learners as L
from widetab.operators import metrics as M
from widetab.operators._util import few_tasks

COLS = ["a", "b", "c"]


def rows_of(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randint(0, 12), None if rng.random() < .15 else round(rng.uniform(0, 5), 1), rng.choice([1.0, 1.0, 2.0])
        y = int(a + (b if b is not None else 3) * 1.5 + rng.gauss(0, 3) > 10)
        out.append((i, float(a), b, c, y, 0.1 * a - 0.5))
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "ID bigint, a double, b double, c double, y int, m double")
    return L.assemble(df, COLS, keep=["ID", "y", "m"], sentinel=None)


def brute_margins(rows, edges, q, start, rounds):
    """Every cut of every node tried on the raw rows."""
    x = [[math.nan if v is None else v for v in r[1:4]] for r in rows]
    y, m = [r[4] for r in rows], list(start)

    def sums(ids, g, h):
        return sum(g[i] for i in ids), sum(h[i] for i in ids)

    def grow(ids, depth, g, h, add):
        gs, hs = sums(ids, g, h)
        best = None
        if depth < q.max_depth:
            for f in range(len(COLS)):
                for missing_left in (False, True):
                    for cut in edges[f]:
                        left = [i for i in ids if (missing_left if math.isnan(x[i][f]) else x[i][f] <= cut)]
                        right = [i for i in ids if i not in set(left)]
                        gl, hl = sums(left, g, h)
                        gr, hr = gs - gl, hs - hl
                        if len(left) < q.min_rows or len(right) < q.min_rows or hl < q.min_child_weight or hr < q.min_child_weight \
                                or not left or not right:
                            continue
                        gain = gl * gl / (hl + q.lam) + gr * gr / (hr + q.lam) - gs * gs / (hs + q.lam)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, left, right)
        if best is None or best[0] <= max(q.gamma, 1e-9):
            for i in ids:
                add[i] = -gs / (hs + q.lam)
            return
        grow(best[1], depth + 1, g, h, add)
        grow(best[2], depth + 1, g, h, add)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-v)) for v in m]
        add = [0.0] * len(rows)
        grow(list(range(len(rows))), 0, [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p], add)
        m = [v + q.eta * w for v, w in zip(m, add)]
    return m


@pytest.mark.parametrize("start", [None, "m"])
def test_margins_equal_plain_loops(spark, start):
    rows = rows_of(160)
    t = table(spark, rows).repartition(3)
    q = B.BoostParams(eta=0.4, nrounds=3, max_depth=2, min_rows=3, max_bins=16)
    model = B.fit(t, "y", q, stage=2, base_margin=start)
    got = {r["ID"]: r["margin"] for r in model.margins(t, ["ID"], base_margin=start).collect()}
    want = brute_margins(rows, model.edges, q, [r[5] if start else 0.0 for r in rows], 3)
    assert max(abs(got[r[0]] - w) for r, w in zip(rows, want)) < 1e-5


def same_trees(a, b):
    return all((x.feature == y.feature).all() and (x.cut == y.cut).all() and (x.value == y.value).all() for x, y in zip(a.trees, b.trees))


def test_partitions_and_stages_do_not_matter(spark):
    t = table(spark, rows_of(300, 2))
    q = {"eta": 0.3, "nrounds": 4, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.7, "alpha": 0.1, "gamma": 0.05}
    models = [B.fit(t.repartition(n), "y", q, stage=s, key="ID") for n, s in ((1, 1), (5, 3), (2, 10))]
    assert same_trees(models[0], models[1]) and same_trees(models[0], models[2])


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_stop_by_auc(spark):
    t = table(spark, rows_of(500, 3))
    train, valid = t.filter("ID % 3 > 0"), t.filter("ID % 3 = 0")
    q = {"eta": 0.9, "nrounds": 40, "max_depth": 4, "min_child_weight": 0.0, "lam": 0.1}
    model = B.fit(train, "y", q, valid=valid, patience=4, stage=4, key="ID")
    assert len(model.trees) < 40 and len(model.trees) - model.best >= 4 and len(model.curve) == len(model.trees)
    exact = {}
    for i in range(1, len(model.trees) + 1):
        exact[i] = brute_auc([(r["m"], r["y"]) for r in model.margins(valid, ["y"], "m", rounds=i).collect()])
    for i, loss, a, e, sure in model.curve:
        assert abs(a - exact[i]) <= e + 1e-12 and (not sure or abs(a - exact[i]) < 1e-12) and loss > 0
    assert model.best == min(i for i, a in exact.items() if a == max(exact.values()))
    scored = L.predict(model, valid, "ID", keep=["y"])
    assert abs(M.auc(scored, "target", "y").first()["auc"] - exact[model.best]) < 1e-12


def test_error_bound_of_binned_auc():
    rng = np.random.default_rng(4)
    for _ in range(50):
        m, y = rng.integers(0, 9, 40) / 9.0, rng.integers(0, 2, 40)
        bins = {}
        for v, one in zip(m, y):
            k = int(v * 3)
            r = bins.setdefault(k, {"bin": k, "pos": 0.0, "neg": 0.0, "low": v, "high": v})
            r["pos"], r["neg"] = r["pos"] + one, r["neg"] + 1 - one
            r["low"], r["high"] = min(r["low"], v), max(r["high"], v)
        got, error = B.binned_auc(list(bins.values()))
        if got is not None:
            assert abs(got - brute_auc(list(zip(m, y)))) <= error + 1e-12


def test_from_a_margin(spark):
    t = table(spark, rows_of(300, 5)).withColumn("zero", F.lit(0.0))
    q = {"eta": 0.3, "nrounds": 5, "max_depth": 2}
    assert same_trees(B.fit(t, "y", q, key="ID"), L.boost_from_margin(t, "y", "zero", q, key="ID"))
    more = L.boost_from_margin(t, "y", "m", q, key="ID")
    losses = []
    for i in range(6):
        rows = more.margins(t, ["y"], "v", rounds=i, base_margin="m").collect()
        losses.append(sum(math.log1p(math.exp(-r["v"] if r["y"] else r["v"])) for r in rows) / len(rows))
    assert all(a > b for a, b in zip(losses, losses[1:]))


def test_regression_and_importance(spark):
    t = table(spark, rows_of(200, 6)).withColumn("z", F.col("ID") * 0 + F.col("m") * 10)
    model = B.fit(t, "z", {"eta": 0.5, "nrounds": 12, "max_depth": 3, "objective": "squared"}, key="ID")
    err = model.predict(t, "ID", "value", keep=["z"]).agg(F.max(F.abs(F.col("target") - F.col("z")))).first()[0]
    assert err < 0.2 and L.top_features(model, COLS, 1)[0][0] == "a"


def test_odd_tables(spark):
    rows = [(1, 1.0, None, 1.0, 1, 0.0), (2, 1.0, None, 1.0, None, 0.0), (3, 1.0, None, 1.0, 1, 0.0)]
    t = table(spark, rows)
    model = B.fit(t, "y", {"nrounds": 2, "max_depth": 2}, valid=t, patience=1)          # one class, no cut, a row without a label
    assert all((x.feature < 0).all() for x in model.trees) and model.predict(t, "ID").count() == 3
    with pytest.raises(ValueError):
        B.fit(t.limit(0), "y", {"nrounds": 1})
    with pytest.raises(TypeError):
        B.fit(t, "y", {"rounds": 1})


def test_masks_find_the_leaves_of_a_walk(monkeypatch):
    rng = np.random.default_rng(9)
    for depth in (0, 1, 3, 6):
        for _ in range(20):
            t = B.Tree.empty(depth)
            for i in range((1 << depth) - 1):
                if (i == 0 or t.feature[(i - 1) // 2] >= 0) and rng.random() < .8:
                    t.feature[i], t.cut[i], t.missing_left[i] = rng.integers(0, 3), rng.integers(1, 254), rng.random() < .5
            x = rng.choice(np.array([0, 1, 2, 100, 253, 254], np.uint8), (3, 200))
            masked = t._masked(x)
            monkeypatch.setattr(B, "MASKED_NODES", 0)
            assert (masked == t.nodes(x)).all()
            monkeypatch.undo()


def test_repeated_passes_have_few_tasks(spark, monkeypatch):
    """A level and the quantiles take two tasks a core at most, however many partitions the rows have."""
    t = table(spark, rows_of(300, 10))
    cores = spark.sparkContext.defaultParallelism
    asked = []
    monkeypatch.setattr(B, "few_tasks", lambda df: asked.append(few_tasks(df)) or asked[-1])
    many = B.fit(t.repartition(5 * cores), "y", {"nrounds": 2, "max_depth": 2}, key="ID")
    assert asked and all(df.rdd.getNumPartitions() <= 2 * cores for df in asked[:1])
    assert same_trees(many, B.fit(t.coalesce(1), "y", {"nrounds": 2, "max_depth": 2}, key="ID"))


def test_stored_rows_are_packed(spark):
    """A fit's table holds chunks of rows, so a pass does not handle rows one by one."""
    t = table(spark, rows_of(300, 8)).repartition(2)
    edges = B.bin_edges(t, "features", 16)
    stored = B._binned(t, "y", "features", edges, F.lit(0.0), F.lit(1.0), "ID").collect()
    assert len(stored) == 2 and sum(len(r["y"]) for r in stored) == 8 * 300 and sum(len(r["x"]) for r in stored) == 3 * 300
