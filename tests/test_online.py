"""Online learners: a batch of one row is the sequential rule."""

import math

import pytest
from pyspark.sql import functions as F

from widetab.operators import online as O


def _sigmoid(x):
    return 1.0 / (1.0 + math.exp(-x))


def _seq_ftrl(rows, alpha, beta, l1, l2):
    """FTRL-proximal from its closed form. The weight of a coordinate solves
    min_w  g·w + l1·|w| + (l2 + (beta + sqrt(n)) / alpha)·w²/2 − Σ sigma·w_t·w,
    so it is the soft threshold of −z over that curvature, and z is rebuilt
    from the whole history of (gradient, weight) of the coordinate."""
    seen = {}                                     # coordinate → [(gradient, weight at that time)]

    def sums(c):
        z = n = 0.0
        for g, w in seen.get(c, ()):
            rate = (math.sqrt(n + g * g) - math.sqrt(n)) / alpha
            z, n = z + g - rate * w, n + g * g
        return z, n

    def weight(c):
        z, n = sums(c)
        return math.copysign(max(abs(z) - l1, 0.0), -z) / ((beta + math.sqrt(n)) / alpha + l2)
    for idx, y in rows:
        at = {c: weight(c) for c in [0, *idx]}
        err = _sigmoid(sum(at.values())) - y
        for c, w in at.items():
            seen.setdefault(c, []).append((err, w))
    got = {c: sums(c) for c in seen}
    return {c: z for c, (z, _) in got.items()}, {c: n for c, (_, n) in got.items()}


def _seq_adagrad(rows, alpha, beta, l2):
    """Gradient steps with rate alpha / (beta + root of the summed squares)."""
    import numpy as np
    size = 1 + max(max(idx) for idx, _ in rows)
    w, squares = np.zeros(size), np.zeros(size)
    for idx, y in rows:
        x = np.zeros(size)
        x[[0, *idx]] = 1.0
        err = _sigmoid(float(w @ x)) - y
        squares += (err * x) ** 2
        w -= x * alpha / (beta + np.sqrt(squares)) * (err + l2 * w)
    used = sorted({0, *[i for idx, _ in rows for i in idx]})
    return {i: w[i] for i in used}, {i: squares[i] for i in used}


ROWS = [([1 + (r * 7) % 5, 10 + (r * 3) % 4], (r * 5 + 1) % 3 % 2) for r in range(50)]


def _run(spark, params):
    df = spark.createDataFrame([(i, idx, y) for i, (idx, y) in enumerate(ROWS)], "k bigint, idx array<bigint>, y int")
    state = O.empty_state(spark)
    for i in range(len(ROWS)):
        state, _ = O.step(state, df.filter(F.col("k") == i), "k", "y", "idx", params)
        state = spark.createDataFrame(state.collect(), O.STATE_SCHEMA)  # cut the lineage in the test
    return {r["idx"]: (r["a"], r["b"]) for r in state.collect()}


def test_ftrl_batch_of_one_is_sequential(spark):
    p = O.OnlineParams("ftrl", alpha=0.1, beta=1.0, l1=0.01, l2=0.1)
    got = _run(spark, p)
    z, n = _seq_ftrl(ROWS, p.alpha, p.beta, p.l1, p.l2)
    assert set(got) == set(z)
    for i in z:
        assert abs(got[i][0] - z[i]) < 1e-9 and abs(got[i][1] - n[i]) < 1e-9


def test_adagrad_batch_of_one_is_sequential(spark):
    p = O.OnlineParams("adagrad", alpha=0.1, beta=1.0, l2=0.05)
    got = _run(spark, p)
    w, G = _seq_adagrad(ROWS, p.alpha, p.beta, p.l2)
    for i in w:
        assert abs(got[i][0] - w[i]) < 1e-9 and abs(got[i][1] - G[i]) < 1e-9


def test_hash_pairs_count(spark):
    df = spark.createDataFrame([(1, [5, 3, 9, 3])], "k int, idx array<bigint>")
    out = O.hash_pairs(df, "idx", 1000).first()["pair_idx"]
    assert len(out) == 6 and all(0 <= v < 1000 for v in out)


def _hashed(spark, n):
    rows = [(i, [(i * 7) % 11 + 1, (i * 5) % 13 + 20, (i * 3) % 17 + 40], int(i * 7 % 11 > 5), i % n) for i in range(60)]
    return spark.createDataFrame(rows, "ID bigint, idx array<bigint>, y int, batch int")


def test_fit_goes_on_after_the_last_state(spark, tmp_path, monkeypatch):
    e = _hashed(spark, 3)
    whole, log = O.fit(e, "ID", "y", str(tmp_path / "a"), epochs=2)
    # A fit that stops in its fourth step, then is started again.
    steps, step = [], O.step

    def broken(*args, **kw):
        if len(steps) == 3:
            raise OSError("lost")
        steps.append(1)
        return step(*args, **kw)
    monkeypatch.setattr(O, "step", broken)
    with pytest.raises(OSError):
        O.fit(e, "ID", "y", str(tmp_path / "b"), epochs=2)
    counted = []
    monkeypatch.setattr(O, "step", lambda *a, **k: (counted.append(1), step(*a, **k))[1])
    again, log2 = O.fit(e, "ID", "y", str(tmp_path / "b"), epochs=2)
    assert len(counted) == 3 and log2.count() == log.count() == 120
    pairs = lambda df: sorted((r["idx"], r["a"], r["b"]) for r in df.collect())
    assert pairs(again) == pairs(whole)
    O.fit(e, "ID", "y", str(tmp_path / "b"), epochs=2)
    assert len(counted) == 3 and spark.read.parquet(str(tmp_path / "b/log")).count() == 120
    with pytest.raises(ValueError):
        O.fit(e, "ID", "y", str(tmp_path / "b"), params=O.OnlineParams(alpha=0.5), epochs=2)


def test_sweep_equals_single_fits(spark, tmp_path):
    e = _hashed(spark, 2)
    settings = {"f": O.OnlineParams(alpha=0.1, l1=0.1, l2=0.5), "g": O.OnlineParams(algo="adagrad", alpha=0.2),
                "h": O.OnlineParams(algo="adagrad", alpha=0.05, l2=0.1)}
    state = O.fit_sweep(e, "ID", "y", str(tmp_path / "s"), list(settings.values()), epochs=2)
    scores = {(r["model"], r["ID"]): r["p"] for r in O.score_sweep(state, e, "ID", settings).collect()}
    for i, (name, p) in enumerate(settings.items()):
        one, _ = O.fit(e, "ID", "y", str(tmp_path / name), params=p, epochs=2)
        want = {r["idx"]: (r["a"], r["b"]) for r in one.collect()}
        got = {r["idx"]: (r[f"a{i}"], r[f"b{i}"]) for r in state.collect()}
        assert set(got) == set(want) and all(abs(x - y) < 1e-12 for k in want for x, y in zip(got[k], want[k]))
        for r in O.score(one, e, "ID", params=p).collect():
            assert abs(scores[name, r["ID"]] - r["p"]) < 1e-12


def test_rows_are_prepared_once(spark, tmp_path):
    """The batches of a fit share one preparation of the rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for b in it:
            seen.add(b.num_rows)
            yield b
    e = spark.range(40).selectExpr("id AS k", "cast(id % 2 AS int) AS y", "array(id % 5) AS idx", "cast(id % 4 AS int) AS batch", "id % 10 = 0 AS v")
    _, log = O.fit(e.mapInArrow(count, e.schema), "k", "y", str(tmp_path / "fit"), n_batches=4, valid_flag="v")
    assert log.count() == 40 and seen.value == 40
