"""Correlation screens: rank strategies agree; pruning drops one of a
near-duplicate pair."""

import numpy as np
from pyspark.sql import functions as F

from widetab.operators import screen as S

from conftest import SMALL


def test_rank_strategies_agree(spark):
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    cols = ["l_quantity", "l_discount", "l_extendedprice"]
    a = S.correlation_matrix(S.average_ranks(li, cols, strategy="broadcast"), cols)
    b = S.correlation_matrix(S.average_ranks(li, cols, strategy="long"), cols)
    assert np.allclose(a, b, atol=1e-12)


def test_prune_drops_duplicate(spark):
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        "l_quantity", "l_discount", (F.col("l_quantity") * 2 + 1).alias("q2"))
    cols = li.columns
    m = S.correlation_matrix(li, cols)
    dropped = S.prune_correlated(m, cols, 0.95)
    assert len(dropped) == 1 and dropped[0] in ("l_quantity", "q2")
    assert S.columns_in_both(["a", "b"], ["b", "c"]) == ["b"]


def test_pruning_against_means_taken_anew():
    """The sweep equals the rule written out for one cutoff at a time."""
    import numpy as np

    def plain(a, cutoff):
        p = len(a)
        pairs = sorted(((-a[i][j], i, j) for i in range(p) for j in range(i + 1, p) if a[i][j] > cutoff))
        left, out = set(range(p)), []
        for _, i, j in pairs:
            if i in left and j in left:
                mean = [round(sum(a[x][k] for k in left if k != x), 9) for x in (i, j)]
                out.append(i if mean[0] > mean[1] else j)
                left.discard(out[-1])
        return out
    rng = np.random.default_rng(2)
    for p in (1, 2, 5, 12, 30):
        for _ in range(8):
            x = rng.normal(size=(40, p)) + rng.normal(size=(40, 1)) * rng.uniform(0, 3, p)
            m = np.round(np.corrcoef(x, rowvar=False).reshape(p, p), 2)
            if p > 2:
                m[0, 1] = m[1, 0] = np.nan
            a = np.abs(np.nan_to_num(m)).tolist()
            cols = [f"c{i}" for i in range(p)]
            curve = dict(S.prune_curve(m, cols))
            for k in range(0, 101, 5):
                want = plain(a, k / 100)
                assert S.prune_correlated(m, cols, k / 100) == [cols[i] for i in want] and curve[k / 100] == len(want)


def test_rank_joins_are_bounded(spark):
    """Broadcast columns are bounded together; missing and NaN cells stay missing
    whichever way the ranks come back."""
    rows = [(None if i % 5 == 0 else float(i * 7 % 40), float("nan") if i % 6 == 0 else float(i % 3)) for i in range(200)]
    t = spark.createDataFrame(rows, "a double, b double")
    got = [S.average_ranks(t, ["a", "b"], **k) for k in ({"strategy": "broadcast"}, {"broadcast_rows": 3}, {"strategy": "long"})]
    key = lambda r: tuple((v is not None, v or 0.0) for v in r)
    tables = [sorted(map(tuple, g.collect()), key=key) for g in got]
    assert tables[0] == tables[1] == tables[2] and sum(r[0] is None for r in tables[0]) == 40 and sum(r[1] is None for r in tables[0]) == 34
    plans = [g._jdf.queryExecution().optimizedPlan().toString() for g in got]
    assert [p.count("strategy=broadcast") for p in plans] == [2, 1, 0]


def test_correlation_of_tasks_that_differ(spark):
    """Tasks far apart in value, one of them without a value of a column, and a
    constant column: as numpy has it, after one pass over the rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) + 1e4 * (np.arange(400) // 100)[:, None]
    x[:, 2] = rng.normal(size=400) - x[:, 0]
    x[:, 3] = 7.3
    x[:100, 1] = np.nan
    cols = list("abcd")
    t = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], "a double, b double, c double, d double") \
        .repartitionByRange(4, "a")
    m = S.correlation_matrix(t, cols)
    on = ~np.isnan(x[:, 1])
    assert abs(m[0, 2] - np.corrcoef(x[:, 0], x[:, 2])[0, 1]) < 1e-12 and abs(m[0, 1] - np.corrcoef(x[on, 0], x[on, 1])[0, 1]) < 1e-12
    assert np.isnan(m[3, :3]).all() and np.isnan(m[:3, 3]).all()
