import random
from collections import defaultdict

import pytest

from widetab.llm import neardup as N

from conftest import rows_equal
from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


def brute(rows, width, percent):
    """doc_id → (set size, smallest id of its component), all pairs by shared shingles."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    up, index = list(range(len(rows))), defaultdict(list)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for g in s:
            for j in index[g]:
                both[j] += 1
            index[g].append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return {k: (len(sets[i]), low[find(i)]) for i, (k, _) in enumerate(rows)}


def group_rows():
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(120):                                     # near copies of one text, 1 to 5 words off
        x = list(base)
        for _ in range(rng.randint(1, 5)):
            x[rng.randrange(150)] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i + 10, " ".join(x)))
    rows += [(500 + i, " ".join(f"z{rng.randrange(400)}" for _ in range(50))) for i in range(60)]
    rows += [(700 + i, "shared opening passage of several words that many documents have " + " ".join(f"q{rng.randrange(10**5)}" for _ in range(30)))
             for i in range(80)]
    return rows + [(900 + i, rows[3][1]) for i in range(20)] + [(950, None), (951, ""), (952, "a b"), (953, "A  B"), (954, "a")]


@pytest.mark.parametrize("limits", [{}, {"class_limit": 16, "node_limit": 6, "depth": 3}])
def test_components_equal_brute_force(spark, limits):
    rows = group_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(docs, width=3, percent=85, **limits).collect()}
    assert got == brute(rows, 3, 85)


def chain_rows():
    """Two chains of edits (neighbours alike, the next but one not), a third
    with a dense group at each end."""
    rng, rows = random.Random(11), []
    for c, n in enumerate((40, 30, 12)):
        words = [f"c{c}w{i}" for i in range(200)]
        for i in range(n):
            for k in range(40 if c == 2 and i in (0, n - 1) else 1):
                x = list(words)
                if k:
                    x[rng.randrange(200)] = f"e{rng.randrange(10 ** 6)}"
                rows.append((len(rows), " ".join(x)))
            words = words[9:] + [f"c{c}i{i}n{j}" for j in range(9)]
    return rows


def test_large_classes_of_bridged_groups(spark):
    rows = chain_rows()
    want = brute(rows, 3, 85)
    assert len({low for _, low in want.values()}) == 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(docs, width=3, percent=85, class_limit=8).collect()}
    assert got == want


def test_sample_documents(spark, sample_docs):
    rows = [(r.doc_id, r.text) for r in sample_docs.collect()]
    got = N.components(sample_docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 5, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sql(spark, duck, sample_docs):
    got = N.components(sample_docs, width=3, percent=85).drop("th")
    res = duck.execute(N.COMPONENTS_SQL)
    rows_equal(got.collect(), got.columns, res.fetchall(), [d[0] for d in res.description])


def test_odd_rows(spark, odd_docs):
    got = N.components(odd_docs, width=3, percent=85).collect()
    assert len(got) == odd_docs.count()
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert {r.component_id for r in got if r.doc_id in (3, 4)} == {3}
    assert by[(1, 0)].component_id == 1 and by[(7, 0)].component_id == 7 and by[(None, 1)].component_id is None
    assert N.components(odd_docs.limit(0)).count() == 0
    left = N.drop_near_copies(odd_docs)
    assert left.schema == odd_docs.schema and sorted([r.doc_id or 0 for r in left.collect()]) == [0, 1, 2, 3, 5, 6, 7]
    assert N.drop_near_copies(odd_docs.limit(0)).count() == 0


def test_dense_class_without_a_centre(spark, monkeypatch):
    """Many sets near the threshold of each other, most of them not alike: few
    links leave the tasks, and what the prefix index leaves out is not alike."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        x = list(base)
        for j in rng.sample(range(120), rng.randint(2, 6)):
            x[j] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(x)))
    sent = []
    confirm = N.confirm_in_blocks
    monkeypatch.setattr(N, "confirm_in_blocks", lambda asked, there, percent: sent.append(
        (asked.count(), confirm(asked, there, percent).count())) or confirm(asked, there, percent))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for limit in (16, 64):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(docs, width=3, percent=85, class_limit=limit).collect()}
        assert got == brute(rows, 3, 85)
    assert sent and all(asked <= 400 * 400 / 16 and links <= asked for asked, links in sent)


def test_any_column_names(spark, odd_docs):
    names = ["fk", "th", "rk", "rth", "row", "rowkey", "gk", "gth", "kept", "k", "t", "component_id", "a.b"]
    docs = odd_docs.selectExpr("doc_id", "text", "source")
    for i, n in enumerate(names):
        docs = docs.withColumn(n, docs.doc_id + i if i % 2 else docs.text)
    left = N.drop_near_copies(docs)
    assert left.columns == docs.columns and sorted([r.doc_id or 0 for r in left.collect()]) == [0, 1, 2, 3, 5, 6, 7]


def test_components_of_edges_over_several_tasks(spark, monkeypatch):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 300) if i % 50] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    want = {i: find(i) for a, b in edges for i in (a, b) if a != b}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    for most in (10, 100, 10 ** 6):
        monkeypatch.setattr(N, "EDGES_PER_TASK", most)
        assert {r.id: r.low for r in N.connected(df).collect() if r.id in want} == want
    assert N.connected(df.limit(0)).count() == 0
