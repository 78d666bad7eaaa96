import re

import numpy as np

from widetab.llm import mixing as M

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


def test_sainte_lague_equals_seat_by_seat():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        w, caps, seats = rng.integers(1, 30, n).astype(float), rng.integers(0, 40, n), int(rng.integers(0, 150))
        given = np.zeros(n, dtype=int)
        for _ in range(min(seats, int(caps.sum()))):
            q = np.where(given < caps, w / (2 * given + 1), -1.0)
            given[int(q.argmax())] += 1
        got = M.sainte_lague(w, caps, seats)
        assert got.sum() == given.sum()
        # ties may fall to another entry of the same quotient
        assert sorted(w / (2 * got + 1)) == sorted(w / (2 * given + 1)) or (got == given).all()


def plain_targets(sizes, weights, most=3):
    total, out, capped = sum(sizes), {}, set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        share = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        out = [most * s if i in capped else rest * weights[i] / share for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in capped and out[i] > most * sizes[i]}
        if not over:
            return out
        capped |= over


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(0, 200)), s) for i, s in enumerate(rng.choice(["b", "a", "tiny", None, "é"], 600, p=[.5, .2, .02, .08, .2]))]
    docs = spark.createDataFrame([(int(i), t, None if s is None else str(s)) for i, t, s in rows], "doc_id bigint, text string, source string")
    got = M.mix(docs.repartition(3), shard_words=5000).collect()
    again = M.mix(docs.repartition(7), shard_words=5000).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    names = ["a", "b", "tiny", "é", None]
    sizes = [sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t, s in rows if (None if s is None else str(s)) == n) for n in names]
    want = plain_targets(sizes, [5, 2, 1, 5, 2])
    for n, size, target in zip(names, sizes, want):
        mine = [r for r in got if r.source == n]
        assert sum(r["size"] for r in mine) == size == mine[0].source_size
        assert abs(mine[0].target - target) < 1e-6
        assert abs(sum(r.taken for r in mine) - target) <= 0.01 * target + 16
        assert all(0 <= r.taken <= 3 * r["size"] for r in mine)


def test_odd_rows(spark, odd_docs):
    got = M.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert M.mix(odd_docs.limit(0)).count() == 0
    empty = M.mix(odd_docs.filter("coalesce(text, '') = ''")).collect()
    assert all((r.target, r.taken) == (0.0, 0) for r in empty)
    mixed = M.apply_mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.schema == odd_docs.schema
    assert M.apply_mix(odd_docs.limit(0)).count() == 0


def test_copies_follow_taken_words(spark, sample_docs):
    taken = {r.doc_id: (r["size"], r.taken) for r in M.mix(sample_docs).collect()}
    copies = {r.doc_id: r["count"] for r in M.apply_mix(sample_docs).groupBy("doc_id").count().collect()}
    for k, (size, t) in taken.items():
        assert not size or abs(copies.get(k, 0) - t / size) < 1
