import re

from widetab.llm import quality as Q

from conftest import rows_equal
from shared_fixtures import ready, sample_docs  # noqa: F401


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    hit = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


ODD = [(1, None, "a"), (None, "", None), (2, "x x x x x x", "a"), (2, "a b c a b c d a b c\n\n \n q\n q\nq|<", "a"),
       (3, "é ü # " * 30, "b"), (4, "one two three " * 9000, "b"), (4, "one two three " * 9000, "b"), (5, "a b c", "b")]


def test_measures_equal_a_loop(spark, sample_docs):
    rows = ODD + [(r.doc_id + 100, r.text, r.source) for r in sample_docs.collect()]
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id bigint, text string, source string, n_words string, m boolean")
    got = Q.judge(docs).collect()
    key = lambda k: -1 if k is None else k
    want = sorted((key(k), *measures(t)) for k, t, _ in rows)
    assert sorted((key(r.doc_id), *[r[c] for c in Q.MEASURES]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert Q.judge(docs.limit(0)).count() == 0


def test_sql(spark, duck, sample_docs):
    got = Q.judge(sample_docs)
    res = duck.execute(Q.JUDGE_SQL)
    rows_equal(got.collect(), got.columns, res.fetchall(), [d[0] for d in res.description])


def test_bad_hosts_go_and_small_ones_shrink(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(300)] + [(1000, good, "bad")]
    rows += [(2000 + i, good, f"h{i % 20}") for i in range(400)] + [(5000, "short", "new"), (5001, good, "new")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id for r in Q.judge(docs).filter("kept").collect()}
    assert 1000 not in kept and 5001 in kept and len(kept) == 401
    left = Q.keep_good(docs)
    assert left.schema == docs.schema and {r.doc_id for r in left.collect()} == kept


def test_no_python_in_the_plan(spark, sample_docs):
    for df in (Q.judge(sample_docs), Q.keep_good(sample_docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
