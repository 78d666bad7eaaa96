"""Stages against plain Python on a small corpus."""

import corpus_pipeline as C
from widetab.llm import secrets as S

from test_neardup import brute
from test_quality import measures
from shared_fixtures import ready  # noqa: F401


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    good = C.quality_rules(spark, docs, sf)
    assert good.schema == docs.schema
    m = {r.doc_id: measures(r.text) for r in rows}
    keep = [r for r in rows if m[r.doc_id][0] >= 50 and 100 * m[r.doc_id][4] <= 50 * m[r.doc_id][0]]
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in keep}      # no host of these is bad
    one = C.near_duplicates(spark, good, sf)
    low = brute([(r.doc_id, r.text) for r in keep], 5, 80)
    left = [r for r in keep if low[r.doc_id][1] == r.doc_id]
    assert one.schema == docs.schema and {r.doc_id for r in one.collect()} == {r.doc_id for r in left}
    clean = C.redact_secrets(spark, one, sf)
    texts = {r.doc_id: r for r in clean.collect()}
    assert clean.schema == docs.schema and len(texts) == len(left)
    for r in left:
        found = S.base_spans(r.text)
        assert ("[SECRET]" in texts[r.doc_id].text) == bool(found) or "[SECRET]" in r.text
        assert texts[r.doc_id].n_chars == len(texts[r.doc_id].text) and not S.base_spans(texts[r.doc_id].text)
    mixed = C.mix_sources(spark, clean, sf)
    assert mixed.columns == docs.columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    packed = C.pack_sequences(spark, mixed, sf).toPandas()
    assert (packed.groupby("sequence_id").length.sum() <= 1024).all()


def test_names_and_run(spark):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "secret_scans", "mix_sources", "best_fit_packing"]
    got = C.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and "sequence_id" in got.columns


NAMES = ["row", "rowkey", "rowhash", "mk", "mn", "fk", "th", "rk", "rth", "k", "t", "gk", "gth", "mcopy", "host", "m", "base", "failed",
         "size", "taken", "piece", "length", "kept", "component_id", "vhost", "s", "c", "a.b"]


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and
    extra columns named as the stages' own."""
    good = lambda i, n=80: " ".join(f"word{i}x{j}" for j in range(n))
    rows = [(1, good(1), "en", "a", 5), (2, None, None, None, None), (None, good(2), "en", None, 7), (3, "", "de", "a", 0),
            (4, good(4), "en", "a", 1), (4, good(4), "en", "a", 1), (5, good(4), "en", "b", 1), (6, good(6, 20_000), "en", "b", None),
            (7, good(7) + " password = hunter2secret", "en", "", 3), (8, " \\t\\n", "en", "b", 3), (9, good(9) + " Zwölf 😀", None, "c", 2),
            (None, None, None, None, None), (10, "same " * 200, "en", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for i, n in enumerate(NAMES):
        docs = docs.withColumn(n, docs.doc_id + i if i % 2 else docs.source)
    return docs


def test_each_stage_on_odd_rows(spark):
    sf, docs = "/none", odd_documents(spark)
    rows = docs.collect()
    got = {}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        got[name] = out.collect()
        empty = stage(spark, docs.limit(0), sf)
        assert empty.columns == docs.columns and empty.count() == 0, name
    m = [measures(r.text) for r in rows]
    keep = [r for r, x in zip(rows, m) if x[0] >= 50 and 100 * x[4] <= 50 * x[0]]
    assert sorted(map(str, got["quality_rules"])) == sorted(map(str, keep))
    near = sorted((r.doc_id or 0, r.text or "") for r in got["near_duplicates"])
    want = sorted({(r.doc_id or 0, r.text or "") for r in rows if r.doc_id != 5})
    assert sorted(set(near)) == want and sum(k == 4 for k, _ in near) == 1
    redacted = {(r.doc_id, r.text) for r in got["secret_scans"]}
    assert len(got["secret_scans"]) == len(rows)
    for r in rows:
        hidden = next(t for k, t in redacted if k == r.doc_id and (t is None) == (r.text is None) and (t or "")[:9] == (r.text or "")[:9])
        assert hidden == r.text if r.doc_id != 7 else "hunter2secret" not in hidden and "[SECRET]" in hidden
    counts = {}
    for r in got["mix_sources"]:
        counts[str(r)] = counts.get(str(r), 0) + 1
    assert set(counts) <= {str(r) for r in rows} and max(counts.values()) <= 6
    assert all(counts[str(r)] >= 1 for r in rows if not (r.text or "").split())
    name, stage = C.STAGES[-1]
    packed = stage(spark, docs, sf)
    pieces = packed.collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in rows}
    used = {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in used.values():
        at = 0
        for o, n in sorted(places):
            assert o == at and n > 0
            at += n
        assert at <= 1024
    assert stage(spark, docs.limit(0), sf).count() == 0


def test_a_stage_drops_what_the_one_before_it_left(spark):
    from widetab.llm import common
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    written = common.write_shared(C.quality_rules(spark, docs, sf), "t-stage")
    left = list(common._LEFT)
    assert left
    C.near_duplicates(spark, written, sf).count()
    assert not set(left) & set(common._LEFT) and written.count() > 0
    # A stage whose input is not written yet keeps what it reads.
    lazy = C.quality_rules(spark, docs, sf)
    n = lazy.count()
    C.redact_secrets(spark, lazy, sf).count()
    assert lazy.count() == n
