import hashlib

import numpy as np

from widetab.llm import fingerprint as P

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


def test_every_document_meets_its_next(spark, sample_docs):
    rows = sorted(((r.doc_id, r.text or "") for r in sample_docs.collect()), reverse=True)
    got = {r.doc_id: r for r in P.fingerprints(sample_docs.repartition(5), parts=7).collect()}
    assert len(got) == len(rows)
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        new = P.edited_text(t, after)
        a, b, c = (P.digest(x.encode()) for x in (t, new, after))
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (P.to_hex(a), P.to_hex(b))
        assert (r.near_edited, r.near_next) == (P.likeness(a, b), P.likeness(a, c))
        assert 0 <= r.near_next <= 1
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.97 * len(got)


def test_triplet_counts_against_a_loop():
    data = ("Zwölf Boxkämpfer jagen Viktor. " * 5).encode()
    want = np.zeros(P.BUCKETS, dtype=int)
    bits = P.BUCKETS.bit_length() - 1
    for g1, g2, mul in P.FORMS:
        for i in range(len(data) - g2):
            h = (data[i] | data[i + g1] << 8 | data[i + g2] << 16) * mul & 0xFFFFFFFF
            h ^= h >> 15
            h = h * 0x2C1B3C6D & 0xFFFFFFFF
            want[h >> (32 - bits)] += 1
    assert (P.bucket_counts(data) == want).all()


def test_long_texts_are_counted_across_chunks(monkeypatch):
    data = bytes(np.random.default_rng(1).integers(0, 256, 10_000, dtype=np.uint8))
    whole = P.bucket_counts(data)
    monkeypatch.setattr(P, "CHUNK", 777)
    assert (P.bucket_counts(data) == whole).all()


def test_odd_rows(spark, odd_docs):
    got = P.fingerprints(odd_docs, parts=3).collect()
    assert len(got) == odd_docs.count()
    same = {r.fingerprint for r in got if r.doc_id in (3, 4)}
    assert len(same) == 1                                       # equal texts, equal digests
    assert P.fingerprints(odd_docs.limit(0)).count() == 0
    one = P.fingerprints(odd_docs.filter("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0            # its own next document
