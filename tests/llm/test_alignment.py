import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from widetab.llm import alignment as A
from widetab.llm.tokens import default_tokenizer_path

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401

FIRST = Tokenizer.from_file(default_tokenizer_path())
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=A.default_piece_path())
ALIGNER = A.Aligner(default_tokenizer_path(), A.default_piece_path())
AB, BB = ALIGNER.t.byte_bytes, ALIGNER.t.piece_bytes


def brute(text):
    """(groups as two id lists each) by walking both token lists; None without tokens."""
    if not text:
        return None
    a, b = FIRST.encode(" " + text, add_special_tokens=False).ids, SECOND.encode(text)
    said = (" " + text).encode()
    if b"".join(AB[x] for x in a) != said or b"".join(BB[x] for x in b) != said:
        return None
    a_ends, b_ends = np.cumsum([len(AB[x]) for x in a]), np.cumsum([len(BB[x]) for x in b])
    shared, groups, i, j = sorted(set(a_ends.tolist()) & set(b_ends.tolist())), [], 0, 0
    for e in shared:
        p, q = int(np.searchsorted(a_ends, e)) + 1, int(np.searchsorted(b_ends, e)) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def linked(groups):
    return Counter((x << 32) | y for a, b in groups for x in a for y in b)


def agrees(text, got):
    groups = brute(text)
    if groups is None or got is None:
        return groups is None and got is None
    links = linked(groups)
    return got[:5] == (written(groups), sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                       sum(links.values())) and dict(zip(got[5].tolist(), got[6].tolist())) == dict(links)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aabeth  \n\t.,1's\u00e9\u6f22\U0001f600\x1c\u3000\x00")), max_size=15)
                | st.sampled_from(["<|endoftext|>", "<s>", "<0x0A>", "a \u2581b", " ", "  x", "x  "]), max_size=6))
def test_any_texts_against_brute_force(texts):
    assert all(agrees(t, g) for t, g in zip(texts, ALIGNER.align(texts)))
    joined = " ".join(texts)
    assert agrees(joined, next(iter(ALIGNER.align([joined]))))


@pytest.mark.parametrize("text", ["ab" * 2000, "\u00e9" * 800, "abcdefghijklmnop" * 300, "x" * 5000])
def test_long_units(text):
    assert agrees(text, next(iter(ALIGNER.align([text]))))


def test_labels_are_the_components_last_tokens():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        a = np.unique(np.append(rng.integers(1, size + 1, rng.integers(1, 20)), size))
        b = np.unique(np.append(rng.integers(1, size + 1, rng.integers(1, 20)), size))
        la, lb, lasts = A.group_labels(a, b)
        shared = np.intersect1d(a, b)
        want = np.searchsorted(a, shared)
        assert lasts.tolist() == want.tolist()
        assert la.tolist() == want[np.searchsorted(shared, a)].tolist()
        assert lb.tolist() == want[np.searchsorted(shared, b)].tolist()


def test_large_groups_pairs():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 200)
    ag, bg = np.sort(rng.integers(0, 3, 300)), np.sort(rng.integers(0, 3, 200))
    group, code, links = A._pairs(a, b, ag, bg, 3)
    got = Counter()
    for g, c, n in zip(group.tolist(), code.tolist(), links.tolist()):
        got[g, c] += n
    want = Counter((g, (x << 32) | y) for x, g in zip(a.tolist(), ag.tolist()) for y, h in zip(b.tolist(), bg.tolist()) if g == h)
    assert got == want and (np.diff(group) >= 0).all()


def corpus(rows):
    """Brute force of the whole operator: (key, text) rows."""
    made = [(k, brute(t)) for k, t in rows]
    docs = Counter(c for _, g in made if g for c in linked(g))
    top = Counter()
    for c, n in docs.items():
        top[c >> 32] = max(top[c >> 32], n)
    out = []
    for k, g in made:
        links = linked(g) if g else Counter()
        out.append((k, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(links.values()),
                    sum(n for c, n in links.items() if docs[c] == top[c >> 32]), sum(n * docs[c] for c, n in links.items()),
                    hashlib.sha256(written(g).encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_documents(spark, sample_docs, odd_docs, monkeypatch):
    for docs in (sample_docs.repartition(5), odd_docs):
        got = [tuple(r[c] for c in COLUMNS) for r in A.align_documents(docs).collect()]
        assert sorted(got, key=str) == corpus([(r.doc_id, r.text) for r in docs.collect()])
    assert A.align_documents(odd_docs.limit(0)).count() == 0
    # The same without a broadcast of the pair table.
    monkeypatch.setattr(A, "small_or_shuffled", lambda df, row_bytes: df)
    got = [tuple(r[c] for c in COLUMNS) for r in A.align_documents(odd_docs, with_groups=True).collect()]
    assert sorted(got, key=str) == corpus([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_small_memory(monkeypatch, sample_docs):
    monkeypatch.setattr(A, "KNOWN_UNITS", 20)
    al = A.Aligner(default_tokenizer_path(), A.default_piece_path())
    texts = [r.text for r in sample_docs.collect()]
    for at in range(0, len(texts), 25):
        assert all(agrees(t, g) for t, g in zip(texts[at:at + 25], al.align(texts[at:at + 25])))
