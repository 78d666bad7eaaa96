import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from widetab.llm import trie_bpe as B
from widetab.llm.tokens import default_tokenizer_path

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401

TOK = Tokenizer.from_file(default_tokenizer_path())
ENC = B.TrieEncoder(default_tokenizer_path())


def ids_of(text):
    return np.array(TOK.encode(text, add_special_tokens=False).ids, dtype="<u4")


def by_merging(v, word):
    """Brute force: merge the oldest pair, leftmost first, until none is left."""
    ids = [v.ids[c] for c in word]
    while True:
        found = [(v.age[v.merged[p]], i) for i, p in enumerate(zip(ids, ids[1:])) if p in v.merged]
        if not found:
            return ids
        i = min(found)[1]
        ids[i:i + 2] = [v.merged[ids[i], ids[i + 1]]]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aabeth  \n\t.,!?1239's\u00e9\u6f22\U0001f600\x1c\u3000\x85\xa0TR<|>")), max_size=40),
       st.lists(st.sampled_from(["<|endoftext|>", "'re", " the", "\r\n", "  ", "<|endof", "\u0301"]), max_size=5))
def test_any_text_as_the_library(text, more):
    text = text[:20] + "".join(more) + text[20:]
    got = ENC.encode_batch([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids_of(text).tolist()
    assert ENC.decode(got) == TOK.decode(ids_of(text).tolist(), skip_special_tokens=False)


def test_words_against_merging():
    rng = np.random.default_rng(3)
    pool = ["the", "ing", "er", "a", "b", "t", "\u0120", "on", "\u0120s", "."]
    words = sorted({"".join(rng.choice(pool, rng.integers(1, 7))) for _ in range(800)})
    trie = B.Trie(ENC.v)
    assert trie.encode(words) == [by_merging(ENC.v, w) for w in words]
    # Every node is made once: as many as there are distinct prefixes.
    assert len(trie.last) == 1 + len({w[:n] for w in words for n in range(1, len(w) + 1)})


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 1500, "\u00e9" * 1000, "!" * 1000 + "a", " " * 700 + "x", "x" * B.DEPTH, "y" * (B.DEPTH + 1)])
def test_long_words(word):
    assert ENC.encode_batch([word, word + " x"]) == [ids_of(word).tobytes(), ids_of(word + " x").tobytes()]


def test_any_ids_decode_as_the_library():
    rng = np.random.default_rng(4)
    for _ in range(300):
        ids = rng.integers(0, 50257, 15)
        assert ENC.decode(ids.astype("<u4").tobytes()) == TOK.decode(ids.tolist(), skip_special_tokens=False)


def test_small_memory(monkeypatch, sample_docs):
    for name in ("KNOWN_UNITS", "KNOWN_WORDS", "KNOWN_NODES", "KNOWN_PAIRS"):
        monkeypatch.setattr(B, name, 50)
    enc = B.TrieEncoder(default_tokenizer_path())
    texts = [r.text or "" for r in sample_docs.collect()]
    got = [x for at in range(0, len(texts), 20) for x in enc.encode_batch(texts[at:at + 20])]
    assert got == [ids_of(t).tobytes() for t in texts]


def want(rows):
    out = []
    for k, t in rows:
        ids = ids_of(t or "")
        back = TOK.decode(ids.tolist(), skip_special_tokens=False)
        out.append((k, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark, sample_docs, odd_docs):
    for docs in (sample_docs.repartition(5), odd_docs):
        got = [tuple(r) for r in B.encoding_digests(docs).collect()]
        assert sorted(got, key=str) == want([(r.doc_id, r.text) for r in docs.collect()])
    assert B.encoding_digests(odd_docs.limit(0)).count() == 0
    full = B.encode_documents(odd_docs).collect()
    assert sorted((r.decoded for r in full)) == sorted(r.text or "" for r in odd_docs.collect())
