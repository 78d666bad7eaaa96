import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from widetab.llm import packing as K
from widetab.llm.tokens import UnitEncoder, default_tokenizer_path

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


def ids_of(tok, text, end):
    return np.array(tok.encode(text, add_special_tokens=False).ids + [end], dtype="<u4")


def test_units_give_the_library_ids(sample_docs):
    tok = Tokenizer.from_file(default_tokenizer_path())
    odd = ["", " ", "  a  b ", " a", "a ", "x\n y", "a<|endoftext|>b", "it's 'll don't  x", "a\n\nb", "a.\n b", "...! ?", "12a 3.4, a_b.",
           "A\tb c", "日本語 です。 a", "é. ß ñ, ª º", "a  b", "x \n\n y", "a\x1c b"]
    enc, small = UnitEncoder(default_tokenizer_path()), UnitEncoder(default_tokenizer_path(), memory=40)
    for t in odd + [r.text for r in sample_docs.limit(60).collect()]:
        want = np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert enc.encode(t) == small.encode(t) == want, t[:60]


def test_pieces_and_places(spark, sample_docs):
    tok = Tokenizer.from_file(default_tokenizer_path())
    got = K.pack_documents(sample_docs.repartition(3)).toPandas()
    texts = {r.doc_id: r.text or "" for r in sample_docs.collect()}
    assert set(got.doc_id) == set(texts)
    for k, g in got.groupby("doc_id"):
        ids, g = ids_of(tok, texts[k], 2), g.sort_values("piece")
        assert list(g.piece) == list(range(len(g))) and g.length.sum() == len(ids)
        assert (g.length.iloc[1:] == 1024).all() and (len(ids) > 1024 or len(g) == 1)
        for r in g.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 1024
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 1024) * 1.01 + 2


def test_two_for_the_smallest_tightens_a_bin():
    # Greedy takes 6 + 3 of 10; two pieces of 2 for the 3 fill it.
    bins = K.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert bins[0] == ([6, 2, 2], 1)


def test_plan_holds_every_piece():
    rng = random.Random(1)
    for _ in range(30):
        counts = {rng.randint(1, 50): rng.randint(1, 400) for _ in range(rng.randint(1, 25))}
        bins = K.best_two_fit(counts, 50)
        assert all(sum(b) <= 50 for b, _ in bins)
        total = {}
        for b, times in bins:
            for n in b:
                total[n] = total.get(n, 0) + times
        assert total == counts
        first_fit, sizes = [], sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
        for n in sizes:
            for i, gap in enumerate(first_fit):
                if gap >= n:
                    first_fit[i] -= n
                    break
            else:
                first_fit.append(50 - n)
        assert sum(t for _, t in bins) <= len(first_fit) * 1.02 + 1


def test_odd_rows(spark, odd_docs):
    got = K.pack_documents(odd_docs, with_ids=True).toPandas()
    assert (got.groupby(got.doc_id.fillna(-1)).piece.nunique() >= 1).all() and len(got[got.doc_id == 3]) == 2
    assert got[got.doc_id.isin([1, 2])].length.tolist() == [1, 1] and got.doc_id.isna().sum() == 1
    assert all(zlib.crc32(bytes(i)) == c for i, c in zip(got.ids, got.ids_crc32))
    assert (got.groupby("sequence_id").length.sum() <= 1024).all()
    assert K.pack_documents(odd_docs.limit(0)).count() == 0
