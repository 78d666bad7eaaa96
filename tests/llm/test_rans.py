import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from widetab.llm import rans as R
from widetab.llm.common import shared_path
from widetab.llm.tokens import default_tokenizer_path

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


@pytest.mark.parametrize("n", [0, 1, 7, 1024, 1025, 300_000])
def test_block_round_trip_and_parts(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 50_000).astype(np.uint32) if n else np.zeros(0, np.uint32)
    t = R.Tables(R.scaled(np.bincount(ids, minlength=50_001) if n else np.array([1])))
    block = R.Block(R.pack_block([7, None], np.array([n, 0]), ids, 99, t))
    assert (block.ids(t) == ids).all() and block.keys == [7, None] and block.start == 99
    # From each checkpoint on, by itself, in any order.
    parts = {i: block.part(i, t) for i in reversed(range(len(block.marks) + 1))}
    assert (np.concatenate([parts[i] for i in range(len(parts))]) == ids).all()
    assert n < 200_000 or block.marks


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 300
    t = R.Tables(R.scaled(np.bincount(ids)))
    good = R.pack_block([1], np.array([5000]), ids, 0, t)
    for place in (-1, -100, -len(good) // 2):
        data = bytearray(good)
        data[place] ^= 1
        with pytest.raises((ValueError, IndexError)):
            R.Block(bytes(data)).ids(t)


def test_a_mark_in_the_bytes_is_masked(monkeypatch):
    ids = np.arange(3000, dtype=np.uint32) % 50
    t = R.Tables(R.scaled(np.bincount(ids)))
    plain = R.pack_block([1], np.array([3000]), ids, 0, t)
    body = plain[R.HEAD.size:]
    at = next(i for i in range(8, len(body) - 6) if max(body[i:i + 6]) < 128 and len(set(body[i:i + 6])) > 3)
    monkeypatch.setattr(R, "MARK", body[at:at + 6].decode())
    data = R.pack_block([1], np.array([3000]), ids, 0, t)
    assert R.MARK.encode() not in data and data[5] != 0 and (R.Block(data).ids(t) == ids).all()


def test_frequencies_sum_and_cover():
    for counts in ([1], [1, 10**12], [5] * 50_000, [0, 3, 0, 1] + [1] * 1000 + [10**9]):
        c = np.array(counts, dtype=np.int64)
        f = R.scaled(c)
        assert f.sum() == 1 << R.SCALE and ((f > 0) == (c > 0)).all()


def test_archive_in_key_order(spark, sample_docs):
    tok = Tokenizer.from_file(default_tokenizer_path())
    path = shared_path(spark, "t-rans")
    R.write_ids(sample_docs.repartition(5), path, block_ids=20_000)
    got = sorted(R.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r.doc_id)
    start = 0
    texts = {r.doc_id: r.text or "" for r in sample_docs.collect()}
    assert [r.doc_id for r in got] == sorted(texts)
    for r in got:
        want = np.array(tok.encode(texts[r.doc_id], add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(want) // 4, zlib.crc32(want), want)
        start += r.n_tokens


def test_odd_rows(spark, odd_docs):
    path = shared_path(spark, "t-rans")
    R.write_ids(odd_docs, path)
    got = sorted(R.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4, 5, 6, 7]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    path = shared_path(spark, "t-rans")
    R.write_ids(odd_docs.limit(0), path)
    assert R.read_documents(spark, path).count() == 0
