"""Cross-tokenizer alignment by pointer jumping (operator 13).

Two tokenizers cut the same bytes differently. Byte places where a token of
both ends cut a text into groups; tokens of one group belong together. Tokens
are nodes: each points to the farthest-right token of the other tokenizer that
overlaps it (a token whose end is shared is its group's last one). Following
pointers from any token ends at its group's last token, and doubling the
pointers (``succ[succ]``) gets there in log2 of the longest group's tokens
rounds; that last token labels the group. All units of a batch are one array,
so every step is a numpy operation over all their tokens.

A unit is what stands between single spaces. No token of either tokenizer
reaches over such a cut (``Tokens`` checks that of the piece model), so both
end there, groups never cross it, and a unit's groups are kept and used
again for every text that has it, up to a bound.

Corpus-wide counts are Spark's work: tasks write each document's distinct
linked id pairs once, one partially aggregated count gives the documents of
each pair and the highest count of each first id, and these are joined back to
the documents' pairs. The pair table is as large as the pairs that occur (at
most one vocabulary's size times the other's), so it is broadcast only if
its counted rows are few; else the join shuffles and Spark splits hot pairs.

Defined results: null and empty texts, and texts whose joined tokens are not a
space and the text (such as those with U+2581), have no tokens: zeros and an
empty string. Special tokens' strings are plain text. Rows that repeat are
documents of their own and count each; a very long text without spaces is one
unit; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.llm.common import small_or_shuffled, text_column, write_shared
from widetab.llm.tokens import UnitEncoder, _byte_letters, default_tokenizer_path

KNOWN_UNITS = 200_000
ROWS = 256
#: Links of one group above which its pairs are formed from distinct ids.
LARGE_GROUP = 4096
PAIR = np.dtype([("code", "<i8"), ("links", "<i8")])
#: Before a single space that a character other than white space follows.
_CUT = re.compile(r"(?<=[^ ])(?= \S)")


def default_piece_path() -> str:
    """Place of the public piece model (never copied here)."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Tokens:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        self.byte = UnitEncoder(byte_path)
        self.byte.tok.encode_special_tokens = True         # their strings are plain text
        letters = {c: b for b, c in enumerate(_byte_letters())}
        size = self.byte.tok.get_vocab_size()
        spelled = [self.byte.tok.id_to_token(i) or "" for i in range(size)]
        self.byte_bytes = [bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode() for s in spelled]
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece that reaches over a space cannot be cut at spaces")
        self.piece_bytes = [bytes([int(p[3:5], 16)]) if self.piece.is_byte(i) else p.replace("▁", " ").encode()
                            for i, p in enumerate(pieces)]

        self.byte_len = np.array([len(x) for x in self.byte_bytes], dtype=np.int64)
        self.piece_len = np.array([len(x) for x in self.piece_bytes], dtype=np.int64)

    def first(self, units: list[str]) -> list[bytes]:
        """Packed ids of a space and each unit by the byte-level tokenizer."""
        enc = self.byte
        plain = [bool(u) and not u[0].isspace() and not u[-1].isspace() and " " not in u for u in units]
        together = iter(enc.packed_units([u for u, p in zip(units, plain) if p]))
        return [next(together) if p else enc.whole(" " + u) for u, p in zip(units, plain)]

    def second(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit by the piece model, which puts the space before it."""
        return self.piece.encode(units, num_threads=1)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label of each first token, label of each second token, labels in use) for
    two tokenizations of the same bytes by their tokens' ends; a label is the
    number of the group's last first token."""
    n = len(a_ends)
    to_b = np.searchsorted(b_ends, a_ends)                 # the token that holds the byte before this end
    to_a = np.searchsorted(a_ends, b_ends)
    succ = np.concatenate([np.where(b_ends[to_b] > a_ends, to_b + n, np.arange(n)), to_a])
    while True:
        further = succ[succ]
        if (further == succ).all():
            break
        succ = further
    return succ[:n], succ[n:], np.flatnonzero(succ[:n] == np.arange(n))


def _pairs(a_ids, b_ids, a_group, b_group, n_groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, code, links) of all links, groups ascending; a large group's come
    by distinct pair."""
    a_n, b_n = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_at, b_at = np.cumsum(a_n) - a_n, np.cumsum(b_n) - b_n
    large = a_n * b_n > LARGE_GROUP
    times = np.where(large, 0, b_n)[a_group]
    at = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    group = np.repeat(a_group, times)
    code = (np.repeat(a_ids, times) << 32) | b_ids[b_at[group] + at]
    links = np.ones(len(code), dtype=np.int64)
    if large.any():
        more = []
        for g in np.flatnonzero(large):
            ua, ca = np.unique(a_ids[a_at[g]:a_at[g] + a_n[g]], return_counts=True)
            ub, cb = np.unique(b_ids[b_at[g]:b_at[g] + b_n[g]], return_counts=True)
            more.append((np.full(len(ua) * len(ub), g), ((ua[:, None] << 32) | ub).reshape(-1),
                         (ca[:, None] * cb).reshape(-1)))
        group, code, links = (np.concatenate([x, *[m[i] for m in more]]) for i, x in enumerate((group, code, links)))
        order = np.argsort(group, kind="stable")
        group, code, links = group[order], code[order], links[order]
    return group, code, links


class Aligner:
    """Groups of units, kept up to a bound. A unit's entry: its groups as text,
    tokens of both, groups, links, and its id pairs; None if its bytes differ."""

    def __init__(self, byte_path: str, piece_path: str):
        self.t = Tokens(byte_path, piece_path)
        self.units: dict[str, tuple | None] = {}

    def _good(self, said: list[bytes], first: list[bytes], second: list[list[int]]) -> list[int]:
        """The units whose joined tokens are what they say."""
        ab, bb = self.t.byte_bytes, self.t.piece_bytes
        whole = b"".join(said)
        if (b"".join([ab[x] for x in np.frombuffer(b"".join(first), "<u4").tolist()]) == whole
                and b"".join([bb[x] for ids in second for x in ids]) == whole):
            same = [sum(map(len, map(bb.__getitem__, ids))) == len(s) for ids, s in zip(second, said)]
            if all(same):
                return list(range(len(said)))
        return [i for i, s in enumerate(said) if b"".join([bb[x] for x in second[i]]) == s
                and b"".join([ab[x] for x in np.frombuffer(first[i], "<u4").tolist()]) == s]

    def learn(self, units: list[str]) -> None:
        first, second = self.t.first(units), self.t.second(units)
        said = [b" " + u.encode() for u in units]
        good = self._good(said, first, second)
        if len(good) < len(units):
            self.units.update(dict.fromkeys(units))
            units, first, second, said = ([x[i] for i in good] for x in (units, first, second, said))
        if not units:
            return
        n_first, n_second = [len(x) // 4 for x in first], [len(x) for x in second]
        a_ids = np.frombuffer(b"".join(first), dtype="<u4").astype(np.int64)
        b_ids = np.fromiter(chain.from_iterable(second), np.int64, sum(n_second))
        a_ends, b_ends = np.cumsum(self.t.byte_len[a_ids]), np.cumsum(self.t.piece_len[b_ids])
        a_label, b_label, lasts = group_labels(a_ends, b_ends)
        a_group, b_group = np.searchsorted(lasts, a_label), np.searchsorted(lasts, b_label)
        n_groups = len(lasts)
        a_n, b_n = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        written = self._written(a_ids.tolist(), b_ids.tolist(), np.cumsum(a_n).tolist(), np.cumsum(b_n).tolist())
        group, code, links = _pairs(a_ids, b_ids, a_group, b_group, n_groups)
        packed = np.empty(len(code), dtype=PAIR)
        packed["code"], packed["links"] = code, links
        # Where each unit's groups end, and its pairs.
        unit_ends = np.cumsum(np.array([len(x) for x in said], dtype=np.int64))
        g_ends = np.searchsorted(a_ends[lasts], unit_ends, side="right")
        p_ends = (np.searchsorted(group, g_ends) * PAIR.itemsize).tolist()
        n_links = np.diff(np.cumsum(a_n * b_n)[g_ends - 1], prepend=0).tolist()
        raw, g0, p0 = packed.tobytes(), 0, 0
        for u, na, nb, nl, g1, p1 in zip(units, n_first, n_second, n_links, g_ends.tolist(), p_ends):
            self.units[u] = (written[g0] if g1 - g0 == 1 else ";".join(written[g0:g1]), na, nb, g1 - g0, nl, raw[p0:p1])
            g0, p0 = g1, p1

    @staticmethod
    def _written(a: list[int], b: list[int], a_to: list[int], b_to: list[int]) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        a, b = list(map(str, a)), list(map(str, b))
        out, i, j = [], 0, 0
        for p, q in zip(a_to, b_to):
            out.append(f"{a[i] if p - i == 1 else ','.join(a[i:p])}|{b[j] if q - j == 1 else ','.join(b[j:q])}")
            i, j = p, q
        return out

    def _cut(self, text: str) -> list[str]:
        parts = text.split(" ")
        if all(parts) and not any(u[0].isspace() for u in parts[1:]):
            return parts
        return [u[1:] if i else u for i, u in enumerate(_CUT.split(text))]

    def align(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """Per text: (groups, tokens of both, groups, links, pairs as codes and
        links by code); None for texts without tokens."""
        if len(self.units) > KNOWN_UNITS:
            self.units = {}
        cut = [self._cut(t) if t else [] for t in texts]
        new = {u for us in cut for u in us}.difference(self.units)
        if new:
            self.learn(list(new))
        for us in cut:
            got = [self.units[u] for u in us]
            if not got or None in got:
                yield None
                continue
            groups, n_a, n_b, n_groups, n_links, raw = zip(*got)
            pairs = np.frombuffer(b"".join(raw), dtype=PAIR)
            code, at = np.unique(pairs["code"], return_inverse=True)
            links = np.bincount(at, weights=pairs["links"], minlength=len(code)).astype(np.int64)   # exact below 2^53
            yield ";".join(groups), sum(n_a), sum(n_b), sum(n_groups), sum(n_links), code, links


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One aligner per Python worker and pair of vocabularies."""
    if (byte_path, piece_path) not in _ALIGNERS:
        _ALIGNERS[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _ALIGNERS[byte_path, piece_path]


def document_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", byte_path: str | None = None,
                    piece_path: str | None = None, with_groups: bool = False) -> DataFrame:
    """Per row: k, n_a, n_b, n_groups, n_links, groups_sha256, its distinct linked
    pairs (codes ascending, first id << 32 | second id) with their links, and
    the groups as text if asked for."""
    paths = byte_path or default_tokenizer_path(), piece_path or default_piece_path()
    src = docs.select(F.col(key).alias("k"), text_column(text).alias("t"))
    fields = [("k", src.schema["k"].dataType), ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()),
              ("n_links", T.LongType()), ("groups_sha256", T.StringType()), ("codes", T.ArrayType(T.LongType())),
              ("links", T.ArrayType(T.LongType()))] + ([("groups", T.StringType())] if with_groups else [])
    none = ("", 0, 0, 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def arrays(parts: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(*paths)
        for whole in it:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                got = [g or none for g in al.align(b.column("t").to_pylist())]
                cols = [b.column("k"), *[pa.array([g[j] for g in got], pa.int64()) for j in range(1, 5)],
                        pa.array([hashlib.sha256(g[0].encode()).hexdigest() if g[0] else "" for g in got], pa.string()),
                        arrays([g[5] for g in got]), arrays([g[6] for g in got])]
                if with_groups:
                    cols.append(pa.array([g[0] for g in got], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[f for f, _ in fields])
    return src.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def pair_counts(groups: DataFrame) -> DataFrame:
    """(code, docs, best): how many documents hold a pair linked, and whether no
    other pair of its first id is held by more."""
    counts = write_shared(groups.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("docs")),
                          "align-counts")
    top = counts.groupBy(F.shiftright("code", 32).alias("first")).agg(F.max("docs").alias("top"))
    # One row per entry of the first vocabulary.
    return counts.join(small_or_shuffled(top, 32), F.shiftright("code", 32) == F.col("first")) \
        .select("code", "docs", (F.col("docs") == F.col("top")).cast("bigint").alias("best"))


def align_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", with_groups: bool = False,
                    **paths) -> DataFrame:
    """Per row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 (and the groups if asked for)."""
    made = document_groups(docs, key, text, with_groups=with_groups, **paths)
    groups = write_shared(made.withColumn("rid", F.monotonically_increasing_id()), "align-groups", "zstd")
    counts = write_shared(pair_counts(groups), "align-pairs").withColumnRenamed("code", "pair")
    each = groups.select("rid", F.explode(F.arrays_zip("codes", "links")).alias("p")) \
        .select("rid", F.col("p.codes").alias("code"), F.col("p.links").alias("links"))
    sums = each.join(small_or_shuffled(counts, 64), F.col("code") == F.col("pair")).groupBy("rid").agg(
        F.sum(F.col("links") * F.col("best")).alias("n_best"), F.sum(F.col("links") * F.col("docs")).alias("count_sum"))
    whole = groups.drop("codes", "links").join(sums.withColumnRenamed("rid", "srid"), F.col("rid") == F.col("srid"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return whole.select(F.col("k").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
                        "groups_sha256", *(["groups"] if with_groups else []))
