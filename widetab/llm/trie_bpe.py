"""BPE encoding and decoding by prefix-sharing trie traversal (operator 12).

Byte-pair merges never cross the words that the vocabulary's splitter makes,
so a task encodes each distinct word once. The words that a batch meets for the
first time are inserted into a trie, and a depth-first walk gives every node
(a prefix of some words) its state: the last token of the prefix's encoding.
A prefix ends with token ``t`` exactly if ``t`` is its end and may follow the
last token of what stands before ``t``; that is one look at a state further up
the path, so the encoding of a shared prefix is computed once for all words
that go on from it. A word's ids are read backwards: last token, state before
it, and so on.

Two tokens may stand side by side if merging would leave them alone: their
touching edges are taken apart, the newest merge first, and no pair of edges
that exist at the same time may have a merge of its own.

Decoding joins the tokens' bytes and reads them as UTF-8 (malformed bytes
become U+FFFD).

Spark partitions the documents; a task keeps the ids of words and of units
(what stands between single spaces) up to a bound, so its memory does not grow
with the input, and a lost task is computed again from its rows alone.

Defined results: a null text is empty, and an empty text has no ids and the
hashes of nothing; a very long word takes the trie's depth for its first
``DEPTH`` letters and goes on alone from there; the string of a special token
in a text is that token; rows that repeat are encoded each; an empty table gives
an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.llm.common import text_column
from widetab.llm.tokens import default_tokenizer_path

DEPTH = 192
KNOWN_UNITS = 500_000
KNOWN_WORDS = 300_000
KNOWN_NODES = 400_000
KNOWN_PAIRS = 500_000
ROWS = 512
MARKS = ".,;:!?"
#: Before a space that a character other than white space follows: no word of
#: the splitter reaches over it.
_CUT = re.compile(r"(?= \S)")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the rest follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merges:
    """A byte-level vocabulary: tokens, their merges, and which may be neighbours."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model = held["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.spelled = [""] * size
        for s, i in [*self.ids.items(), *self.special.items()]:
            self.spelled[i] = s
        self.length = [len(s) for s in self.spelled]
        self.age = [-1] * size                        # when a merge makes the token; -1: a single letter
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}  # a pair's token
        for rank, m in enumerate(model["merges"]):
            left, right = (self.ids[x] for x in (m if isinstance(m, list) else m.split(" ")))
            made = self.ids[self.spelled[left] + self.spelled[right]]
            if max(self.age[left], self.age[right]) >= rank or self.age[made] >= 0:
                raise ValueError("merges must follow those of their parts, one for each token")
            self.age[made], self.halves[made], self.merged[left, right] = rank, (left, right), made
        # Tokens that merging their own letters makes, and every start of one.
        self.made = {s: i for s, i in self.ids.items()
                     if len(s) == 1 or self.halves[i] and self._apart(*self.halves[i], self.age[i])}
        self.starts = {s[:n] for s in self.made for n in range(1, len(s) + 1)}
        self.pairs: list[dict[int, bool]] = [{} for _ in range(size)]
        self.held = 0

    def neighbours(self, left: int, right: int) -> bool:
        """True if merging the two tokens' letters gives these two again."""
        got = self.pairs[left].get(right)
        if got is None:
            if self.held >= KNOWN_PAIRS:
                for known in self.pairs:
                    known.clear()
                self.held = 0
            got = self.pairs[left][right] = self._apart(left, right, len(self.merged))
            self.held += 1
        return got

    def _apart(self, left: int, right: int, until: int) -> bool:
        """True if no merge older than ``until`` joins the tokens' touching edges."""
        # Until when each edge exists: the age of the token that swallows it.
        left_until = right_until = until
        while True:
            made = self.merged.get((left, right))
            # Of equal merges the leftmost is made first: the left token's own one
            # comes before this one, this one before the right token's own.
            if made is not None and self.age[made] < left_until and self.age[made] <= right_until:
                return False
            if self.age[left] < 0 and self.age[right] < 0:
                return True
            if self.age[left] >= self.age[right]:
                left_until, left = self.age[left], self.halves[left][1]
            else:
                right_until, right = self.age[right], self.halves[right][0]


class End:
    """The longest end of a prefix that starts some token, with the tokens that
    are ends of it (shortest first, with their lengths) and what a letter makes of it."""

    __slots__ = ("letters", "tokens", "after")

    def __init__(self, letters: str, v: Merges):
        self.letters, self.after = letters, {}
        ends = (letters[at:] for at in range(len(letters) - 1, -1, -1))
        self.tokens = [(v.made[s], len(s)) for s in ends if s in v.made]


class Trie:
    """Words by their prefixes. A node is a number; it holds its end and the last
    token of its prefix's encoding, worked out once when the node is made. Words
    come in sorted order, so nodes are made, and states handed down, depth first."""

    def __init__(self, v: Merges):
        self.v = v
        self.ends: dict[str, End] = {"": End("", v)}
        self.clear()

    def clear(self) -> None:
        self.below: dict[tuple[int, str], int] = {}
        self.end: list[End] = [self.ends[""]]
        self.last: list[int] = [-1]

    def step(self, end: End, letter: str) -> End:
        """The end after one more letter."""
        got = end.after.get(letter)
        if got is None:
            s = end.letters + letter
            while s not in self.v.starts:
                s = s[1:]
                if not s:
                    raise ValueError(f"the vocabulary lacks the letter {letter!r}")
            got = self.ends.get(s)
            if got is None:
                got = self.ends[s] = End(s, self.v)
            end.after[letter] = got
        return got

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of sorted distinct words (in byte letters)."""
        out = []
        below, ends, last, length, pairs = self.below, self.end, self.last, self.v.length, self.v.pairs
        before, path, lasts = "", [0], [-1]                # the walk's nodes and their states
        for w in words:
            deep = min(len(w), DEPTH)
            shared, most = 0, min(len(path) - 1, deep)
            while shared < most and w[shared] == before[shared]:
                shared += 1
            del path[shared + 1:], lasts[shared + 1:]
            node, before = path[shared], w
            for n in range(shared, deep):
                letter = w[n]
                child = below.get((node, letter))
                if child is None:
                    end = ends[node].after.get(letter) or self.step(ends[node], letter)
                    for t, size in end.tokens:
                        if size > n:
                            break
                        left = lasts[n + 1 - size]
                        good = pairs[left].get(t)
                        if good or good is None and self.v.neighbours(left, t):
                            break
                    child = below[node, letter] = len(last)
                    ends.append(end)
                    last.append(t)
                node = child
                path.append(node)
                lasts.append(last[node])
            if len(w) > DEPTH:
                states = self._alone(w, ends[node], lasts[:])
            else:
                states = lasts
            ids, n = [], len(w)
            while n:                                       # back from token to token
                t = states[n]
                ids.append(t)
                n -= length[t]
            ids.reverse()
            out.append(ids)
        return out

    def _alone(self, w: str, end: End, states: list[int]) -> list[int]:
        """States of a word longer than the trie is deep."""
        for n in range(len(states), len(w) + 1):
            end = self.step(end, w[n - 1])
            states.append(next(t for t, size in end.tokens if size == n or self.v.neighbours(states[n - size], t)))
        return states


class TrieEncoder:
    """Encodes batches of texts; keeps the packed ids of units and words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.v = Merges(path)
        self.trie = Trie(self.v)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}                 # units after a space
        self.bare: dict[str, bytes] = {}
        special = sorted(self.v.special, key=len, reverse=True)
        self.mark = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.bytes = [bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
                      for s in self.v.spelled]

    def _plain(self, lead: str, u: str) -> list[str] | None:
        """Words of a unit of letters with marks behind; None for any other."""
        word = u.rstrip(MARKS)
        if not word.isalpha():
            return None
        if not word.isascii():
            if max(word) >= "\u0250":
                return None
            spelled = "".join([self.letters[b] for b in word.encode()])
            return [lead + spelled, u[len(word):]] if word != u else [lead + spelled]
        return [lead + word, u[len(word):]] if word != u else [lead + word]

    def split(self, u: str, after_space: bool) -> list[str]:
        """The splitter's words of a unit, in byte letters."""
        lead = self.letters[32] if after_space else ""
        got = self._plain(lead, u)
        if got is None and "\n" in u:                      # lines of such
            lines = [self._plain("" if i else lead, x) for i, x in enumerate(u.split("\n"))]
            if None not in lines:
                got = lines[0]
                for x in lines[1:]:
                    got = [*got, self.letters[10], *x]
        return got if got is not None else [w for w, _ in self.splitter.pre_tokenize_str(" " + u if after_space else u)]

    def learn(self, units: list[str], after_space: bool) -> None:
        """Ids of units met for the first time: their new words go through the trie."""
        parts = [self.split(u, after_space) for u in units]
        known = self.words
        new = sorted({w for ws in parts for w in ws if w not in known})
        for w, ids in zip(new, self.trie.encode(new)):
            known[w] = array("I", ids).tobytes()
        into = self.spaced if after_space else self.bare
        for u, ws in zip(units, parts):
            into[u] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])

    def _forget(self) -> None:
        """Cut the memory back when it is full."""
        if len(self.spaced) + len(self.bare) > KNOWN_UNITS:
            self.spaced, self.bare = {}, {}
        if len(self.words) > KNOWN_WORDS:
            self.words = {}
        if len(self.trie.last) > KNOWN_NODES:
            self.trie.clear()

    def _stretch(self, text: str) -> bytes:
        """Ids of a stretch without special tokens, cut where no word reaches over."""
        if not text:
            return b""
        parts = text.split(" ")
        try:
            return (self.bare[parts[0]] if parts[0] else b"") + b"".join([self.spaced[u] for u in parts[1:]])
        except KeyError:
            pass
        units = [(True, u[1:]) if u[0] == " " and len(u) > 1 and not u[1].isspace() else (False, u)
                 for u in _CUT.split(text) if u]
        for after_space, into in ((True, self.spaced), (False, self.bare)):
            new = {u for s, u in units if s == after_space and u not in into}
            if new:
                self.learn(list(new), after_space)
        return b"".join([(self.spaced if s else self.bare)[u] for s, u in units])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        self._forget()
        spaced: set[str] = set()
        bare: set[str] = set()
        for t in texts:
            parts = t.split(" ")
            bare.add(parts[0])
            spaced.update(parts[1:])
        for after_space, found, into in ((True, spaced, self.spaced), (False, bare, self.bare)):
            self.learn([u for u in found if u not in into and u and not (after_space and u[0].isspace())
                        and (not self.mark or not self.mark.search(u))], after_space)
        out = []
        for t in texts:
            if self.mark and any(s in t for s in self.v.special):
                out.append(b"".join([array("I", [self.v.special[p]]).tobytes() if j % 2 else self._stretch(p)
                                     for j, p in enumerate(self.mark.split(t))]))
            else:
                out.append(self._stretch(t))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, special tokens included."""
        known = self.bytes
        return b"".join([known[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", errors="replace")


_ENCODERS: dict[str, TrieEncoder] = {}


def trie_encoder(path: str) -> TrieEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per row of ``docs``: key, ids (packed), decoded (their text)."""
    path = tokenizer or default_tokenizer_path()
    src = docs.select(F.col(key).alias("k"), text_column(text).alias("t"))
    kind = T.StructType([T.StructField("k", src.schema["k"].dataType), T.StructField("ids", T.BinaryType()),
                         T.StructField("decoded", T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = trie_encoder(path)
        for whole in it:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = enc.encode_batch(b.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("k"), pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
                    names=["k", "ids", "decoded"])
    return src.mapInArrow(run, kind).withColumnRenamed("k", key)


def encoding_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256. Ids and texts are
    hashed where they are made, so neither leaves its task."""
    path = tokenizer or default_tokenizer_path()
    src = docs.select(F.col(key).alias("k"), text_column(text).alias("t"))
    kind = T.StructType([T.StructField("k", src.schema["k"].dataType), T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = trie_encoder(path)
        for whole in it:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = enc.encode_batch(b.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("k"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in ids], pa.string())],
                    names=["k", "n_tokens", "ids_sha256", "decoded_sha256"])
    return src.mapInArrow(run, kind).withColumnRenamed("k", key)
