"""Token ids with the public tokenizers library, memoised per text unit.

The byte-level BPE splits text before merging, and no piece crosses a single
space that has a non-space character on both sides. So a text is cut there,
and each unit (with its leading space) is encoded once by the library and
remembered as packed ids. Units of letters, of letters and a mark, and of lines
of these are put together from their pieces. Texts with a special token's
string are encoded whole. The memory is cut back when it is full. ``packed_units``
takes many units in one call: their ids fall apart at the tokens that begin with the space.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,;:!?"
MEMORY_UNITS = 900_000
KEPT_UNITS = 100_000


def default_tokenizer_path() -> str:
    """Place of the public byte-level BPE vocabulary (never copied here)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class _CutElsewhere(Exception):
    """A unit starts or ends with white space, or is empty."""


class _Units(dict):
    """Ids of units that follow ``lead`` (a space, or nothing)."""

    def __init__(self, enc: UnitEncoder, lead: str):
        super().__init__()
        self.enc, self.lead = enc, lead

    def __missing__(self, u: str) -> bytes:
        ids = self.enc.new_unit(self.lead, u)
        if len(self) >= self.enc.memory:
            # Keep the units met first: frequent ones are among them.
            first = list(islice(self.items(), min(KEPT_UNITS, self.enc.memory // 2)))
            self.clear()
            self.update(first)
        self[u] = ids
        return ids


class UnitEncoder:
    """``encode(text)`` → ids as little-endian unsigned 32-bit bytes, equal to
    ``tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, memory: int = MEMORY_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.memory = memory
        self.letters = _byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tok.get_vocab_size())]
        self.begins = np.array([(self.tok.id_to_token(i) or "").startswith(self.letters[32]) for i in range(len(self.packed))])
        self.spaced, self.bare = _Units(self, " "), _Units(self, "")

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, lead: str, word: str) -> bytes:
        """A piece that is a word for the splitter goes to the library's model."""
        start = self.letters[32] if lead else ""
        spelled = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(start + spelled)])

    def new_unit(self, lead: str, u: str) -> bytes:
        if not u or u[0].isspace() or u[-1].isspace():
            raise _CutElsewhere
        word = u.rstrip(_MARKS)
        if word.isalpha() and (word.isascii() or max(word) < "ɐ"):
            if word == u:
                return self._word(lead, u)
            return (self.spaced if lead else self.bare)[word] + self.bare[u[len(word):]]
        if "\n" in u:
            lines = u.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                first = (self.spaced if lead else self.bare)[lines[0]]
                end = self.whole("\n")
                return first + b"".join([end + self.bare[x] for x in lines[1:]])
        return self.whole(lead + u)

    def packed_units(self, units: list[str]) -> list[bytes]:
        """Ids of a space and each unit, for units without a space, without white
        space at their ends and without special tokens' strings: one call."""
        if not units:
            return []
        ids = np.array(self.tok.encode_batch_fast([" " + " ".join(units)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(units):
            raise ValueError("units do not begin where their ids do")
        raw, at = ids.tobytes(), (4 * np.append(at, len(ids))).tolist()
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        units = text.split(" ")
        try:
            return self.bare[units[0]] + b"".join(map(self.spaced.__getitem__, units[1:]))
        except _CutElsewhere:
            out = []
            for i, u in enumerate(_CUT.split(text)):
                plain = " " not in u and u and not u[0].isspace() and not u[-1].isspace()
                out.append((self.spaced if i else self.bare)[u] if plain else self.whole(" " + u if i else u))
            return b"".join(out)


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
