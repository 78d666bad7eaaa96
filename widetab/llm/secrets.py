"""Secret scans: base patterns plus sliding-window entropy (operator 1).

Base kinds are fixed patterns. The method adds spans of kind ``entropy``:
candidate strings are long runs of key-like characters and the values within
them (between ``=`` signs, and without path parts that are words), a window
slides over each candidate, and the Shannon entropy of the window is kept up to date by
adding the entering and removing the leaving character's count. Each
character class has its own threshold; strings on the allow list (and the
longer ones that consist of them) are suppressed.

Defined results: null text is empty and has no span; a repeated row gets the
same spans as its twin; null doc_id rows are scanned too; an empty table gives
an empty table; other columns of the input are ignored by ``scan`` and kept
unchanged by ``redact``. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.llm.common import map_rows

# Fixed base patterns, kinds in their order of listing.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_GATE = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Character class → least bits per character of a window.
THRESHOLDS = {"hex": 3.0, "alnum": 3.8, "base64": 3.9}
# Harmless parts: alphabets and counting runs, placeholders. A candidate is
# harmless if less than a window of it is left without them.
HARMLESS = re.compile(
    r"(?i)abcdefghij" + "".join(f"(?:{c}" for c in "klmnopqrstuvwxyz") + ")?" * 16 +
    r"|0123456789|1234567890|qwertyuiop(?:asdfghjkl(?:zxcvbnm)?)?"
    r"|example|sample|placeholder|changeme|dummy|x{6,}|your[_-]")
# Harmless strings: identifiers written as words, UUID-like and date-like
# forms, repeated units.
ALLOW = tuple(re.compile(p) for p in (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[A-Za-z]+([_/=-][A-Za-z]+)*[0-9]{0,4}$",
    r"^[0-9/_=+-]+$",
    r"^(.{1,8})\1+.{0,7}$",
))
VALUE = re.compile(r"[^=]+(?:=+\Z)?")
PATH_WORD = re.compile(r"[A-Za-z]+(?:[_-][A-Za-z]+)*[0-9]{0,4}")
_NLOGN = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def char_class(s: str) -> str | None:
    """Class whose threshold applies; None for strings that mix too little."""
    digit = any(c.isdigit() for c in s)
    lower = any(c.islower() for c in s)
    upper = any(c.isupper() for c in s)
    if not digit or not (lower or upper):
        return None
    if lower != upper and all(c in "0123456789abcdefABCDEF" for c in s):
        return "hex"
    return "alnum" if s.isalnum() else "base64"


def window_entropies(s: str, width: int = WINDOW) -> list[float]:
    """Entropy in bits of every window of ``width`` characters, by
    incremental counts: one character enters, one leaves per step."""
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _NLOGN[n + 1] - _NLOGN[n]
        if i >= width:
            gone = s[i - width]
            n = counts[gone]
            counts[gone] = n - 1
            total += _NLOGN[n - 1] - _NLOGN[n]
        if i >= width - 1:
            out.append(math.log2(width) - total / width)
        elif i == 0 and width > len(_NLOGN) - 1:
            raise ValueError("window is wider than its table")
    return out


def allowed(s: str) -> bool:
    """The candidate consists of allow-listed strings."""
    return len(HARMLESS.sub("", s)) < WINDOW and HARMLESS.search(s) is not None or any(p.search(s) for p in ALLOW)


def candidates_of(run: str) -> list[tuple[int, int]]:
    """The run itself, its parts between ``=`` signs (trailing ones are
    padding), and the stretches of those without path parts that are words."""
    values = [m.span() for m in VALUE.finditer(run)]
    found = values[:]
    for a, b in values:
        start, at = a, a
        for part in run[a:b].split("/"):
            end = at + len(part)
            if not part or PATH_WORD.fullmatch(part):
                found.append((start, at - 1))
                start = end + 1
            at = end + 1
        found.append((start, b))
    # A run of several values is harmless if each of them is.
    whole = [(0, len(run))] if not all(allowed(run[a:b]) for a, b in values) else []
    return sorted({(a, b) for a, b in found + whole if b - a >= WINDOW})


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Merged runs of windows over their class's threshold, allow list off."""
    out: list[list[int]] = []
    for m in CANDIDATE.finditer(text):
        found = []
        for a, b in candidates_of(m.group()):
            s = m.group()[a:b]
            kind = char_class(s)
            if kind is None or allowed(s):
                continue
            least, at = THRESHOLDS[kind], m.start() + a
            found += [(at + i, at + i + WINDOW) for i, h in enumerate(window_entropies(s)) if h >= least - 1e-9]
        run = None
        for a, b in sorted(found):
            if run and a <= run[1]:
                run[1] = max(run[1], b)
            else:
                run = [a, b]
                out.append(run)
    return [(a, b) for a, b in out]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(g in low for g in _GATE) or not text.isascii():
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def all_spans(text: str, base: list[tuple[int, int, str]] | None = None) -> list[tuple[int, int, str]]:
    """Base spans and the entropy spans that no base span covers."""
    base = base_spans(text) if base is None else base
    more = [(a, b, "entropy") for a, b in entropy_spans(text)
            if not any(x <= a and b <= y for x, y, _ in base)]
    return sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[2]))) if more else base


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``spans`` array of (start, end, kind), and
    ``base`` with the base spans only. Offsets count code points, end exclusive."""
    src = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = dict(df.select(F.col(key).alias("k")).dtypes)["k"]
    span = "array<struct<start: bigint, end: bigint, kind: string>>"

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        as_rows = lambda spans: [{"start": a, "end": b, "kind": k} for a, b, k in spans]
        for p in parts:
            base = [base_spans(t) for t in p["t"]]
            full = [all_spans(t, b) for t, b in zip(p["t"], base)]
            yield {"k": p["k"], "base": [as_rows(x) for x in base], "spans": [as_rows(x) for x in full]}
    return (map_rows(src, f"k {kind}, base {span}, spans {span}", run)
            .withColumnRenamed("k", key))


def span_digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans joined."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return scanned.select(
        key, *[count(k) for k in KINDS[:3]],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """The input with every span in ``text`` replaced by ``mark`` (overlapping
    spans by one mark). ``length`` names a column that holds the text's code
    points and is brought up to date on changed rows. Null texts stay null."""
    schema = df.schema

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            if length:
                p[length] = list(p[length])
            for i, t in enumerate(p[text]):
                spans = all_spans(t) if t else []
                if not spans:
                    continue
                bits, at = [], 0
                for a, b, _ in spans:
                    if a >= at:
                        bits += [t[at:a], mark]
                    at = max(at, b)
                p[text][i] = "".join([*bits, t[at:]])
                if length:
                    p[length][i] = len(p[text][i])
            yield p
    return map_rows(df, schema, run)


def digest_of(text: str | None) -> str:
    """SHA-256 of the joined base spans of one text (used by tests)."""
    return hashlib.sha256(_joined(base_spans(text or "")).encode()).hexdigest()
