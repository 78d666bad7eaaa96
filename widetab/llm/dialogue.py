"""Conversation structure repair by weighted CYK interval parsing (operator 11).

A conversation's repaired roles must spell ``(s?(ua)+)?`` (system, user,
assistant). Edits: keep a row (K, 0), give it the role user or assistant (R, 1),
delete it (D, 2; blank and repeated rows must go), insert an empty user or
assistant row anywhere (I, 5); a truncated row that stays costs 5 more.

The repair grammar in Chomsky normal form has a symbol X(p,q) for what leads
from place p of the pattern to place q, with rules X(p,r) → X(p,q) X(q,r), edits
of one row as its terminals, and insertions as derivations of nothing; their
closure is put around every row's terminals beforehand. A span's cell holds,
for each symbol, the minimum (cost, audit). Of two audits of one span with equal
cost neither starts the other (more letters would be insertions, which cost), so
the minimum of joined audits is the join of the minima, and cells combine
exactly. X(p,r) derives a span over every place that splits it, so one
bracketing is enough: spans are combined bottom-up by length, 1, 2, 4 and so on,
n - 1 combinations for n rows.

Rows are dealt by ranges of (conversation, turn, role, text hash), so a
conversation that holds a third of all rows lies in many partitions. A task
streams its rows; a conversation that lies within it and has at most
``SEGMENT`` rows is repaired there and then. Pieces of all others are written as
segments: repeats are found by a grouped first place of (conversation, role,
text), segments get their cells, and cells are combined by partition, then
by 16, 256, ... partitions. The audit goes back to the segments in
slices, which write their repaired rows; only the digest of a conversation's
repaired text is made in sequence, streamed in order.

Defined results: nulls in the damage key, roles and texts are one space
(such a text is blank, such a role fits nothing and must be changed); an empty
role fits nothing either; turns that tie are ordered by role, then by the
text's MD5; rows that repeat whole follow each other, all but the first
are duplicates; a null conv_id is a conversation; a conversation without rows after
damage has zeros, an empty audit and the digest of nothing; an empty table gives
an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.llm.common import SPACES, write_shared
from widetab.session import shuffle_partitions

SEGMENT = 1024
SEGMENT_CHARS = 8_000_000
FAN = 16
REROLE, DROP, INSERT, TRUNCATED = 1, 2, 5, 5
#: Places of the pattern: before all, after s, after u, after a; and what each letter leads to.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
SYMBOLS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_AT = {s: i for i, s in enumerate(SYMBOLS)}
RULES = [(_AT[p, q], _AT[q2, r], _AT[p, r]) for p, q in SYMBOLS for q2, r in SYMBOLS if q == q2]
Cell = list  # per symbol: (cost, audit), or None


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out: Cell = [None] * len(SYMBOLS)
    for i, j, k in RULES:
        a, b = left[i], right[j]
        if a is None or b is None:
            continue
        cost, held = a[0] + b[0], out[k]
        if held is None or cost < held[0]:
            out[k] = (cost, a[1] + b[1])
        elif cost == held[0] and (audit := a[1] + b[1]) < held[1]:
            out[k] = (cost, audit)
    return out


def _cell(found: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [found.get(s) for s in SYMBOLS]


def insertions() -> Cell:
    """What insertions alone derive: the closure of one inserted row."""
    one = {(p, p): (0, "") for p in range(4)}
    for letter in "ua":
        one |= {(p, q): (INSERT, "I") for p, q in STEPS[letter].items()}
    now, last = _cell(one), None
    while now != last:
        now, last = combine(now, now), now
    return now


def terminals(initial: str, must_go: bool, truncated: bool) -> Cell:
    """Edits of one row."""
    found: dict[tuple[int, int], tuple[int, str]] = {(p, p): (DROP, "D") for p in range(4)}
    if not must_go:
        more = TRUNCATED if truncated else 0
        for letter in "sua":
            for p, q in STEPS[letter].items():
                if letter == initial:
                    found[p, q] = (more, "K")
                elif letter != "s":
                    found[p, q] = (more + REROLE, "R")
    return _cell(found)


_INSERTIONS = insertions()
LEAVES = {(c, g, t): combine(combine(_INSERTIONS, terminals(c, g, t)), _INSERTIONS)
          for c in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


def by_span_length(cells: list[Cell]) -> Cell:
    """The cell of a whole sequence, spans doubling in length."""
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation: nothing left, or an end after a."""
    return min(x for x in (cell[_AT[0, 0]], cell[_AT[0, 3]]) if x is not None)


def fault(text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated, or none."""
    said = text.strip(SPACES)
    return "blank" if not said else "duplicate" if seen else "truncated" if said[-1] not in ".!?" else ""


def leaf(role: str, found: str) -> Cell:
    first = role[:1] if role[:1] in STEPS else ""
    return LEAVES[first, found in ("blank", "duplicate"), found == "truncated"]


def repaired(rows: list[tuple[str, str]], audit: str, left: int) -> list[str]:
    """Lines of the repaired rows; ``left`` rows come out from here to the
    conversation's end, so an odd number left makes this one an assistant."""
    out, at = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if left % 2 else "user"
        out.append(f"{role}:{text}")
        left -= 1
    return out


def shape(rows: list[tuple], faults: list[str]) -> dict:
    """Sums of a piece of a conversation: rows (turn, role, text) in order."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return {"n": len(rows), "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"), "illegal": sum(map(_illegal, initials, initials[1:])),
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
            "turns": sum(a != b for a, b in zip(turns, [None, *turns])),
            "begins": initials[0] if rows else None, "ends": initials[-1] if rows else None}


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def joined_shape(a: dict, b: dict) -> dict:
    """The sums of two neighbouring pieces."""
    if not a["n"] or not b["n"]:
        return a if a["n"] else b
    out = {c: a[c] + b[c] for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += _illegal(a["ends"], b["begins"])
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    return out | {"low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"],
                  "begins": a["begins"], "ends": b["ends"]}


def _gaps(s: dict) -> int:
    return 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["turns"]


def damaged(conversations: DataFrame) -> DataFrame:
    """(c, t, r, x, h, times): rows after the damage; ``times`` is 0 for a dropped
    row (which stays as a mark of its conversation), 2 for a repeated one."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    return conversations.select(
        F.col("conv_id").alias("c"), F.col("turn").cast("bigint").alias("t"),
        F.when(kind == 4, F.lit("user")).otherwise(said("role")).alias("r"), text.alias("x"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times")).withColumn("h", F.md5("x"))


SUMS = ("n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, "
        "turns bigint, begins string, ends string")
ROWS = "array<struct<t: bigint, r: string, x: string>>"


def _results(s: dict, cost: int, audit: str, digest: str) -> dict:
    return {"gaps": _gaps(s), "blank": s["blank"], "duplicate": s["duplicate"], "truncated": s["truncated"],
            "illegal": s["illegal"], "cost": cost, "audit": audit, "repaired_sha256": digest}


RESULTS = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string")


def _repair(rows: list[tuple]) -> dict:
    """All of a whole conversation."""
    if not rows:
        return _results(shape([], []), 0, "", hashlib.sha256().hexdigest())
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in rows:
        faults.append(fault(text, (role, text) in seen))
        seen.add((role, text))
    cost, audit = cheapest(by_span_length([leaf(r[1], f) for r, f in zip(rows, faults)]))
    lines = repaired([r[1:] for r in rows], audit, len(audit) - audit.count("D"))
    return _results(shape(rows, faults), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _emit(schema: T.StructType, rows: list[dict]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    return pa.RecordBatch.from_pylist([{f: r.get(f) for f in schema.names} for r in rows], schema=to_arrow_schema(schema))


def _typed(key: T.DataType, rest: str) -> T.StructType:
    return T.StructType([T.StructField("c", key), *T._parse_datatype_string(rest).fields])


def runs(rows: DataFrame, segment: int, chars: int) -> DataFrame:
    """Per conversation that lies within a partition: its results. Per piece of
    another: (pid, seq) and its rows."""
    kind = _typed(rows.schema["c"].dataType, f"whole boolean, {RESULTS}, pid int, seq int, rows {ROWS}")
    parts, order = shuffle_partitions(rows.sparkSession), ["c", "t", "r", "h"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("c", "t", "r", "x", "times")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid, seq, first, cut, size = TaskContext.get().partitionId(), 0, True, False, 0
        key, got, out = None, None, []

        def piece() -> dict:
            nonlocal seq
            seq += 1
            return {"c": key, "whole": False, "pid": pid, "seq": seq, "rows": [{"t": t, "r": r, "x": x} for t, r, x in got]}
        for b in it:
            for r in b.to_pylist():
                if got is not None and r["c"] != key:
                    # The first run may have begun in another partition.
                    out.append(piece() if first or cut else {"c": key, "whole": True, **_repair(got)})
                    got, first, cut = None, False, False
                if got is None:
                    key, got, size = r["c"], [], 0
                elif len(got) >= segment or size >= chars:
                    out.append(piece())
                    got, size, cut = [], 0, True
                got += [(r["t"], r["r"], r["x"])] * r["times"]
                size += len(r["x"]) * r["times"]
                if len(out) >= 256 or size >= chars and out:
                    yield _emit(kind, out)
                    out = []
        if got is not None:
            out.append(piece())                            # the last run may go on elsewhere
        if out:
            yield _emit(kind, out)
    return dealt.mapInArrow(run, kind)


CELLS = "array<struct<cost: bigint, audit: string>>"


def _pack(cell: Cell | None) -> list | None:
    return cell and [None if x is None else {"cost": x[0], "audit": x[1]} for x in cell]


def _unpack(cell: list | None) -> Cell | None:
    return cell and [None if x is None else (x["cost"], x["audit"]) for x in cell]


def segment_cells(pieces: DataFrame) -> DataFrame:
    """Cells and sums of pieces: a row repeats another if its (conversation, role,
    text) has an earlier first place."""
    each = pieces.select("c", "pid", "seq", F.posexplode("rows").alias("pos", "row")) \
        .select("c", F.col("row.r").alias("r"), F.sha2("row.x", 256).alias("x"), F.struct("pid", "seq", "pos").alias("at"))
    firsts = each.groupBy("c", "r", "x").agg(F.min("at").alias("at")).groupBy(
        F.col("at.pid").alias("fp"), F.col("at.seq").alias("fs")).agg(F.collect_list("at.pos").alias("firsts"))
    kind = _typed(pieces.schema["c"].dataType, f"pid int, seq int, {SUMS}, cell {CELLS}, "
                                               "parts array<struct<pid: int, seq: int, n: bigint>>")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(b.num_rows):
                p = b.slice(at, 1).to_pylist()[0]
                rows, new = [(r["t"], r["r"], r["x"]) for r in p["rows"]], set(p["firsts"] or ())
                faults = [fault(r[2], i not in new) for i, r in enumerate(rows)]
                cell = by_span_length([leaf(r[1], f) for r, f in zip(rows, faults)]) if rows else None
                yield _emit(kind, [{"c": p["c"], "pid": p["pid"], "seq": p["seq"], **shape(rows, faults), "cell": _pack(cell),
                                    "parts": [{"pid": p["pid"], "seq": p["seq"], "n": len(rows)}]}])
    return pieces.join(firsts, (F.col("pid") == F.col("fp")) & (F.col("seq") == F.col("fs")), "left") \
        .select("c", "pid", "seq", "rows", "firsts").mapInArrow(run, kind)


def _runs_of(it: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for b in it:
        for r in b.to_pylist():
            if held and any(held[0][k] != r[k] for k in keys):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _joined(pieces: DataFrame, width: int) -> DataFrame:
    """Pieces combined in order within ``width`` partitions of a conversation."""
    kind, parts = pieces.schema, shuffle_partitions(pieces.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _runs_of(it, ["c", "block"]):
            sums = got[0]
            for p in got[1:]:
                sums = joined_shape(sums, p)
            cells = [_unpack(p["cell"]) for p in got if p["cell"]]
            yield _emit(kind, [{**sums, "c": got[0]["c"], "pid": got[0]["pid"], "seq": got[0]["seq"],
                                "cell": _pack(by_span_length(cells)) if cells else None,
                                "parts": [x for p in got for x in p["parts"]]}])
    return pieces.withColumn("block", F.floor(F.col("pid") / width)).repartition(parts, "c", "block") \
        .sortWithinPartitions("c", "block", "pid", "seq").mapInArrow(run, kind)


def long_conversations(pieces: DataFrame) -> DataFrame:
    """Results of conversations that lie in pieces."""
    now = write_shared(segment_cells(pieces), "dialogue-cells", "zstd")
    last = pieces.agg(F.max("pid")).first()[0] or 0
    width = 1
    while True:
        now = write_shared(_joined(now, width), "dialogue-cells", "zstd")
        if width > last:
            break
        width *= FAN
    key = pieces.schema["c"].dataType
    slices = _typed(key, "sp int, ss int, slice string, remaining bigint")
    done = _typed(key, f"{SUMS}, cost bigint, audit string")

    def best(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for p in b.to_pylist():
                cost, audit = cheapest(_unpack(p["cell"])) if p["cell"] else (0, "")
                yield _emit(done, [{**p, "cost": cost, "audit": audit}])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for p in b.to_pylist():
                audit = cheapest(_unpack(p["cell"]))[1] if p["cell"] else ""
                at, left = 0, len(audit) - audit.count("D")
                for i, x in enumerate(p["parts"]):
                    end, rows = at, x["n"]
                    while rows:
                        rows -= audit[end] != "I"
                        end += 1
                    end = len(audit) if i + 1 == len(p["parts"]) else end
                    part = audit[at:end]
                    yield _emit(slices, [{"c": p["c"], "sp": x["pid"], "ss": x["seq"], "slice": part, "remaining": left}])
                    at, left = end, left - len(part) + part.count("D")
    results = write_shared(now.select("c", *[f.split()[0] for f in SUMS.split(", ")], "cell").mapInArrow(best, done),
                           "dialogue-best", "zstd")
    given = now.select("c", "cell", "parts").mapInArrow(cut, slices)
    said = _typed(key, "pid int, seq int, said string")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(b.num_rows):
                p = b.slice(at, 1).to_pylist()[0]
                lines = repaired([(r["r"], r["x"]) for r in p["rows"]], p["slice"], p["remaining"])
                yield _emit(said, [{**p, "said": "\n".join(lines)}])
    texts = pieces.join(given.drop("c"), (F.col("pid") == F.col("sp")) & (F.col("seq") == F.col("ss"))) \
        .select("c", "pid", "seq", "rows", "slice", "remaining").mapInArrow(write, said)
    digests = _typed(key, "repaired_sha256 string")

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, any_yet = (), hashlib.sha256(), False
        for b in it:
            for r in b.to_pylist():
                if held != (r["c"],):
                    if held:
                        yield _emit(digests, [{"c": held[0], "repaired_sha256": digest.hexdigest()}])
                    held, digest, any_yet = (r["c"],), hashlib.sha256(), False
                if r["said"]:
                    digest.update((("\n" if any_yet else "") + r["said"]).encode())
                    any_yet = True
        if held:
            yield _emit(digests, [{"c": held[0], "repaired_sha256": digest.hexdigest()}])
    parts = shuffle_partitions(pieces.sparkSession)
    made = texts.repartition(parts, "c").sortWithinPartitions("c", "pid", "seq").mapInArrow(hashed, digests)
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns")).cast("bigint")
    return results.join(made.withColumnRenamed("c", "dc"), F.col("c").eqNullSafe(F.col("dc"))).select(
        "c", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(conversations: DataFrame, segment: int = SEGMENT, chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): its faults after
    the damage and its cheapest repair."""
    found = write_shared(runs(damaged(conversations), segment, chars), "dialogue-runs", "zstd")
    columns = ["c", *[f.split()[0] for f in RESULTS.split(", ")]]
    whole = found.filter("whole").select(*columns)
    pieces = found.filter("not whole").select("c", "pid", "seq", "rows")
    out = whole if pieces.isEmpty() else whole.unionByName(long_conversations(pieces))
    return out.withColumnRenamed("c", "conv_id")


def _line(state: str, line: str) -> str:
    return f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}"


def _move(state: str, edit: str, cost: str, line: str | None = None, when: str = "true") -> str:
    """A state after an edit, null where the state or the edit is not possible."""
    said = _line(state, line) if line else f"{state}.t"
    return (f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', "
            f"'t': {said}}} END")


def _least(*moves: str) -> str:
    return f"list_min(list_filter([{', '.join(moves)}], lambda z: z IS NOT NULL))"


def _repair_sql() -> str:
    """The same by a left-to-right minimum over the four places of the pattern."""
    may = "NOT must_go AND "
    keep = lambda s, c: _move(s, "K", "more", "role || ':' || text", f"{may}left(role, 1) = '{c}'")
    rerole = lambda s, c: _move(s, "R", "more + 1", f"'{c}:' || text", f"{may}true")
    insert = lambda s, c: _move(s, "I", "5", f"'{c}:'")
    user = [f(s, c) for s in ("s0", "s1", "s3") for f, c in ((keep, "u"), (rerole, "user"))]
    rows = [_move("s0", "D", "2"), _least(_move("s1", "D", "2"), keep("s0", "s")), _least(_move("s2", "D", "2"), *user),
            _least(_move("s3", "D", "2"), keep("s2", "a"), rerole("s2", "assistant"))]
    return rf"""
WITH RECURSIVE tab0(i, step, v) AS (
  SELECT i, 0, i FROM range(256) g(i)
  UNION ALL SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab0 WHERE step < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM tab0 WHERE step = 8),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''),
               lambda z: CAST(unicode(z) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS h
        FROM src, tab),
dam AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE h <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM dam),
dup AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS seen FROM num),
flt AS (SELECT *, said = '' AS blank, said <> '' AND seen AS dup,
               said <> '' AND NOT seen AND right(said, 1) NOT IN ('.', '!', '?') AS trunc FROM dup),
per AS (SELECT conv_id, n, turn, role, text, blank, dup, trunc, blank OR dup AS must_go, CASE WHEN trunc THEN 5 ELSE 0 END AS more,
               coalesce(lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
        FROM flt WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
sums AS (SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
                count(*) FILTER (illegal) AS illegal FROM per GROUP BY conv_id),
ins1 AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0 FROM sums),
start AS (SELECT conv_id, n, s0, CASE WHEN false THEN s0 END AS s1, {insert('s0', 'user')} AS s2 FROM ins1),
walk(conv_id, n, s0, s1, s2, s3) AS (
  SELECT conv_id, n, s0, s1, s2, {insert('s2', 'assistant')} FROM start
  UNION ALL
  SELECT conv_id, n, s0, s1, s2, {_least('s3', insert('s2', 'assistant'))} FROM (
    SELECT conv_id, n, s0, s1, {_least('s2', insert('s0', 'user'), insert('s1', 'user'), insert('s3', 'user'))} AS s2,
           {_least('s3', insert('s2', 'assistant'))} AS s3 FROM (
      SELECT w.conv_id, p.n, {rows[0]} AS s0, {rows[1]} AS s1, {rows[2]} AS s2, {rows[3]} AS s3
      FROM walk w JOIN per p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.n = w.n + 1))),
best AS (SELECT s.*, {_least('s0', 's3')} AS b FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(b.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM k.conv_id"""


REPAIR_SQL = _repair_sql()
