"""Near duplicates: chosen-path set similarity join (operator 7).

1. Each text becomes its set of word shingles (64-bit hashes), the set's
   digest, and ``COORDS`` minwise tokens. Equal sets are one class from here
   on: their links need no search.
2. Independent trees branch the sets: a node chooses one of the coordinates by
   a hash of the node (a second one with probability 1 / similarity − 1, so that
   a pair at the threshold shares about one child per node), and a set goes to
   the child of its minwise token there. Nodes are counted first; those with at
   most ``node_limit`` sets are compared exhaustively on one byte of each minwise token
   (with a margin of four deviations under the threshold) and emit the edges that span what is
   alike; larger ones branch again. Nodes still larger at ``depth`` emit one star.
   A pair is missed only if no tree keeps it together.
3. The edges' components are candidate classes. Links are confirmed on full
   sets: classes of up to ``class_limit`` sets in one task, with those already
   connected skipped. Larger classes go in blocks: every set is compared with its
   class's hubs (the sets closest to the class's most common tokens), tree edges that
   still cross components are confirmed, and a prefix index finds what is left: in
   any fixed order of shingles (those that no hub has come first, being rare) two alike
   sets share one of their first n − ⌈t·n⌉ + 1. A set outside its class's largest component goes
   to the blocks that the index names, lengths and places permitting, and its
   exact intersections with a block's sets come from one count over the block's
   postings. Only links that join components leave a task, no pairs.
4. Confirmed links' components give each document the smallest doc_id.

Links, classes and components stay in tables; the driver sees counts only.

Defined results: null or wordless texts have an empty set and are linked with
nothing (component_id is their own doc_id); null doc_ids never are a component's
smallest id unless it has no other; repeated rows share their component (each
row with the component's id is kept by ``components``; ``drop_near_copies``
keeps one); an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from widetab.llm.common import drop_shared, small_or_shuffled, write_shared
from widetab.session import shuffle_partitions

COORDS = 64
EDGES_PER_TASK = 250_000
MASK = (1 << 64) - 1
_RNG = np.random.default_rng(20240517)
_MUL = _RNG.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordIds(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w)
        return v


_WORDS = _WordIds()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (A-Z
    lower-cased, words split at ASCII white space); one for a shorter text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(width, len(ids))
    h = np.full(len(ids) - k + 1, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        h = _mix((h ^ ids[j:len(ids) - k + 1 + j]) + _STEP)
    return np.unique(h)


def minwise(s: np.ndarray) -> np.ndarray:
    """Minwise tokens of a nonempty set, 16 bits each (of the least element, so
    that they spread evenly whatever the set's size)."""
    best = np.full(COORDS, np.uint64(MASK), dtype=np.uint64)
    for at in range(0, len(s), 4096):
        part = s[at:at + 4096, None] * _MUL + _ADD
        best = np.minimum(best, part.min(axis=0))
    return (_mix(best) & np.uint64(0xFFFF)).astype("<u2")


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 × intersection >= percent × union, of sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _batch(names: list[str], kinds: list[pa.DataType], cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def signed_sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per row: k, th (hash of the text), n (set size), sid (set digest), sig
    (minwise tokens) and low (one byte of each)."""
    src = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    kind = T.StructType([T.StructField("k", src.schema["k"].dataType), T.StructField("th", T.LongType()),
                         T.StructField("n", T.LongType()), T.StructField("sid", T.StringType()),
                         T.StructField("sig", T.BinaryType()), T.StructField("low", T.BinaryType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n, sid, sig, low = [], [], [], []
            for t in b.column("t"):
                s = shingles(t.as_py(), width)
                n.append(len(s))
                sid.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                tokens = minwise(s) if len(s) else None
                sig.append(None if tokens is None else tokens.tobytes())
                low.append(None if tokens is None else tokens.astype("u1").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("th"), pa.array(n, pa.int64()), pa.array(sid, pa.string()),
                 pa.array(sig, pa.binary()), pa.array(low, pa.binary())], names=["k", "th", "n", "sid", "sig", "low"])
    return src.mapInArrow(run, kind)


def _tokens(column: pa.Array) -> np.ndarray:
    """Minwise tokens of a batch as a matrix."""
    if not len(column):
        return np.zeros((0, COORDS), dtype=np.uint64)
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, COORDS).astype(np.uint64)


def _children(nodes: np.ndarray, tokens: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, child nodes): a first coordinate for every row, a second one for
    the nodes whose hash says so."""
    for turn in (0, 1):
        h = _mix(nodes + np.uint64(int(_STEP) * (turn + 1) & MASK))
        on = np.arange(len(nodes)) if not turn else np.flatnonzero(
            (_mix(h) >> np.uint64(11)) < np.uint64(int((1 / similarity - 1) * (1 << 53))))
        coord = (h[on] % np.uint64(COORDS)).astype(np.int64)
        yield on, _mix(nodes[on] ^ _mix(tokens[on, coord] + _STEP * (coord.astype(np.uint64) + np.uint64(7))))


def branch(rows: DataFrame, similarity: float, trees: int = 0) -> DataFrame:
    """Children (node, rid) of rows (node, rid, sig); with ``trees`` the roots
    of that many trees instead of ``node``."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            tokens, rid = _tokens(b.column("sig")), b.column("rid").to_numpy()
            starts = ([np.full(len(rid), _mix(np.array([t + 1], dtype=np.uint64))[0]) for t in range(trees)]
                      or [b.column("node").to_numpy().view(np.uint64)])
            for nodes in starts:
                for on, child in _children(nodes, tokens, similarity):
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(rid[on])],
                                                     names=["node", "rid"])
    return rows.mapInArrow(run, "node bigint, rid bigint")


def _groups(it: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Runs of rows of one key, from batches sorted by it."""
    held: list[dict] = []
    for b in it:
        for r in b.to_pylist():
            if held and held[0][key] != r[key]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


class _Sets:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


EDGE = "a bigint, b bigint"
_EDGE = (["a", "b"], [pa.int64(), pa.int64()])


def compare_nodes(leaves: DataFrame, least: int) -> DataFrame:
    """Edges that span, within each small node, the sets whose minwise tokens' bytes
    agree in at least ``least`` places (every pair of the node is compared)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _groups(it, "node"):
            sig = np.frombuffer(b"".join([r["low"] for r in rows]), dtype=np.uint8).reshape(-1, COORDS)
            sets = _Sets(len(rows))
            for i in range(1, len(rows)):
                for j in np.flatnonzero((sig[:i] == sig[i]).sum(axis=1) >= least).tolist():
                    sets.union(i, j)
            out += [(rows[r]["rid"], rows[i]["rid"]) for i in range(len(rows)) if (r := sets.find(i)) != i]
            if len(out) > 4096:
                yield _batch(*_EDGE, [list(c) for c in zip(*out)])
                out = []
        if out:
            yield _batch(*_EDGE, [list(c) for c in zip(*out)])
    parts = shuffle_partitions(leaves.sparkSession)
    return leaves.repartition(parts, "node").sortWithinPartitions("node", "rid").mapInArrow(run, EDGE)


def candidate_edges(reps: DataFrame, similarity: float, trees: int, node_limit: int, depth: int) -> DataFrame:
    """Edges between sets (rid) that some tree brings together as alike."""
    least = max(1, ceil(COORDS * (similarity - 4 * sqrt(similarity * (1 - similarity) / COORDS))))
    sig, low = reps.select("rid", "sig"), reps.select("rid", "low")
    rows = write_shared(branch(sig, similarity, trees), "near-rows")
    levels: list[DataFrame] = []
    for level in range(1, depth + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("rid").alias("least")).filter("size > 1")
        levels.append(write_shared(rows.join(sizes, "node"), "near-sized"))
        drop_shared(rows)
        large = levels[-1].filter(F.col("size") > node_limit)
        if level == depth or large.isEmpty():
            break
        rows = write_shared(branch(large.select("node", "rid").join(sig, "rid"), similarity), "near-rows")
    # The small nodes of all levels are compared in one pass; nodes still large are stars.
    leaves, stars = (reduce(DataFrame.unionByName, [x.filter(c) for x in some]) for some, c in (
        (levels, F.col("size") <= node_limit), (levels[-1:], (F.col("size") > node_limit) & (F.col("rid") != F.col("least")))))
    edges = compare_nodes(leaves.select("node", "rid").join(low, "rid"), least)
    out = write_shared(edges.unionByName(stars.select(F.col("least").alias("a"), F.col("rid").alias("b"))).distinct(), "near-edges")
    drop_shared(*levels)
    return out


def _is_stars(edges: DataFrame) -> bool:
    """Every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    sums = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.filter("out > 1 or (out = 1 and into = 1)").isEmpty()


def _forest(edges: DataFrame) -> tuple[DataFrame, int]:
    """(u, v) stars of the edges of each task, and the number of tasks: at most
    ``EDGES_PER_TASK`` edges go to one, so what a task holds is bounded."""
    tasks = max(1, -(-edges.count() // EDGES_PER_TASK))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def find(i: int) -> int:
            while (j := up.setdefault(i, i)) != i:
                up[i] = i = up[j] if j in up else j
            return i
        for b in it:
            for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
                x, y = find(x), find(y)
                up[max(x, y)] = min(x, y)
        out = [(i, r) for i in up if (r := find(i)) != i]
        if out:
            yield _batch(["u", "v"], [pa.int64(), pa.int64()], [list(c) for c in zip(*out)])
    return edges.select("a", "b").repartition(tasks).mapInArrow(run, "u bigint, v bigint"), tasks


def connected(edges: DataFrame) -> DataFrame:
    """(id, low): smallest id of each node's component. Tasks reduce their share of
    the edges to stars; large-star and small-star steps join those until all
    components are stars. Nodes without edges are not listed."""
    stars, tasks = _forest(edges)
    now = write_shared(stars.distinct() if tasks > 1 else stars, "near-star")
    while tasks > 1 and not _is_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = write_shared(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .distinct(), "near-star")
        drop_shared(now)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        now = write_shared(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                           .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "near-star")
        drop_shared(large)
    out = write_shared(now.select(F.col("u").alias("id"), F.col("v").alias("low"))
                       .unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("low")).distinct()), "near-classes")
    drop_shared(now)
    return out


def confirm_classes(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links that span each small class: rows (cls, rid, t)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _groups(it, "cls"):
            full = [shingles(r["t"], width) for r in got]
            order = sorted(range(len(got)), key=lambda i: len(full[i]))
            sets, done = _Sets(len(got)), []
            for i in order:
                for j in reversed(done):                     # nearest sizes first
                    if 100 * len(full[j]) < percent * len(full[i]):
                        break
                    if sets.find(i) != sets.find(j) and alike(full[i], full[j], percent):
                        sets.union(i, j)
                done.append(i)
            out = [(got[r]["rid"], got[i]["rid"]) for i in range(len(got)) if (r := sets.find(i)) != i]
            if out:
                yield _batch(*_EDGE, [list(c) for c in zip(*out)])
    parts = shuffle_partitions(rows.sparkSession)
    return rows.repartition(parts, "cls").sortWithinPartitions("cls", "rid").mapInArrow(run, EDGE)


def _hubs(members: DataFrame, reps: DataFrame, hubs: int) -> DataFrame:
    """(cls, rid) of the sets that agree most with their class's most common tokens."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            tokens = _tokens(b.column("sig")).astype(np.int64)
            n = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column("cls").to_numpy(), COORDS)), pa.array(np.repeat(b.column("rid").to_numpy(), COORDS)),
                 pa.array(np.tile(np.arange(COORDS), n)), pa.array(tokens.reshape(-1))], names=["cls", "rid", "j", "v"])
    each = members.join(reps.select("rid", "sig"), "rid").select("cls", "rid", "sig").mapInArrow(
        run, "cls bigint, rid bigint, j bigint, v bigint")
    modes = each.groupBy("cls", "j", "v").agg(F.count("*").alias("n")).groupBy("cls", "j").agg(
        F.max(F.struct("n", "v")).alias("top")).select("cls", "j", F.col("top.v").alias("v"))
    score = each.join(F.broadcast(modes) if modes.count() <= 1_000_000 else modes, ["cls", "j", "v"]) \
        .groupBy("cls", "rid").agg(F.count("*").alias("n"))
    # Best per class: keep each partition's best before the class meets (row_number <= k is pushed down).
    order = W.partitionBy("cls").orderBy(F.desc("n"), "rid")
    return score.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= hubs).select("cls", "rid")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(cls, size, rid, n, s): each set's sorted hashes, of rows (cls, size, rid, t)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                sets = [shingles(t.as_py(), width) for t in part.column("t")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), part.column("size"), part.column("rid"), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], names=["cls", "size", "rid", "n", "s"])
    return texts.select("cls", "size", "rid", "t").mapInArrow(run, "cls bigint, size bigint, rid bigint, n bigint, s binary")


def _hashes(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype=np.uint64)


ASKED = "a bigint, b bigint, place int, n int"


def against_hubs(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (block, hub flag, rid, s), each block with all hubs of its class first:
    links (a hub, b set; place −1) of each set to all hubs alike, those that earlier
    links of the block imply left out, and each set's prefix (a set, b shingle, its
    place, set size)."""
    def prefix(s: np.ndarray, known: np.ndarray) -> list[int]:
        return _ordered(s, known)[:len(s) + 1 - int(-(-percent * len(s) // 100))].view(np.int64).tolist()

    def in_block(rows: Iterator[dict]) -> Iterator[tuple[int, int, int, int]]:
        pivots: list[tuple[int, np.ndarray, bool]] = []
        known, sets = None, _Sets(0)

        def ready() -> Iterator[tuple[int, int, int, int]]:
            # The class's order: shingles of hubs after all others, else by another hash.
            nonlocal known
            known = np.unique(np.concatenate([p for _, p, _ in pivots]))
            for rid, p, first in pivots:                     # a hub's prefix comes from the class's first block
                for at, g in enumerate(prefix(p, known) if first else ()):
                    yield rid, g, at, len(p)
        for r in rows:
            s = _hashes(r["s"])
            if not r["hub"] and known is None:
                yield from ready()
            hits: list[int] = []
            for i, (rid, p, _) in enumerate(pivots):
                if all(sets.find(i) != sets.find(j) for j in hits) and alike(p, s, percent):
                    hits.append(i)
                    yield rid, r["rid"], -1, 0
            if r["hub"]:
                sets.up.append(len(pivots))
                hits.append(len(pivots))
                pivots.append((r["rid"], s, r["first"]))
            else:
                for at, g in enumerate(prefix(s, known)):
                    yield r["rid"], g, at, len(s)
            for i in hits[1:]:                               # the set bridges its hubs
                sets.union(hits[0], i)
        if known is None:
            yield from ready()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in it for r in b.to_pylist())
        out: list[tuple[int, int, int, int]] = []
        for _, got in groupby(rows, key=lambda r: r["block"]):
            for x in in_block(got):
                out.append(x)
                if len(out) >= 100_000:
                    yield _batch(["a", "b", "place", "n"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()], [list(c) for c in zip(*out)])
                    out = []
        if out:
            yield _batch(["a", "b", "place", "n"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()], [list(c) for c in zip(*out)])
    parts = shuffle_partitions(rows.sparkSession)
    return rows.repartition(parts, "block").sortWithinPartitions("block", F.desc("hub"), "rid").mapInArrow(run, ASKED)


def _ordered(s: np.ndarray, known: np.ndarray) -> np.ndarray:
    common = np.isin(s, known, assume_unique=True)
    return s[np.lexsort((_mix(s), common))]


def _parts(large: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, rid, part): each set's component by the links so far."""
    found = connected(links)
    out = write_shared(large.select("cls", "rid").join(found.select(F.col("id").alias("rid"), "low"), "rid", "left")
                       .select("cls", "rid", F.coalesce("low", "rid").alias("part")), "near-parts")
    drop_shared(found)
    return out


def _across(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs of ``parts``' sets whose ends lie in different components."""
    end = lambda c: parts.select(F.col("rid").alias(c), F.col("part").alias(f"{c}_part"))
    return pairs.join(end("a"), "a").join(end("b"), "b").filter("a_part <> b_part").select("a", "b")


def _outside_largest(parts: DataFrame) -> DataFrame:
    """The rows of ``parts`` outside their class's largest component: every
    pair across components has an end among them."""
    sizes = parts.groupBy("cls", "part").agg(F.count("*").alias("n"))
    largest = write_shared(sizes.groupBy("cls").agg(F.max(F.struct("n", "part")).alias("top"))
                           .select("cls", F.col("top.part").alias("largest")), "near-largest")
    return parts.join(small_or_shuffled(largest, 32), "cls").filter("part <> largest").select("cls", "rid", "part")


def _asked_blocks(rest: DataFrame, prefixes: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(rid, block): where a set outside the largest component may have a partner.
    Alike sets share a shingle of both prefixes; the first such leaves at most the
    rest of either set in common. A block's entry for a shingle keeps the greatest
    rest and the least size of its sets that have it there."""
    index = prefixes.join(blocks.select(F.col("rid").alias("a"), "cls", "block"), "a")
    entries = index.groupBy("cls", F.col("b").alias("shingle"), "block").agg(
        F.max(F.col("n") - F.col("place")).alias("most"), F.min("n").alias("least"), F.max("n").alias("greatest"))
    asking = index.join(rest.select(F.col("rid").alias("a")), "a").select(
        F.col("a").alias("rid"), F.col("cls").alias("acls"), F.col("b").alias("ask"), "n", (F.col("n") - F.col("place")).alias("left"))
    low = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    return asking.join(entries, (F.col("acls") == F.col("cls")) & (F.col("ask") == F.col("shingle"))) \
        .filter((F.col("greatest") * 100 >= F.col("n") * percent) & (F.col("least") * percent <= F.col("n") * 100)
                & (F.least("left", "most") * (100 + percent) >= (F.col("n") + low) * percent)) \
        .select("rid", "block").distinct()


def confirm_in_blocks(asked: DataFrame, there: DataFrame, percent: int) -> DataFrame:
    """Links (a asked, b of the block) that join components within each block:
    rows (block, part, rid, s), ``there`` held, ``asked`` compared with all held."""
    rows = there.select("block", F.lit(False).alias("asks"), "part", "rid", "s").unionByName(
        asked.select("block", F.lit(True).alias("asks"), "part", "rid", "s"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rids, held, part, index = None, [], [], [], None
        up: dict[int, int] = {}

        def find(i: int) -> int:
            while up.setdefault(i, i) != i:
                up[i] = up[up[i]]
                i = up[i]
            return i
        for b in it:
            out = []
            for r in b.to_pylist():
                if r["block"] != block:
                    block, rids, held, part, index, up = r["block"], [], [], [], None, {}
                if not r["asks"]:
                    rids.append(r["rid"])
                    held.append(_hashes(r["s"]))
                    part.append(r["part"])
                    continue
                if not rids:
                    continue
                if index is None:                            # the block's postings
                    sizes = np.array([len(h) for h in held])
                    tokens, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
                    order = np.argsort(tokens, kind="stable")
                    keys, starts = np.unique(tokens[order], return_index=True)
                    index = keys, np.append(starts, len(tokens)), owner[order], sizes
                keys, starts, owner, sizes = index
                s = _hashes(r["s"])
                at = np.searchsorted(keys, s)
                at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == s)]
                n = starts[at + 1] - starts[at]
                spread = np.arange(int(n.sum())) + np.repeat(starts[at] - (np.cumsum(n) - n), n)
                both = np.bincount(owner[spread], minlength=len(sizes))
                for i in np.flatnonzero(100 * both >= percent * (sizes + len(s) - both)).tolist():
                    x, y = find(r["part"]), find(part[i])
                    if x != y:
                        up[max(x, y)] = min(x, y)
                        out.append((r["rid"], rids[i]))
            if out:
                yield _batch(*_EDGE, [list(c) for c in zip(*out)])
    parts = shuffle_partitions(there.sparkSession)
    return rows.repartition(parts, "block").sortWithinPartitions("block", "asks", "rid").mapInArrow(run, EDGE)


def confirm_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are alike; sizes are compared before sets are shipped."""
    size = lambda c: sets.select(F.col("rid").alias(c), F.col("n").alias(f"n{c}"))
    fit = pairs.join(size("a"), "a").join(size("b"), "b").filter(
        (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent))
    both = (fit.join(sets.select(F.col("rid").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("rid").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [(r["a"], r["b"]) for r in b.to_pylist() if alike(_hashes(r["sa"]), _hashes(r["sb"]), percent)]
            if out:
                yield _batch(*_EDGE, [list(c) for c in zip(*out)])
    return both.mapInArrow(run, EDGE)


def large_class_links(sets: DataFrame, reps: DataFrame, edges: DataFrame, percent: int, class_limit: int, hubs: int) -> DataFrame:
    """Links that span the components of every large class: ``sets`` as ``full_sets`` gives them."""
    members = sets.select("cls", "rid", "size")
    best = write_shared(_hubs(members.select("cls", "rid"), reps, hubs), "near-hubs")
    number = F.pmod(F.xxhash64("rid"), F.ceil(F.col("size") / class_limit))
    blocks = write_shared(members.select("cls", "rid", number.alias("number"), F.xxhash64("cls", number).alias("block")), "near-blocks")
    all_blocks = blocks.select("cls", "block", "number").distinct()
    lowest = all_blocks.groupBy("cls").agg(F.min("number").alias("low"))
    plain = blocks.select("rid", "block", F.lit(False).alias("hub"), F.lit(False).alias("first"))
    hubbed = best.join(all_blocks, "cls").join(lowest, "cls").select(
        "rid", "block", F.lit(True).alias("hub"), (F.col("number") == F.col("low")).alias("first"))
    # A hub is in every block of its class as a hub, and not again as a member of its own.
    dealt = hubbed.unionByName(plain.join(best.select("rid"), "rid", "left_anti"))
    asked = write_shared(against_hubs(sets.select("rid", "s").join(dealt, "rid"), percent), "near-asked")
    at_hubs = asked.filter("place < 0").select("a", "b").distinct()
    # Tree edges join most of what the hubs leave apart; they are as many as the sets, not their pairs.
    parts = _parts(members, at_hubs)
    by_edge = write_shared(confirm_pairs(_across(edges, parts), sets, percent), "near-links")
    drop_shared(parts)
    linked = at_hubs.unionByName(by_edge)
    # What still crosses components, through the prefix index.
    parts = _parts(members, linked)
    rest = write_shared(_outside_largest(parts), "near-rest")
    out = linked
    if not rest.isEmpty():
        goes = write_shared(_asked_blocks(rest, asked.filter("place >= 0"), blocks, percent), "near-goes")
        asks = goes.join(rest.select("rid", "part"), "rid").join(sets.select("rid", "s"), "rid")
        there = blocks.select("rid", "block").join(goes.select("block").distinct(), "block", "left_semi") \
            .join(parts.select("rid", "part"), "rid").join(sets.select("rid", "s"), "rid")
        out = linked.unionByName(confirm_in_blocks(asks, there, percent))
    out = write_shared(out, "near-links")
    drop_shared(best, blocks, asked, by_edge, parts, rest)
    return out


def confirmed_links(docs: DataFrame, key: str, text: str, reps: DataFrame, edges: DataFrame, classes: DataFrame, width: int,
                    percent: int, class_limit: int, hubs: int) -> DataFrame:
    """Links on full sets that span the components of every candidate class."""
    size = classes.groupBy(F.col("low").alias("cls")).agg(F.count("*").alias("size"))
    members = write_shared(classes.withColumnRenamed("low", "cls").join(size, "cls")
                           .join(reps.select(F.col("rid").alias("id"), "k", "th"), "id")
                           .select(F.col("id").alias("rid"), "cls", "size", F.col("k").alias("mk"), F.col("th").alias("mth")),
                           "near-members")
    asked = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))

    def texts(some: DataFrame) -> DataFrame:
        return asked.join(small_or_shuffled(some, 64), F.col("k").eqNullSafe(F.col("mk")) & (F.col("th") == F.col("mth"))) \
            .select("rid", "cls", "size", "t")
    # Rows that repeat a member (same key and text) only link it with itself.
    links = write_shared(confirm_classes(texts(members.filter(F.col("size") <= class_limit)).select("cls", "rid", "t"), width, percent),
                         "near-links")
    large = members.filter(F.col("size") > class_limit)
    if large.isEmpty():
        drop_shared(members)
        return links
    sets = write_shared(full_sets(texts(large).dropDuplicates(["rid"]), width), "near-full")
    more = large_class_links(sets, reps, edges, percent, class_limit, hubs)
    drop_shared(sets, members)
    return links.unionByName(more)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
               trees: int = 12, node_limit: int = 128, depth: int = 4, class_limit: int = 256, hubs: int = 8) -> DataFrame:
    """Per row: key, th (hash of the text), n_shingles, component_id, kept."""
    base = write_shared(signed_sets(docs, key, text, width), "near-sets")
    # One row per distinct set; rid is fixed by being written.
    groups = base.filter("n > 0").groupBy("sid").agg(
        F.min(F.struct(F.col("k").isNull().alias("z"), "k", "th")).alias("first"), F.first("sig").alias("sig"), F.first("low").alias("low"),
        F.count("*").alias("copies"))
    reps = write_shared(groups.select("sid", F.col("first.k").alias("k"), F.col("first.th").alias("th"), "sig", "low", "copies",
                                      F.monotonically_increasing_id().alias("rid")), "near-reps")
    edges = candidate_edges(reps, percent / 100, trees, node_limit, depth)
    classes = connected(edges)
    links = confirmed_links(docs, key, text, reps, edges, classes, width, percent, class_limit, hubs)
    comp = connected(links)
    drop_shared(edges, classes)
    named = comp.join(reps.select("sid", "k", F.col("rid").alias("id")), "id")
    lowest = named.groupBy("low").agg(F.min("k").alias("component"))
    joined = named.join(lowest, "low").select("sid", "component")
    # Sets with copies but without a link; all other documents are their own component.
    alone = reps.filter("copies > 1").join(joined.select("sid"), "sid", "left_anti").select("sid", F.col("k").alias("component"))
    table = write_shared(joined.unionByName(alone).withColumnRenamed("sid", "csid"), "near-components")
    drop_shared(comp, reps)
    got = base.select("k", "th", "n", "sid").join(small_or_shuffled(table, 120), F.col("sid") == F.col("csid"), "left")
    component = F.when(F.col("csid").isNotNull(), F.col("component")).otherwise(F.col("k"))
    out = got.select(F.col("k").alias(key), "th", F.col("n").alias("n_shingles"), component.alias("component_id"),
                     F.col("k").eqNullSafe(component).alias("kept"))
    out.reads = (base, table)
    return out


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id;
    of rows that repeat a kept id with an equal text, one stays."""
    made = components(docs, key, text, **options)
    found = write_shared(made.withColumnRenamed(key, "fk"), "near-found")
    drop_shared(*made.reads)
    # Kept rows of one component that share its id: one text stays, and one row of it.
    kept = found.filter("kept and n_shingles > 0")
    shared = write_shared(kept.groupBy("component_id").agg(F.count("*").alias("rows"), F.min("th").alias("rth"))
                          .filter("rows > 1").select(F.col("component_id").alias("rk"), "rth"), "near-shared")
    others = kept.join(small_or_shuffled(shared, 32), F.col("fk").eqNullSafe(F.col("rk"))).filter("th <> rth")
    gone = write_shared(found.filter("not kept").select("fk", "th").unionByName(others.select("fk", "th")).distinct(), "near-gone")
    # Rows travel whole in one column, so no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("rowkey"),
                       F.xxhash64(F.col(f"`{text}`")).alias("rowhash"))
    left = rows.join(small_or_shuffled(gone, 32), F.col("rowkey").eqNullSafe(F.col("fk")) & (F.col("rowhash") == F.col("th")),
                     "left_anti")
    if shared.isEmpty():
        drop_shared(found)
        return left.select("row.*")
    tagged = left.join(small_or_shuffled(shared, 32), F.col("rowkey").eqNullSafe(F.col("rk")) & (F.col("rowhash") == F.col("rth")),
                       "left")
    once = tagged.filter("rth is not null").dropDuplicates(["rowkey"])
    return tagged.filter("rth is null").select("row").unionByName(once.select("row")).select("row.*")


COMPONENTS_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
l AS (SELECT x AS u, y AS v FROM e UNION SELECT y, x FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.v, r.root FROM r JOIN l ON l.u = r.id),
m AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.id = d.doc_id
"""
