"""Boosted trees grown in stages from any margin.

Second-order boosting as Spark jobs. Features are binned once (quantile edges, a
bin of their own for missing cells) and written as one byte a cell. A level of a
tree is one job: tasks sum gradients and Hessians per (node, feature, bin), the
sums meet by feature, where the best cut of every node is found, and the driver
receives one row per node. Leaf values are Newton steps, so a tree is finished
with its last level and no pass over the rows follows it.

Rows carry the margin they had when their stage began; the trees of the running
stage (at most ``stage``) are applied on the way. After a stage the margins are
written and the table before it is deleted, so neither plans nor tables grow
with the number of rounds. Any column can be the first margin: boosting goes on
from another model's output, all on the margin scale.

Rounds are judged by validation AUC. A stage's rounds are counted in one pass into
score bins (positives, negatives, least and greatest margin), which add up
over tasks; the AUC of bins is off by at most the pairs that share a bin of
unequal margins, and that bound is kept for every round. Boosting stops after
``patience`` rounds without a better one; the rounds that the bounds leave in
question are then decided by their exact AUC.

Gradients are summed as whole numbers (``SCALE`` steps a unit), so trees do not
depend on how rows lie in partitions. A row's sampling is a hash of its key and
the round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.operators._util import chunks, few_tasks, qcol, stored
from widetab.operators.metrics import auc
from widetab.session import discard

SCALE = float(1 << 24)
SCORE_BINS = 1 << 14
HISTOGRAM_BYTES = 128 << 20
COLUMNS_PER_AGGREGATE = 200
MASKED_NODES = 255
EXACT_AT_ONCE = 8


@dataclass(frozen=True)
class BoostParams:
    """Names follow the usual ones of boosted trees; ``min_rows`` bounds a leaf's
    rows, ``min_child_weight`` its Hessian."""

    eta: float = 0.3
    nrounds: int = 100
    max_depth: int = 6
    lam: float = 1.0
    alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_rows: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    max_bins: int = 64
    seed: int = 0
    objective: str = "logistic"          # or "squared"

    @staticmethod
    def of(params: dict | BoostParams | None) -> BoostParams:
        if isinstance(params, BoostParams):
            return params
        known = {"lambda": "lam", "reg_lambda": "lam", "reg_alpha": "alpha"}
        return BoostParams(**{known.get(k, k): v for k, v in (params or {}).items()})


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2i + 1 and 2i + 2. A feature of -1
    is a leaf; a row goes left if its bin is at most ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (1 << depth + 1) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int16), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of binned features, x[feature, row]."""
        if len(self.feature) <= MASKED_NODES:
            return self._masked(x)
        n = x.shape[1]
        at, flat, rows = np.zeros(n, dtype=np.int64), x.reshape(-1), np.arange(n)
        # Feature, cut and side of missing cells (bin 0) as one table per node: leaves keep their rows.
        inner = self.feature >= 0
        if not inner[0]:
            return at
        place = np.where(inner, self.feature, 0).astype(np.int64) * n
        cut = np.where(inner, self.cut, -1)
        for _ in range(int(len(self.feature) + 1).bit_length() - 2):
            v = flat[place[at] + rows]
            left = np.where(v == 0, self.missing_left[at], v <= cut[at])
            at = np.where(inner[at], 2 * at + 2 - left, at)
        return at

    def _masked(self, x: np.ndarray) -> np.ndarray:
        """The same by one mask of rows per node, on bytes."""
        at, rows = np.zeros(x.shape[1], dtype=np.uint8), {0: np.ones(x.shape[1], dtype=bool)}
        for i in np.flatnonzero(self.feature >= 0).tolist():       # a parent comes before its children
            v, cut = x[self.feature[i]], int(self.cut[i])
            # Missing cells, bin 0, become the largest byte where they go right.
            left = rows[i] & (v <= np.uint8(cut) if self.missing_left[i] else v - np.uint8(1) <= np.uint8(cut - 1))
            rows[2 * i + 1], rows[2 * i + 2] = left, rows.pop(i) ^ left
        for i, here in rows.items():
            at += here.view(np.uint8) * np.uint8(i)
        return at


def bin_edges(df: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Quantile edges per feature, at most ``max_bins`` - 1 each (approximate
    quantiles of partial summaries; a bin holds values up to its edge). One task
    merges the summaries, so there are two per core and not one per partition."""
    x = df.select(vector_to_array(features).alias("x"))
    first = x.select(F.size("x").alias("p")).first()
    if first is None:
        raise ValueError("no rows to fit")
    at = [i / max_bins for i in range(1, max_bins)]
    edges: list[np.ndarray] = []
    x = few_tasks(x)
    for part in chunks(list(range(first["p"])), COLUMNS_PER_AGGREGATE):
        row = x.agg(*[F.percentile_approx(F.nanvl(F.col("x")[i], F.lit(None)), at, 10_000).alias(f"q{i}") for i in part]).first()
        edges += [np.unique(np.array(row[f"q{i}"] or [], dtype=float)) for i in part]
    return edges


def _bins(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, dtype=np.uint8)
    for f, e in enumerate(edges):
        v = x[:, f]
        out[:, f] = np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v))
    return out


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, p)


CHUNK_ROWS = 1 << 14


def _packed(y: np.ndarray, w: np.ndarray, m0: np.ndarray, m: np.ndarray, u: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """One row of the stored table: a chunk of rows, its bins feature by feature."""
    parts = [np.ascontiguousarray(v).tobytes() for v in (y, w, m0, m, u, x.T)]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in parts], names=_NAMES)


def _binned(df: DataFrame, label: str, features: str, edges: list[np.ndarray], margin: Column, weight: Column,
            key: str | None) -> DataFrame:
    """(y, w, m0, m, u, x): label, weight, first and present margin, the row's
    random number and its bins, ``CHUNK_ROWS`` rows packed into one; rows
    without a label are left out. A fit reads the table once a level, and packed
    rows go to Python as they lie."""
    x = vector_to_array(features)
    src = df.filter(qcol(label).isNotNull()).select(
        qcol(label).cast("double").alias("y"), weight.cast("double").alias("w"), margin.cast("double").alias("m"),
        F.xxhash64(qcol(key).cast("string") if key else x).alias("u"), x.alias("x"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0
        for b in it:
            m = b.column("m").to_numpy()
            held.append((b.column("y").to_numpy(), b.column("w").to_numpy(), m, m, b.column("u").to_numpy(),
                         _bins(_matrix(b.column("x"), len(edges)), edges)))
            rows += b.num_rows
            if rows >= CHUNK_ROWS:
                yield _packed(*map(np.concatenate, zip(*held)))
                held, rows = [], 0
        if rows:
            yield _packed(*map(np.concatenate, zip(*held)))
    return src.mapInArrow(run, _ROW)


_ROW = "y binary, w binary, m0 binary, m binary, u binary, x binary"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _numbers(b: pa.RecordBatch, column: str, kind: str = "<f8") -> Iterator[np.ndarray]:
    for v in b.column(column):
        yield np.frombuffer(v.as_buffer(), dtype=kind)


def _held(b: pa.RecordBatch, p: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
    """The chunks of a batch; bins are x[feature, row]. ``u`` is None if not read."""
    us = _numbers(b, "u", "<u8") if "u" in b.schema.names else repeat(None)
    for y, w, m, u, x in zip(_numbers(b, "y"), _numbers(b, "w"), _numbers(b, "m"), us, _numbers(b, "x", "u1")):
        yield y, w, m, u, x.reshape(p, -1)


def _unit(u: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per row and round."""
    z = u + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))


def _derivatives(y: np.ndarray, m: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return m - y, np.ones(len(y))
    p = _sigmoid(m)
    return p - y, np.maximum(p * (1 - p), 1e-16)


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_cuts(hist: np.ndarray, q: BoostParams) -> list[tuple]:
    """Per node of one feature: (gain, cut, missing_left, sums left of the cut,
    sums of the node), for hist[node, bin] = (gradient, Hessian, rows)."""
    total = hist.sum(axis=1)
    missing = hist[:, 0]
    below = np.cumsum(hist[:, 1:], axis=1)[:, :-1]                      # bins 1..cut
    score = lambda s: _shrunk(s[..., 0], q.alpha) ** 2 / (s[..., 1] + q.lam)
    found = []
    for left_too in (False, True):
        left = below + missing[:, None] if left_too else below
        right = total[:, None] - left
        good = ((left[..., 1] >= q.min_child_weight) & (right[..., 1] >= q.min_child_weight)
                & (left[..., 2] >= max(1, q.min_rows)) & (right[..., 2] >= max(1, q.min_rows)))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(good, score(left) + score(right) - score(total)[:, None], -np.inf)
        found.append((gain, left))
    out = []
    for n in range(len(hist)):
        if not below.shape[1]:
            out.append((-np.inf, 0, False, np.zeros(3), total[n]))
            continue
        at = [int(g[n].argmax()) for g, _ in found]
        side = int(found[1][0][n, at[1]] > found[0][0][n, at[0]])
        gain, left = found[side]
        out.append((float(gain[n, at[side]]), at[side] + 1, bool(side), left[n, at[side]], total[n]))
    return out


_CUT = ("node int, gain double, feature int, cut int, missing_left boolean, gl double, hl double, nl double, "
        "g double, h double, n double")


def _level(data: DataFrame, trees: list[Tree], tree: Tree, frontier: list[int], columns: list[int], p: int,
           bins: int, number: int, q: BoostParams) -> list:
    """The best cut of each node of the frontier: one row per node."""
    place = np.full(len(tree.feature), -1)
    place[frontier] = np.arange(len(frontier))
    size = len(frontier) * bins

    def sums(part: list[int]):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((len(part), 3, size))
            for y, w, m, u, x in (chunk for b in it for chunk in _held(b, p)):
                at = place[tree.nodes(x)]
                on = at >= 0
                if q.subsample < 1:
                    on &= _unit(u, q.seed * 1_000_003 + number) < q.subsample
                if not on.all():
                    at, y, w, m, x = at[on], y[on], w[on], m[on], x[:, on]
                for t in trees:
                    m = m + q.eta * t.value[t.nodes(x)]
                g, h = _derivatives(y, m, q.objective)
                at = at * bins
                # Whole numbers: sums are exact and the same in any order.
                g, h = np.rint(g * w * SCALE), np.rint(h * w * SCALE)
                for i, f in enumerate(part):
                    k = at + x[f]
                    held[i, 0] += np.bincount(k, weights=g, minlength=size)
                    held[i, 1] += np.bincount(k, weights=h, minlength=size)
                    held[i, 2] += np.bincount(k, minlength=size)
            if held.any():
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([s.tobytes() for s in held], pa.binary())],
                                                 names=["feature", "sums"])
        return run

    def cuts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in it:
            for f, s in zip(b.column("feature").to_pylist(), b.column("sums")):
                got = np.frombuffer(s.as_buffer(), dtype=float)
                held[f] = held[f] + got if f in held else got
        top: dict[int, tuple] = {}
        for f in sorted(held):
            hist = np.moveaxis(held[f].reshape(3, len(frontier), bins), 0, 2) / np.array([SCALE, SCALE, 1.0])
            for n, (gain, cut, left_too, left, total) in zip(frontier, best_cuts(hist, q)):
                if n not in top or gain > top[n][1]:
                    top[n] = (n, gain, f, cut, left_too, *left, *total)
        if top:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*top.values())],
                                             names=[c.split()[0] for c in _CUT.split(", ")]).cast(_arrow(_CUT))
    best: dict[int, object] = {}
    # The random numbers are read for sampling only, the first margins never.
    data = few_tasks(data.select("y", "w", "m", *["u"] * (q.subsample < 1), "x"))
    for part in chunks(columns, max(1, HISTOGRAM_BYTES // (size * 24))):
        # Each task that sums features returns its best cut of every node.
        for r in data.mapInArrow(sums(part), "feature int, sums binary").repartition("feature").mapInArrow(cuts, _CUT).collect():
            if r["node"] not in best or (r["gain"], -r["feature"]) > (best[r["node"]]["gain"], -best[r["node"]]["feature"]):
                best[r["node"]] = r
    return list(best.values())


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(_parsed(schema))


_PARSED: dict[str, T.StructType] = {}


def _parsed(schema: str) -> T.StructType:
    kinds = {"int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "bigint": T.LongType()}
    if schema not in _PARSED:
        _PARSED[schema] = T.StructType([T.StructField(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    return _PARSED[schema]


def grow_tree(data: DataFrame, trees: list[Tree], p: int, number: int, q: BoostParams) -> Tree:
    """One tree on the margins of ``data`` and of the stage's earlier trees."""
    rng = np.random.default_rng([q.seed, number])
    columns = sorted(rng.permutation(p)[:max(1, round(q.colsample_bytree * p))].tolist())
    tree, frontier = Tree.empty(q.max_depth), [0]
    leaf = lambda g, h: float(-_shrunk(np.float64(g), q.alpha) / (h + q.lam)) if h + q.lam > 0 else 0.0
    for depth in range(max(1, q.max_depth)):
        rows = _level(data, trees, tree, frontier, columns, p, q.max_bins + 1, number, q)
        frontier = []
        for r in rows:
            i = r["node"]
            tree.value[i] = leaf(r["g"], r["h"])
            if depth < q.max_depth and r["gain"] > max(q.gamma, 1e-9):
                tree.feature[i], tree.cut[i], tree.missing_left[i], tree.gain[i] = r["feature"], r["cut"], r["missing_left"], r["gain"]
                tree.value[2 * i + 1] = leaf(r["gl"], r["hl"])
                tree.value[2 * i + 2] = leaf(r["g"] - r["gl"], r["h"] - r["hl"])
                frontier += [2 * i + 1, 2 * i + 2]
        frontier.sort()
        if not frontier:
            break
    return tree


@dataclass
class BoostedTrees:
    """A fitted booster: trees, bin edges and the constant first margin. ``curve``
    holds (round, mean loss, auc, error, exact) per round where validation rows were
    given."""

    trees: list[Tree]
    edges: list[np.ndarray]
    base: float
    params: BoostParams
    features: str
    curve: list[tuple[int, float | None, float | None, float | None, bool]] = field(default_factory=list)
    best: int | None = None

    def margins(self, df: DataFrame, keep: Sequence[str], name: str = "margin", rounds: int | None = None,
                base_margin: str | None = None) -> DataFrame:
        """``keep`` columns of ``df`` and each row's margin: one pass, whatever
        the number of trees."""
        trees, edges, eta = self.trees[:rounds], self.edges, self.params.eta
        first = F.lit(self.base) if base_margin is None else qcol(base_margin).cast("double")
        src = df.select(*[qcol(k) for k in keep], first.alias("__m"), vector_to_array(self.features).alias("__x"))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                x, m = _bins(_matrix(b.column("__x"), len(edges)), edges).T.copy(), b.column("__m").to_numpy(zero_copy_only=False).copy()
                for t in trees:
                    m += eta * t.value[t.nodes(x)]
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(m, from_pandas=False)],
                                                 names=[*keep, name])
        fields = [src.schema[i] for i in range(len(keep))]
        return src.mapInArrow(run, T.StructType([*fields, T.StructField(name, T.DoubleType())]))

    def predict(self, df: DataFrame, key: str, out: str = "prob", name: str = "target", keep: Sequence[str] = (),
                rounds: int | None = None, base_margin: str | None = None) -> DataFrame:
        """(key, keep…, prediction): P(y = 1), the margin, or the value."""
        got = self.margins(df, [key, *keep], "__m", rounds if rounds is not None else self.best, base_margin)
        v = F.col("__m")
        if out == "prob" and self.params.objective == "logistic":
            v = F.lit(1.0) / (F.lit(1.0) + F.exp(-v))
        return got.select(qcol(key), *[qcol(k) for k in keep], v.alias(name))

    def importance(self, names: Sequence[str]) -> list[tuple[str, float]]:
        """Features by the gain of their cuts, as shares."""
        total = np.zeros(len(names))
        for t in self.trees[:self.best]:
            on = t.feature >= 0
            np.add.at(total, t.feature[on], t.gain[on])
        total = total / total.sum() if total.sum() else total
        return [(names[i], float(total[i])) for i in sorted(range(len(names)), key=lambda i: (-total[i], i))]


def _applied(data: DataFrame, trees: list[Tree], p: int, eta: float) -> DataFrame:
    """``data`` with the trees added to its margins."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            new = []
            for _, _, m, _, x in _held(b, p):
                for t in trees:
                    m = m + eta * t.value[t.nodes(x)]
                new.append(m.tobytes())
            yield b.set_column(b.schema.get_field_index("m"), "m", pa.array(new, pa.binary()))
    return data.mapInArrow(run, _ROW)


_BIN = "round int, bin int, pos double, neg double, low double, high double, loss double"


def round_bins(data: DataFrame, trees: list[Tree], p: int, eta: float, first: int, objective: str) -> DataFrame:
    """(round, bin, pos, neg, low, high, loss): validation rows by score bin after
    each of the stage's rounds, with their summed loss; the first is numbered ``first``."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for y, _, m, _, x in (chunk for b in it for chunk in _held(b, p)):
            if not held:
                held = [np.zeros((SCORE_BINS, 5)) for _ in trees]
                for r in held:
                    r[:, 2], r[:, 3] = np.inf, -np.inf
            one = y == 1
            for t, r in zip(trees, held):
                m = m + eta * t.value[t.nodes(x)]
                score = _sigmoid(m) if objective == "logistic" else np.clip(m, 0, 1)
                at = np.minimum((score * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)
                off = np.logaddexp(0, np.where(one, -m, m)) if objective == "logistic" else (m - y) ** 2
                order = np.argsort(at, kind="stable")
                u, starts = np.unique(at[order], return_index=True)
                pos = np.add.reduceat(one[order].astype(float), starts)
                low, high = np.minimum.reduceat(m[order], starts), np.maximum.reduceat(m[order], starts)
                r[u, 0] += pos
                r[u, 1] += np.diff(np.append(starts, len(at))) - pos
                r[u, 2], r[u, 3] = np.minimum(r[u, 2], low), np.maximum(r[u, 3], high)
                r[u, 4] += np.add.reduceat(off[order], starts)
        for i, r in enumerate(held):
            some = np.flatnonzero(r[:, 0] + r[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), first + i)), pa.array(some), *[pa.array(c) for c in r[some].T]],
                                             names=[c.split()[0] for c in _BIN.split(", ")]).cast(_arrow(_BIN))
    return data.mapInArrow(run, _BIN).groupBy("round", "bin").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("loss").alias("loss"))


def binned_auc(rows: Sequence) -> tuple[float | None, float | None]:
    """(AUC, greatest error) of one round's bins; (None, None) if a class is empty."""
    rows = sorted(rows, key=lambda r: r["bin"])
    pos, neg = np.array([r["pos"] for r in rows]), np.array([r["neg"] for r in rows])
    pairs = float(pos.sum() * neg.sum())
    if not pairs:
        return None, None
    unsure = np.array([r["low"] < r["high"] for r in rows])
    below = np.cumsum(neg) - neg
    return float((pos * (below + neg / 2)).sum() / pairs), float((pos * neg / 2)[unsure].sum() / pairs)


def _exact(valid: DataFrame, trees: list[Tree], p: int, eta: float, rounds: list[int]) -> dict[int, float]:
    """Exact AUC after each of a few rounds, from the validation rows' first margins."""
    out: dict[int, float] = {}
    for some in chunks(rounds, EXACT_AT_ONCE):
        wanted = set(some)

        def run(it: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            for m, (y, _, _, _, x) in (pair for b in it for pair in zip(_numbers(b, "m0"), _held(b, p))):
                for i, t in enumerate(trees[:max(wanted)], 1):
                    m = m + eta * t.value[t.nodes(x)]
                    if i in wanted:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), i, np.int32)), pa.array(m), pa.array(y)],
                                                         names=["round", "m", "y"])
        scored = valid.mapInArrow(run, "round int, m double, y double")
        out |= {r["round"]: r["auc"] for r in auc(scored, "m", "y", ["round"]).collect()}
    return out


def fit(df: DataFrame, label: str, params: dict | BoostParams | None = None, features: str = "features",
        valid: DataFrame | None = None, patience: int | None = None, stage: int = 10, key: str | None = None,
        base_margin: str | None = None, weight_col: str | None = None) -> BoostedTrees:
    """Boost ``df``. With ``valid`` the best round by AUC is found (``best``, the
    earliest of equal ones) and boosting stops ``patience`` rounds after it."""
    q = BoostParams.of(params)
    if q.max_bins > 254 or q.objective not in ("logistic", "squared"):
        raise ValueError(f"not supported: {q}")
    spark = df.sparkSession
    edges = bin_edges(df, features, q.max_bins)
    p = len(edges)
    base = 0.0
    if base_margin is None and q.objective == "squared":
        base = df.agg(F.avg(qcol(label).cast("double"))).first()[0] or 0.0
    margin = F.lit(base) if base_margin is None else qcol(base_margin)
    weight = F.lit(1.0) if weight_col is None else qcol(weight_col)
    data, path = stored(_binned(df, label, features, edges, margin, weight, key), "boost-rows")
    model = BoostedTrees([], edges, base, q, features)
    held, held_path = (None, None) if valid is None else stored(
        _binned(valid, label, features, edges, margin, F.lit(1.0), key), "boost-valid")
    while len(model.trees) < q.nrounds:
        done = len(model.trees)
        new: list[Tree] = []
        for number in range(done, min(done + stage, q.nrounds)):
            new.append(grow_tree(data, new, p, number, q))
        model.trees += new
        if held is not None:
            by_round: dict[int, list] = {}
            for r in round_bins(held, new, p, q.eta, done + 1, q.objective).collect():   # at most stage x SCORE_BINS rows
                by_round.setdefault(r["round"], []).append(r)
            for i in range(done + 1, len(model.trees) + 1):
                got = by_round.get(i, [])
                rows = sum(r["pos"] + r["neg"] for r in got)
                model.curve.append((i, sum(r["loss"] for r in got) / rows if rows else None, *binned_auc(got), False))
            model.curve, model.best = _decided(held, model, p)
            if patience is not None and len(model.trees) - (model.best or 0) >= patience:
                break
        if len(model.trees) < q.nrounds:
            (data, path), old = stored(_applied(data, new, p, q.eta), "boost-rows"), path
            discard(spark, old)
            if held is not None:
                (held, held_path), old = stored(_applied(held, new, p, q.eta), "boost-valid"), held_path
                discard(spark, old)
    discard(spark, path)
    if held_path:
        discard(spark, held_path)
    return model


def _decided(valid: DataFrame, model: BoostedTrees, p: int) -> tuple[list[tuple], int]:
    """The curve with exact AUCs for the rounds that may be best, and the best round."""
    known = [c for c in model.curve if c[2] is not None]
    if not known:
        # One class only: the least loss decides.
        return model.curve, min((c for c in model.curve if c[1] is not None), key=lambda c: c[1], default=(len(model.trees),))[0]
    floor = max(a - (0 if exact else e) for _, _, a, e, exact in known)
    sure = {r: a for r, _, a, e, exact in known if not exact and e == 0}   # a round without unsure pairs is exact as it is
    asked = [r for r, _, a, e, exact in known if not exact and a + e >= floor and r not in sure]
    found = sure | _exact(valid, model.trees, p, model.params.eta, asked)
    curve = [(r, loss, found[r], 0.0, True) if r in found else (r, loss, a, e, exact) for r, loss, a, e, exact in model.curve]
    best = max((c for c in curve if c[4]), key=lambda c: (c[2], -c[0]))
    return curve, best[0]


def curve_table(spark, model: BoostedTrees) -> DataFrame:
    """(round, loss, auc, error, exact) of a fit with validation rows."""
    return spark.createDataFrame(model.curve, "round int, loss double, auc double, error double, exact boolean")
