"""Combining models (G1-G4, G8, G9) on the long prediction table.

Predictions live in one long table ``(model, key, target)``; the wide
"meta-feature" matrix is a pivot of it with an explicit model list.
Averages are grouped aggregates (partial aggregation before the shuffle);
weights are small tables joined by model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.functions.exprs import safe_ratio
from widetab.operators._util import bounded_broadcast, broadcast_if_small, materialize, qcol, sum_columns
from widetab.session import shuffle_partitions


def average(preds: DataFrame, key: str, score: str = "target", model: str = "model",
            n_models: int | None = None, digits: int | None = 6, strict: bool = False) -> DataFrame:
    """Mean prediction per key over models (G1).

    The divisor is the number of models (a model lacking a key still counts,
    as in the reference); ``strict`` rejects the input when some key is not
    predicted by every model.
    """
    n = n_models
    agg = preds.groupBy(key).agg(F.sum(score).alias("__s"), F.countDistinct(model).alias("__k"))
    if n is None:
        # One number: how many models there are.
        n = preds.agg(F.countDistinct(model).alias("__n")).first()["__n"]
    div = F.lit(n)
    if strict:
        gaps = agg.filter(F.col("__k") < div).agg(F.count(F.lit(1)).alias("g")).first()["g"]
        if gaps:
            raise ValueError(f"average: {gaps} keys lack a prediction from some model")
    val = F.col("__s") / div.cast("double")
    if digits is not None:
        val = F.round(val, digits)
    return agg.select(key, val.alias(score))


def _refuse_gaps(preds: DataFrame, known: Sequence[str], score: str, model: str) -> None:
    """Weighted means need a score in every row and a weight for every model."""
    bad = preds.agg(F.count_if(F.col(score).isNull()).alias("empty"),
                    F.count_if(F.coalesce(~F.col(model).isin(list(known)), F.lit(True))).alias("unknown")).first()
    if bad["empty"] or bad["unknown"]:
        raise ValueError(f"{bad['empty']} rows without a score, {bad['unknown']} rows of models without a weight")


def weighted_average(preds: DataFrame, weights: dict[str, float], key: str, score: str = "target",
                     model: str = "model") -> DataFrame:
    """Σ w·p / Σ w per key with given model weights (G2). The weight table
    has one row per model and is broadcast (bounded by the dict size). Rows
    without a score and models without a weight are refused."""
    _refuse_gaps(preds, list(weights), score, model)
    spark = preds.sparkSession
    wdf = spark.createDataFrame([(m, float(w)) for m, w in weights.items()], f"{model} string, __w double")
    j = preds.join(bounded_broadcast(wdf, len(weights)), model)
    return j.groupBy(key).agg(
        (F.sum(F.col("__w") * F.col(score)) / F.sum("__w")).alias(score))


def blend(preds: DataFrame, families: dict[str, dict[str, float]], family_weights: dict[str, float],
          key: str, score: str = "target", model: str = "model") -> DataFrame:
    """Two-level blend (G3): a weighted mean inside each family of models,
    then a weighted mean of the family scores. Rows without a score and models
    outside the families are refused."""
    spark = preds.sparkSession
    _refuse_gaps(preds, [m for ms in families.values() for m in ms], score, model)
    rows = [(m, fam, float(w)) for fam, ms in families.items() for m, w in ms.items()]
    wdf = spark.createDataFrame(rows, f"{model} string, __fam string, __w double")
    inner = (preds.join(bounded_broadcast(wdf, len(rows)), model)
             .groupBy("__fam", key).agg((F.sum(F.col("__w") * F.col(score)) / F.sum("__w")).alias("__fs")))
    fdf = spark.createDataFrame([(f, float(w)) for f, w in family_weights.items()], "__fam string, __fw double")
    outer = inner.join(bounded_broadcast(fdf, len(family_weights)), "__fam")
    return outer.groupBy(key).agg((F.sum(F.col("__fw") * F.col("__fs")) / F.sum("__fw")).alias(score))


def row_mean(df: DataFrame, cols: Sequence[str], name: str = "target") -> DataFrame:
    """Mean across model columns within a row (G4); a missing cell makes the
    mean missing, like ``rowMeans`` without ``na.rm``."""
    cols = list(cols)
    return df.withColumn(name, sum_columns([qcol(c).cast("double") for c in cols]) / F.lit(float(len(cols))))


PIVOT_SPREAD = 8


def pivot_models(preds: DataFrame, key: str, models: Sequence[str], score: str = "target",
                 model: str = "model") -> DataFrame:
    """Long predictions → one column per model (meta-feature table), with an
    explicit model list so no distinct pass is needed. One shuffle by key, into
    many partitions, serves both steps of the pivot and keeps a task's groups few."""
    parts = PIVOT_SPREAD * shuffle_partitions(preds.sparkSession)
    return preds.repartition(parts, qcol(key)).groupBy(key).pivot(model, list(models)).agg(F.first(score))


def minmax(preds: DataFrame, score: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """Stretch scores to [0, 1] (G9); a constant score gives NULL.
    The min/max row (per group) is joined back as a bounded broadcast."""
    by = list(by)
    stats = preds.groupBy(*by).agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"))
    if by:
        groups = stats.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], "__lo", "__hi")
        same = F.lit(True)
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
        j = preds.join(broadcast_if_small(groups), same).drop(*[f"__g{i}" for i in range(len(by))])
    else:
        lo_hi = stats.first()
        j = preds.withColumns({"__lo": F.lit(lo_hi["__lo"]), "__hi": F.lit(lo_hi["__hi"])})
    return j.withColumn(score, safe_ratio(F.col(score) - F.col("__lo"), F.col("__hi") - F.col("__lo"))) \
        .drop("__lo", "__hi")


def _wide_with_label(preds: DataFrame, labels: DataFrame | None, key: str, label: str,
                     models: Sequence[str], score: str, model: str) -> DataFrame:
    """One column per model plus the label. When ``labels`` is None the
    label is a column of ``preds`` and rides along the same pivot (one
    shuffle); otherwise it is joined by key."""
    if labels is None:
        return (preds.groupBy(key).pivot(model, list(models))
                .agg(F.first(score).alias("s"), F.max(label).alias("y"))
                .select(key, *[F.col(f"{m}_s").alias(m) for m in models],
                        F.greatest(*[F.col(f"{m}_y") for m in models]).alias(label)))
    return pivot_models(preds, key, models, score, model).join(labels.select(key, label), key)


def weight_grid(models: Sequence[str], step: float = 0.1) -> list[dict[str, float]]:
    """All weight vectors on the simplex with the given step (driver-side,
    size C(1/step + k − 1, k − 1))."""
    k = len(models)
    units = int(round(1.0 / step))
    out = []

    def rec(prefix, left, i):
        if i == k - 1:
            out.append(prefix + [left])
            return
        for u in range(left + 1):
            rec(prefix + [u], left - u, i + 1)
    rec([], units, 0)
    return [{m: u / units for m, u in zip(models, ws)} for ws in out]


GRID_ROWS = 512


def blend_grid_losses(preds: DataFrame, labels: DataFrame | None, key: str, label: str,
                      models: Sequence[str], step: float = 0.1, score: str = "target",
                      model: str = "model") -> DataFrame:
    """Log loss of every weight vector on a simplex grid (G8, grid form).

    The grid is a small bounded table. A task multiplies its rows' scores with all
    weight vectors, a few rows at a time, and sums the losses; one row per grid
    point and task is shuffled. Rows without a score or a label are left out.
    """
    models = list(models)
    grid = weight_grid(models, step)
    wide = _wide_with_label(preds, labels, key, label, models, score, model)
    weights, eps = np.array([[g[m] for m in models] for g in grid]).T, 1e-14
    rows = wide.select(*[qcol(m).cast("double").alias(f"p{i}") for i, m in enumerate(models)],
                       F.col(label).cast("double").alias("y")).dropna()

    def losses(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(grid)), 0
        for b in it:
            scores = np.column_stack([b.column(f"p{i}").to_numpy() for i in range(len(models))])
            y = b.column("y").to_numpy()
            for at in range(0, len(y), GRID_ROWS):
                p = np.clip(scores[at:at + GRID_ROWS] @ weights, eps, 1 - eps)
                some = y[at:at + GRID_ROWS, None]
                if np.isin(some, (0, 1)).all():
                    total -= np.log(np.where(some == 1, p, 1 - p)).sum(axis=0)
                else:
                    total -= (some * np.log(p) + (1 - some) * np.log(1 - p)).sum(axis=0)
            n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid), dtype=np.int32)), pa.array(total),
                                              pa.array(np.full(len(grid), n))], names=["grid_id", "loss", "n"])
    sums = rows.mapInArrow(losses, "grid_id int, loss double, n bigint").groupBy("grid_id").agg(
        (F.sum("loss") / F.sum("n")).alias("logloss"))
    gdf = preds.sparkSession.createDataFrame([(i, *[g[m] for m in models]) for i, g in enumerate(grid)],
                                             "grid_id int, " + ", ".join(f"`w_{m}` double" for m in models))
    return sums.join(bounded_broadcast(gdf, len(grid)), "grid_id")


class BlendFit(NamedTuple):
    """Blend weights with their loss, the passes over the rows, and the duality
    gap: no weights on the simplex have a loss below ``loss - gap``."""

    weights: dict[str, float]
    loss: float
    steps: int
    gap: float


MIN_SHARE = 1 / 64


def _simplex_minimum(w: np.ndarray, g: np.ndarray, h: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Minimum over the simplex of the quadratic g·(x − w) + (x − w)·h·(x − w)/2, by
    pairwise Frank–Wolfe steps from w (k numbers, on the driver)."""
    x = w.copy()
    for _ in range(rounds):
        d = g + h @ (x - w)
        into = int(d.argmin())
        out = int(np.where(x > 0, d, -np.inf).argmax())
        if d[out] - d[into] < 1e-13:
            break
        curve = h[into, into] + h[out, out] - 2 * h[into, out]
        move = x[out] if curve <= 0 else min(x[out], (d[out] - d[into]) / curve)
        x[into], x[out] = x[into] + move, x[out] - move
    return x


def fit_blend_weights(preds: DataFrame, labels: DataFrame | None, key: str, label: str, models: Sequence[str],
                      tolerance: float = 1e-6, max_steps: int = 100, score: str = "target", model: str = "model",
                      eps: float = 1e-14) -> BlendFit:
    """Blend weights in the simplex minimising log loss.

    The loss is convex in the weights. A pass over the rows is one aggregate:
    loss, gradient and Hessian at the present weights (k² / 2 numbers). The driver
    minimises the quadratic model on the simplex and the next pass tries that
    point, halving the way back while the loss does not fall; if it does not fall
    near by either, an EM step (each weight times its share of the rows'
    likelihood), which always lowers it, is taken instead. It ends when the duality
    gap, which bounds what any weights could still gain, is at most ``tolerance``
    (a fit that needs more than ``max_steps`` passes is an error).

    The best single model is tried first; if it is not the optimum, equal weights are
    the start, and no step may give a row a blend that only the
    clip at ``eps`` keeps from an endless loss (a score of 0 for a positive row,
    alone): there the derivatives of a single row would outweigh all others.
    A single model that is better than the last weights is returned instead, so
    the loss is never above the best one. Rows without a score or label are left out.
    """
    models = list(models)
    k = len(models)
    wide = materialize(_wide_with_label(preds, labels, key, label, models, score, model)
                       .select(*[qcol(m).cast("double").alias(f"p{i}") for i, m in enumerate(models)],
                               F.col(label).cast("double").alias("y")).dropna())
    clip = lambda p: F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))
    ll = lambda p: -(F.col("y") * F.ln(clip(p)) + (F.lit(1.0) - F.col("y")) * F.ln(F.lit(1.0) - clip(p)))
    single = wide.agg(*[F.avg(ll(F.col(f"p{i}"))).alias(f"l{i}") for i in range(k)]).first()
    if single["l0"] is None:
        raise ValueError("no rows to fit weights on")
    # Likelihoods of both labels: q = 1 - p is blended like p, so 1 - b has no rounding of its own.
    sides = [("y", [F.col(f"p{i}") for i in range(k)]),
             ("n", [F.lit(1.0) - F.col(f"p{i}") for i in range(k)])]

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int]:
        """Mean loss, gradient and Hessian, and the rows that only the clip bounds."""
        rows = wide.withColumn("n", F.lit(1.0) - F.col("y"))
        blend = {f"b_{y}": sum_columns([F.lit(float(w[i])) * p[i] for i in range(k)]) for y, p in sides}
        rows = rows.withColumns(blend)
        inside = {y: (F.col(y) > 0) & F.col(f"b_{y}").between(eps, 1.0) for y, _ in sides}
        rows = rows.withColumns({f"d_{y}": F.when(inside[y], F.col(y) / F.col(f"b_{y}")).otherwise(F.lit(0.0)) for y, _ in sides})
        rows = rows.withColumns({f"c_{y}": F.when(inside[y], F.col(f"d_{y}") / F.col(f"b_{y}")).otherwise(F.lit(0.0)) for y, _ in sides})
        lost = [(F.col(y) > 0) & (F.col(f"b_{y}") < eps) & ((F.greatest(*p) if k > 1 else p[0]) > eps) for y, p in sides]
        loss = -sum_columns([F.col(y) * F.ln(clip(F.col(f"b_{y}"))) for y, _ in sides])
        total = lambda terms: F.avg(sum_columns(terms))
        r = rows.agg(F.avg(loss).alias("loss"), F.count_if(lost[0] | lost[1]).alias("lost"),
                     *[total([-F.col(f"d_{y}") * p[i] for y, p in sides]).alias(f"g{i}") for i in range(k)],
                     *[total([F.col(f"c_{y}") * p[i] * p[j] for y, p in sides]).alias(f"h{i}_{j}")
                       for i in range(k) for j in range(i, k)]).first()
        return (r["loss"], np.array([r[f"g{i}"] for i in range(k)]),
                np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]), r["lost"])
    best = int(np.argmin([single[f"l{i}"] for i in range(k)]))
    w = np.eye(k)[best]
    loss, g, h, lost = at(w)
    gap = float(g @ w - g.min())
    steps = 1
    if gap > tolerance or lost:
        w = np.full(k, 1.0 / k)
        loss, g, h, lost = at(w)
        gap = float(g @ w - g.min())
        steps += 1
    while gap > tolerance:
        goal = _simplex_minimum(w, g, h)
        share, falls = 1.0, float(g @ (goal - w))
        while True:
            if steps >= max_steps:
                raise RuntimeError(f"blend weights: gap {gap:g} after {steps} passes")
            if share < MIN_SHARE:
                new = w * -g / (w * -g).sum()
                got = at(new)
                steps += 1
                break
            new = w + share * (goal - w)
            got = at(new)
            steps += 1
            if got[0] <= loss + 1e-4 * share * falls and got[3] <= lost:
                break
            share /= 2
        w, (loss, g, h, _) = new, got
        gap = float(g @ w - g.min())
    w = np.maximum(w, 0) / np.maximum(w, 0).sum()
    if single[f"l{best}"] <= loss:
        w, loss = np.eye(k)[best], single[f"l{best}"]
    return BlendFit({m: float(x) for m, x in zip(models, w)}, float(loss), steps, max(gap, 0.0))
