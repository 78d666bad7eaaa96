"""Parameter search.

Grids are small driver-side lists; each setting is a distributed fit. The
run log is a DataFrame with one row per setting (parameters as columns,
scores as columns), so ``metrics.best_run`` picks the winner.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession


def grid(space: dict[str, Sequence]) -> list[dict]:
    """Full factorial grid over the listed values."""
    keys = list(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def _u(seed, i, name) -> float:
    h = hashlib.md5(f"{seed}_{i}_{name}".encode()).hexdigest()[:8]
    return int(h, 16) / 2 ** 32


def random_grid(space: dict[str, tuple], n: int, seed: int = 0) -> list[dict]:
    """n seeded draws (F6). Each entry of ``space`` is ``("int", lo, hi)``,
    ``("uniform", lo, hi)`` (rounded to 1 decimal, as the reference did) or
    ``("choice", [values])``."""
    out = []
    for i in range(n):
        d = {}
        for name, spec in space.items():
            u = _u(seed, i, name)
            kind = spec[0]
            if kind == "int":
                d[name] = int(spec[1] + int(u * (spec[2] - spec[1] + 1)))
            elif kind == "uniform":
                d[name] = round(spec[1] + u * (spec[2] - spec[1]), 1)
            elif kind == "choice":
                vals = list(spec[1])
                d[name] = vals[int(u * len(vals))]
            else:
                raise ValueError(f"unknown draw {kind!r}")
        out.append(d)
    return out


def search(spark: SparkSession, settings: Sequence[dict], evaluate: Callable[[dict], dict]) -> DataFrame:
    """Run ``evaluate(setting) -> {metric: value}`` for every setting (each a
    Spark job) and return the run log ``(i, params…, metrics…)``."""
    rows = []
    for i, s in enumerate(settings):
        m = evaluate(s)
        rows.append({"i": i, **{k: float(v) for k, v in s.items()}, **{k: float(v) for k, v in m.items()}})
    cols = list(rows[0]) if rows else ["i"]
    schema = ", ".join([f"`{c}` {'int' if c == 'i' else 'double'}" for c in cols])
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def cross_validate(estimator, param_grid: dict, train: DataFrame, label: str, fold_col: str | None = None,
                   k: int = 4, parallelism: int = 2, holdout_ratio: float | None = None):
    """Spark ML grid search (F5): ``CrossValidator`` (with a fold column when
    given) or ``TrainValidationSplit``; AUC of the probability."""
    pg = ParamGridBuilder()
    for param, values in param_grid.items():
        pg = pg.addGrid(getattr(estimator, param), list(values))
    maps = pg.build()
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    if holdout_ratio is not None:
        tuner = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                                     trainRatio=1 - holdout_ratio, parallelism=parallelism)
    else:
        tuner = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev, numFolds=k,
                               parallelism=parallelism)
        if fold_col:
            tuner = tuner.setFoldCol(fold_col)
    model = tuner.fit(train)
    metrics = model.avgMetrics if hasattr(model, "avgMetrics") else model.validationMetrics
    log = [({p.name: m[p] for p in m}, float(s)) for m, s in zip(maps, metrics)]
    return model, log


def sweep(fit_predict: Callable[[dict], DataFrame], settings: Sequence[dict], name: Callable[[dict], str]) -> DataFrame:
    """The same learner under a list of settings (F9): one prediction table
    per setting, returned as one long table with a ``model`` column."""
    from pyspark.sql import functions as F
    parts = [fit_predict(s).withColumn("model", F.lit(name(s))) for s in settings]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
