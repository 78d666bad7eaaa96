"""Stacking, bagging and seed ensembles.

The driver loops over (model, fold) or bags; each loop body is a
distributed fit and transform. Every piece of output is a keyed long table
``(model, set, key, target)``; pieces are unioned, and test predictions are
averaged over folds with a grouped aggregate. Out-of-fold bookkeeping is by
the ``fold`` column: a row is scored only by models whose training set
excluded its fold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.operators import boosting
from widetab.operators import learners as L
from widetab.operators._util import few_tasks, qcol, stored, sum_columns
from widetab.operators.ensemble import pivot_models
from widetab.session import discard

Fit = Callable[[DataFrame], object]

# Independent fits are submitted from this many driver threads at once
# (each fit is a distributed Spark job; the threads only submit them).
DEFAULT_PARALLELISM = 4

# What fits side by side may cache in all. A fit of Spark ML caches a row's cells
# and, for boosted trees, about 200 bytes of objects, and reads them once a level
# or step: several large fits would push each other's rows to disk.
FIT_BYTES_AT_ONCE = 6 << 30
FIT_ROW_BYTES = 200


def fit_many(jobs: list[tuple[Fit, DataFrame]], parallelism: int = DEFAULT_PARALLELISM) -> list:
    """Fit several independent models concurrently, like
    ``CrossValidator(parallelism=…)``; results keep the input order."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [fit(df) for fit, df in jobs]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda job: job[0](job[1]), jobs))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _at_once(df: DataFrame, features: str, parallelism: int) -> int:
    """How many fits on the rows of ``df`` run side by side."""
    first = df.select(features).first() if features in df.columns else None
    width = FIT_ROW_BYTES + (8 * first[0].size if first and first[0] is not None else 0)
    return max(1, min(parallelism, FIT_BYTES_AT_ONCE // (width * max(1, df.count()))))


def _scored(models: dict[str, Sequence], df: DataFrame, key: str, out: str) -> DataFrame:
    """(model, key, target): each row's mean prediction over the models of a name.
    Spark ML models add their scores to the row one after the other, so it is read
    and assembled once; boosted trees of ours score it by themselves."""
    if any(isinstance(m, boosting.BoostedTrees) for some in models.values() for m in some):
        return _union([L.predict(m, df, key, out).select(F.lit(name).alias("model"), key, "target")
                       for name, some in models.items() for m in some])
    carried = [c for c in df.columns if c != key]
    scores: dict[str, list[str]] = {name: [] for name in models}
    for i, (name, m) in enumerate((name, m) for name, some in models.items() for m in some):
        df = L.predict(m, df, key, out, f"__score_{i}", keep=carried)
        carried.append(f"__score_{i}")
        scores[name].append(f"__score_{i}")
    means = [F.struct(F.lit(name).alias("model"), (sum_columns([F.col(c) for c in some]) / F.lit(float(len(some)))).alias("target"))
             for name, some in scores.items()]
    return df.select(qcol(key), F.inline(F.array(*means))).select("model", key, "target")


def stack_oof(train: DataFrame, test: DataFrame, key: str, learners: dict[str, Fit], fold_col: str = "fold",
              k: int | None = None, out: str = "prob", features: str = L.FEATURES,
              parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """CV stacking, stage 1.

    ``train`` carries ``features``, the label and ``fold_col``; ``test``
    carries ``features``. For every model and fold i: fit on folds ≠ i,
    score fold i (out-of-fold train rows) and the test table. Returns the
    long table ``(model, set, key, target)``; test rows are the mean over
    the k fold models.
    """
    if k is None:
        k = train.agg(F.max(fold_col)).first()[0] + 1
    pairs = [(name, i) for name in learners for i in range(k)]
    fitted = fit_many([(learners[name], train.filter(F.col(fold_col) != i)) for name, i in pairs],
                      _at_once(train, features, parallelism))
    models = {name: fitted[at * k:(at + 1) * k] for at, name in enumerate(learners)}
    oof = _union([_scored({name: [some[i]] for name, some in models.items()}, train.filter(F.col(fold_col) == i), key, out)
                  for i in range(k)])
    train_part = oof.select("model", F.lit("train").alias("set"), key, "target")
    test_part = (_scored(models, test, key, out).groupBy("model", key).agg(F.avg("target").alias("target"))
                 .select("model", F.lit("test").alias("set"), key, "target"))
    return train_part.unionByName(test_part)


def meta_features(stack: DataFrame, key: str, models: Sequence[str], set_name: str) -> DataFrame:
    """One column per model for one side of the stage-1 table (meta features)."""
    return pivot_models(stack.filter(F.col("set") == set_name).select("model", key, "target"), key, models)


def stack_holdout(train: DataFrame, test: DataFrame, key: str, label: str, part_col: str,
                  base: dict[str, Fit], meta: Fit, out: str = "prob") -> DataFrame:
    """Hold-out stacking (G6): base learners fit on part 0 and score part 1;
    the meta learner fits on part 1's base scores; base learners are refit
    on all train rows to score the test table, which the meta learner then
    scores. Returns ``(key, target)`` for the test table."""
    models = list(base)
    first = train.filter(F.col(part_col) == 0)
    second = train.filter(F.col(part_col) == 1)
    lvl = []
    tst = []
    for name, fit in base.items():
        m = fit(first)
        lvl.append(L.predict(m, second, key, out).select(F.lit(name).alias("model"), key, "target"))
        m_all = fit(train)
        tst.append(L.predict(m_all, test, key, out).select(F.lit(name).alias("model"), key, "target"))
    meta_train = pivot_models(_union(lvl), key, models).join(second.select(key, label), key)
    meta_train = L.assemble(meta_train, models, keep=[key, label])
    meta_model = meta(meta_train)
    meta_test = L.assemble(pivot_models(_union(tst), key, models), models, keep=[key])
    return L.predict(meta_model, meta_test, key, out)


def stack_meta(train: DataFrame, test: DataFrame, key: str, label: str, feature_cols: Sequence[str],
               stack: DataFrame, models: Sequence[str], params: dict, valid_col: str,
               patience: int | None = None) -> tuple[DataFrame, int]:
    """Stage 2 (G7): original columns + stage-1 meta columns → boosted trees
    validated on ``valid_col`` rows; the round with the highest validation
    AUC is kept, the model refit on all rows and the test table scored."""
    cols = list(feature_cols) + list(models)
    tr = train.join(meta_features(stack, key, models, "train"), key)
    te = test.join(meta_features(stack, key, models, "test"), key)
    # Written once: the scores and joins behind these rows are costly, and two fits read them many times.
    rows, path = stored(L.assemble(tr, cols, keep=[key, label, valid_col]), "stack-rows")
    tr_v = few_tasks(rows)
    chosen = L.fit_boosted_by_auc(tr_v.filter(~F.col(valid_col)), tr_v.filter(F.col(valid_col)), label, params,
                                  patience=patience, key=key)
    final = L.refit_by_auc(tr_v, label, params, chosen.best, key=key)
    discard(train.sparkSession, path)
    return L.predict(final, L.assemble(te, cols, keep=[key]), key), chosen.best


def bag(fit: Fit, df: DataFrame, test: DataFrame, key: str, label: str, members: DataFrame,
        bag_cols: dict[int, Sequence[str]], out: str = "prob", parallelism: int = DEFAULT_PARALLELISM,
        fit_valid: Callable[[DataFrame, DataFrame], object] | None = None) -> DataFrame:
    """Bagging (G10): for each bag, fit on its member rows (not the bag's
    validation rows) and its own column subset, score the test table with
    the same columns, and average over bags. ``members`` is the long
    ``(bag, key, is_valid)`` table from ``sampling.bags``. ``fit_valid`` takes
    the bag's training and validation rows instead (e.g. to choose its round)."""
    parts = []
    bags_ = list(bag_cols.items())

    def rows(b: int, cols: Sequence[str], valid: bool) -> DataFrame:
        chosen = members.filter((F.col("bag") == b) & (F.col("is_valid") == F.lit(valid))).select(key)
        return L.assemble(df.join(chosen, key), cols, keep=[key, label])
    if fit_valid:
        models = fit_many([((lambda pair: fit_valid(*pair)), (rows(b, cols, False), rows(b, cols, True)))
                           for b, cols in bags_], parallelism)
    else:
        models = fit_many([(fit, rows(b, cols, False)) for b, cols in bags_], parallelism)
    for (b, cols), model in zip(bags_, models):
        te = L.assemble(test, cols, keep=[key])
        parts.append(L.predict(model, te, key, out).select(F.lit(b).alias("bag"), key, "target"))
    return _union(parts).groupBy(key).agg(F.avg("target").alias("target"))


def seed_ensemble(fit_with_seed: Callable[[DataFrame, int], object], train: DataFrame, test: DataFrame,
                  key: str, n: int = 1, seed: int = 0, out: str = "prob",
                  parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """The same learner under seeds seed, seed+1, …; mean prediction."""
    parts = []
    seeds = list(range(seed, seed + n))
    models = fit_many([((lambda df, s=s: fit_with_seed(df, s)), train) for s in seeds], parallelism)
    for s, model in zip(seeds, models):
        parts.append(L.predict(model, test, key, out).select(F.lit(s).alias("seed"), key, "target"))
    return _union(parts).groupBy(key).agg(F.avg("target").alias("target"))
