"""Model fitting and scoring, mostly with Spark ML.

Every learner takes a DataFrame with an explicit key, a label and a list of
feature columns, and returns a fitted Spark ML model; ``predict`` turns a
model and a keyed table into the long prediction form ``(key, target)``.
Missing values are replaced by a sentinel at this edge only (Spark's tree
learners reject NaN), optionally with ``<col>_isnull`` flags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.functions.exprs import safe_ratio
from widetab.operators import boosting
from widetab.operators._util import materialize, qcol, sum_columns

FEATURES = "features"

# Fixed value: the missing-value code used before model fitting.
DEFAULT_SENTINEL = -98989898.0


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES, sentinel: float | None = DEFAULT_SENTINEL,
             null_flags: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns → one vector column. Missing → ``sentinel`` (or kept
    as NaN when ``sentinel`` is None); ``null_flags`` adds 0/1 indicators."""
    cols = list(cols)
    exprs = []
    for c in cols:
        v = qcol(c).cast("double")
        exprs.append((F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(sentinel)) if sentinel is not None
                      else F.coalesce(v, F.lit(float("nan")))).alias(c))
    flags = [F.when(qcol(c).isNull(), 1.0).otherwise(0.0).alias(f"{c}_isnull") for c in cols] if null_flags else []
    base = df.select(*[qcol(k) for k in keep], *exprs, *flags)
    inputs = cols + ([f"{c}_isnull" for c in cols] if null_flags else [])
    va = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep")
    return va.transform(base).select(*[qcol(k) for k in keep], out)


def class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights (E16): positives weigh neg/pos, negatives 1. The
    ratio is one aggregate row."""
    r = df.agg(safe_ratio(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("r")).first()["r"]
    r = 1.0 if r is None else r
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(r)).otherwise(F.lit(1.0)))


# Parameter names of the reference's boosted trees mapped to GBTClassifier.
BOOST_PARAM_MAP = {
    "eta": "stepSize", "nrounds": "maxIter", "max_depth": "maxDepth", "subsample": "subsamplingRate",
    "min_child_weight": "minInstancesPerNode", "gamma": "minInfoGain", "seed": "seed",
    "max_bins": "maxBins",
}


def boost_params(params: dict) -> dict:
    out = {}
    for k, v in params.items():
        if k in BOOST_PARAM_MAP:
            name = BOOST_PARAM_MAP[k]
            out[name] = int(v) if name in ("maxIter", "maxDepth", "minInstancesPerNode", "maxBins", "seed") else float(v)
        elif k == "colsample_bytree":
            out["featureSubsetStrategy"] = str(float(v))
        elif k in ("alpha", "early_stop_round", "objective", "eval_metric", "missing"):
            continue  # no GBTClassifier counterpart (see SURVEY §4.5)
        else:
            out[k] = v
    return out


def fit_boosted(df: DataFrame, label: str, params: dict | None = None, features: str = FEATURES,
                valid_col: str | None = None, weight_col: str | None = None, regression: bool = False) -> Model:
    """Spark ML's boosted trees (E3, E4). With ``valid_col`` Spark stops on the
    validation loss; ``fit_boosted_by_auc`` stops by AUC."""
    kw = boost_params(params or {})
    cls = GBTRegressor if regression else GBTClassifier
    est = cls(labelCol=label, featuresCol=features, **kw)
    if valid_col:
        est = est.setValidationIndicatorCol(valid_col)
    if weight_col:
        est = est.setWeightCol(weight_col)
    return est.fit(df)


def fit_boosted_by_auc(train: DataFrame, valid: DataFrame, label: str, params: dict, features: str = FEATURES,
                       patience: int | None = None, stage: int = 10, key: str | None = None) -> boosting.BoostedTrees:
    """Boosted trees that stop ``patience`` rounds after the best validation AUC
    (E1); predictions take the best round, without a second fit."""
    return boosting.fit(train, label, params, features, valid=valid, patience=patience, stage=stage, key=key)


def boosted_curve(train: DataFrame, valid: DataFrame, label: str, params: dict, features: str = FEATURES,
                  patience: int | None = None, stage: int = 10, key: str | None = None) -> DataFrame:
    """Validation loss and AUC after each round (F8): ``(round, loss, auc, error,
    exact)``; ``error`` bounds the AUC of rounds that cannot be the best one."""
    return boosting.curve_table(train.sparkSession, fit_boosted_by_auc(train, valid, label, params, features, patience, stage, key))


def refit_by_auc(df: DataFrame, label: str, params: dict, best: int, features: str = FEATURES,
                 key: str | None = None) -> boosting.BoostedTrees:
    """All rows with the number of rounds that validation chose."""
    return boosting.fit(df, label, {**params, "nrounds": best}, features, key=key)


def refit_boosted(df: DataFrame, label: str, params: dict, best_round: int, features: str = FEATURES) -> Model:
    """Refit on all rows with the chosen number of rounds."""
    p = dict(params)
    p["nrounds"] = best_round
    return fit_boosted(df, label, p, features)


def fit_forest(df: DataFrame, label: str, n_trees: int = 100, depth: int = 8, min_rows: int = 1,
               regression: bool = True, impurity: str | None = None, seed: int = 0,
               features: str = FEATURES) -> Model:
    """Random forest on the 0/1 label (E5): regression or a gini/entropy
    classifier."""
    if regression:
        est = RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=n_trees, maxDepth=depth,
                                    minInstancesPerNode=min_rows, seed=seed)
    else:
        est = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=n_trees, maxDepth=depth,
                                     minInstancesPerNode=min_rows, seed=seed, impurity=impurity or "gini")
    return est.fit(df)


def fit_linear(df: DataFrame, label: str, alpha: float = 0.5, lam: float = 1e-5,
               features: str = FEATURES) -> Model:
    """Gaussian elastic net on the 0/1 label (E6); predictions may leave [0, 1]."""
    return LinearRegression(labelCol=label, featuresCol=features, elasticNetParam=alpha, regParam=lam).fit(df)


def fit_logistic(df: DataFrame, label: str, reg: float = 0.0, elastic: float = 0.0, standardization: bool = True,
                 features: str = FEATURES, weight_col: str | None = None, max_iter: int = 100) -> Model:
    """Logistic regression."""
    est = LogisticRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=elastic,
                             standardization=standardization, maxIter=max_iter)
    if weight_col:
        est = est.setWeightCol(weight_col)
    return est.fit(df)


def ridge_path(df: DataFrame, label: str, lambdas: Sequence[float], features: str = FEATURES) -> list[Model]:
    """Ridge logistic path (E7): alpha 0, not standardised, one fit per λ."""
    return [fit_logistic(df, label, reg=lam, elastic=0.0, standardization=False, features=features)
            for lam in lambdas]


def fit_mlp(df: DataFrame, label: str, n_features: int, hidden: Sequence[int] = (500, 500), max_iter: int = 10,
            seed: int = 0, features: str = FEATURES) -> Model:
    """Feed-forward net with sigmoid hidden layers."""
    layers = [n_features, *hidden, 2]
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=layers,
                                          maxIter=max_iter, seed=seed).fit(df)


class PlattSVM:
    """Linear SVM with probabilities (E12): a logistic fit on the SVM margin
    (Platt scaling)."""

    def __init__(self, svm, platt):
        self.svm, self.platt = svm, platt

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.svm.transform(df).withColumn("__margin", vector_to_array("rawPrediction")[1])
        m = VectorAssembler(inputCols=["__margin"], outputCol="__mvec").transform(m)
        return self.platt.transform(m.drop("rawPrediction", "prediction")).drop("__margin", "__mvec")


def fit_svm_platt(df: DataFrame, label: str, reg: float = 0.0, features: str = FEATURES,
                  fold_col: str | None = None, k: int | None = None, max_iter: int = 100) -> PlattSVM:
    """With ``fold_col`` Platt's logistic fit sees out-of-fold margins only: each
    fold's rows are scored by an SVM of the other folds, as margins of training
    rows are too sure."""
    def margins(svm, rows: DataFrame) -> DataFrame:
        m = svm.transform(rows).withColumn("__margin", vector_to_array("rawPrediction")[1])
        return VectorAssembler(inputCols=["__margin"], outputCol="__mvec").transform(m).select(label, "__mvec")
    fit = LinearSVC(labelCol=label, featuresCol=features, regParam=reg, maxIter=max_iter).fit
    svm = fit(df)
    if fold_col is None:
        scored = margins(svm, df)
    else:
        k = df.agg(F.max(fold_col)).first()[0] + 1 if k is None else k
        parts = [margins(fit(df.filter(F.col(fold_col) != i)), df.filter(F.col(fold_col) == i)) for i in range(k)]
        scored = parts[0]
        for p in parts[1:]:
            scored = scored.unionByName(p)
    return PlattSVM(svm, LogisticRegression(labelCol=label, featuresCol="__mvec").fit(scored))


def predict(model, df: DataFrame, key: str, out: str = "prob", name: str = "target",
            keep: Sequence[str] = ()) -> DataFrame:
    """Score a keyed table (E15): ``prob`` (P(y = 1)), ``margin`` (raw score)
    or ``value`` (regression output)."""
    if isinstance(model, boosting.BoostedTrees):
        return model.predict(df, key, out, name, keep)
    t = model.transform(df)
    if out == "prob" and "probability" in t.columns:
        v = vector_to_array("probability")[1]
    elif out == "margin" and "rawPrediction" in t.columns:
        v = vector_to_array("rawPrediction")[1]
    else:
        v = F.col("prediction")
    return t.select(qcol(key), *[qcol(k) for k in keep], v.cast("double").alias(name))


def isotonic_calibrate(scores: DataFrame, key: str, label: str, fold_col: str, score: str = "target",
                       k: int | None = None, test: DataFrame | None = None) -> DataFrame:
    """Isotonic calibration over folds (E13): for each fold, fit isotonic
    regression on the other folds' (score, label) and calibrate this fold. Rows of
    ``test`` (key, score) get the mean of all folds' calibrators; the result then has
    a column ``set`` of ``train`` and ``test``.

    Each fit takes one row per distinct score, with its mean label and its rows as
    weight: the same regression, on a table that does not grow with copies. Rows
    without a score or label are left out of fits; without a score they get NULL.
    """
    if k is None:
        k = scores.agg(F.max(fold_col)).first()[0] + 1
    counts = materialize(scores.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
                         .groupBy(F.col(fold_col).alias("__f"), F.col(score).cast("double").alias("__s"))
                         .agg(F.sum(F.col(label).cast("double")).alias("__y"), F.count(F.lit(1)).cast("double").alias("__n")))
    va = VectorAssembler(inputCols=["__s"], outputCol="__v")
    models = []
    for i in range(k):
        others = counts.filter(F.col("__f") != i).groupBy("__s").agg(F.sum("__y").alias("__y"), F.sum("__n").alias("__n"))
        rows = va.transform(others.select("__s", "__n", (F.col("__y") / F.col("__n")).alias("__m")))
        models.append(IsotonicRegression(labelCol="__m", featuresCol="__v", weightCol="__n").fit(rows))

    def calibrated(df: DataFrame, some: Sequence[int]) -> DataFrame:
        """``df`` (with ``__s``) and the mean prediction of some folds' models."""
        out = va.transform(df)
        for i in some:
            out = models[i].setPredictionCol(f"__p{i}").transform(out)
        return out.withColumn(score, sum_columns([F.col(f"__p{i}") for i in some]) / F.lit(float(len(some)))) \
            .drop("__v", "__s", *[f"__p{i}" for i in some])

    def known(df: DataFrame) -> DataFrame:
        return df.filter(F.col(score).isNotNull()).withColumn("__s", F.col(score).cast("double"))
    out: DataFrame | None = None
    for i in range(k):
        part = calibrated(known(scores.filter(F.col(fold_col) == i).select(key, score)), [i])
        out = part if out is None else out.unionByName(part)
    lost = lambda df: df.filter(F.col(score).isNull()).select(key, F.lit(None).cast("double").alias(score))
    out = out.unionByName(lost(scores))
    if test is None:
        return out
    tested = calibrated(known(test.select(key, score)), list(range(k))).unionByName(lost(test))
    return out.withColumn("set", F.lit("train")).unionByName(tested.withColumn("set", F.lit("test")))


def boost_from_margin(df: DataFrame, label: str, base_margin: str, params: dict, features: str = FEATURES,
                      key: str | None = None) -> boosting.BoostedTrees:
    """Go on boosting from an earlier model's output (E14). ``base_margin`` is its
    log-odds; trees take Newton steps from it, and predictions need the same
    column of the rows they score (``model.predict(..., base_margin=...)``)."""
    return boosting.fit(df, label, params, features, base_margin=base_margin, key=key)


def top_features(model, names: Sequence[str], k: int = 50) -> list[tuple[str, float]]:
    """The k most important features of a tree model."""
    if isinstance(model, boosting.BoostedTrees):
        return model.importance(names)[:k]
    imp = model.featureImportances.toArray()
    order = sorted(range(len(names)), key=lambda i: (-imp[i], i))[:k]
    return [(names[i], float(imp[i])) for i in order]
