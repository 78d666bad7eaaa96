"""Hashed one-hot features and online learners as Spark jobs.

Model state is a sparse table ``(idx, a, b)`` holding only touched indices:
FTRL-proximal keeps ``(z, n)``, adaptive SGD keeps ``(w, G)``. One
mini-batch is:

1. explode each row's index list and join the state on ``idx`` (missing
   index = initial state); the state is broadcast only after counting it,
   otherwise a shuffle join with AQE's skew split (the bias index 0 is in
   every row);
2. per row: ``p = sigmoid(clip(Σ w, ±35))``, ``g = p − y``;
3. per index: Σg, Σg², occurrences (partial aggregation first, so a hot
   index costs one partial row per task);
4. full-outer merge into the state.

A batch of one row is the sequential rule exactly; larger batches are the
synchronous mini-batch form. The state is written after every batch to the
shared checkpoint folder (versioned by batch), which cuts the lineage; a fit that
is started again on the same folder goes on after the last written state.

``fit_sweep`` trains several settings at once: the state has a pair (a, b) per
setting, and one explode, one join and two aggregates a batch serve them all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from widetab.functions.hashing import raw_hash
from widetab.operators._util import broadcast_if_small, qcol
from widetab.operators.metrics import row_logloss
from widetab.session import discard

# Fixed value: hash space of the reference learner, 2**28 + 2**22.
DEFAULT_D = 2 ** 28 + 2 ** 22
# Fixed value: the score is clipped to ±35 before the sigmoid.
WTX_CLIP = 35.0

STATE_SCHEMA = "idx bigint, a double, b double"


@dataclass(frozen=True)
class OnlineParams:
    """Learner settings. ``algo`` is ``"ftrl"`` (a = z, b = n) or
    ``"adagrad"`` (a = w, b = G). Defaults are the reference's FTRL run."""
    algo: str = "ftrl"
    alpha: float = 0.005
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    compat_l2_sign: bool = False


def hash_features(df: DataFrame, cols: Sequence[str], D: int = DEFAULT_D, fn: str = "md5",
                  out: str = "idx") -> DataFrame:
    """Hash one-hot (C8): ``idx = hash(name + '_' + value) mod D`` for every
    listed column, as an ``ARRAY<BIGINT>`` in column order. Values are used
    as text (the reference reads every field as text); a missing cell is a
    category of its own, ``name + '_'``."""
    arr = F.array(*[F.pmod(raw_hash(F.concat(F.lit(f"{c}_"), F.coalesce(qcol(c).cast("string"), F.lit(""))), fn), F.lit(D))
                    for c in cols])
    return df.withColumn(out, arr)


def hash_pairs(df: DataFrame, idx_col: str = "idx", D: int = DEFAULT_D, fn: str = "md5",
               out: str = "pair_idx") -> DataFrame:
    """Hashed second-order features (C9): for the sorted index list x, every
    pair i < j gives ``hash(str(x[i]) + '_' + str(x[j])) mod D``. Row-local
    (quadratic in the row's width, as in the reference); no shuffle."""
    s = F.array_sort(F.col(idx_col))
    n = F.size(s)
    pos = F.sequence(F.lit(0), n - 1)
    pairs = F.flatten(F.transform(pos, lambda i: F.transform(
        F.filter(pos, lambda j: j > i),
        lambda j: F.pmod(raw_hash(F.concat(s[i].cast("string"), F.lit("_"), s[j].cast("string")), fn), F.lit(D)))))
    return df.withColumn(out, F.when(n > 1, pairs).otherwise(F.array().cast("array<bigint>")))


def with_bias(idx: Column) -> Column:
    """Prepend the bias index 0."""
    return F.concat(F.array(F.lit(0).cast("bigint")), idx)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def _weight(params: OnlineParams, a: str = "a", b: str = "b") -> Column:
    a, b = F.coalesce(F.col(a), F.lit(0.0)), F.coalesce(F.col(b), F.lit(0.0))
    if params.algo == "adagrad":
        return a
    # FTRL lazy weight from (z, n).
    return F.when(F.abs(a) <= params.l1, F.lit(0.0)).otherwise(
        (F.signum(a) * F.lit(params.l1) - a) / ((F.lit(params.beta) + F.sqrt(b)) / F.lit(params.alpha)
                                              + F.lit(params.l2)))


def _advanced(params: OnlineParams, a: str, b: str, grad: str, squares: str, count: str) -> tuple[Column, Column]:
    """An index's pair after a batch, from its pair, Σg, Σg² and occurrences."""
    a0, b0, g, g2, c = (F.coalesce(F.col(x), F.lit(0.0)) for x in (a, b, grad, squares, count))
    b1 = b0 + g2
    if params.algo == "ftrl":
        sigma = (F.sqrt(b1) - F.sqrt(b0)) / F.lit(params.alpha)
        return a0 + g - sigma * _weight(params, a, b), b1
    if params.algo == "adagrad":
        sign = -1.0 if params.compat_l2_sign else 1.0
        return a0 - F.lit(params.alpha) / (F.lit(params.beta) + F.sqrt(b1)) * (g + F.lit(sign * params.l2) * c * a0), b1
    raise ValueError(f"unknown online algorithm {params.algo!r}")


def _probability(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(WTX_CLIP)), F.lit(-WTX_CLIP))))


def _join_state(exploded: DataFrame, state: DataFrame, params: OnlineParams,
                broadcast_limit: int) -> DataFrame:
    st = state.select("idx", "a", "b")
    st = broadcast_if_small(st, broadcast_limit)
    return exploded.join(st, "idx", "left").withColumn("w", _weight(params))


def score(state: DataFrame, df: DataFrame, key: str, idx_col: str = "idx", params: OnlineParams = OnlineParams(),
          add_bias: bool = True, keep: Sequence[str] = (), broadcast_limit: int = 2_000_000) -> DataFrame:
    """Probability per row under the current state (E15 / H2 for online models)."""
    idx = with_bias(F.col(idx_col)) if add_bias else F.col(idx_col)
    ex = df.select(key, *keep, F.explode(idx).alias("idx"))
    j = _join_state(ex, state, params, broadcast_limit)
    per = j.groupBy(key, *keep).agg(F.sum("w").alias("wtx"))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(F.col("wtx"), F.lit(WTX_CLIP)), F.lit(-WTX_CLIP))))
    return per.select(key, *keep, p.alias("p"))


def step(state: DataFrame, batch: DataFrame, key: str, label: str, idx_col: str = "idx",
         params: OnlineParams = OnlineParams(), add_bias: bool = True,
         broadcast_limit: int = 2_000_000, hold: list | None = None,
         only_touched: bool = False) -> tuple[DataFrame, DataFrame]:
    """One synchronous mini-batch. Returns (new state — with ``only_touched`` just
    the indices that the batch has —, per-row predictions
    made *before* the update: ``key, label, p``). ``key`` identifies a row
    and must be unique within the batch (the per-row step groups by it, so
    its groups are bounded by the row's width)."""
    idx = with_bias(F.col(idx_col)) if add_bias else F.col(idx_col)
    ex = batch.select(key, F.col(label).cast("double").alias("__y"), F.explode(idx).alias("idx"))
    j = _join_state(ex, state, params, broadcast_limit)
    # The row's own index list rides along the per-row shuffle (bounded by
    # the row's width), so no second join of the exploded rows is needed.
    per = j.groupBy(key).agg(F.sum("w").alias("wtx"), F.first("__y").alias("__y"),
                             F.collect_list("idx").alias("__idx"))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(F.col("wtx"), F.lit(WTX_CLIP)), F.lit(-WTX_CLIP))))
    scored = per.select(key, F.col("__y").alias(label), p.alias("p"), "__idx")
    if hold is not None:
        # The caller writes both outputs; keep the per-row scores for the
        # second write and release them afterwards (``hold`` collects them).
        scored = scored.persist()
        hold.append(scored)
    preds = scored.select(key, label, "p")
    grads = (scored.select((F.col("p") - F.col(label)).alias("g"), F.explode("__idx").alias("idx"))
             .groupBy("idx").agg(F.sum("g").alias("G"), F.sum(F.col("g") * F.col("g")).alias("G2"),
                                 F.count(F.lit(1)).cast("double").alias("C")))
    merged = state.select("idx", "a", "b").join(grads, "idx", "right" if only_touched else "full_outer")
    a1, b1 = _advanced(params, "a", "b", "G", "G2", "C")
    return merged.select("idx", a1.alias("a"), b1.alias("b")), preds


def save_state(state: DataFrame, path: str) -> DataFrame:
    """Write a state version and read it back (cuts the lineage; on shared
    storage a lost executor cannot lose it)."""
    spark = state.sparkSession
    state.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written whole."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _same_settings(spark: SparkSession, path: str, settings: str) -> None:
    """Note the settings of a fit; refuse a folder that holds a fit with others."""
    if _written(spark, f"{path}/settings"):
        found = "\n".join(r["value"] for r in spark.read.text(f"{path}/settings").collect())
        if found != settings:
            raise ValueError(f"{path} holds a fit with other settings: {found}")
    else:
        spark.createDataFrame([(settings,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def _by_batch(df: DataFrame, cols: Sequence[str], batch_col: str, n_batches: int, passes: int, path: str) -> DataFrame:
    """The rows of all batches, written once by batch if they are read more than
    once: a batch then reads its own rows and does not prepare the others again."""
    rows = df.select(*dict.fromkeys([*cols, batch_col]))
    if n_batches * passes < 2:
        return rows
    if not _written(df.sparkSession, path):
        rows.filter(F.col(batch_col).between(0, n_batches - 1)).write.mode("overwrite").partitionBy(batch_col).parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def fit(df: DataFrame, key: str, label: str, state_path: str, idx_col: str = "idx",
        params: OnlineParams = OnlineParams(), batch_col: str = "batch", n_batches: int | None = None,
        epochs: int = 1, valid_flag: str | None = None, add_bias: bool = True,
        start_state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Train over mini-batches in ``batch_col`` order, ``epochs`` passes
    (E9, E10). Every batch is scored before it updates the model
    (progressive validation); rows flagged ``valid_flag`` are scored but not
    trained on. Returns (final state, prediction log) where the log has
    ``epoch, batch, key, label, p, is_valid`` for every row and pass, and is
    written per batch below ``state_path/log``.

    Batches run one after another (each row must see the weights after the
    previous batch); the work inside a batch is distributed. A batch's log is
    written before its state, and a batch whose state is there is not run again: a
    restarted fit goes on after it and leaves no log row twice.
    """
    spark = df.sparkSession
    if n_batches is None:
        n_batches = df.agg(F.max(batch_col)).first()[0] + 1
    _same_settings(spark, state_path, f"{params} {idx_col} {batch_col} {n_batches} {valid_flag} {add_bias}")
    cols = [key, label, idx_col, *([valid_flag] if valid_flag else [])]
    # A batch is read for its training rows and, if there are any, for its held-out rows.
    df = _by_batch(df, cols, batch_col, n_batches, epochs * (2 if valid_flag else 1), f"{state_path}/rows")
    state = start_state if start_state is not None else empty_state(spark)
    for e in range(epochs):
        for b in range(n_batches):
            place = f"epoch={e}/batch={b}"
            if _written(spark, f"{state_path}/state/{place}"):
                state = spark.read.parquet(f"{state_path}/state/{place}")
                continue
            batch = df.filter(F.col(batch_col) == b)
            if valid_flag:
                train = batch.filter(~F.col(valid_flag))
                valid = batch.filter(F.col(valid_flag))
            else:
                train, valid = batch, None
            hold: list = []
            new_state, preds = step(state, train, key, label, idx_col, params, add_bias, hold=hold)
            logs = preds.select(key, label, "p", F.lit(False).alias("is_valid"))
            if valid is not None:
                vp = score(state, valid, key, idx_col, params, add_bias, keep=[label])
                logs = logs.unionByName(vp.select(key, label, "p", F.lit(True).alias("is_valid")))
            logs.write.mode("overwrite").parquet(f"{state_path}/log/{place}")
            state = save_state(new_state, f"{state_path}/state/{place}")
            for h in hold:
                h.unpersist()
    discard(spark, f"{state_path}/rows")
    return state, spark.read.parquet(f"{state_path}/log").select("epoch", "batch", key, label, "p", "is_valid")


def empty_sweep(spark: SparkSession, n: int) -> DataFrame:
    return spark.createDataFrame([], "idx bigint, " + ", ".join(f"a{i} double, b{i} double" for i in range(n)))


def sweep_step(state: DataFrame, batch: DataFrame, key: str, label: str, settings: Sequence[OnlineParams],
               idx_col: str = "idx", add_bias: bool = True, broadcast_limit: int = 2_000_000) -> DataFrame:
    """``step`` for several settings at once; the state has (a, b) per setting."""
    n = range(len(settings))
    idx = with_bias(F.col(idx_col)) if add_bias else F.col(idx_col)
    ex = batch.select(key, F.col(label).cast("double").alias("__y"), F.explode(idx).alias("idx"))
    j = ex.join(broadcast_if_small(state, broadcast_limit), "idx", "left") \
        .select(key, "__y", "idx", *[_weight(p, f"a{i}", f"b{i}").alias(f"w{i}") for i, p in enumerate(settings)])
    per = j.groupBy(key).agg(F.first("__y").alias("__y"), F.collect_list("idx").alias("__idx"),
                             *[F.sum(f"w{i}").alias(f"x{i}") for i in n])
    each = per.select(F.explode("__idx").alias("idx"), *[(_probability(F.col(f"x{i}")) - F.col("__y")).alias(f"g{i}") for i in n])
    grads = each.groupBy("idx").agg(F.count(F.lit(1)).cast("double").alias("C"),
                                    *[F.sum(f"g{i}").alias(f"G{i}") for i in n],
                                    *[F.sum(F.col(f"g{i}") * F.col(f"g{i}")).alias(f"S{i}") for i in n])
    merged = state.join(grads, "idx", "full_outer")
    new = [c.alias(f"{x}{i}") for i, p in enumerate(settings)
           for x, c in zip("ab", _advanced(p, f"a{i}", f"b{i}", f"G{i}", f"S{i}", "C"))]
    return merged.select("idx", *new)


def fit_sweep(df: DataFrame, key: str, label: str, state_path: str, settings: Sequence[OnlineParams], idx_col: str = "idx",
              batch_col: str = "batch", n_batches: int | None = None, epochs: int = 1, add_bias: bool = True) -> DataFrame:
    """All settings trained in the same passes (F9): the state after the last
    batch, equal to what ``fit`` gives each setting by itself. Resumes like it."""
    spark = df.sparkSession
    if n_batches is None:
        n_batches = df.agg(F.max(batch_col)).first()[0] + 1
    _same_settings(spark, state_path, f"{list(settings)} {idx_col} {batch_col} {n_batches} {add_bias}")
    df = _by_batch(df, [key, label, idx_col], batch_col, n_batches, epochs, f"{state_path}/rows")
    state = empty_sweep(spark, len(settings))
    for e in range(epochs):
        for b in range(n_batches):
            path = f"{state_path}/state/epoch={e}/batch={b}"
            if not _written(spark, path):
                sweep_step(state, df.filter(F.col(batch_col) == b), key, label, settings, idx_col, add_bias) \
                    .write.mode("overwrite").parquet(path)
            state = spark.read.parquet(path)
    discard(spark, f"{state_path}/rows")
    return state


def score_sweep(state: DataFrame, df: DataFrame, key: str, settings: dict[str, OnlineParams], idx_col: str = "idx",
                add_bias: bool = True, keep: Sequence[str] = (), broadcast_limit: int = 2_000_000) -> DataFrame:
    """(model, key, keep…, p) for every setting, named by the dict in the state's order."""
    idx = with_bias(F.col(idx_col)) if add_bias else F.col(idx_col)
    ex = df.select(key, *keep, F.explode(idx).alias("idx"))
    j = ex.join(broadcast_if_small(state, broadcast_limit), "idx", "left")
    per = j.groupBy(key, *keep).agg(*[F.sum(_weight(p, f"a{i}", f"b{i}")).alias(f"x{i}") for i, p in enumerate(settings.values())])
    rows = F.array(*[F.struct(F.lit(m).alias("model"), _probability(F.col(f"x{i}")).alias("p")) for i, m in enumerate(settings)])
    return per.select(key, *keep, F.explode(rows).alias("__r")).select("__r.model", key, *keep, "__r.p")


def batch_progress(log: DataFrame, label: str) -> DataFrame:
    """Per (epoch, batch): running train and hold-out log loss within the
    epoch and the hold-out row count (F3 for the online learners)."""
    from pyspark.sql import Window
    ll = row_logloss("p", label)
    per = log.groupBy("epoch", "batch").agg(
        F.sum(F.when(~F.col("is_valid"), ll)).alias("tl"), F.count_if(~F.col("is_valid")).alias("tn"),
        F.sum(F.when(F.col("is_valid"), ll)).alias("vl"), F.count_if(F.col("is_valid")).alias("vn"))
    w = Window.partitionBy("epoch").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("epoch", "batch",
                      F.try_divide(F.sum(F.coalesce("tl", F.lit(0.0))).over(w), F.sum("tn").over(w).cast("double")).alias("train_logloss"),
                      F.try_divide(F.sum(F.coalesce("vl", F.lit(0.0))).over(w), F.sum("vn").over(w).cast("double")).alias("valid_logloss"),
                      F.sum("vn").over(w).cast("bigint").alias("n_valid"))
