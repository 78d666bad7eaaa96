"""Online learning on a stream (H1) and scoring a stream (H2).

``stream_fit`` runs one mini-batch step (``operators.online.step``) per
micro-batch inside ``foreachBatch``: each micro-batch is scored *before* it
updates the model (progressive validation). State lives only in the shared
folder, in hash buckets of the feature index:

* ``delta/batch=<id>/bucket=<k>`` — the new pairs of the indices that a
  micro-batch touched, and of no others; a step reads the touched buckets only;
* ``base/version=<id>/bucket=<k>`` — all pairs as of that batch, written when
  ``compact_every`` deltas have come together (the tables before it then go);
* ``log/batch=<id>`` — the batch's predictions;
* ``commits/batch=<id>``, ``commits/base=<id>`` — empty files, created at once
  when what they name is written whole.

Only committed versions are read. A micro-batch that is replayed after a crash
(Structured Streaming runs the last uncommitted batch again) overwrites what it had
begun, and one that is committed is skipped: each is applied exactly once.

A stateful streaming operator keyed by feature cannot express this: a row's
gradient needs the weights of all its features at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widetab.operators import online as O
from widetab.session import discard

BUCKETS = 64
COMPACT_EVERY = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _committed(spark: SparkSession, state_path: str, kind: str) -> list[int]:
    fs, p = _fs(spark, f"{state_path}/commits")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[len(kind) + 1:]) for n in names if n.startswith(f"{kind}="))


def _commit(spark: SparkSession, state_path: str, kind: str, version: int) -> None:
    fs, p = _fs(spark, f"{state_path}/commits/{kind}={version}")
    fs.create(p, True).close()


def latest_version(spark: SparkSession, state_path: str) -> int | None:
    """The last micro-batch that the state holds."""
    v = _committed(spark, state_path, "batch")
    return v[-1] if v else None


def _bucket(idx) -> F.Column:
    return F.pmod(F.xxhash64(idx), F.lit(BUCKETS)).cast("int")


def read_state(spark: SparkSession, state_path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """(idx, a, b) after all committed batches (before one, in some buckets): the
    latest pair of each index in the last base and the deltas since."""
    bases = [v for v in _committed(spark, state_path, "base") if before is None or v < before]
    deltas = [v for v in _committed(spark, state_path, "batch") if (before is None or v < before) and (not bases or v > bases[-1])]
    paths = [(v, f"{state_path}/delta/batch={v}") for v in deltas]
    if bases:
        paths.append((bases[-1], f"{state_path}/base/version={bases[-1]}"))
    out: DataFrame | None = None
    for v, path in paths:                                # at most compact_every + 1 tables
        part = spark.read.schema("idx bigint, a double, b double, bucket int").parquet(path)
        if buckets is not None:
            part = part.filter(F.col("bucket").isin(buckets))
        part = part.select("idx", "a", "b", F.lit(v).alias("__v"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return O.empty_state(spark)
    if len(paths) == 1:
        return out.drop("__v")
    return out.groupBy("idx").agg(F.max_by(F.struct("a", "b"), "__v").alias("s")).select("idx", "s.a", "s.b")


def _by_bucket(state: DataFrame) -> DataFrame:
    return state.withColumn("bucket", _bucket(F.col("idx"))).repartition("bucket")


def compact(spark: SparkSession, state_path: str) -> None:
    """Write all pairs as a base of the last committed batch; what it replaces goes."""
    version = latest_version(spark, state_path)
    old = _committed(spark, state_path, "base")
    if version is None or version in old:
        return
    gone = [f"{state_path}/delta/batch={v}" for v in _committed(spark, state_path, "batch")]
    gone += [f"{state_path}/base/version={v}" for v in old]
    _by_bucket(read_state(spark, state_path)).write.mode("overwrite").partitionBy("bucket") \
        .parquet(f"{state_path}/base/version={version}")
    _commit(spark, state_path, "base", version)
    for path in gone:
        discard(spark, path)


def apply_batch(batch_df: DataFrame, batch_id: int, key: str, label: str, state_path: str, idx_col: str = "idx",
                params: O.OnlineParams = O.OnlineParams(), add_bias: bool = True, compact_every: int = COMPACT_EVERY) -> None:
    """Apply one micro-batch to the state, unless it is committed."""
    spark = batch_df.sparkSession
    done = _committed(spark, state_path, "batch")
    if batch_id in done:
        return
    rows = batch_df.select(key, label, idx_col).persist()
    hold: list = []
    try:
        idx = O.with_bias(F.col(idx_col)) if add_bias else F.col(idx_col)
        touched = [r[0] for r in rows.select(F.explode(idx).alias("i")).select(_bucket(F.col("i"))).distinct().collect()]
        state = read_state(spark, state_path, before=batch_id, buckets=touched)
        new, preds = O.step(state, rows, key, label, idx_col, params, add_bias, hold=hold, only_touched=True)
        preds.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{state_path}/log/batch={batch_id}")
        _by_bucket(new).write.mode("overwrite").partitionBy("bucket").parquet(f"{state_path}/delta/batch={batch_id}")
    finally:
        for h in hold:
            h.unpersist()
        rows.unpersist()
    _commit(spark, state_path, "batch", batch_id)
    bases = _committed(spark, state_path, "base")
    if sum(v > (bases[-1] if bases else -1) for v in [*done, batch_id]) >= compact_every:
        compact(spark, state_path)


def stream_fit(stream: DataFrame, key: str, label: str, state_path: str, checkpoint: str,
               idx_col: str = "idx", params: O.OnlineParams = O.OnlineParams(), add_bias: bool = True,
               available_now: bool = True, processing_time: str | None = None, compact_every: int = COMPACT_EVERY):
    """Start the online learner on a streaming DataFrame carrying ``key``,
    ``label`` and an index array (H1). Returns the ``StreamingQuery``;
    with ``available_now`` it stops after the data present at start."""

    def process(batch_df: DataFrame, batch_id: int) -> None:
        apply_batch(batch_df, batch_id, key, label, state_path, idx_col, params, add_bias, compact_every)

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def stream_score(stream: DataFrame, key: str, out_path: str, checkpoint: str, model=None,
                 state: DataFrame | None = None, idx_col: str = "idx", params: O.OnlineParams = O.OnlineParams(),
                 keep=(), available_now: bool = True):
    """Score a stream with a fixed model (H2). Spark ML models score the
    stream directly (stateless ``transform``); an online-learner state is
    joined per micro-batch (stream–static), since summing a row's weights
    needs all of its indices."""
    if model is not None:
        from widetab.operators.learners import predict
        scored = predict(model, stream, key, keep=keep)
        w = scored.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()

    def process(batch_df: DataFrame, batch_id: int) -> None:
        O.score(state, batch_df, key, idx_col, params, keep=list(keep)) \
            .withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
