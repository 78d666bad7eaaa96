"""A stream of mini-batches gives the same model as the batch loop, and a
replayed micro-batch is applied once."""

import tempfile

from pyspark.sql import functions as F

from widetab.operators import online as O
from widetab.streaming import apply_batch, compact, latest_version, read_state, stream_fit
from widetab.streaming import online_stream as S

from conftest import SMALL


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="wt-stream-", dir="/tmp")
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    e = O.hash_features(e.select("event_id", "event_type", "user_id",
                                 (F.col("value") > 50).cast("int").alias("y")), ["event_type", "user_id"], 4096)
    e = e.withColumn("mb", F.pmod(F.col("event_id"), F.lit(3)))
    for b in range(3):
        e.filter(F.col("mb") == b).coalesce(1).write.mode("append").parquet(f"{base}/src")
    params = O.OnlineParams(alpha=0.1)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    q = stream_fit(stream, "event_id", "y", f"{base}/model", f"{base}/ckpt", params=params)
    q.awaitTermination()
    assert latest_version(spark, f"{base}/model") == 2
    st = {r["idx"]: (r["a"], r["b"]) for r in read_state(spark, f"{base}/model").collect()}
    ref, _ = O.fit(e, "event_id", "y", f"{base}/batch", params=params, batch_col="mb", n_batches=3)
    rf = {r["idx"]: (r["a"], r["b"]) for r in ref.collect()}
    assert set(st) == set(rf)
    for k in st:
        assert abs(st[k][0] - rf[k][0]) < 1e-9 and abs(st[k][1] - rf[k][1]) < 1e-9
    # restart on the same checkpoint: nothing new, nothing applied twice
    q2 = stream_fit(spark.readStream.schema(e.schema).parquet(f"{base}/src"), "event_id", "y",
                    f"{base}/model", f"{base}/ckpt", params=params)
    q2.awaitTermination()
    assert latest_version(spark, f"{base}/model") == 2


def _batches(spark, n):
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    e = O.hash_features(e.select("event_id", "event_type", "user_id", (F.col("value") > 50).cast("int").alias("y")),
                        ["event_type", "user_id"], 4096).limit(200).withColumn("mb", F.pmod(F.col("event_id"), F.lit(n)))
    return spark.createDataFrame(e.collect(), e.schema)


def _pairs(df):
    return {r["idx"]: (round(r["a"], 9), round(r["b"], 9)) for r in df.collect()}


def test_crash_replay_and_compaction(spark, tmp_path, monkeypatch):
    import pytest
    path, params = str(tmp_path / "model"), O.OnlineParams(alpha=0.1)
    e = _batches(spark, 5)
    want, _ = O.fit(e, "event_id", "y", str(tmp_path / "batch"), params=params, batch_col="mb", n_batches=5)
    run = lambda b: apply_batch(e.filter(F.col("mb") == b), b, "event_id", "y", path, params=params, compact_every=3)
    run(0)
    commit = S._commit
    # The crash comes after the log and the delta are written, before the commit.
    monkeypatch.setattr(S, "_commit", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        run(1)
    monkeypatch.setattr(S, "_commit", commit)
    assert latest_version(spark, path) == 0
    for b in (1, 1, 2, 3, 2, 4):                             # replays of committed batches change nothing
        run(b)
    assert latest_version(spark, path) == 4 and S._committed(spark, path, "base") == [2]
    assert _pairs(read_state(spark, path)) == _pairs(want)
    assert not (tmp_path / "model/delta/batch=1").exists() and (tmp_path / "model/delta/batch=3").exists()
    compact(spark, path)
    assert _pairs(read_state(spark, path)) == _pairs(want)
    log = spark.read.parquet(f"{path}/log")
    assert log.count() == 200 and log.select("event_id").distinct().count() == 200


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "model")
    e = _batches(spark, 1)
    apply_batch(e, 0, "event_id", "y", path)
    one = e.limit(1)
    apply_batch(one, 1, "event_id", "y", path)
    touched = {0, *one.first()["idx"]}
    delta = spark.read.parquet(f"{path}/delta/batch=1")
    assert {r["idx"] for r in delta.collect()} == touched
    assert read_state(spark, path).count() == read_state(spark, path, before=1).count()


def test_micro_batches_do_not_follow_the_files(spark, tmp_path):
    """Four mini-batches, however many files the events lie in."""
    from widetab.plans.registry import load_all
    e = spark.read.parquet(f"{SMALL}/events.parquet").limit(400)
    got = []
    for n in (1, 5):
        e.repartition(n).write.parquet(str(tmp_path / f"in{n}/events.parquet"))
        rows = load_all()["stream_fit"].build(spark, str(tmp_path / f"in{n}")).collect()
        got.append({r["event_id"]: (r["batch_id"], round(r["p"], 9)) for r in rows})
    assert got[0] == got[1] and {b for b, _ in got[1].values()} == {0, 1, 2, 3}
