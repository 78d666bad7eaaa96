"""Hashed features and online-learner queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from widetab.operators import metrics as M
from widetab.operators import online as O
from widetab.plans.registry import register
from widetab.plans.tables import read, sql_hash, sql_key_hash
from widetab.session import scratch_path

# Hash space for the checked queries (the learner default is the reference's
# 2**28 + 2**22; any D gives the same job shape).
D = 2 ** 20
FEATURES = ("event_type", "user_id", "props")


def _events(spark, d):
    e = read(spark, d, "events")
    return e.select("event_id", *FEATURES, F.when(F.col("value") > 50, 1).otherwise(0).alias("y"))


def _feat_sql(col: str) -> str:
    return f"{sql_hash(f"concat('{col}_', CAST({col} AS VARCHAR))")} % {D}"


_F_SQL = " UNION ALL ".join(
    f"SELECT event_id, '{c}' AS feature, {i} AS pos, {_feat_sql(c)} AS idx FROM events" for i, c in enumerate(FEATURES))


@register("hash_features", f"SELECT event_id, feature, idx FROM ({_F_SQL})", ("C8",))
def hash_features(spark, d):
    h = O.hash_features(_events(spark, d), FEATURES, D)
    return h.select("event_id", F.posexplode("idx").alias("pos", "idx")).select(
        "event_id", F.element_at(F.array(*[F.lit(c) for c in FEATURES]), F.col("pos") + 1).alias("feature"), "idx")


@register("hash_pairs", f"""
WITH f AS ({_F_SQL})
SELECT a.event_id, {sql_hash("concat(CAST(a.idx AS VARCHAR), '_', CAST(b.idx AS VARCHAR))")} % {D} AS pair_idx
FROM f a JOIN f b ON a.event_id = b.event_id AND (a.idx < b.idx OR (a.idx = b.idx AND a.pos < b.pos))
""", ("C9",))
def hash_pairs(spark, d):
    h = O.hash_pairs(O.hash_features(_events(spark, d), FEATURES, D), "idx", D)
    return h.select("event_id", F.explode("pair_idx").alias("pair_idx"))


ALPHA, BETA, L1, L2 = 0.05, 1.0, 0.5, 0.1


def _two_step(spark, d, algo):
    e = O.hash_features(_events(spark, d), FEATURES, D)
    e = e.withColumn("batch", F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"),
                                                                         F.lit("_batch"))), 1, 8), 16, 10)
                                     .cast("bigint"), F.lit(2)))
    params = O.OnlineParams(algo=algo, alpha=ALPHA, beta=BETA, l1=L1, l2=L2)
    state = O.empty_state(spark)
    for b in range(2):
        state, _ = O.step(state, e.filter(F.col("batch") == b), "event_id", "y", "idx", params)
    return state.select("idx", (F.round("a", 9) + F.lit(0.0)).alias("a"), (F.round("b", 9) + F.lit(0.0)).alias("b"))


def _two_step_sql(algo: str) -> str:
    zero = "CAST(0 AS DOUBLE)"
    if algo == "ftrl":
        weight = (f"CASE WHEN abs(coalesce(a, {zero})) <= {L1} THEN {zero} ELSE "
                  f"(sign(coalesce(a, {zero})) * {L1} - coalesce(a, {zero})) / "
                  f"(({BETA} + sqrt(coalesce(b, {zero}))) / {ALPHA} + {L2}) END")
        upd_a = (f"coalesce(a, {zero}) + coalesce(G, {zero}) - ((sqrt(coalesce(b, {zero}) + coalesce(G2, {zero})) "
                 f"- sqrt(coalesce(b, {zero}))) / {ALPHA}) * w")
        upd_b = f"coalesce(b, {zero}) + coalesce(G2, {zero})"
    else:
        weight = f"coalesce(a, {zero})"
        upd_b = f"coalesce(b, {zero}) + coalesce(G2, {zero})"
        upd_a = (f"coalesce(a, {zero}) - {ALPHA} / ({BETA} + sqrt({upd_b})) * "
                 f"(coalesce(G, {zero}) + {L2} * coalesce(C, {zero}) * coalesce(a, {zero}))")
    steps = []
    prev = "s0"
    for b in range(2):
        steps.append(f"""
w{b} AS (SELECT idx, a, b, {weight} AS w FROM {prev}),
x{b} AS (SELECT f.event_id, f.y, f.idx, coalesce(w{b}.w, {zero}) AS w FROM f LEFT JOIN w{b} ON f.idx = w{b}.idx
         WHERE f.batch = {b}),
p{b} AS (SELECT event_id, max(y) AS y,
                1 / (1 + exp(-greatest(least(sum(w), 35), -35))) AS p FROM x{b} GROUP BY event_id),
g{b} AS (SELECT x{b}.idx, sum(p{b}.p - p{b}.y) AS G, sum((p{b}.p - p{b}.y) * (p{b}.p - p{b}.y)) AS G2,
                CAST(count(*) AS DOUBLE) AS C
         FROM x{b} JOIN p{b} ON x{b}.event_id = p{b}.event_id GROUP BY x{b}.idx),
s{b + 1} AS (SELECT coalesce(m.idx, g{b}.idx) AS idx, m.a, m.b, m.w, g{b}.G, g{b}.G2, g{b}.C
           FROM w{b} m FULL OUTER JOIN g{b} ON m.idx = g{b}.idx),
t{b + 1} AS (SELECT idx, {upd_a.replace(" w", " coalesce(w, " + zero + ")")} AS a, {upd_b} AS b FROM s{b + 1})""")
        prev = f"t{b + 1}"
    body = ",".join(steps)
    return _two_step_ctes(body) + f"""
SELECT idx, round(a, 9) + {zero} AS a, round(b, 9) + {zero} AS b FROM t2"""


def _two_step_ctes(body: str) -> str:
    return f"""
WITH e AS (SELECT event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS y,
                  {sql_key_hash('event_id', 'batch')} % 2 AS batch, event_type, user_id, props FROM events),
f AS (SELECT event_id, y, batch, CAST(0 AS BIGINT) AS idx FROM e
      UNION ALL """ + " UNION ALL ".join(
        f"SELECT event_id, y, batch, {_feat_sql(c)} FROM e" for c in FEATURES) + f"""),
s0 AS (SELECT CAST(NULL AS BIGINT) AS idx, CAST(NULL AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b WHERE false),{body}"""


@register("ftrl_two_steps", _two_step_sql("ftrl"), ("E9",))
def ftrl_two_steps(spark, d):
    return _two_step(spark, d, "ftrl")


@register("adagrad_two_steps", _two_step_sql("adagrad"), ("E10",))
def adagrad_two_steps(spark, d):
    return _two_step(spark, d, "adagrad")


def _prepared(spark, d, n_batches=4):
    e = O.hash_features(_events(spark, d), FEATURES, D)
    e = e.withColumn("batch", F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"),
                                                                         F.lit("_mb"))), 1, 8), 16, 10)
                                     .cast("bigint"), F.lit(n_batches)))
    from widetab.operators.ordering import row_number
    e = row_number(e, ["event_id"], (), "rn").withColumn("is_valid", F.pmod("rn", F.lit(100)) == 0)
    return e


@register("ftrl_progress", None, ("E9", "F3", "D6"))
def ftrl_progress(spark, d):
    e = _prepared(spark, d)
    state, log = O.fit(e, "event_id", "y", scratch_path(spark, "ftrl"), params=O.OnlineParams(alpha=0.05),
                       n_batches=4, epochs=2, valid_flag="is_valid")
    return O.batch_progress(log, "y")


@register("adagrad_scores", None, ("E10", "E15"))
def adagrad_scores(spark, d):
    e = _prepared(spark, d)
    params = O.OnlineParams(algo="adagrad", alpha=0.05)
    state, _log = O.fit(e, "event_id", "y", scratch_path(spark, "adagrad"), params=params, n_batches=4)
    scored = O.score(state, e, "event_id", params=params, keep=["y"])
    return M.auc(scored, "p", "y")


N_APPENDS = 4


def _stream(spark, d, start, appends=1):
    """Hashed event rows as a file stream source in the shared folder, one append
    per mini-batch. ``start`` gets the stream after every ``appends`` appends and
    runs it over what is new on its checkpoint: a micro-batch holds whole
    appends, however many files Spark writes for each."""
    e = O.hash_features(_events(spark, d), FEATURES, D)
    mb = F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("_mb"))), 1, 8), 16, 10)
                .cast("bigint"), F.lit(N_APPENDS))
    src = scratch_path(spark, "stream-src")
    for b in range(N_APPENDS):
        e.filter(mb == b).write.mode("append").parquet(src)
        if (b + 1) % appends == 0 or b + 1 == N_APPENDS:
            start(spark.readStream.schema(e.schema).parquet(src)).awaitTermination()


@register("stream_fit", None, ("H1", "E9"))
def stream_fit(spark, d):
    from widetab.streaming import stream_fit as run
    base = scratch_path(spark, "stream-fit")
    _stream(spark, d, lambda stream: run(stream, "event_id", "y", f"{base}/model", f"{base}/ckpt",
                                         params=O.OnlineParams(alpha=0.05)))
    return spark.read.parquet(f"{base}/model/log").select("event_id", "y", "p", "batch_id")


@register("stream_score", None, ("H2",))
def stream_score(spark, d):
    from widetab.streaming import stream_score as run
    base = scratch_path(spark, "stream-score")
    params = O.OnlineParams(alpha=0.05)
    e = O.hash_features(_events(spark, d), FEATURES, D)
    state, _ = O.fit(e.withColumn("batch", F.lit(0)), "event_id", "y", f"{base}/model", params=params, n_batches=1)
    _stream(spark, d, lambda stream: run(stream, "event_id", f"{base}/scores", f"{base}/ckpt", state=state, params=params,
                                         keep=["y"]), appends=2)
    return spark.read.parquet(f"{base}/scores").select("event_id", "y", "p", "batch_id")


@register("ftrl_wide_table", None, ("E9", "C8", "D6", "F1"))
def ftrl_wide_table(spark, d):
    """FTRL on the wide labelled table with every column hashed as text (the
    reference's online setup): every 100th row in key order is held out and
    only scored, the rest train in four hashed mini-batches, one pass.
    ``status`` is left out: the label is derived from it. Returns train and
    hold-out AUC from the prediction log (scores made before each update)."""
    from widetab.operators import sampling as SMP
    from widetab.plans.tables import KEY, LABEL, wide
    w = wide(spark, d)
    cols = [c for c in w.columns if c not in (KEY, LABEL, "status")]
    h = O.hash_features(w, cols, O.DEFAULT_D).select(KEY, LABEL, "idx")
    h = SMP.every_nth(h, KEY, 100)
    h = SMP.folds(h, KEY, 4, seed="mb", name="batch")
    _state, log = O.fit(h, KEY, LABEL, scratch_path(spark, "ftrl-wide"), params=O.OnlineParams(alpha=0.05),
                        n_batches=4, epochs=1, valid_flag="is_valid")
    return M.auc(log, "p", LABEL, ["epoch", "is_valid"])



def _ftrl_state(spark, d):
    e = O.hash_features(_events(spark, d), FEATURES, D)
    e = e.withColumn("batch", F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"),
                                                                         F.lit("_batch"))), 1, 8), 16, 10)
                                     .cast("bigint"), F.lit(2)))
    params = O.OnlineParams(algo="ftrl", alpha=ALPHA, beta=BETA, l1=L1, l2=L2)
    state = O.empty_state(spark)
    for b in range(2):
        state, _ = O.step(state, e.filter(F.col("batch") == b), "event_id", "y", "idx", params)
    return O.save_state(state, scratch_path(spark, "ftrl-state")), params


def _stream_score_sql() -> str:
    zero = "CAST(0 AS DOUBLE)"
    full = _two_step_sql("ftrl")
    ctes = full[:full.rindex("SELECT idx, round(a, 9)")]
    weight = (f"CASE WHEN abs(coalesce(a, {zero})) <= {L1} THEN {zero} ELSE "
              f"(sign(coalesce(a, {zero})) * {L1} - coalesce(a, {zero})) / "
              f"(({BETA} + sqrt(coalesce(b, {zero}))) / {ALPHA} + {L2}) END")
    return ctes + f""",
wf AS (SELECT idx, {weight} AS w FROM t2),
sc AS (SELECT f.event_id, max(f.y) AS y, sum(coalesce(wf.w, {zero})) AS wtx
       FROM f LEFT JOIN wf ON f.idx = wf.idx GROUP BY f.event_id)
SELECT event_id, y, round(1 / (1 + exp(-greatest(least(wtx, 35), -35))), 9) + {zero} AS p FROM sc"""


@register("stream_score_ftrl", _stream_score_sql(), ("H2", "E9", "E15"))
def stream_score_ftrl(spark, d):
    """Score a stream of events with the FTRL state of two mini-batch steps
    (stream–static, per micro-batch); same scores as SQL replaying the steps."""
    from widetab.streaming import stream_score as run
    state, params = _ftrl_state(spark, d)
    base = scratch_path(spark, "stream-score-ftrl")
    _stream(spark, d, lambda stream: run(stream, "event_id", f"{base}/scores", f"{base}/ckpt", state=state, params=params, keep=["y"]))
    out = spark.read.parquet(f"{base}/scores")
    return out.select("event_id", "y", (F.round("p", 9) + F.lit(0.0)).alias("p"))


@register("stream_fit_two_batches", _two_step_sql("ftrl"), ("H1", "E9"))
def stream_fit_two_batches(spark, d):
    """FTRL on a stream of two micro-batches, a base written after each: the same
    state as SQL replaying the steps."""
    from widetab.streaming import read_state
    from widetab.streaming import stream_fit as run
    e = O.hash_features(_events(spark, d), FEATURES, D)
    batch = F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("_batch"))), 1, 8), 16, 10)
                   .cast("bigint"), F.lit(2))
    base = scratch_path(spark, "stream-two")
    params = O.OnlineParams(algo="ftrl", alpha=ALPHA, beta=BETA, l1=L1, l2=L2)
    for b in range(2):
        e.filter(batch == b).coalesce(1).write.mode("append").parquet(f"{base}/src")
        stream = spark.readStream.schema(e.schema).parquet(f"{base}/src")
        run(stream, "event_id", "y", f"{base}/model", f"{base}/ckpt", params=params, compact_every=1 + b).awaitTermination()
    return read_state(spark, f"{base}/model").select(
        "idx", (F.round("a", 9) + F.lit(0.0)).alias("a"), (F.round("b", 9) + F.lit(0.0)).alias("b"))
