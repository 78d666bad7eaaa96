"""Quality rules with host-level verdicts (operator 8), DataFrame functions only.

Every text is measured on its own (words, code points in words, symbols,
repeated lines, words in repeated 3-word windows). Rule failures are summed by
domain (``source``); a domain's failure rate is shrunk towards the corpus rate
by a beta prior whose two parameters are fitted to all domains by moments; a
domain whose shrunk rate exceeds ``host_limit`` is rejected, and its verdict is
joined back to its documents. Domains are sums of partial counts, so a hot
domain is one row after each task; the join back is a checked broadcast or a
shuffle that AQE splits.

Defined results: null text has no words (all measures 0, base fails); null
source is a domain of its own; repeated rows are measured each; an empty table
gives an empty table; other columns of the input do not matter (``judge``
returns only its own columns, ``keep_good`` all of the input's and no other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from widetab.llm.common import WORD, small_or_shuffled, write_shared

SYMBOLS = "#*$%&|<>"
GAPS = r"[\x20\x09-\x0D]"
HOST_LIMIT = 0.8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with a struct column ``name`` of the MEASURES of ``text``."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, GAPS + "+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    df = df.withColumn(name, F.struct(
        words.alias("words"),
        F.length(F.regexp_replace(t, GAPS, "")).alias("chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("symbols"),
        lines.alias("lines")))
    w = F.col(f"{name}.words")
    n = F.size(w)
    windows = F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    df = df.withColumn(name, F.struct(
        n.cast("bigint").alias("n_words"), F.col(f"{name}.chars").cast("bigint").alias("word_chars"),
        F.col(f"{name}.symbols").cast("bigint").alias("n_symbols"),
        (F.size(f"{name}.lines") - F.size(F.array_distinct(f"{name}.lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows")))
    # Windows that occur twice, by sorting (hash, place): equal neighbours.
    h = F.col(f"{name}.windows")
    twice = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn(name, F.struct(
        *[F.col(f"{name}.{c}").alias(c) for c in MEASURES[:4]],
        F.when(twice, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("sorted")))
    s = F.col(f"{name}.sorted")
    places = F.sort_array(F.transform(
        F.filter(F.transform(s, lambda x, k: F.struct(
            x["i"].alias("i"), (F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))
                                | F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))).alias("two"))),
                 lambda x: x["two"]), lambda x: x["i"]))
    # Each place covers three words; those that the place before it covers are not counted again.
    covered = F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return df.withColumn(name, F.struct(
        *[F.col(f"{name}.{c}").alias(c) for c in MEASURES[:4]],
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words")))


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < 50) | (100 * F.col(f"{m}.n_repeat_words") > 50 * F.col(f"{m}.n_words"))


def any_rule_failed(m: str) -> Column:
    """Base rules and three more that count towards the host's rate."""
    n = F.greatest(F.col(f"{m}.n_words"), F.lit(1))
    return (base_failed(m) | (10 * F.col(f"{m}.n_symbols") > n)
            | (10 * F.col(f"{m}.n_dup_lines") > 3 * n) | (F.col(f"{m}.word_chars") > 12 * n))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(a, b) of the beta prior by moments over (n, failed) per host."""
    r = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("k"),
                  F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("ss")).first()
    if not r["n"]:
        return 1.0, 1.0
    mean = float(r["f"]) / r["n"]
    spread = float(r["ss"]) / r["n"] - mean * mean      # variance of host rates, weighed by documents
    within = mean * (1 - mean) * r["k"] / r["n"]        # what chance alone gives
    between = max(spread - within, 1e-6)
    strength = min(max(mean * (1 - mean) / between - 1, 2.0), 1e6)
    mean = min(max(mean, 1e-3), 1 - 1e-3)
    return mean * strength, (1 - mean) * strength


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, rate, host_ok) from rows (host, failed)."""
    hosts = write_shared(rows.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("bigint")).alias("failed")), "quality-hosts")
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + a) / (F.col("n") + a + b)
    return hosts.select(F.col("host").alias("vhost"), rate.alias("rate"), (rate <= limit).alias("host_ok"))


def _joined(rows: DataFrame, limit: float) -> DataFrame:
    verdicts = host_verdicts(rows.select("host", "failed"), limit)
    return rows.join(small_or_shuffled(verdicts, 200), F.col("host").eqNullSafe(F.col("vhost")))


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", domain: str = "source",
          limit: float = HOST_LIMIT) -> DataFrame:
    """Per document: key, MEASURES, base_failed, kept."""
    src = df.select(F.col(key).alias("k"), F.col(domain).alias("host"), F.col(text).alias("t"))
    rows = write_shared(measured(src, F.col("t"), "m").select(
        "k", "host", "m", base_failed("m").alias("base"), any_rule_failed("m").alias("failed")), "quality-measures")
    return _joined(rows, limit).select(
        F.col("k").alias(key), *[F.col(f"m.{c}").alias(c) for c in MEASURES], F.col("base").alias("base_failed"),
        (~F.col("base") & F.col("host_ok")).alias("kept"))


def keep_good(df: DataFrame, text: str = "text", domain: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``df`` that base rules and host verdicts keep."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = write_shared(measured(packed, F.col(f"row.`{text}`"), "m").select(
        "row", F.col(f"row.`{domain}`").alias("host"), base_failed("m").alias("base"),
        any_rule_failed("m").alias("failed")), "quality-rows", "zstd")
    return _joined(rows, limit).filter(~F.col("base") & F.col("host_ok")).select("row.*")


JUDGE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
a AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM a WHERE len(w) >= 3)),
two AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n >= 2),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM two) GROUP BY rid),
m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM a LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 10 * n_symbols > greatest(n_words, 1) OR 10 * n_dup_lines > 3 * greatest(n_words, 1)
             OR word_chars > 12 * greatest(n_words, 1) AS failed FROM b),
h AS (SELECT source, count(*) AS n, sum(CAST(failed AS INT)) AS f FROM f GROUP BY source),
s AS (SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS sq, count(*) / sum(n) AS per FROM h),
p AS (SELECT least(greatest(mean, 1e-3), 1 - 1e-3) AS mu,
             least(greatest(mean * (1 - mean) / greatest(sq - mean * mean - mean * (1 - mean) * per, 1e-6) - 1, 2.0), 1e6) AS k
      FROM s),
v AS (SELECT source, (f + mu * k) / (n + k) <= 0.8 AS host_ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
