"""Registered queries of the training-data operators: whole tables, production
parameters. ``QUERIES`` maps a name to (spark, sf_dir) → DataFrame, ``SQL`` to
DuckDB SQL where it can express the result."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widetab.llm import alignment, dialogue, fingerprint, html_tree, licenses, mixing, neardup, packing, quality, rans, secrets, trie_bpe, warc
from widetab.llm.common import query_table, shared_path
from widetab.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Shared folder set, and the package on the Python workers' path."""
    ensure_checkpoint_dir(spark)
    top, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    held = env.get("PYTHONPATH", "").split(os.pathsep)
    if top not in held:
        env["PYTHONPATH"] = os.pathsep.join([top, *[p for p in held if p]])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


@query("op1_secret_scan")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.scan(query_table(spark, sf_dir, "documents")))


@query("op2_fingerprints")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(query_table(spark, sf_dir, "documents"))


@query("op3_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS b FROM pages),
g AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p WHERE b >= 1000 GROUP BY h),
j AS (SELECT p.*, g.top, coalesce(g.n > 1 AND p.page_id IS DISTINCT FROM g.top AND g.top IS NOT NULL, false) AS rv
      FROM p LEFT JOIN g ON p.h = g.h AND p.b >= 1000)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN rv THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN rv THEN top END AS refers_to, true AS verified
FROM j""")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc-archive")
    warc.write_archive(query_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


@query("op4_source_mix")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(query_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op5_best_two_fit")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(query_table(spark, sf_dir, "documents"))


@query("op6_token_files")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-archive")
    rans.write_ids(query_table(spark, sf_dir, "documents"), path)
    return rans.read_documents(spark, path).select("doc_id", "start", F.col("n_tokens"), "ids_crc32")


@query("op7_near_duplicates", neardup.COMPONENTS_SQL)
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(query_table(spark, sf_dir, "documents"), width=3, percent=85).drop("th")


@query("op8_host_quality", quality.JUDGE_SQL)
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(query_table(spark, sf_dir, "documents"))


@query("op9_main_text")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.main_text(query_table(spark, sf_dir, "pages"))


@query("op10_licence_scan")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(query_table(spark, sf_dir, "documents"))


@query("op11_dialogue_repair", dialogue.REPAIR_SQL)
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(query_table(spark, sf_dir, "conversations"))


@query("op12_trie_bpe")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encoding_digests(query_table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(query_table(spark, sf_dir, "documents"))
