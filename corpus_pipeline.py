"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``, others
of ``docs`` too, whatever their names. What a stage writes for its own use goes
when the next one begins.

Defined results, for every stage: an empty table gives an empty table. Null
and empty texts: quality rules reject them (fewer than 50 words), near-duplicates
link them with nothing, secrets leave them as they are, the mix keeps them once,
packing gives them one piece (the end id). Null ids are an id of their own, null
sources a source (last in the mix's order). Rows that repeat: quality rules judge
each alike, near-duplicates keep one, the mix gives rows of one id the same
number of copies, packing packs each. Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from widetab.llm import mixing, neardup, packing, quality, secrets
from widetab.llm.common import drop_shared, pipeline_stage, query_table, write_shared
from widetab.llm.queries import prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their host's verdict reject go."""
    prepare(spark)
    with pipeline_stage(docs):
        return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    prepare(spark)
    with pipeline_stage(docs):
        return neardup.drop_near_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in every text are replaced by a mark; no document goes."""
    prepare(spark)
    with pipeline_stage(docs):
        return secrets.redact(docs, length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words (0 to 3 times)."""
    prepare(spark)
    with pipeline_stage(docs):
        return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    prepare(spark)
    with pipeline_stage(docs):
        return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", redact_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]
#: Tokenised packing has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs, before = query_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
        if before is not None:
            drop_shared(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
