"""Reading and writing tables, predictions and stage outputs (A1, A4-A10).

Rows are tied by key, never by position: a prediction file is written from a
template of keys joined to the predictions, and stage outputs are written
per model under a ``model=`` partition so a crash loses one model only.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widetab.functions.exprs import nan_to_null, null_if_token, DEFAULT_NA_TOKENS
from widetab.operators._util import columns_by_type, qcol


def read_table(spark: SparkSession, path: str, key: str = "ID", label: str | None = "target",
               na_tokens: Iterable[str] = DEFAULT_NA_TOKENS, fmt: str = "parquet",
               schema=None, check_key: bool = False) -> DataFrame:
    """Read a labelled table (A1): key first, label (if any) last, missing
    text tokens → NULL in one projection; ``check_key`` refuses a repeated
    key. CSV is read with an explicit schema
    when given (inference is one extra pass over the data)."""
    if fmt == "csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    text = set(columns_by_type(df)["text"])
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    tokens = list(na_tokens)
    body = [c for c in df.columns if c not in (key, label)]

    def clean(c):
        if c in text:
            return null_if_token(qcol(c), tokens).alias(c)
        if c in floats:
            return nan_to_null(qcol(c)).alias(c)  # NaN is missing, as NULL is
        return qcol(c)
    cols = [qcol(key)] + [clean(c) for c in body]
    if label and label in df.columns:
        cols.append(qcol(label))
    if check_key:
        from widetab.operators.features import assert_unique_key
        assert_unique_key(df, key)
    return df.select(*cols)


def read_text_records(spark: SparkSession, path: str, key: str = "ID", label: str = "target") -> DataFrame:
    """All-text records (A4): every field is a string (the raw text is the
    category); the label is 1 when its text is exactly '1', else 0."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = [c for c in df.columns if c != label]
    y = (F.when(F.col(label) == "1", 1).otherwise(0) if label in df.columns else F.lit(0)).alias(label)
    return df.select(*[qcol(c) for c in cols], y)


def write_variant(df: DataFrame, path: str, columns: Sequence[str], key: str = "ID",
                  label: str | None = "target", mode: str = "overwrite") -> str:
    """Write one feature-set variant (A5): key first, label last, only the
    listed columns (a variant is a column list, not a copied table)."""
    body = [c for c in columns if c not in (key, label)]
    cols = [key] + body + ([label] if label and label in df.columns else [])
    df.select(*[qcol(c) for c in cols]).write.mode(mode).parquet(path)
    return path


def write_predictions(pred: DataFrame, keys: DataFrame, key: str = "ID", score: str = "target",
                      path: str | None = None, fmt: str = "csv") -> DataFrame:
    """``ID,target`` for every key of the template (A6). Positional pasting
    is replaced by a left join on the key; a key without a prediction keeps
    a NULL target. Writes when ``path`` is given."""
    out = keys.select(key).join(pred.select(key, score), key, "left")
    if path is not None:
        w = out.write.mode("overwrite")
        (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))
    return out


def read_predictions(spark: SparkSession, pattern: str, key: str = "ID", score: str = "target",
                     model_from: str = "dir") -> DataFrame:
    """Many prediction files by glob (A7) → long ``(model, key, target)``.

    The model name comes from the file's location (``_metadata.file_path``):
    its parent folder (``model_from="dir"``) or the file name.
    """
    df = (spark.read.option("header", True).schema(f"{key} bigint, {score} double").csv(pattern)
          .select(key, score, F.col("_metadata.file_path").alias("__path")))
    parts = F.split(F.col("__path"), "/")
    name = F.element_at(parts, -2) if model_from == "dir" else F.element_at(parts, -1)
    return df.select(F.regexp_replace(name, r"(^model=)|(\.csv$)", "").alias("model"), key, score)


def read_model_columns(spark: SparkSession, paths: dict[str, str], key: str = "ID", score: str = "target",
                       fmt: str = "csv") -> DataFrame:
    """Named prediction files, one column kept from each (A8) → long table
    ``(model, key, target)``: one scan per path, a literal model name,
    ``unionByName``."""
    out = None
    for model, path in paths.items():
        r = spark.read.option("header", True) if fmt == "csv" else spark.read
        df = r.schema(f"{key} bigint, {score} double").csv(path) if fmt == "csv" else r.format(fmt).load(path)
        part = df.select(F.lit(model).alias("model"), qcol(key), qcol(score).cast("double").alias(score))
        out = part if out is None else out.unionByName(part)
    return out


def checkpoint_stage(df: DataFrame, path: str, model: str, fmt: str = "parquet") -> str:
    """Save one model's stage output under ``model=<name>``.

    Dynamic partition overwrite replaces only that model's folder, so a
    re-run after a crash redoes one model and keeps the others.
    """
    (df.withColumn("model", F.lit(model)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("model").format(fmt).save(path))
    return path


def completed_models(spark: SparkSession, path: str) -> list[str]:
    """Models already present in a stage folder (A9), from the folder
    listing through the Hadoop file system (works on shared storage)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    # Dynamic overwrite moves a model's folder into place when its write
    # commits, so a folder that is there is finished.
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("model="):
            out.append(name[len("model="):])
    return sorted(out)


def run_id(params: dict, prefix: str = "") -> str:
    """A result name built from its parameters (A10), e.g. for an output
    folder; the parameters themselves go to the run log as columns."""
    body = "_".join(f"{k}_{params[k]}" for k in params)
    return f"{prefix}_{body}" if prefix else body
