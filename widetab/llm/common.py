"""Helpers of the training-data operators: shared tables, batches, order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widetab.session import discard, ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


#: Folders that the pipeline's present stage has written, while one runs.
_STAGE: list[str] | None = None
_LEFT: list[str] = []


@contextmanager
def pipeline_stage(docs: DataFrame) -> Iterator[None]:
    """A stage of the pipeline: the tables that the stage before wrote for its own
    use go, as its output is written by now; any that ``docs`` still reads stays."""
    global _STAGE, _LEFT
    read = " ".join(docs.inputFiles())
    _LEFT = [p for p in _LEFT if p.rsplit("/", 1)[1] in read or discard(docs.sparkSession, p)]
    _STAGE = []
    try:
        yield
    finally:
        _LEFT, _STAGE = _LEFT + _STAGE, None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_shared(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends
    there and a lost executor costs only a re-read. Tables of texts or ids take
    ``zstd`` (smaller files); for small ones its native buffers cost more."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    if _STAGE is not None:
        _STAGE.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_folder = path
    return out


def drop_shared(*tables: DataFrame) -> None:
    """Delete tables of ``write_shared`` that nothing will read again (what was
    computed from them is written)."""
    for t in tables:
        discard(t.sparkSession, t.shared_folder)
        if _STAGE and t.shared_folder in _STAGE:
            _STAGE.remove(t.shared_folder)


def text_column(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def map_rows(df: DataFrame, schema: str | T.StructType, fn: Callable[[Iterator[dict]], Iterator[dict]],
             rows: int = 256) -> DataFrame:
    """Run ``fn`` over each partition as a stream of column dicts (lists) and
    send its column dicts back as Arrow batches of at most ``rows`` input rows."""
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    names = df.columns

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(placed)

        def feed():
            for b in it:
                for at in range(0, b.num_rows, rows):
                    yield dict(zip(names, b.slice(at, rows).to_pydict().values()))
        for got in fn(feed()):
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=o.type) for f, o in zip(target, out)], schema=out)
    # Columns travel by place, so any name will do (one with a dot too).
    placed = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(target)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(batches, placed).toDF(*[f.name for f in target])


def small_or_shuffled(df: DataFrame, row_bytes: int, limit_bytes: int = 64 << 20) -> DataFrame:
    """Mark ``df`` for broadcast if its counted rows times ``row_bytes`` stay
    under the limit; beyond it the join shuffles (AQE splits hot keys)."""
    return F.broadcast(df) if df.count() * row_bytes <= limit_bytes else df


def word_count(col: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs of a string column: every
    other character becomes one letter, so runs are what a split leaves."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("bigint")


def query_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
