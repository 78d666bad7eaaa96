"""Internal helpers shared by operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)

# Largest lookup / side table we broadcast after counting it.
BROADCAST_ROW_LIMIT = 2_000_000


def columns_by_type(df: DataFrame, exclude: Iterable[str] = ()) -> dict[str, list[str]]:
    """Schema-only split of columns into numeric / text / temporal / other."""
    skip = set(exclude)
    out: dict[str, list[str]] = {"numeric": [], "text": [], "temporal": [], "other": []}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType) or isinstance(f.dataType, NUMERIC_TYPES):
            out["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            out["text"].append(f.name)
        elif isinstance(f.dataType, TEMPORAL_TYPES):
            out["temporal"].append(f.name)
        else:
            out["other"].append(f.name)
    return out


def chunks(seq: Sequence, size: int):
    for i in range(0, len(seq), size):
        yield seq[i:i + size]


def sum_columns(exprs: list):
    """Balanced sum of column expressions (keeps generated code shallow)."""
    if not exprs:
        return F.lit(0)
    while len(exprs) > 1:
        exprs = [exprs[i] + exprs[i + 1] if i + 1 < len(exprs) else exprs[i]
                 for i in range(0, len(exprs), 2)]
    return exprs[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only after counting it; above the limit the join is
    left to the planner (sort-merge, or AQE's runtime conversion)."""
    n = df.count()
    return F.broadcast(df) if n <= limit else df


def bounded_broadcast(df: DataFrame, bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction
    (``bound`` rows, e.g. columns × buckets); no job is run."""
    return F.broadcast(df) if bound <= limit else df


def qcol(name: str):
    """Column reference that tolerates dots and odd characters in names."""
    return F.col(f"`{name}`")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared checkpoint folder, and its path for ``discard``."""
    from widetab.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in two tasks per core at most: for passes that are repeated, where
    what a task costs by itself adds up."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back
    (reliable ``checkpoint``): later passes reuse it instead of recomputing
    the lineage, and a lost executor cannot lose it. Used for aggregated
    intermediates that several later passes read."""
    from widetab.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
