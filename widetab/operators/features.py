"""Feature building.

Columns are always added in one ``select`` built from a list of expressions
(never ``withColumn`` in a loop: a 400-column loop makes the plan explode).
Data-driven choices (sentinel codes, level ids, importance ranks) are
computed by aggregates whose results are p-sized; row-level work stays in
column expressions inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widetab.functions.exprs import epoch_seconds, nan_to_null, parse_text_date, TEXT_DATE_FORMAT
from widetab.operators.ordering import row_number
from widetab.operators._util import (
    bounded_broadcast, broadcast_if_small, columns_by_type, materialize, qcol,
)


def _replace(df: DataFrame, mapping: dict) -> DataFrame:
    """Replace some columns in place, keeping column order."""
    return df.select(*[(mapping[c].alias(c) if c in mapping else qcol(c)) for c in df.columns])


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str = TEXT_DATE_FORMAT,
                as_epoch: bool = False) -> DataFrame:
    """Text dates → timestamps (or epoch seconds), unparsable → NULL."""
    conv = (lambda c: epoch_seconds(parse_text_date(qcol(c), fmt))) if as_epoch \
        else (lambda c: parse_text_date(qcol(c), fmt))
    return _replace(df, {c: conv(c) for c in cols})


def to_epoch(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Timestamp columns → seconds since the epoch as double."""
    return _replace(df, {c: epoch_seconds(qcol(c)) for c in cols})


def hour_of_day(df: DataFrame, cols: Sequence[str], suffix: str = "_hour") -> DataFrame:
    """Add the hour of day of each timestamp column."""
    return df.select("*", *[F.hour(qcol(c)).alias(c + suffix) for c in cols])


def fill_sentinel(df: DataFrame, value: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL or NaN) numeric cells → ``value``."""
    cols = columns_by_type(df)["numeric"] if cols is None else list(cols)
    types = dict(df.dtypes)
    mapping = {}
    for c in cols:
        v = nan_to_null(qcol(c)) if types[c] in ("double", "float") else qcol(c)
        mapping[c] = F.coalesce(v, F.lit(value).cast(types[c]))
    return _replace(df, mapping)


def clamp_negative(df: DataFrame, value: float, cols: Sequence[str]) -> DataFrame:
    """Every negative value → ``value``."""
    return _replace(df, {c: F.when(qcol(c) < 0, F.lit(value)).otherwise(qcol(c)) for c in cols})


def null_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Negative values → NULL (C3), applied before products so sentinel codes
    do not multiply real values."""
    return _replace(df, {c: F.when(qcol(c) >= 0, qcol(c)) for c in cols})


def encode_levels(train: DataFrame, test: DataFrame | None, key: str, cols: Sequence[str],
                  suffix: str = "", strategy: str = "auto",
                  broadcast_rows: int = 2_000_000) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Text → integer level id by order of first appearance over train, then
    test, in key order; missing stays missing (C4).

    The level table ``(column, value, level)`` is built from a tagged union:
    ``min(struct(src, key))`` per (column, value) is the first appearance;
    ``row_number`` per column over distinct values numbers them.

    Joining back (``strategy``): ``"broadcast"`` — one broadcast hash join
    per column, no shuffle, when every column's level table is small
    (counted); ``"long"`` — unpivot to ``(key, column, value)``, one join on
    (column, value), pivot back by key: three shuffles whatever the number
    of columns, for large level tables (``key`` must be unique). ``"auto"``
    picks by the counted sizes. Returns (train, test, levels).
    """
    cols = list(cols)
    tagged = train.select(F.lit(0).alias("__src"), key, *[qcol(c).cast("string").alias(c) for c in cols])
    if test is not None:
        tagged = tagged.unionByName(
            test.select(F.lit(1).alias("__src"), key, *[qcol(c).cast("string").alias(c) for c in cols]))
    long = tagged.unpivot(["__src", key], cols, "col_name", "value").filter(F.col("value").isNotNull())
    first = long.groupBy("col_name", "value").agg(F.min(F.struct("__src", key)).alias("__first"))
    first = first.select("col_name", "value", F.col("__first.__src").alias("__src"),
                         F.col(f"__first.{key}").alias("__key"))
    # Number distinct values per column by first appearance without putting a
    # whole column in one task: range-partitioned windows (ordering.row_number).
    levels = materialize(row_number(first, ["__src", "__key"], ["col_name"], "level",
                                    materialize_input=True).select(
        "col_name", "value", F.col("level").cast("int").alias("level")))
    sizes = {r["col_name"]: r["n"] for r in levels.groupBy("col_name").agg(F.count(F.lit(1)).alias("n")).collect()}

    if strategy == "auto":
        strategy = "broadcast" if max(sizes.values(), default=0) <= broadcast_rows else "long"

    def apply_long(df: DataFrame) -> DataFrame:
        long = df.select(key, *[qcol(c).cast("string").alias(c) for c in cols]) \
            .unpivot([key], cols, "col_name", "value")
        coded = long.join(levels, ["col_name", "value"], "left")
        back = coded.groupBy(key).pivot("col_name", cols).agg(F.first("level"))
        back = back.select(key, *[F.col(c).alias(f"__l_{c}") for c in cols])
        out = df.join(back, key, "left")
        return out.select(*[(F.col(f"__l_{c}").alias(c + suffix) if c in cols else qcol(c))
                            for c in df.columns])

    def apply(df: DataFrame) -> DataFrame:
        if strategy == "long":
            return apply_long(df)
        out = df
        for c in cols:
            # Each column's level table is broadcast only when its counted size allows.
            m = levels.filter(F.col("col_name") == c).select(F.col("value").alias(f"__v_{c}"),
                                                           F.col("level").alias(f"__l_{c}"))
            out = out.join(bounded_broadcast(m, sizes.get(c, 0)), qcol(c).cast("string") == F.col(f"__v_{c}"), "left")
        return out.select(*[(F.col(f"__l_{c}").alias(c + suffix) if c in cols else qcol(c))
                            for c in df.columns])

    return apply(train), (apply(test) if test is not None else None), levels


def interactions(df: DataFrame, cols: Sequence[str], ops: Iterable[str] = ("plus", "times"),
                 keep: bool = True, self_pair: bool = False) -> DataFrame:
    """Pairwise ``a_PLUS_b`` and ``a_TIMES_b`` for i < j.

    Names are de-duplicated first (a repeated name would make a self pair).
    ``self_pair=True`` also adds the last column with itself, as the
    reference's loop bound did.
    """
    names = list(dict.fromkeys(cols))
    pairs = [(names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names))]
    if self_pair and names:
        pairs.append((names[-1], names[-1]))
    exprs = []
    for a, b in pairs:
        x, y = qcol(a).cast("double"), qcol(b).cast("double")
        if "plus" in ops:
            exprs.append((x + y).alias(f"{a}_PLUS_{b}"))
        if "times" in ops:
            exprs.append((x * y).alias(f"{a}_TIMES_{b}"))
    return df.select(*(["*"] if keep else []), *exprs)


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Refuse a table whose key repeats (rows are tied by key, so a
    duplicate would silently multiply rows in every later join). One
    aggregate; only the count of repeated keys reaches the driver."""
    dup = df.groupBy(key).count().filter("count > 1").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if dup:
        raise ValueError(f"key {key!r} is not unique: {dup} values repeat")


def attach(df: DataFrame, other: DataFrame, key: str, check: bool = False) -> DataFrame:
    """Paste the columns of ``other`` onto ``df`` row by row, by key.

    Positional ``cbind`` becomes an inner join on the key; with ``check``
    the row counts must agree (a missing key would silently drop rows).
    """
    out = df.join(other, key, "inner")
    if check:
        a, b, c = df.count(), other.count(), out.count()
        if not (a == b == c):
            raise ValueError(f"attach: row counts differ ({a}, {b}, joined {c})")
    return out


def variant_columns(columns: Sequence[str], drop_sets: dict[str, Iterable[str]],
                    keep: Sequence[str] = ()) -> dict[str, list[str]]:
    """Named column lists (C7): ``full`` plus one list per drop set and one for
    the union of all drop sets (``all``). Pure set algebra on names."""
    keep = list(keep)
    body = [c for c in columns if c not in set(keep)]
    out = {"full": keep + body}
    union: set[str] = set()
    for name, drops in drop_sets.items():
        d = set(drops)
        union |= d
        out[f"minus_{name}"] = keep + [c for c in body if c not in d]
    if len(drop_sets) > 1:
        out["minus_all"] = keep + [c for c in body if c not in union]
    return out


def order_columns(df: DataFrame, first: Sequence[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Put ``first`` columns first, keep the rest in order; optional renames (C11)."""
    first = list(first)
    out = df.select(*[qcol(c) for c in first], *[qcol(c) for c in df.columns if c not in set(first)])
    return out.withColumnsRenamed(rename) if rename else out


def binarise(df: DataFrame, col: str, threshold: float, name: str | None = None) -> DataFrame:
    """1 when ``col >= threshold`` else 0 (C12; ML ``Binarizer`` uses >)."""
    name = name or col
    return _replace(df, {col: F.when(qcol(col) >= threshold, 1).otherwise(0)}) if name == col \
        else df.withColumn(name, F.when(qcol(col) >= threshold, 1).otherwise(0))


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x − mean) / sample standard deviation (C14); a constant column → NULL.

    The column means and deviations are one aggregate row (2p numbers)
    brought to the driver and used as literals; the data is not shuffled.
    """
    cols = list(cols)
    stats = df.agg(*[F.avg(qcol(c)).alias(f"__m_{c}") for c in cols],
                   *[F.stddev_samp(qcol(c)).alias(f"__s_{c}") for c in cols]).first()

    def z(c):
        m, s = stats[f"__m_{c}"], stats[f"__s_{c}"]
        if m is None or s is None or s == 0:
            return F.lit(None).cast("double")
        return (qcol(c).cast("double") - F.lit(m)) / F.lit(s)
    return _replace(df, {c: z(c) for c in cols})


def sentinel_codes(max_power: int = 20, max_offset: int = 4) -> list[float]:
    """Candidate sentinel codes ``10^i - j`` for i in 2..max_power, j in
    1..max_offset, as doubles, de-duplicated by value (above 2**53 several j
    give the same double)."""
    vals = {float(10 ** i - j) for i in range(2, max_power + 1) for j in range(1, max_offset + 1)}
    return sorted(vals)


def sentinel_flags(df: DataFrame, cols: Sequence[str], max_power: int = 20,
                   max_offset: int = 4) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Sentinel codes to flags.

    A column whose maximum is ``10^i - j`` (or minimum ``-(10^i - j)``) gets a
    0/1 column ``<col>_<code>`` and the code becomes NULL. Repeated while any
    column still matches (a column may carry several codes; the list of codes is
    finite, so this ends); each pass is one min/max aggregate over all columns. Returns the table and the
    ``(column, code)`` list.
    """
    codes = set(sentinel_codes(max_power, max_offset))
    cols = list(cols)
    found: list[tuple[str, float]] = []
    cur = df
    while True:
        exprs = []
        for c in cols:
            exprs += [F.max(qcol(c).cast("double")).alias(f"hi::{c}"),
                      F.min(qcol(c).cast("double")).alias(f"lo::{c}")]
        row = cur.agg(*exprs).first()
        hits = []
        for c in cols:
            hi, lo = row[f"hi::{c}"], row[f"lo::{c}"]
            if hi is not None and hi in codes:
                hits.append((c, hi))
            if lo is not None and -lo in codes:
                hits.append((c, lo))
        if not hits:
            break
        flags, nulls = [], {}
        for c, code in hits:
            label = str(int(code)) if code >= 0 else "neg" + str(int(-code))
            flags.append(F.when(qcol(c).cast("double") == F.lit(code), 1).otherwise(0).alias(f"{c}_{label}"))
            cond = qcol(c).cast("double") == F.lit(code)
            prev = nulls.get(c, qcol(c))
            nulls[c] = F.when(~cond, prev)
        # One select: flags read the input columns, codes become NULL.
        cur = cur.select(*[(nulls[c].alias(c) if c in nulls else qcol(c)) for c in cur.columns], *flags)
        found += hits
    return cur, found


def pooled_frequency_score(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Row score from pooled value frequencies.

    Frequencies are counted over all listed text columns together; each row
    gets the sum, count and mean of its values' frequencies (missing values
    left out) and the text ``"sum/count"``.
    """
    long = df.select(key, *[qcol(c).cast("string").alias(c) for c in cols]) \
        .unpivot([key], list(cols), "col_name", "v").filter(F.col("v").isNotNull())
    freq = long.groupBy("v").agg(F.count(F.lit(1)).alias("freq"))
    # Joined on the value itself, so a hot value would skew a shuffle join:
    # broadcast the frequency table when its counted size allows (otherwise
    # AQE splits the skewed partition).
    scored = long.join(broadcast_if_small(freq), "v")
    return scored.groupBy(key).agg(
        F.sum("freq").cast("bigint").alias("freq_sum"),
        F.count(F.lit(1)).cast("bigint").alias("freq_count")).select(
        key, "freq_sum", "freq_count",
        (F.col("freq_sum") / F.col("freq_count").cast("double")).alias("freq_mean"),
        F.concat_ws("/", F.col("freq_sum").cast("string"), F.col("freq_count").cast("string")).alias("freq_text"))


def where(df: DataFrame, predicate=None, exclude: DataFrame | None = None, key: str | None = None,
          values: tuple[str, Sequence] | None = None) -> DataFrame:
    """Row filter by predicate, by excluded keys (anti join) or by value list."""
    out = df
    if predicate is not None:
        out = out.filter(predicate)
    if values is not None:
        col, vals = values
        out = out.filter(qcol(col).isin(list(vals)))
    if exclude is not None:
        out = out.join(exclude.select(key).distinct(), key, "left_anti")
    return out
