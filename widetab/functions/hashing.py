"""Stable hashes of keys and values.

All random choices in widetab (splits, folds, bags, column samples, hashed
features) are hashes of ``(value, seed)`` so they do not depend on the
partitioning, survive task retries unchanged and can be written in any SQL
engine.

``fn="md5"``: the first 8 hex digits of md5 read as an unsigned 32-bit number.
The same value is produced by ``concat('0x', substr(md5(x), 1, 8))::BIGINT``
in DuckDB, which is what the oracle queries use.
``fn="xxhash64"``: Spark's xxhash64 folded to the same 32-bit range; faster,
Spark-only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32 = 4294967296  # 2**32


def _as_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _text_key(c, seed) -> Column:
    if seed is None:
        return _as_text(c)
    return F.concat(_as_text(c), F.lit("_"), F.lit(str(seed)))


def raw_hash(text: Column, fn: str = "md5") -> Column:
    """Unsigned 32-bit hash (as BIGINT) of a string column."""
    if fn == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    if fn == "xxhash64":
        return F.pmod(F.xxhash64(text), F.lit(U32))
    raise ValueError(f"unknown hash function {fn!r}")


def key_hash(c, seed=None, fn: str = "md5") -> Column:
    """Hash of ``cast(c as string) || '_' || seed`` in [0, 2**32)."""
    return raw_hash(_text_key(c, seed), fn)


def unit_hash(c, seed=None, fn: str = "md5") -> Column:
    """``key_hash`` scaled to a double in [0, 1)."""
    return key_hash(c, seed, fn).cast("double") / F.lit(float(U32))


def index_hash(name: str, c, modulus: int, fn: str = "md5") -> Column:
    """Hash-trick index of ``name || '_' || value`` in [0, modulus)."""
    text = F.concat(F.lit(name + "_"), _as_text(c))
    return F.pmod(raw_hash(text, fn), F.lit(modulus))
