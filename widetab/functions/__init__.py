"""Column-expression helpers (pure ``pyspark.sql.functions`` compositions)."""

from widetab.functions.hashing import key_hash, unit_hash, index_hash  # noqa: F401
from widetab.functions.exprs import (  # noqa: F401
    null_if_token, parse_text_date, epoch_seconds, safe_ratio, nan_to_null,
)
