from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def spark():
    from widetab.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="widetab-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def norm(v):
    import math
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if isinstance(v, int):
        return (1, repr(float(v)))
    return (1, str(v))


def rows_equal(spark_rows, spark_cols, duck_rows, duck_cols):
    order = sorted(spark_cols)
    assert order == sorted(duck_cols), (spark_cols, duck_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted(tuple(norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(norm(r[i]) for i in di) for r in duck_rows)
    assert len(a) == len(b)
    assert a == b
