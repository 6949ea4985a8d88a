"""Every registered key against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from cartwheel.oracle import ORACLES
from cartwheel.registry import all_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(float(f"{v:.12g}")))
    if isinstance(v, int) and not isinstance(v, bool):
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


KEYS = sorted(set(ORACLES) & set(all_queries()))
SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    if os.environ.get("CARTWHEEL_QUICK") and key.startswith("dq_"):
        pytest.skip("quick mode")
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[key])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    rows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    want = sorted(tuple(_norm(r[c]) for c in cols) for r in rows)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
