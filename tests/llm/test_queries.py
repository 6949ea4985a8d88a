import duckdb
import pytest

from cartwheel.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    pick = lambda rows, names: sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in rows)
    assert pick([tuple(r) for r in got.collect()], got.columns) == pick(want.fetchall(), want.columns)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
