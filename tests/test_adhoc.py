"""The read-only guard of run_sql, and rows and count from one run."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.plans import adhoc
from cartwheel.registry import context


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, SF_SMALL)


@pytest.mark.parametrize("statement", [
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home')",
    "SELECT order_id FROM fct_orders WHERE reflect('java.lang.System', 'getProperty', 'user.home') = ''",
    "SELECT max(upper(try_reflect('java.lang.System', 'getenv', 'HOME'))) FROM dim_users",
    "SELECT * FROM fct_orders ORDER BY system.builtin.java_method('java.lang.System', 'getProperty', 'user.home')",
    "WITH a AS (SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS x) SELECT * FROM a",
    "SELECT (SELECT java_method('java.lang.System', 'getProperty', 'user.home')) AS x FROM dim_users",
    f"SELECT count(*) FROM parquet.`{SF_SMALL}/orders.parquet`",
    f"SELECT * FROM dim_users WHERE user_id IN (SELECT o_custkey FROM parquet.`{SF_SMALL}/orders.parquet`)",
    f"WITH a AS (SELECT * FROM text.`{SF_SMALL}`) SELECT * FROM a",
    "SELECT * FROM stg_orders", "SELECT * FROM nowhere", "SELECT * FROM spark_catalog.default.fct_orders",
    "SELECT * FROM python_worker_logs()", "DROP TABLE fct_orders", "INSERT INTO fct_orders SELECT * FROM fct_orders",
    "CREATE TABLE x AS SELECT 1", "SET spark.sql.ansi.enabled = false",
])
def test_refused(ctx, statement):
    with pytest.raises(ValueError):
        adhoc.run_sql(ctx, statement)


def test_accepted(ctx):
    statements = ["SELECT count(*) AS n FROM fct_orders", "SELECT COUNT(*) AS n FROM FCT_ORDERS",
                  "WITH recent AS (SELECT * FROM fct_orders) SELECT count(*) AS n FROM recent",
                  "SELECT count(*) AS n FROM fct_orders o LEFT JOIN (SELECT user_id AS u FROM dim_users) d ON o.user_id = d.u"]
    assert {adhoc.run_sql(ctx, s).first().n for s in statements} == {ctx.ref("fct_orders").count()}
    assert adhoc.run_sql(ctx, "SELECT id FROM range(3)").count() == 3


def test_rows_and_count_from_one_run(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(0, 5000, 1, 7).mapInArrow(seen, "id long")
    rows, n = adhoc.capped(df, 100)
    assert n == 5000 and len(rows) == 100 and runs.value == 5000


def test_order_names_and_types_are_kept(spark):
    df = spark.range(1000).select(F.col("id"), F.lit(None).alias("nothing"), (-F.col("id")).alias("id2"),
                                  F.array("id").alias("list")).orderBy(F.col("id2"))
    rows, n = adhoc.capped(df, 3)
    assert n == 1000 and [r["id"] for r in rows] == [999, 998, 997]
    assert list(rows[0]) == ["id", "nothing", "id2", "list"] and rows[0]["nothing"] is None and rows[0]["list"] == [999]
    assert adhoc.capped(spark.range(2), 100) == ([{"id": 0}, {"id": 1}], 2)
    assert adhoc.capped(spark.range(0), 100) == ([], 0)
