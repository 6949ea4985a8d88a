"""Data refresh, stored source types, key checks before the build, the read-only guard and metric query shapes."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.functions import outward
from cartwheel.oracle.oracles import declared
from cartwheel.plans import load_models, metrics, quality
from cartwheel.plans.adhoc import run_sql
from cartwheel.plans.context import ModelContext
from cartwheel.plans.ordering import RESULT_ORDER, read_ordered
from cartwheel.plans.pipeline import build_all
from cartwheel.registry import all_queries, context
from cartwheel.sources import SOURCES, FixtureSources, ParquetSources


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in outward(df).collect())


def _copy_tables(folder):
    for name in os.listdir(SF_SMALL):
        shutil.copyfile(f"{SF_SMALL}/{name}", f"{folder}/{name}")


def test_a_later_call_sees_new_data(spark, tmp_out):
    _copy_tables(tmp_out)
    before = {k: _rows(all_queries()[k](spark, tmp_out)) for k in ("fct_rfm_scores", "stg_events")}
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas()
    half.to_parquet(f"{tmp_out}/lineitem.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(50).toPandas()
    events.to_parquet(f"{tmp_out}/events.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    spark.catalog.clearCache()
    after = {k: _rows(all_queries()[k](spark, tmp_out)) for k in before}
    assert after["fct_rfm_scores"] != before["fct_rfm_scores"] and len(after["stg_events"]) == 50


def _stored(df, documented: bool):
    """Floating-point money and, where the id is a number, integer ids; or all as strings and decimals."""
    for f in df.schema:
        kind = f.dataType.simpleString()
        if documented and kind.startswith("decimal"):
            df = df.withColumn(f.name, F.col(f.name).cast("double"))
        elif not documented and kind == "bigint" and f.name.endswith("id"):
            df = df.withColumn(f.name, F.col(f.name).cast("string"))
    return df


@pytest.mark.parametrize("documented", [True, False])
def test_sources_with_other_stored_types_give_the_same_marts(spark, tmp_out, documented):
    load_models()
    fx = FixtureSources(spark, SF_SMALL)
    for name in SOURCES:
        df = fx(name)
        if name in ("order_items", "inventory_items"):  # a numeric id, as documented
            df = df.withColumn("id", F.pmod(F.xxhash64("id"), F.lit(1 << 53)))
        if name == "order_items":
            df = df.withColumn("inventory_item_id", F.col("id"))
        _stored(df, documented).write.parquet(f"{tmp_out}/{name}")
    a, b = ModelContext(spark, fx), ModelContext(spark, ParquetSources(spark, tmp_out))
    assert b.source("order_items").schema == SOURCES["order_items"]
    for model in ("fct_orders", "fct_daily_revenue", "dim_products", "fct_customer_retention"):
        assert _rows(a.ref(model)) == _rows(b.ref(model)), model


def test_a_source_without_a_column_is_named(spark, tmp_out):
    spark.range(3).write.parquet(f"{tmp_out}/orders")
    with pytest.raises(ValueError, match="order_id"):
        ParquetSources(spark, tmp_out)("orders")


def test_a_duplicate_key_stops_the_build_before_it_writes(spark, tmp_out):
    fx = FixtureSources(spark, SF_SMALL)

    def sources(name):
        df = fx(name)
        return df.union(df.orderBy("order_id").limit(1)) if name == "orders" else df

    with pytest.raises(quality.KeyCheckError, match="stg_orders.order_id unique: 1"):
        build_all(ModelContext(spark, sources), tmp_out)
    assert os.listdir(tmp_out) == []


def test_the_two_lists_of_checks_agree():
    key = lambda c: (c[0], c[1], c[2], str(c[3]))
    assert sorted(map(key, declared())) == sorted(map(key, quality.CHECKS)) and len(quality.CHECKS) == 76
    assert len(quality.checks_of("not_null")) == 48 and len(quality.checks_of("unique")) == 25


@pytest.mark.parametrize("statement", [
    "DROP TABLE fct_orders", "WITH x AS (SELECT 1 a) INSERT OVERWRITE DIRECTORY '/tmp/never' USING parquet SELECT * FROM x",
    "INSERT INTO t SELECT 1", "CREATE TABLE t AS SELECT 1", "SET spark.sql.ansi.enabled=false", "CACHE TABLE fct_orders",
    "EXPLAIN SELECT 1", "FROM (SELECT 1 a) INSERT OVERWRITE DIRECTORY '/tmp/never' USING parquet SELECT a"])
def test_only_queries_pass_the_guard(spark, statement):
    with pytest.raises(ValueError):
        run_sql(context(spark, SF_SMALL), statement)
    assert not os.path.exists("/tmp/never")


def test_the_guard_resolves_only_what_is_read(spark):
    ctx = context(spark, SF_SMALL)
    df = run_sql(ctx, """
        WITH d AS (SELECT order_status AS s FROM fct_orders WHERE order_id IN (SELECT order_id FROM fct_fulfillment))
        SELECT s, count(*) AS n, 'fct_rfm_scores' AS label FROM d GROUP BY s HAVING count(*) > 0 ORDER BY n DESC LIMIT 3""")
    assert df.count() <= 3
    assert {"fct_orders", "fct_fulfillment"} <= set(ctx._resolved) and "fct_rfm_scores" not in ctx._resolved


def test_metric_query_shapes(spark):
    ctx = context(spark, SF_SMALL)
    with pytest.raises(ValueError):
        metrics.metric_query(ctx, [], [], filters=[{"member": "orders.status", "operator": "set"}])
    with pytest.raises(ValueError, match="order by"):
        metrics.metric_query(ctx, ["orders.count"], ["orders.country"], order={"orders.status": "asc"})
    dims = metrics.metric_query(ctx, [], ["orders.status"])
    assert dims.columns == ["status"] and dims.count() == dims.distinct().count() > 1
    top = metrics.metric_query(ctx, ["orders.count"], ["orders.country"], order={"orders.total_revenue": "desc"})
    full = metrics.metric_query(ctx, ["orders.count", "orders.total_revenue"], ["orders.country"], order={"orders.total_revenue": "desc"})
    assert top.columns == ["country", "count"] and [r.country for r in top.collect()] == [r.country for r in full.collect()]
    some = metrics.metric_query(ctx, ["orders.count"], ["orders.country"],
                                filters=[{"member": "orders.total_revenue", "operator": "gt", "values": [0]}])
    assert some.columns == ["country", "count"]


def test_a_date_range_keeps_its_whole_last_day(spark):
    ctx = context(spark, SF_SMALL)
    ctx.replace("vw_users", spark.sql("""
        SELECT 1L AS user_id, 'X' AS country, 'c' AS city, 1L AS total_orders, TIMESTAMP_NTZ '2024-01-31 15:00:00' AS first_order_at"""))
    got = metrics.metric_query(ctx, ["users.count"], filters=[
        {"member": "users.first_order_date", "operator": "inDateRange", "values": ["2024-01-01", "2024-01-31"]}])
    assert got.first()["count"] == 1


def test_relative_periods():
    r = metrics.resolve_date_range
    assert r("last month", "2025-03-15") == (dt.date(2025, 2, 1), dt.date(2025, 2, 28))
    assert r("last quarter", "2025-05-15") == (dt.date(2025, 1, 1), dt.date(2025, 3, 31))
    assert r("YTD", "2025-03-15") == (dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    assert r("last year", "2025-03-15") == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_declared_orders(spark):
    ctx = context(spark, SF_SMALL)
    assert len(RESULT_ORDER) == 15
    rows = [(r.order_month, r.order_count) for r in read_ordered(ctx, "fct_order_status").collect()]
    assert rows == sorted(rows, reverse=True)
    days = [r.order_date for r in read_ordered(ctx, "daily_revenue").collect()]
    assert days == sorted(days)


def test_the_spine_reaches_the_as_of_date(spark):
    ctx = context(spark, SF_SMALL, as_of="2028-03-10")
    assert ctx.ref("dim_date").agg(F.max("date_key")).first()[0] == dt.date(2028, 3, 10)
    assert ctx.ref("fct_customer_cohorts").agg(F.max("activity_month")).first()[0] == dt.date(2028, 3, 1)


def test_kpis_cover_the_whole_period(spark):
    ctx = context(spark, SF_SMALL)
    days = ctx.ref("vw_daily_revenue").where("order_date between date'2024-12-31' and date'2025-12-30'").count()
    assert days > 0 and all_queries()["kpi_summary"](spark, SF_SMALL).first()["days_of_data"] == days
    listing = metrics.revenue_by_date(context(spark, SF_SMALL, as_of="2023-01-01"), 1000)
    assert listing.count() > 100
