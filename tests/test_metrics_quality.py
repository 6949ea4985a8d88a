"""Metric queries, ad-hoc helpers, checks and the build job at sf0.001."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.plans import metrics, quality
from cartwheel.plans.adhoc import capped, run_sql
from cartwheel.plans.pipeline import BUILD_ORDER, build_all
from cartwheel.registry import context


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, SF_SMALL)


def test_cross_cube_query_is_rejected(ctx):
    with pytest.raises(ValueError):
        metrics.metric_query(ctx, ["orders.count", "users.count"])


def test_last_n_days_window():
    lo, hi = metrics.resolve_date_range("last 30 days", "2025-12-31")
    assert (lo, hi) == (dt.date(2025, 12, 1), dt.date(2025, 12, 30))


def test_intents_and_meta(ctx, spark):
    assert metrics.execute_intent(ctx, "nope") is None
    tot = metrics.execute_intent(ctx, "total_orders").collect()[0]["count"]
    assert tot == ctx.ref("vw_orders").count()
    meta = metrics.cube_meta(spark)
    assert meta.where(F.col("kind") == "measure").count() == 8


def test_run_sql_only_select(ctx):
    with pytest.raises(ValueError):
        run_sql(ctx, "DROP TABLE fct_orders")
    rows, n = capped(run_sql(ctx, "SELECT order_id FROM fct_orders"), 100)
    assert len(rows) == 100 and n == ctx.ref("fct_orders").count()


def test_checks_find_planted_failures(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "zzz")], "k bigint, s string")
    found = quality.column_failures(df, ["k", "s"], ["k", "s"], [("s", ["a", "b"])])
    assert {(r.column_name, r.test): r.failures for r in found.collect()} == {
        ("k", "not_null"): 1, ("s", "not_null"): 0, ("k", "unique"): 1, ("s", "unique"): 0, ("s", "accepted_values"): 1}
    found = quality.column_failures(df, ["k", "s"])
    assert {(r.column_name, r.test): r.failures for r in found.collect()} == {("k", "not_null"): 1, ("s", "not_null"): 0}
    none = quality.column_failures(df.where("false"), ["k"], ["k"])
    assert {r.failures for r in none.collect()} == {0}
    parent = spark.createDataFrame([(1,)], "k bigint")
    child = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    assert quality.relationships_failures(child, "k", parent, "k").collect()[0][0] == 1


def test_build_all_and_invariants(spark, tmp_out):
    ctx = context(spark, SF_SMALL, as_of="2025-12-31")
    timings = build_all(ctx, tmp_out)
    assert set(timings) == set(BUILD_ORDER)
    assert all(os.path.isdir(f"{tmp_out}/{m}") for m in BUILD_ORDER)
    o = spark.read.parquet(f"{tmp_out}/fct_orders")
    d = spark.read.parquet(f"{tmp_out}/fct_daily_revenue")
    assert o.agg(F.sum("total_revenue")).collect()[0][0] == d.agg(F.sum("total_revenue")).collect()[0][0]
    s = spark.read.parquet(f"{tmp_out}/fct_order_status").groupBy("order_month").agg(
        F.sum("pct_of_month_orders").alias("p"))
    assert s.where(F.abs(F.col("p") - 1.0) > 1e-9).count() == 0
    r = spark.read.parquet(f"{tmp_out}/fct_customer_retention").where("months_since_signup = 0")
    assert r.where("cohort_size <= 0").count() == 0
    report = quality.run_checks(ctx).collect()
    assert len(report) == len(quality.CHECKS)


def test_metric_filter_operators_and_grains(ctx):
    base = ctx.ref("vw_orders")
    n_all = base.count()
    q = lambda filters: metrics.metric_query(ctx, ["orders.count"], [], filters=filters).collect()[0]["count"]
    assert q([{"member": "orders.country", "operator": "set"}]) == base.where("user_country IS NOT NULL").count()
    assert q([{"member": "orders.country", "operator": "notSet"}]) == base.where("user_country IS NULL").count()
    assert q([{"member": "orders.status", "operator": "contains", "values": ["compl"]}]) == \
        base.where("order_status = 'Complete'").count()
    assert q([{"member": "orders.order_date", "operator": "inDateRange", "values": ["2020-01-01", "2020-12-31"]}]) == \
        base.where("year(order_date) = 2020").count()
    assert q([]) == n_all
    for grain in ("day", "week", "month", "quarter", "year"):
        df = metrics.metric_query(ctx, ["orders.count"], [],
                                  time_dimensions=[{"dimension": "orders.order_date", "granularity": grain}],
                                  limit=None)
        assert df.agg(F.sum("count")).collect()[0][0] == n_all
    first = metrics.metric_query(ctx, ["users.count"], [], time_dimensions=[
        {"dimension": "users.first_order_date", "granularity": "month"}], limit=None)
    assert dict(first.dtypes)["first_order_date"] == "timestamp_ntz"


def test_relative_month_and_week_ranges():
    assert metrics.resolve_date_range("last 2 months", "2025-03-15") == (dt.date(2025, 1, 1), dt.date(2025, 2, 28))
    assert metrics.resolve_date_range("last 1 week", "2025-03-15") == (dt.date(2025, 3, 8), dt.date(2025, 3, 14))
    with pytest.raises(ValueError):
        metrics.resolve_date_range("yesterday-ish", "2025-03-15")


def test_catalogue_lists_marts(spark):
    from cartwheel.plans.adhoc import catalogue
    assert catalogue(spark).where(F.col("table_name") == "fct_rfm_scores").count() == 1


def test_build_and_check_writes_report(spark, tmp_out):
    from cartwheel.plans.pipeline import build_and_check
    ctx = context(spark, SF_SMALL)
    _, report = build_and_check(ctx, tmp_out)
    rows = report.collect()
    assert len(rows) == len(quality.CHECKS)
    assert os.path.isdir(f"{tmp_out}/_dq_report")
    # the fixtures satisfy every declared key and value check
    assert sum(r.failures for r in rows) == 0
