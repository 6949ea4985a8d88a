"""ntile by its edges against Spark's own single-task window."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.operators import quantiles
from cartwheel.operators.quantiles import ntile, ntiles
from cartwheel.registry import context


def _wrong(df, ours, column, k, out, descending=False):
    """Rows whose bucket differs from the window's (keys are unique)."""
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()
    ref = df.select(F.col("id").alias("_id"), F.ntile(k).over(Window.orderBy(order, F.col("id").asc_nulls_first())).alias("_ref"))
    return ours.join(ref, F.col("id").eqNullSafe(F.col("_id"))).where(F.col(out) != F.col("_ref")).count()


def _frame(spark, n=1500):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        hot = rnd.random() < 0.6  # one value on most rows: several edges fall into its ties
        value = 1 if hot else rnd.randint(-40, 10_000)
        money = None if i % 17 == 0 else Decimal("9.99") if hot else Decimal(rnd.randint(-10**9, 10**12)) / 100
        at = None if i % 23 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rnd.randint(0, 10**13))
        # ids far apart, negative ones and one at the end of the type
        key = 2**63 - 1 if i == 7 else -(2**63) if i == 8 else (i - 700) * 1_000_003
        rows.append((key, value, money, at, at.date() if at else None))
    return spark.createDataFrame(rows, "id bigint, v bigint, m decimal(18,2), t timestamp_ntz, d date").repartition(5)


def test_ties_nulls_and_types_match_the_window(spark):
    df = _frame(spark)
    ours = ntiles(df, "id", [("v", 5, False, "a"), ("m", 4, True, "b"), ("t", 7, False, "c"), ("d", 3, True, "e")]).cache()
    assert ours.count() == df.count() and ours.columns == [*df.columns, "a", "b", "c", "e"]
    assert _wrong(df, ours, "v", 5, "a") == 0
    assert _wrong(df, ours, "m", 4, "b", True) == 0
    assert _wrong(df, ours, "t", 7, "c") == 0
    assert _wrong(df, ours, "d", 3, "e", True) == 0


def test_few_rows_equal_values_and_none(spark):
    two = spark.createDataFrame([(1, 5), (2, 3)], "id bigint, v bigint")
    assert sorted((r.id, r.b) for r in ntile(two, 5, "v", "b", "id").collect()) == [(1, 2), (2, 1)]
    same = spark.range(101).select("id", F.lit(3).alias("v"))
    assert _wrong(same, ntile(same, 4, "v", "b", "id", descending=True), "v", 4, "b", True) == 0
    nulls = spark.range(50).select("id", F.lit(None).cast("int").alias("v"))
    assert _wrong(nulls, ntile(nulls, 3, "v", "b", "id"), "v", 3, "b") == 0
    null_key = spark.createDataFrame([(None, 1), (1, 1), (2, 1), (3, 1)], "id bigint, v bigint")
    assert _wrong(null_key, ntile(null_key, 4, "v", "b", "id"), "v", 4, "b") == 0
    empty = two.where("false")
    assert ntile(empty, 4, "v", "b", "id").collect() == []
    assert {r.b for r in ntile(two, 1, "v", "b", "id").collect()} == {1}


@pytest.mark.parametrize("bins", [2, 3, 16])
def test_any_number_of_bins_gives_the_same(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    df = _frame(spark, 300)
    assert _wrong(df, ntile(df, 6, "v", "b", "id"), "v", 6, "b") == 0


def test_inexact_types_are_refused(spark):
    df = spark.createDataFrame([(1, 0.5, "x")], "id bigint, f double, s string")
    for column in ("f", "s"):
        with pytest.raises(TypeError):
            ntile(df, 2, column, "b", "id")
    with pytest.raises(TypeError):
        ntile(df, 2, "id", "b", "s")


def test_no_job_runs_while_planning(spark):
    sc = spark.sparkContext
    sc.setJobGroup("quantile-planning", "planning")
    try:
        df = ntile(spark.range(1000).withColumn("v", F.col("id") % 10), 4, "v", "b", "id")
        df.schema
        assert list(sc.statusTracker().getJobIdsForGroup("quantile-planning")) == []
        df.collect()
        assert list(sc.statusTracker().getJobIdsForGroup("quantile-planning")) != []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_scores_of_a_stored_summary_equal_the_ranked_ones(spark, tmp_out):
    ranked, stored = context(spark, SF_SMALL), context(spark, SF_SMALL)
    stored.ref("int_user_order_summary").write.parquet(f"{tmp_out}/summary")
    stored.replace("int_user_order_summary", spark.read.parquet(f"{tmp_out}/summary"))
    a, b = ranked.ref("fct_rfm_scores"), stored.ref("fct_rfm_scores")
    assert a.columns == b.columns and a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
