"""Scalar helpers and the semantic traps around them."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.functions import mean, month_diff, outward, safe_divide, ts_diff, us_week


def test_safe_divide_null_on_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (3, 2), (None, 1), (2, None)], "a bigint, b bigint")
    got = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    assert got == [None, 1.5, None, None]


def test_ts_diff_truncates_toward_zero(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 23, 59)),
         (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 0, 0)),
         (dt.datetime(2024, 1, 3, 0, 0), dt.datetime(2024, 1, 1, 1, 0))],
        "s timestamp_ntz, e timestamp_ntz")
    rows = df.select(ts_diff("DAY", F.col("e"), F.col("s")).alias("d"),
                     ts_diff("HOUR", F.col("e"), F.col("s")).alias("h")).collect()
    assert [(r.d, r.h) for r in rows] == [(0, 23), (1, 24), (-1, -47)]


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2023, 12, 1), dt.date(2024, 1, 31))], "a date, b date")
    got = [r[0] for r in df.select(month_diff("b", "a")).collect()]
    assert got == [1, 1]


def test_us_week_matches_strftime_U(spark):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 2922, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(us_week("d")).collect()]
    assert got == [int(d.strftime("%U")) for d in days]


def test_mean_is_exact_on_decimals(spark):
    df = spark.createDataFrame([("0.10",), ("0.20",), ("0.30",)], "x string").select(
        F.col("x").cast("decimal(18,2)").alias("x"))
    # exact sum 0.60 divided once: 0.6 / 3 in double
    assert df.agg(mean("x")).collect()[0][0] == 0.6 / 3


def test_outward_casts_decimals_and_ints(spark):
    df = spark.createDataFrame([(1, "1.25")], "i int, d string").select("i", F.col("d").cast("decimal(10,2)").alias("d"))
    out = outward(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double"]
