"""Calendar generators: the day spine and per-entity month grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's calendar spine bounds.
SPINE_START = "2019-01-01"
SPINE_END = "2026-12-31"


def spine_end(ctx) -> str:
    """Last day of the spine: the parameter, else the reference's end, but never before ``as_of``."""
    return ctx.param("spine_end", max(SPINE_END, str(ctx.as_of)))


def day_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END,
              col: str = "date_day") -> DataFrame:
    """One row per calendar day in [start, end] (bounded by the calendar, not the data)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias(col))


def month_grid(first_month: Column, last_month: Column) -> Column:
    """Array of month starts from ``first_month`` to ``last_month`` (empty when first > last)."""
    return F.when(first_month <= last_month,
                  F.sequence(first_month, last_month, F.expr("INTERVAL 1 MONTH")))


def month_of(d: str | dt.date) -> Column:
    return F.trunc(F.lit(str(d)).cast("date"), "month")
