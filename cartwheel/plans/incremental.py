"""Refresh of a partitioned build after some days of orders have changed.

``pipeline.build_all(partitioned=True)`` stores the order and item facts by ``order_date``.  ``refresh`` is told the days whose
orders (or their items) were added, changed or removed, and brings a stored build up to date:

* the facts: only the partitions of those days are computed and replaced (dynamic partition overwrite).  A changed
  order can give or take a user's first order, so the days of first orders that are not the stored ones any more are added;
* marts by day or month of the order: their rows of those days or months are computed from the stored facts, of which only
  the partitions of these days or months are read, and put in the place of the old ones;
* other marts over orders are built anew from the stored facts; marts that read no orders stay as they are.

An order that moved to another day changes both days.  Rows without a date are always replaced: the items of an order that
is not there (yet, or any more) are among them.  Changed users or products need a full build.  A day without rows any more
loses its partition.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.plans import load_models
from cartwheel.plans.context import MODELS, ModelContext
from cartwheel.plans.pipeline import ITEMS, NEEDS, ORDERS, PARTITION_BY, read_mart, write_mart
from cartwheel.plans.scheduler import THREADS, levels, require_done, run_graph
from cartwheel.session import checkpoint_dir, configure

#: Marts whose rows depend on the orders of one day, or of one month, alone: (grain, the column that names it).
GRAINS = {
    "fct_daily_revenue": ("day", "order_date"), "daily_revenue": ("day", "order_date"),
    "fct_category_performance": ("month", "order_month"), "fct_brand_performance": ("month", "order_month"),
    "fct_geography_revenue": ("month", "order_month"), "fct_order_status": ("month", "order_month"),
    "fct_distribution_center_performance": ("month", "order_month"),
}
Days = set[dt.date | None]


def dependents(of: Iterable[str]) -> list[str]:
    """The models that read one of ``of``, directly or through others, and these, in build order."""
    found = set(of)
    for name in levels(NEEDS):
        if found & set(NEEDS[name]):
            found.add(name)
    return [n for n in levels(NEEDS) if n in found]


def among(day: Column, days: Days) -> Column:
    """Whether the date is one of ``days``; a plain list, so that it prunes partitions and reaches the scans."""
    known = sorted(d for d in days if d is not None)
    found = day.isin(*known) if known else F.lit(False)
    return found | day.isNull() if None in days else found


def _months(days: Days) -> Days:
    return {d if d is None else d.replace(day=1) for d in days}


def first_order_days(ctx: ModelContext, stored: DataFrame, days: Days) -> Days:
    """Days of the first orders, as stored and as they are, of users whose first order is another one now."""
    now = ctx.ref("stg_orders")
    touched = now.where(among(F.to_date("created_at"), days)).select("user_id").union(
        stored.where(among(F.col("order_date"), days)).select("user_id")).distinct().select(F.col("user_id").alias("_touched"))
    first = now.join(touched, F.col("user_id").eqNullSafe(F.col("_touched")), "left_semi").groupBy("user_id").agg(
        F.min(F.struct("created_at", "order_id")).alias("first")).select(
        F.col("user_id").alias("_user"), F.col("first.order_id").alias("_order"), F.to_date("first.created_at").alias("_day"))
    before = stored.where("is_first_order").join(touched, F.col("user_id").eqNullSafe(F.col("_touched")), "left_semi").select("user_id", "order_id", "order_date")
    moved = first.join(before, F.col("_user").eqNullSafe(F.col("user_id")), "full").where(~F.col("_order").eqNullSafe(F.col("order_id")))
    moved = moved.select(F.explode(F.array(
        F.struct(F.col("_order").alias("o"), F.col("_day").alias("d")), F.struct(F.col("order_id").alias("o"), F.col("order_date").alias("d")))).alias("x"))
    return {r["d"] for r in moved.where("x.o is not null").select("x.d").distinct().collect()}  # at most one row a day


def _drop_empty(ctx: ModelContext, path: str, column: str, days: Days) -> None:
    """Remove the partitions of days that have no rows any more: an overwrite of partitions touches only those it writes."""
    jvm, conf = ctx.spark._jvm, ctx.spark._jsc.hadoopConfiguration()
    for day in days:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}")
        folder.getFileSystem(conf).delete(folder, True)


def refresh(ctx: ModelContext, out_dir: str, days: Iterable[dt.date | str | None], log=None, threads: int = THREADS,
            models: Iterable[str] | None = None) -> dict:
    """Bring the build in ``out_dir`` up to date with the sources; returns the days replaced and the seconds of every model.

    ``models`` are those that the build holds, if it does not hold all.
    """
    load_models()
    spark, root = ctx.spark, out_dir.rstrip("/")
    configure(spark)
    scratch = checkpoint_dir(spark)
    changed: Days = {dt.date.fromisoformat(d) if isinstance(d, str) else d for d in days}
    if not changed:
        return {"days": [], "seconds": {}}
    changed.add(None)
    held = list(models or NEEDS)
    for name in held:
        ctx.replace(name, read_mart(spark, root, name))
    changed |= first_order_days(ctx, ctx.ref(ORDERS), changed)
    names = [n for n in dependents([ITEMS, ORDERS]) if n in held]

    def facts(name: str) -> None:
        """Partitions of the changed days: computed from the sources, the filter reaching the orders."""
        own = ModelContext(spark, ctx.sources, ctx.as_of, ctx.params)
        if name == ORDERS:
            own.replace(ITEMS, ctx.ref(ITEMS).where(among(F.col(PARTITION_BY[ITEMS]), changed)))
        column = PARTITION_BY[name]
        seen = Observation()
        new = MODELS[name](own).where(among(F.col(column), changed)).observe(
            seen, F.collect_set(column).alias("days"), F.count_if(F.col(column).isNull()).alias("undated"))  # at most one entry a changed day
        write_mart(new, root, name, partitioned=True, changes=True)
        present = set(seen.get["days"]) | ({None} if seen.get["undated"] else set())
        _drop_empty(ctx, f"{root}/{name}", column, changed - present)
        ctx.replace(name, read_mart(spark, root, name))

    def rows(name: str) -> None:
        """The rows of the changed days or months anew, the others as they are; the result is one row a key and day or month."""
        grain, column = GRAINS[name]
        keys = changed if grain == "day" else _months(changed)
        own = ModelContext(spark, ctx.sources, ctx.as_of, ctx.params)
        for other in held:
            read = ctx.ref(other)
            if other in PARTITION_BY:
                day = F.col(PARTITION_BY[other])
                read = read.where(among(day if grain == "day" else F.trunc(day, "month"), keys))
            own.replace(other, read)
        new, old = MODELS[name](own), ctx.ref(name)
        kept = old.where(~F.coalesce(among(F.to_date(column), keys), F.lit(False)))
        path = f"{scratch.rstrip('/')}/{name}-{uuid.uuid4().hex}"  # the mart is read and written
        kept.unionByName(new).write.parquet(path)
        write_mart(spark.read.parquet(path), root, name)
        ctx.replace(name, read_mart(spark, root, name))

    def whole(name: str) -> None:
        write_mart(MODELS[name](ctx), root, name)
        ctx.replace(name, read_mart(spark, root, name))

    step = {n: facts if n in PARTITION_BY else rows if n in GRAINS else whole for n in names}
    outcomes = require_done(run_graph(spark, {n: (lambda n=n: step[n](n)) for n in names}, NEEDS, threads, log))
    return {"days": sorted(changed, key=lambda d: d or dt.date.min), "seconds": {n: outcomes[n].seconds for n in names}}
