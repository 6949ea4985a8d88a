"""Build every model in dependency order and write the tables (SNK1-SNK3).

Staging models and public views stay lazy (views in the reference); the
intermediate models and marts are written as Parquet.  After each write,
``ref(name)`` is re-pointed at the written table, so downstream models read
the stored result instead of recomputing its lineage, and a lost executor
only re-runs the model being written.

Models that do not need each other are written at the same time, by a bounded number of
threads; a failed model stops only those that need it.  The null and bad-value counts of
the declared checks are observed by the write itself, in its last stage.

``build_all`` writes to a plain folder; ``publish`` writes a new version and makes it the one
that readers see only if every check passes.

usage: python -m cartwheel.plans.pipeline --sf-dir DIR --out DIR [--as-of YYYY-MM-DD] [--checks | --publish | --partitioned | --days DAY...] [--threads N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from cartwheel import DEFAULT_AS_OF
from cartwheel.plans import load_models
from cartwheel.plans import publish as versions
from cartwheel.plans.context import LAYERS, ModelContext
from cartwheel.plans.core import ORDER_COLUMNS
from cartwheel.plans.intermediate import INT1_COLUMNS
from cartwheel.plans.quality import CHECKS, Observed, check_rows, report_frame, require_keys
from cartwheel.plans.scheduler import THREADS, levels, require_done, run_graph
from cartwheel.session import checkpoint_dir, configure

ITEMS, ORDERS = "int_order_items_enriched", "fct_orders"

# The written models and the written models that each reads (through views as well); a test holds
# this against the ref() calls.  Models that others wait for come first.
NEEDS = {
    ITEMS: (), "fct_sessions": (), "dim_users": (), "dim_products": (), "dim_date": (), "dim_distribution_centers": (),
    ORDERS: (ITEMS,), "int_user_order_summary": (ITEMS,),
    "fct_customer_cohorts": ("dim_users", ORDERS), "fct_customer_active_months": ("dim_users", ORDERS), "fct_rfm_scores": ("int_user_order_summary",),
    "fct_customer_orders": ("int_user_order_summary", "dim_users"),
    "fct_product_affinity": (ITEMS,), "fct_product_performance": (ITEMS,), "fct_category_performance": (ITEMS,),
    "fct_brand_performance": (ITEMS,), "fct_returns": (ITEMS,),
    "fct_distribution_center_performance": (ITEMS, "dim_distribution_centers"),
    "fct_daily_revenue": (ORDERS,), "fct_geography_revenue": (ORDERS,), "daily_revenue": (ORDERS,),
    "fct_order_status": (ORDERS,), "fct_fulfillment": (ORDERS,),
    "fct_web_funnel": ("fct_sessions",), "fct_traffic_source_performance": ("fct_sessions", ORDERS),
    "fct_browser_performance": ("fct_sessions", ORDERS),
    "fct_monthly_revenue": ("fct_daily_revenue",), "fct_fulfillment_summary": ("fct_fulfillment",),
    "fct_customer_retention": ("dim_users", "fct_customer_active_months"),
    "fct_cohort_revenue": ("dim_users", "fct_customer_active_months"),
}
BUILD_ORDER = levels(NEEDS)
VIEW_LAYERS = {"staging", "semantic"}

# Time-keyed tables are sorted within each output partition before the write,
# so parquet row-group min/max statistics let date filters (metric date
# ranges, "last N days") skip row groups.  A local sort: no extra shuffle.
CLUSTER_BY = {
    "int_order_items_enriched": "order_created_at",
    "fct_orders": "order_created_at",
    "fct_fulfillment": "created_at",
    "fct_sessions": "session_start_at",
    "fct_customer_cohorts": "activity_month",
    "fct_customer_active_months": "activity_month",
}

# The facts that a partitioned build stores by day, so that readers of a period open only its files and
# ``incremental.refresh`` replaces only the days that changed.
PARTITION_BY = {ITEMS: "order_date", ORDERS: "order_date"}


def write_mart(df: DataFrame, root: str, name: str, partitioned: bool = False, seen: Observed | None = None, changes: bool = False) -> None:
    """Write a mart; by its day, if ``partitioned`` and it has one: then a day's rows meet in files of a bounded size (a hot
    day is split), and ``changes`` replaces only the partitions that ``df`` has rows of."""
    day = PARTITION_BY.get(name) if partitioned else None
    if day:
        df = df.hint("rebalance", day)
    if seen is not None:
        df = seen.attach(df)
    order = [c for c in (day, CLUSTER_BY.get(name)) if c]
    if order:
        df = df.sortWithinPartitions(*order)
    out = df.write.mode("overwrite")
    if day:
        out = out.partitionBy(day)
    if changes:
        out = out.option("partitionOverwriteMode", "dynamic")
    out.parquet(f"{root}/{name}")


def read_mart(spark, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A written mart, its columns in the order of the model (a partition column is stored last)."""
    df = spark.read.parquet(f"{root}/{name}")
    if columns is None and name in PARTITION_BY:
        columns = {ITEMS: INT1_COLUMNS, ORDERS: ORDER_COLUMNS}[name]
    return df.select(*columns) if columns else df


def build_all(ctx: ModelContext, out_dir: str, models: list[str] | None = None, log=None,
              check_keys: bool = True, threads: int = THREADS, partitioned: bool = False) -> dict[str, float]:
    """Write each model of ``BUILD_ORDER`` (or ``models``) to ``out_dir/<name>``; returns seconds per model.

    The declared keys of the sources are checked first: nothing is written if one does not hold.
    Models run at the same time as far as ``NEEDS`` allows; if some fail, all that do not need them are
    still written, then ``TasksFailed`` tells which.  What the writes observed is in ``ctx.observed``.
    ``partitioned`` stores the facts of ``PARTITION_BY`` by day, for ``incremental.refresh``.
    """
    load_models()
    spark = ctx.spark
    configure(spark)
    checkpoint_dir(spark)
    root = out_dir.rstrip("/")
    if check_keys:
        ctx.observed.update(require_keys(ctx, threads))

    def write(name: str):
        seen = Observed(name)
        write_mart(ctx.ref(name), root, name, partitioned, seen)
        ctx.replace(name, read_mart(spark, root, name))
        ctx.observed.update(seen.failures())

    names = [m for m in models or BUILD_ORDER if LAYERS.get(m) not in VIEW_LAYERS]
    outcomes = require_done(run_graph(spark, {m: (lambda m=m: write(m)) for m in names}, NEEDS, threads, log))
    return {m: outcomes[m].seconds for m in names}


def build_and_check(ctx: ModelContext, out_dir: str, log=None, models: list[str] | None = None, threads: int = THREADS):
    """Build every mart (or ``models``) with the declared checks.

    What the writes did not observe (unique columns, relationships, views) is read from the written
    tables.  The report (model, column_name, test, failures) is written next to the
    marts as ``_dq_report``; returns (timings, report DataFrame).
    """
    timings = build_all(ctx, out_dir, models, log, threads=threads)
    path = f"{out_dir.rstrip('/')}/_dq_report"
    checks = CHECKS if models is None else [c for c in CHECKS if c[0] in models]
    report_frame(ctx.spark, check_rows(ctx, checks, ctx.observed, threads)).write.mode("overwrite").parquet(path)
    return timings, ctx.spark.read.parquet(path)


def publish(ctx: ModelContext, out_dir: str, log=None, models: list[str] | None = None, threads: int = THREADS) -> dict:
    """Build a new version and publish it if every declared check passes; returns the publication.

    ``ChecksFailed`` or ``TasksFailed`` leave the publication before as it is.  With ``models``, the others
    are read from, and stay at, the version that is published now.
    """
    load_models()
    folder = versions.new_version(out_dir)
    if models is not None:
        before = versions.Published(ctx.spark, out_dir)
        for name in set(before.manifest["models"]) - set(models):
            ctx.replace(name, before.read(name, ordered=False))
    _, report = build_and_check(ctx, folder, log, models, threads)
    bad = [tuple(r) for r in report.where("failures > 0").orderBy("model", "column_name", "test").collect()]  # one row a check at most
    if bad:
        raise versions.ChecksFailed(bad, folder)
    return versions.commit(ctx.spark, out_dir, folder, models or BUILD_ORDER)


def main(argv=None):
    from cartwheel.session import local_session
    from cartwheel.sources import FixtureSources, ParquetSources

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", help="driver fixture tables (TPC-H style)")
    ap.add_argument("--sources", help="folder of the seven source tables as parquet")
    ap.add_argument("--out", required=True, help="folder of the marts, on storage that all executors share")
    ap.add_argument("--as-of", default=DEFAULT_AS_OF)
    ap.add_argument("--checks", action="store_true", help="report the declared checks with the build")
    ap.add_argument("--publish", action="store_true", help="write a new version and publish it if all checks pass")
    ap.add_argument("--partitioned", action="store_true", help="store the order and item facts by day")
    ap.add_argument("--days", nargs="+", metavar="YYYY-MM-DD", help="refresh a partitioned build after these days of orders changed")
    ap.add_argument("--threads", type=int, default=THREADS, help="models written at the same time")
    args = ap.parse_args(argv)
    spark = local_session()
    src = ParquetSources(spark, args.sources) if args.sources else FixtureSources(spark, args.sf_dir)
    ctx = ModelContext(spark, src, as_of=args.as_of)
    if args.days:
        from cartwheel.plans.incremental import refresh
        print(refresh(ctx, args.out, args.days, log=print, threads=args.threads))
    elif args.publish:
        print(publish(ctx, args.out, log=print, threads=args.threads))
    elif args.checks:
        _, report = build_and_check(ctx, args.out, log=print, threads=args.threads)
        for row in report.where("failures > 0").collect():  # at most one row per declared check
            print(f"FAIL {row.model}.{row.column_name} {row.test}: {row.failures}")
    else:
        build_all(ctx, args.out, log=print, threads=args.threads, partitioned=args.partitioned)


if __name__ == "__main__":
    main()
