"""Partitioned build and its refresh after some days of orders changed, against a full build."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.plans import load_models
from cartwheel.plans.context import MODELS, ModelContext
from cartwheel.plans.incremental import GRAINS, among, dependents, first_order_days, refresh
from cartwheel.plans.pipeline import ITEMS, ORDERS, PARTITION_BY, build_all, read_mart
from cartwheel.registry import context

HELD = [ITEMS, ORDERS, "dim_distribution_centers", "int_user_order_summary", *GRAINS, "fct_monthly_revenue", "fct_returns"]
PERIOD = "order_date < '2020-03-01'"


class Changed:
    """The fixture's sources with a changed ``orders`` table."""

    def __init__(self, base, orders):
        self.base, self.orders = base, orders

    def __call__(self, name):
        return self.orders if name == "orders" else self.base(name)

    def __getattr__(self, name):
        return getattr(self.base, name)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Two states of the sources: a day's orders come, another's go, a user gets an earlier first order and one order loses its date."""
    ctx = context(spark, SF_SMALL)
    after = ctx.source("orders").cache()
    day = F.to_date("created_at")
    count = {r["d"]: r["n"] for r in after.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    known = sorted(d for d in count if d is not None)
    come, gone = known[len(known) // 2], known[len(known) // 3]
    # a user's first order is absent from the state before, so that a later one is the first there
    users = after.groupBy("user_id").agg(F.min(F.struct("created_at", "order_id")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 2")
    first = users.orderBy("user_id").select("f.*").first()
    before = after.where((day != come) & (F.col("order_id") != first["order_id"]))
    after = after.where(day != gone)
    old = ModelContext(spark, Changed(ctx.sources, before), ctx.as_of)
    new = ModelContext(spark, Changed(ctx.sources, after), ctx.as_of)
    out, full = (str(tmp_path_factory.mktemp(n)) for n in ("old", "full"))
    build_all(old, out, HELD, partitioned=True, check_keys=False)
    files = {n: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/{n}/order_date=*/*.parquet")} for n in PARTITION_BY}
    days = {come, gone, first["created_at"].date()}
    done = refresh(ModelContext(spark, Changed(ctx.sources, after), ctx.as_of), out, days, models=HELD)
    build_all(new, full, HELD, check_keys=False)
    return out, full, days, files, done, gone


def test_a_refresh_equals_a_full_build(spark, built):
    out, full, *_ = built
    for name in HELD:
        assert rows(read_mart(spark, out, name)) == rows(read_mart(spark, full, name)), name


def test_only_changed_days_are_written(built):
    out, _, days, files, done, gone = built
    changed = {"__HIVE_DEFAULT_PARTITION__"[:10] if d is None else d.isoformat() for d in done["days"]}
    assert {d.isoformat() for d in days} < changed and len(changed) <= len(days) + 40
    for name in PARTITION_BY:
        left = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/{name}/order_date=*/*.parquet")}
        same = {f for f in left if files[name].get(f) == left[f]}
        of = lambda f: f.split("order_date=")[1][:10]
        assert all(of(f) in changed for f in set(left) - same) and all(of(f) in changed for f in set(files[name]) - same)
        assert len(same) > 10 * len(set(left) - same)
        assert not os.path.exists(f"{out}/{name}/order_date={gone}")
    assert sorted(done["seconds"]) == sorted(set(HELD) & set(dependents([ITEMS, ORDERS])))


def test_readers_of_a_period_open_its_partitions(spark, built):
    import contextlib
    import io
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        read_mart(spark, built[0], ORDERS).where(PERIOD).select("order_id").explain()
    assert "PartitionFilters: [isnotnull(order_date" in text.getvalue()
    ctx = ModelContext(spark, None)
    for name in HELD:
        ctx.replace(name, read_mart(spark, built[0], name))
    table = ctx.ref(ITEMS).where(among(F.trunc("order_date", "month"), {dt.date(2020, 1, 1)}))
    ctx.replace(ITEMS, table)
    with contextlib.redirect_stdout(text):
        MODELS["fct_category_performance"](ctx).explain()
    assert "PartitionFilters: [" in text.getvalue().split("Physical Plan")[-1]


def test_grains_depend_on_one_day_or_month(spark):
    """A mart's rows of a month, computed from this month's facts alone, are those of the whole."""
    load_models()
    ctx = context(spark, SF_SMALL)
    shared = {n: ctx.ref(n).cache() if n in PARTITION_BY else ctx.ref(n) for n in (ITEMS, ORDERS, "dim_distribution_centers")}
    month = shared[ORDERS].groupBy(F.trunc("order_date", "month").alias("m")).count().where("m is not null").orderBy(F.col("count").desc(), "m").first()["m"]
    for name, (grain, column) in GRAINS.items():
        own = ModelContext(spark, ctx.sources, ctx.as_of)
        whole = ModelContext(spark, ctx.sources, ctx.as_of)
        for n, df in shared.items():
            whole.replace(n, df)
            own.replace(n, df.where(among(F.trunc("order_date", "month"), {month})) if n in PARTITION_BY else df)
        want = MODELS[name](whole).where(F.trunc(F.to_date(column), "month") == F.lit(month))
        assert rows(MODELS[name](own)) == rows(want) and want.count() > 0, name


def test_first_orders_that_moved(spark):
    schema = "order_id long, user_id long, created_at timestamp_ntz"
    at = lambda d: dt.datetime(2024, 1, d, 12)
    now = [(1, 1, at(2)), (2, 1, at(5)), (3, 2, at(4)), (4, 3, at(9)), (7, None, at(8)), (8, 5, None), (9, 5, at(3))]
    stored = [(2, 1, dt.date(2024, 1, 5), True), (3, 2, dt.date(2024, 1, 4), True), (5, 3, dt.date(2024, 1, 2), True), (6, 4, dt.date(2024, 1, 2), True),
              (7, None, dt.date(2024, 1, 8), True), (8, 5, None, True)]
    ctx = ModelContext(spark, None)
    ctx.replace("stg_orders", spark.createDataFrame(now, schema))
    table = spark.createDataFrame(stored, "order_id long, user_id long, order_date date, is_first_order boolean")
    # user 1 has an earlier one, user 3's was removed, user 4 has none any more; users 2, 5 and null keep theirs
    found = first_order_days(ctx, table, {dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4), None})
    assert found == {dt.date(2024, 1, d) for d in (2, 5, 9)}


def test_days_of_a_condition(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    table = spark.createDataFrame([(d,) for d in days], "d date")
    for wanted in ([], [days[0]], [None], [days[1], None]):
        assert {r.d for r in table.where(among(F.col("d"), set(wanted))).collect()} == set(wanted)


def test_nothing_changed(spark, tmp_out):
    assert refresh(context(spark, SF_SMALL), tmp_out, []) == {"days": [], "seconds": {}}
