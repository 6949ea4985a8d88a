"""Declarative metric queries over the public views (MQ0-MQ13).

A cube is a base view plus named measures and dimensions.  ``metric_query``
turns {measures, dimensions, filters, time_dimensions, order, limit} into one
DataFrame plan: filters on dimensions -> ``where`` (pushed to the scan),
``groupBy`` dimensions and truncated time dimensions, measures -> ``agg``
(partial aggregation map-side), measure filters -> ``where`` after the
aggregate, then ``orderBy`` + ``limit`` (a top-k when ordered).

Output columns are named by member (``total_revenue``, ``country``...); a
query may use members of one cube only (the cubes declare no joins).
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from cartwheel.functions import mean


@dataclass(frozen=True)
class Measure:
    kind: str            # count | sum | avg
    sql: str | None = None
    title: str = ""
    fmt: str | None = None


@dataclass(frozen=True)
class Dimension:
    sql: str
    kind: str = "string"  # string | time
    primary_key: bool = False


@dataclass(frozen=True)
class Cube:
    name: str
    view: str
    measures: dict = field(default_factory=dict)
    dimensions: dict = field(default_factory=dict)


# The three cubes of the reference (views, measures, dimensions).
CUBES = {
    "orders": Cube("orders", "vw_orders",
                   measures={"count": Measure("count", None, "Total Orders"),
                             "total_revenue": Measure("sum", "revenue", "Total Revenue", "currency"),
                             "avg_order_value": Measure("avg", "revenue", "Average Order Value", "currency")},
                   dimensions={"order_id": Dimension("order_id", "string", True),
                               "status": Dimension("order_status"),
                               "country": Dimension("user_country"),
                               "order_date": Dimension("order_date", "time")}),
    "revenue_daily": Cube("revenue_daily", "vw_daily_revenue",
                          measures={"total_revenue": Measure("sum", "daily_revenue", "Total Revenue (Daily Rollup)", "currency"),
                                    "total_orders": Measure("sum", "order_count", "Total Orders (Daily Rollup)"),
                                    "avg_daily_order_value": Measure("avg", "avg_order_value", "Average Daily Order Value", "currency")},
                          dimensions={"date": Dimension("order_date", "time", True)}),
    "users": Cube("users", "vw_users",
                  measures={"count": Measure("count", None, "Total Users"),
                            "total_orders_placed": Measure("sum", "total_orders", "Total Orders Placed by Users")},
                  dimensions={"user_id": Dimension("user_id", "string", True),
                              "country": Dimension("country"), "city": Dimension("city"),
                              "first_order_date": Dimension("first_order_at", "time")}),
}

GRANULARITIES = ("day", "week", "month", "quarter", "year")
_LAST_N = re.compile(r"^\s*last\s+(\d+)\s+(day|days|week|weeks|month|months|year|years)\s*$", re.I)


def _split(member: str) -> tuple[str, str]:
    if "." not in member:
        raise ValueError(f"member {member!r} must be 'cube.name'")
    cube, name = member.split(".", 1)
    if cube not in CUBES:
        raise ValueError(f"unknown cube {cube!r}")
    return cube, name


def _measure_col(m: Measure) -> Column:
    if m.kind == "count":
        return F.count(F.lit(1))
    if m.kind == "sum":
        return F.sum(m.sql)
    if m.kind == "avg":
        return mean(m.sql)
    raise ValueError(f"unsupported measure type {m.kind!r}")


def resolve_date_range(date_range, as_of: str) -> tuple[dt.date, dt.date]:
    """[start, end] inclusive.  "last N days" is the N whole days before ``as_of``."""
    as_of_d = dt.date.fromisoformat(str(as_of))
    if isinstance(date_range, str):
        named = date_range.strip().lower()
        if named in ("ytd", "year to date", "this year"):  # the as-of date's year; data after it has not happened
            return as_of_d.replace(month=1, day=1), as_of_d.replace(month=12, day=31)
        if named == "last quarter":
            this = as_of_d.replace(month=(as_of_d.month - 1) // 3 * 3 + 1, day=1)
            end = this - dt.timedelta(days=1)
            return end.replace(month=end.month - 2, day=1), end
        if named == "last year":
            return dt.date(as_of_d.year - 1, 1, 1), dt.date(as_of_d.year - 1, 12, 31)
        if named in ("last month", "last week", "last day"):
            date_range = named.replace("last ", "last 1 ")
        m = _LAST_N.match(date_range)
        if not m:
            raise ValueError(f"unsupported dateRange {date_range!r}")
        n, unit = int(m.group(1)), m.group(2).lower().rstrip("s")
        days = {"day": 1, "week": 7}.get(unit)
        if days is not None:
            return as_of_d - dt.timedelta(days=n * days), as_of_d - dt.timedelta(days=1)
        months = n * (12 if unit == "year" else 1)
        first_this = as_of_d.replace(day=1)
        y, mth = divmod(first_this.year * 12 + first_this.month - 1 - months, 12)
        return dt.date(y, mth + 1, 1), first_this - dt.timedelta(days=1)
    start, end = date_range
    return dt.date.fromisoformat(str(start)[:10]), dt.date.fromisoformat(str(end)[:10])


def _truncate(col: Column, granularity: str, is_date: bool) -> Column:
    if granularity not in GRANULARITIES:
        raise ValueError(f"unsupported granularity {granularity!r}")
    if is_date:
        return col if granularity == "day" else F.trunc(col, granularity)
    return F.date_trunc(granularity, col).cast("timestamp_ntz")


def _filter_col(col: Column, op: str, values) -> Column:
    values = list(values or [])
    if op == "equals":
        return col.isin(*values)
    if op == "notEquals":
        return ~col.isin(*values) | col.isNull()
    if op in ("gt", "gte", "lt", "lte"):
        v = F.lit(values[0])
        return {"gt": col > v, "gte": col >= v, "lt": col < v, "lte": col <= v}[op]
    if op == "set":
        return col.isNotNull()
    if op == "notSet":
        return col.isNull()
    if op == "contains":
        out = None
        for v in values:
            c = F.lower(col).contains(str(v).lower())
            out = c if out is None else (out | c)
        return out
    if op == "inDateRange":
        lo, hi = values
        return F.to_date(col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    raise ValueError(f"unsupported filter operator {op!r}")


def metric_query(ctx, measures=(), dimensions=None, filters=None, time_dimensions=None, order=None,
                 limit: int | None = 100) -> DataFrame:
    members = list(measures) + list(dimensions or []) + [f["member"] for f in (filters or [])] \
        + [t["dimension"] for t in (time_dimensions or [])] + list((order or {}).keys())
    cubes = {_split(m)[0] for m in members}
    if len(cubes) != 1:
        raise ValueError(f"a metric query must use exactly one cube, got {sorted(cubes)}")
    cube = CUBES[cubes.pop()]
    base = ctx.ref(cube.view)

    def dim(name):
        if name not in cube.dimensions:
            raise ValueError(f"unknown dimension {cube.name}.{name}")
        return cube.dimensions[name]

    measure_filters = []
    for f in filters or []:
        _, name = _split(f["member"])
        if name in cube.measures:
            measure_filters.append((name, f["operator"], f.get("values")))
            continue
        base = base.where(_filter_col(F.col(dim(name).sql), f["operator"], f.get("values")))
    group_cols = []
    for d in dimensions or []:
        _, name = _split(d)
        group_cols.append(F.col(dim(name).sql).alias(name))
    for t in time_dimensions or []:
        _, name = _split(t["dimension"])
        d = dim(name)
        src = F.col(d.sql)
        is_date = isinstance(base.schema[d.sql].dataType, DateType)
        if t.get("dateRange"):
            lo, hi = resolve_date_range(t["dateRange"], ctx.as_of)
            day = src if is_date else F.to_date(src)
            base = base.where(day.between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date")))
        if t.get("granularity"):
            group_cols.append(_truncate(src, t["granularity"], is_date).alias(name))
    def measure(name):
        if name not in cube.measures:
            raise ValueError(f"unknown measure {cube.name}.{name}")
        return _measure_col(cube.measures[name])

    selected = [_split(m)[1] for m in measures]
    # measures that only a filter or the order names are computed and dropped at the end
    extra = [n for n in [n for n, _, _ in measure_filters] + [_split(m)[1] for m in (order or {})]
             if n in cube.measures and n not in selected]
    aggs = [measure(n).alias(n) for n in dict.fromkeys(selected + extra)]
    if not aggs and not group_cols:
        raise ValueError("a metric query needs a measure, a dimension or a time grain")
    if not aggs:
        out = base.select(*group_cols).distinct()
    else:
        out = base.groupBy(*group_cols).agg(*aggs) if group_cols else base.agg(*aggs)
    for name, op, values in measure_filters:
        out = out.where(_filter_col(F.col(name), op, values))
    sort = []
    for member, direction in (order or {}).items():
        _, name = _split(member)
        if name not in out.columns:
            raise ValueError(f"cannot order by {member}: a dimension must be selected (or given a grain) to order by it")
        c = F.col(name)
        sort.append(c.desc_nulls_last() if str(direction).lower() == "desc" else c.asc_nulls_first())
    if not sort:
        times = [t for t in (time_dimensions or []) if t.get("granularity")]
        if times:
            sort.append(F.col(_split(times[0]["dimension"])[1]).asc_nulls_first())
        elif measures:
            sort.append(F.col(selected[0]).desc_nulls_last())
    # dimension columns as tie-breaks make the limited row set deterministic
    sort += [F.col(c).asc_nulls_first() for c in out.columns if c not in cube.measures or c not in selected + extra]
    if sort:
        out = out.orderBy(*sort)
    if limit is not None and group_cols:
        out = out.limit(int(limit))
    return out.drop(*extra) if extra else out


def cube_meta(spark) -> DataFrame:
    """Metadata: one row per cube member (cube, member, kind, type, sql, title)."""
    rows = []
    for c in CUBES.values():
        for n, m in c.measures.items():
            rows.append((c.name, f"{c.name}.{n}", "measure", m.kind, m.sql, m.title))
        for n, d in c.dimensions.items():
            rows.append((c.name, f"{c.name}.{n}", "dimension", d.kind, d.sql, ""))
    return spark.createDataFrame(rows, "cube string, member string, kind string, type string, sql string, title string")


# The named metric calls of the reference's API and its intents.
def revenue_by_date(ctx, days: int = 30, limit: int | None = None) -> DataFrame:
    """Daily revenue and orders of the whole period; a listing may ask for a limit."""
    return metric_query(ctx, ["revenue_daily.total_revenue", "revenue_daily.total_orders"], [],
                        time_dimensions=[{"dimension": "revenue_daily.date", "dateRange": f"last {days} days",
                                          "granularity": "day"}],
                        order={"revenue_daily.date": "asc"}, limit=limit)


def revenue_by_country(ctx) -> DataFrame:
    return metric_query(ctx, ["orders.total_revenue", "orders.count"], ["orders.country"],
                        order={"orders.total_revenue": "desc"}, limit=20)


def order_metrics(ctx) -> DataFrame:
    return metric_query(ctx, ["orders.count", "orders.total_revenue", "orders.avg_order_value"], [])


def user_metrics(ctx) -> DataFrame:
    return metric_query(ctx, ["users.count", "users.total_orders_placed"], [])


def orders_by_status(ctx) -> DataFrame:
    return metric_query(ctx, ["orders.count", "orders.total_revenue"], ["orders.status"],
                        order={"orders.count": "desc"})


INTENTS = {
    "total_revenue": lambda ctx: metric_query(ctx, ["orders.total_revenue"], []),
    "total_orders": lambda ctx: metric_query(ctx, ["orders.count"], []),
    "revenue_by_country": revenue_by_country,
    "orders_by_status": orders_by_status,
    "daily_revenue": lambda ctx: revenue_by_date(ctx, 30),
    "user_count": user_metrics,
}


def execute_intent(ctx, intent: str) -> DataFrame | None:
    fn = INTENTS.get(intent)
    return fn(ctx) if fn else None
