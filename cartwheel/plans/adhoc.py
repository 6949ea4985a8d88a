"""Ad-hoc analyses over the marts (ADH0-ADH12, SL2, SL4).

``run_sql`` registers the resolved models as temporary views and runs one
SELECT through Spark SQL (the same Catalyst plan the DataFrame API gets).
The other functions are the analyses the reference's question path and
dashboard ask for, as DataFrame plans.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.functions import numeric, safe_divide
from cartwheel.plans.context import LAYERS, MODELS
from cartwheel.plans.intermediate import enriched_items
from cartwheel.plans.metrics import revenue_by_date
from cartwheel.session import checkpoint_dir

ROW_CAP = 100

# Domain -> marts, shown to question writers (all marts, by our own domains).
CATALOGUE = {
    "customers": ["fct_customer_orders", "fct_rfm_scores", "fct_customer_cohorts", "fct_customer_retention"],
    "products": ["fct_product_performance", "fct_category_performance", "fct_brand_performance",
                 "fct_product_affinity"],
    "revenue": ["fct_daily_revenue", "fct_monthly_revenue", "fct_cohort_revenue", "fct_geography_revenue"],
    "operations": ["fct_fulfillment", "fct_fulfillment_summary", "fct_returns", "fct_order_status",
                   "fct_distribution_center_performance"],
    "web": ["fct_sessions", "fct_web_funnel", "fct_traffic_source_performance", "fct_browser_performance"],
    "dimensions": ["dim_users", "dim_products", "dim_date", "dim_distribution_centers"],
}


# Plan nodes a read-only query may consist of; commands and writes are not among them.
QUERY_NODES = {
    "Aggregate", "Deduplicate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "GroupingSets", "Intersect", "Join",
    "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project", "RebalancePartitions",
    "Repartition", "RepartitionByExpression", "Sample", "Sort", "SubqueryAlias", "Union", "Unpivot", "UnresolvedHaving",
    "UnresolvedHint", "UnresolvedInlineTable", "UnresolvedOrdinal", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedTableValuedFunction", "UnresolvedWith", "Window", "WithWindowDefinition",
}


#: Functions that call host code, or whatever name they are given; table functions that only make rows.
HOST_FUNCTIONS = {"java_method", "reflect", "try_reflect"}
TABLE_FUNCTIONS = {"explode", "explode_outer", "inline", "inline_outer", "posexplode", "posexplode_outer", "range", "stack"}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _check_functions(node) -> None:
    """ValueError if an expression of a parsed plan node calls host code."""
    todo = _items(node.expressions())
    while todo:
        e = todo.pop()
        if e.getClass().getSimpleName() == "UnresolvedFunction":
            name = _items(e.nameParts())[-1].lower()
            if name in HOST_FUNCTIONS:
                raise ValueError(f"the function {name} is not accepted")
        todo += _items(e.children())


def tables_read(ctx, statement: str) -> set[str]:
    """Names of the models a statement reads.

    ValueError if its parsed plan is anything but a query, if it names a relation that is neither a
    model nor one of its own WITH names (a path, another catalogue's table), or calls host code.
    """
    plan = ctx.spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    found, own, todo = set(), set(), [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind not in QUERY_NODES:
            raise ValueError(f"only queries are accepted, not {kind}")
        _check_functions(node)
        if kind == "UnresolvedRelation":
            found.add(".".join(_items(node.multipartIdentifier())))
        if kind == "UnresolvedTableValuedFunction" and (name := _items(node.name())[-1].lower()) not in TABLE_FUNCTIONS:
            raise ValueError(f"the table function {name} is not accepted")
        todo += _items(node.children()) + _items(node.subqueries())
        if kind == "UnresolvedWith":
            own |= {t._1().lower() for t in _items(node.cteRelations())}
            todo += _items(node.innerChildren())
    models = {t.lower() for t in found} - own
    if foreign := sorted(t for t in models if t not in MODELS or LAYERS[t] == "staging"):
        raise ValueError(f"only marts can be read, not {', '.join(foreign)}")
    return models


def run_sql(ctx, statement: str) -> DataFrame:
    """Run one query over the models it names (registered lazily as temp views)."""
    text = statement.strip().rstrip(";")
    for name in tables_read(ctx, text):
        ctx.ref(name).createOrReplaceTempView(name)
    return ctx.spark.sql(text)


def capped(df: DataFrame, cap: int = ROW_CAP) -> tuple[list[dict], int]:
    """First ``cap`` rows as dicts and the full row count (the API edge), from one run of the query.

    The result is written once to the shared folder and counted by that write; its rows keep their
    order through an increasing number, of which the first ``cap`` are read back.  Of columns with one name
    the last is returned.
    """
    spark, names = df.sparkSession, df.columns
    path = f"{checkpoint_dir(spark).rstrip('/')}/answer-{uuid.uuid4().hex}"
    counted = Observation(f"answer-{uuid.uuid4().hex}")
    stored = df.toDF(*[f"c{i}" for i in range(len(names))])
    stored = stored.select(*[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "void" else F.col(f.name)
                             for f in stored.schema.fields])
    numbered = stored.select(F.monotonically_increasing_id().alias("at"), "*")
    numbered.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    first = spark.read.schema(numbered.schema).parquet(path).orderBy("at").limit(cap).drop("at")
    return [dict(zip(names, r)) for r in first.collect()], int(counted.get["n"])


def topk_products_by_return_rate(ctx, min_units: int = 10, k: int = 10) -> DataFrame:
    p = ctx.ref("fct_product_performance").where(F.col("total_units_sold") > min_units)
    return p.orderBy(F.col("return_rate").desc_nulls_last(), F.col("product_id")).limit(k).select(
        "product_name", "return_rate", "total_units_sold")


def champions_list(ctx, segment: str = "Champions", cap: int = ROW_CAP) -> DataFrame:
    r = ctx.ref("fct_rfm_scores").where(F.col("rfm_segment") == segment)
    return r.orderBy("user_id").limit(cap).select("user_id", "recency_days", "frequency", "monetary", "rfm_segment")


def monthly_growth(ctx, months: int = 12) -> DataFrame:
    m = ctx.ref("fct_monthly_revenue")
    return m.orderBy(F.col("order_month").desc()).limit(months).select(
        "order_month", "total_revenue", "mom_growth_pct", "yoy_growth_pct")


def latest_month_revenue(ctx) -> DataFrame:
    return ctx.ref("fct_monthly_revenue").orderBy(F.col("order_month").desc()).limit(1).select(
        "order_month", "total_revenue")


def purchase_rate_by_source(ctx) -> DataFrame:
    f = ctx.ref("fct_web_funnel")
    g = f.groupBy("traffic_source").agg(F.sum("total_sessions").alias("total_sessions"),
                                        F.sum("sessions_with_purchase").alias("sessions_with_purchase"))
    return g.select("*", safe_divide("sessions_with_purchase", "total_sessions").alias("purchase_rate"))


def brands_over(ctx, threshold: float = 10_000) -> DataFrame:
    b = ctx.ref("fct_brand_performance")
    g = b.groupBy("brand").agg(F.sum("total_revenue").alias("total_revenue"))
    return g.where(F.col("total_revenue") > F.lit(threshold))


def category_sales_last_days(ctx, days: int = 30) -> DataFrame:
    as_of = dt.date.fromisoformat(ctx.as_of)
    lo, hi = as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)
    items = enriched_items(ctx, "order_date", "category", "sale_price").where(
        F.col("order_date").between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date")))
    return items.groupBy("category").agg(F.sum("sale_price").alias("total_sales"),
                                         F.count(F.lit(1)).alias("units_sold"))


def top_categories(ctx, k: int = 8, days: int = 365) -> DataFrame:
    s = category_sales_last_days(ctx, days)
    return s.orderBy(F.col("total_sales").desc_nulls_last(), F.col("category")).limit(k)


def cohort_retention(ctx, cohort: str) -> DataFrame:
    return ctx.ref("fct_customer_retention").where(F.col("signup_cohort") == cohort)


def segment_summary(ctx) -> DataFrame:
    r = ctx.ref("fct_rfm_scores")
    return r.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.try_divide(F.sum("recency_days").cast("double"), F.count("recency_days").cast("double")).alias("avg_recency_days"),
        F.try_divide(F.sum("frequency").cast("double"), F.count("frequency").cast("double")).alias("avg_frequency"),
        F.try_divide(F.sum("monetary").cast("double"), F.count("monetary").cast("double")).alias("avg_monetary"),
        F.sum("monetary").alias("total_monetary"))


def top_customers(ctx, k: int = 10) -> DataFrame:
    c = ctx.ref("fct_customer_orders")
    return c.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("user_id")).limit(k).select(
        "user_id", "total_revenue", "total_orders", "avg_order_value", "customer_status")


def kpi_summary(ctx, days: int = 30) -> DataFrame:
    """Dashboard KPIs over the whole daily revenue series (a global aggregate, one row)."""
    s = revenue_by_date(ctx, days).select(*[numeric(c).alias(c) for c in ("total_revenue", "total_orders")])
    g = s.agg(F.sum("total_revenue").alias("total_revenue"), F.sum("total_orders").cast("bigint").alias("total_orders"),
              F.max("total_revenue").alias("max_daily_revenue"), F.min("total_revenue").alias("min_daily_revenue"),
              F.try_divide(F.sum("total_revenue").cast("double"), F.count("total_revenue").cast("double"))
              .alias("avg_daily_revenue"),
              F.count(F.lit(1)).alias("days_of_data"))
    aov = F.when(F.coalesce(F.col("total_orders"), F.lit(0)) > 0,
                 safe_divide("total_revenue", "total_orders")).otherwise(F.lit(0.0))
    return g.select("*", aov.alias("avg_order_value"))


def catalogue(spark) -> DataFrame:
    rows = [(d, t) for d, ts in CATALOGUE.items() for t in ts]
    return spark.createDataFrame(rows, "domain string, table_name string")
