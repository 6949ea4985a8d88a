"""Registered query keys beyond the models: metric queries, ad-hoc analyses,
data-quality checks, and primitive-level keys that exercise one operator
each (joins, aggregates, windows, top-k, scalar functions) over the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import (
    count_if, day_diff, mean, month_diff, month_start_ts, numeric, safe_divide, ts_diff, us_week,
)
from cartwheel.operators.calendar import SPINE_START, month_grid, month_of, spine_end
from cartwheel.operators.ranking import ntile
from cartwheel.plans import adhoc, metrics, quality
from cartwheel.plans.core import first_order_flag
from cartwheel.plans.intermediate import enriched_items
from cartwheel.plans.ordering import sort_columns
from cartwheel.registry import context, query

# --- calendar dimension over the data (COR4) --------------------------------


@query("dim_date_orders")
def _dim_date_orders(ctx):
    """dim_date attributes of every order date, with that day's orders.

    dim_date itself is a fixed calendar (it reads no table), so the key joins
    it to the order facts: the work grows with the orders.
    """
    daily = ctx.ref("fct_orders").groupBy(F.col("order_date").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders"), count_if(F.col("is_first_order")).alias("first_orders"))
    return ctx.ref("dim_date").join(daily, "date_key", "inner")


# --- metric queries (MQ4-MQ8, MQ10, MQ11) ----------------------------------


@query("metric_daily_revenue")
def _metric_daily_revenue(ctx):
    """Revenue and orders by day for the last 30 days before the as-of date."""
    return metrics.revenue_by_date(ctx, 30)


@query("metric_daily_revenue_365")
def _metric_daily_revenue_365(ctx):
    """Same call with days=365 (the fixture's orders end months before the as-of date)."""
    return metrics.revenue_by_date(ctx, 365)


@query("metric_revenue_by_country")
def _metric_revenue_by_country(ctx):
    return metrics.revenue_by_country(ctx)


@query("metric_order_totals")
def _metric_order_totals(ctx):
    return metrics.order_metrics(ctx)


@query("metric_user_totals")
def _metric_user_totals(ctx):
    return metrics.user_metrics(ctx)


@query("metric_orders_by_status")
def _metric_orders_by_status(ctx):
    return metrics.orders_by_status(ctx)


@query("metric_time_grain")
def _metric_time_grain(ctx):
    return metrics.metric_query(
        ctx, ["orders.total_revenue", "orders.count", "orders.avg_order_value"], ["orders.status"],
        time_dimensions=[{"dimension": "orders.order_date", "granularity": "quarter",
                          "dateRange": ["2021-01-01", "2024-12-31"]}],
        order={"orders.order_date": "asc"}, limit=None)


@query("metric_filtered")
def _metric_filtered(ctx):
    return metrics.metric_query(
        ctx, ["orders.count", "orders.total_revenue"], ["orders.country"],
        filters=[{"member": "orders.status", "operator": "equals", "values": ["Complete", "Shipped"]},
                 {"member": "orders.country", "operator": "notEquals", "values": ["CHINA"]},
                 {"member": "orders.count", "operator": "gt", "values": [100]}],
        order={"orders.total_revenue": "desc"}, limit=None)


@query("metric_users_by_first_order")
def _metric_users_by_first_order(ctx):
    """inDateRange on a timestamp: the whole last day belongs to the range."""
    return metrics.metric_query(ctx, ["users.count", "users.total_orders_placed"], ["users.country"], filters=[
        {"member": "users.first_order_date", "operator": "inDateRange", "values": ["2019-01-01", "2020-06-30"]}], limit=None)


@query("metric_dimensions_only")
def _metric_dimensions_only(ctx):
    return metrics.metric_query(ctx, [], ["orders.country", "orders.status"], limit=None)


@query("metric_ordered_by_unselected")
def _metric_ordered_by_unselected(ctx):
    """The ten countries with the highest average order value, which is not shown."""
    return metrics.metric_query(ctx, ["orders.count"], ["orders.country"], order={"orders.avg_order_value": "desc"}, limit=10)


@query("metric_year_to_date")
def _metric_year_to_date(ctx):
    mid_year = context(ctx.spark, ctx.sf_dir, as_of="2025-06-15")
    return metrics.metric_query(mid_year, ["orders.count", "orders.total_revenue"], ["orders.status"],
                                time_dimensions=[{"dimension": "orders.order_date", "dateRange": "year to date"}], limit=None)


@query("metric_last_month")
def _metric_last_month(ctx):
    mid_year = context(ctx.spark, ctx.sf_dir, as_of="2025-06-15")
    return metrics.metric_query(mid_year, ["revenue_daily.total_revenue", "revenue_daily.total_orders"], time_dimensions=[
        {"dimension": "revenue_daily.date", "dateRange": "last month", "granularity": "day"}], limit=None)


@query("ordered_category_top20")
def _ordered_category_top20(ctx):
    """First rows of a mart in its declared order."""
    c = ctx.ref("fct_category_performance")
    return c.orderBy(*sort_columns("fct_category_performance"), "category", "department").limit(20).select(
        "category", "department", "order_month", "total_revenue")


# --- ad-hoc analyses (ADH1-ADH11, SL2, SL4) ---------------------------------


@query("topk_products_by_return_rate")
def _topk_products_by_return_rate(ctx):
    return adhoc.topk_products_by_return_rate(ctx)


@query("champions_list")
def _champions_list(ctx):
    return adhoc.champions_list(ctx)


@query("monthly_growth_last_12")
def _monthly_growth_last_12(ctx):
    return adhoc.monthly_growth(ctx, 12)


@query("latest_month_revenue")
def _latest_month_revenue(ctx):
    return adhoc.latest_month_revenue(ctx)


@query("purchase_rate_by_source")
def _purchase_rate_by_source(ctx):
    return adhoc.purchase_rate_by_source(ctx)


@query("brands_over_10k")
def _brands_over_10k(ctx):
    return adhoc.brands_over(ctx, 10_000)


@query("category_sales_last_30_days")
def _category_sales_last_30_days(ctx):
    return adhoc.category_sales_last_days(ctx, 30)


@query("category_sales_last_365_days")
def _category_sales_last_365_days(ctx):
    return adhoc.category_sales_last_days(ctx, 365)


@query("top8_categories")
def _top8_categories(ctx):
    return adhoc.top_categories(ctx, 8, 365)


@query("cohort_retention_lookup")
def _cohort_retention_lookup(ctx):
    return adhoc.cohort_retention(ctx, "2020-01")


@query("segment_summary")
def _segment_summary(ctx):
    return adhoc.segment_summary(ctx)


@query("top_customers")
def _top_customers(ctx):
    return adhoc.top_customers(ctx, 10)


@query("kpi_summary")
def _kpi_summary(ctx):
    return adhoc.kpi_summary(ctx, 365)


@query("sql_adhoc_monthly_by_status")
def _sql_adhoc(ctx):
    """ADH0: a SELECT run through Spark SQL over the registered marts."""
    return adhoc.run_sql(ctx, """
        SELECT order_month, order_status, order_count, revenue
        FROM fct_order_status WHERE order_status IN ('Complete', 'Returned')""")


# --- data-quality checks (DQ1-DQ5) ----------------------------------------


@query("dq_not_null")
def _dq_not_null(ctx):
    """Every declared not_null check."""
    return quality.report(ctx, quality.checks_of("not_null"))


@query("dq_unique")
def _dq_unique(ctx):
    """Every declared unique check."""
    return quality.report(ctx, quality.checks_of("unique"))


@query("dq_accepted_values")
def _dq_accepted_values(ctx):
    return quality.run_checks(ctx, quality.checks_of("accepted_values"))


@query("dq_relationships")
def _dq_relationships(ctx):
    return quality.run_checks(ctx, quality.checks_of("relationships"))


@query("dq_report")
def _dq_report(ctx):
    return quality.report(ctx)


# --- primitive-level keys ---------------------------------------------------


@query("join_left_equi")
def _join_left_equi(ctx):
    oi, o = ctx.ref("stg_order_items"), ctx.ref("stg_orders")
    o = o.select(F.col("order_id").alias("_o_id"), F.col("status").alias("order_status"),
                 F.col("created_at").alias("order_created_at"))
    return oi.join(o, oi["order_id"] == o["_o_id"], "left").select(
        "order_item_id", "order_id", "order_status", "order_created_at")


@query("join_inner_equi")
def _join_inner_equi(ctx):
    p, d = ctx.ref("stg_products"), ctx.ref("stg_distribution_centers")
    d = d.select(F.col("distribution_center_id").alias("_d_id"), "distribution_center_name")
    return p.join(d, p["distribution_center_id"] == d["_d_id"], "inner").select(
        "product_id", "distribution_center_id", "distribution_center_name")


def _user_month_grid(ctx):
    u = ctx.ref("dim_users").where(F.col("user_id").isNotNull())
    first = F.greatest(F.trunc(F.to_date("created_at"), "month"), month_of(ctx.param("spine_start", SPINE_START)))
    last = F.least(month_of(ctx.as_of), month_of(spine_end(ctx)))
    return u.select("user_id", F.explode(month_grid(first, last)).alias("activity_month"))


@query("join_cross_range")
def _join_cross_range(ctx):
    """users x months with signup_month <= month <= as-of month, generated per user."""
    return _user_month_grid(ctx)


@query("join_left_composite")
def _join_left_composite(ctx):
    grid = _user_month_grid(ctx)
    o = ctx.ref("fct_orders").groupBy(F.col("user_id").alias("_u"),
                                      F.trunc(F.to_date("order_created_at"), "month").alias("_m")).agg(
        F.count(F.lit(1)).alias("_n"))
    j = grid.join(o, (grid["user_id"] == o["_u"]) & (grid["activity_month"] == o["_m"]), "left")
    return j.select("user_id", "activity_month", F.coalesce(F.col("_n"), F.lit(0)).alias("orders_in_month"))


@query("join_left_on_date_expr")
def _join_left_on_date_expr(ctx):
    """Sessions LEFT JOIN orders on (user, same day), reported per session (orders matched, revenue)."""
    s = ctx.ref("fct_sessions")
    od = ctx.ref("fct_orders").groupBy(F.col("user_id").alias("_u"), F.to_date("order_created_at").alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_revenue").alias("_r"))
    j = s.join(od, (s["user_id"] == od["_u"]) & (F.to_date(s["session_start_at"]) == od["_d"]), "left")
    return j.select("session_id", "user_id", F.coalesce(F.col("_n"), F.lit(0)).alias("same_day_orders"),
                    F.coalesce(F.col("_r"), F.lit(0)).alias("same_day_revenue"))


@query("join_self_pairs")
def _join_self_pairs(ctx):
    """fct_product_affinity with min_support_count=2 (pairs exist at this threshold in the fixtures)."""
    return context(ctx.spark, ctx.sf_dir, ctx.as_of, min_support_count=2).ref("fct_product_affinity")


@query("join_cross_scalar")
def _join_cross_scalar(ctx):
    items = enriched_items(ctx, "product_id", "sale_price")
    total = items.select(F.sum("sale_price")).scalar()
    g = items.groupBy("product_id").agg(F.sum("sale_price").alias("revenue"))
    return g.select("product_id", "revenue", safe_divide(F.col("revenue"), total).alias("revenue_share"))


@query("agg_count_distinct_multi")
def _agg_count_distinct_multi(ctx):
    items = enriched_items(ctx, "brand", "order_id", "user_id", "product_id")
    return items.groupBy("brand").agg(F.countDistinct("order_id").alias("orders"),
                                      F.countDistinct("user_id").alias("customers"),
                                      F.countDistinct("product_id").alias("products"))


@query("agg_conditional_distinct")
def _agg_conditional_distinct(ctx):
    o = ctx.ref("fct_orders")
    return o.groupBy("order_date").agg(
        F.countDistinct("user_id").alias("unique_customers"),
        F.countDistinct(F.when(F.col("is_first_order"), F.col("user_id"))).alias("new_customers"))


@query("agg_countif")
def _agg_countif(ctx):
    o = ctx.ref("fct_orders")
    st = F.col("order_status")
    return o.groupBy(month_start_ts("order_created_at").alias("order_month")).agg(
        count_if(st == "Returned").alias("returned"), count_if(st == "Cancelled").alias("cancelled"),
        count_if(F.col("shipped_at").isNotNull()).alias("shipped"), count_if(st.isin("Complete", "Shipped")).alias("open_or_done"))


@query("agg_conditional_sum_avg")
def _agg_conditional_sum_avg(ctx):
    items = enriched_items(ctx, "product_id", "order_status", "sale_price", "order_returned_at",
                           "order_delivered_at")
    ret = F.col("order_status") == "Returned"
    return items.groupBy("product_id").agg(
        F.sum(F.when(ret, F.col("sale_price")).otherwise(F.lit(0))).alias("revenue_lost_to_returns"),
        mean(F.when(ret, ts_diff("DAY", F.col("order_returned_at"), F.col("order_delivered_at")))).alias("avg_days_to_return"))


@query("win_row_number_first")
def _win_row_number_first(ctx):
    o = first_order_flag(ctx.ref("stg_orders"))
    return o.select("order_id", "user_id", "created_at", "is_first_order")


@query("win_ntile_global")
def _win_ntile_global(ctx):
    s = ctx.ref("int_user_order_summary").select("user_id", "total_revenue", "last_order_at")
    s = ntile(s, 4, "total_revenue", "revenue_quartile", key="user_id")
    return ntile(s, 7, "last_order_at", "recency_septile", key="user_id", descending=True)


@query("win_rank_partitioned")
def _win_rank_partitioned(ctx):
    b = ctx.ref("fct_brand_performance")
    return b.select("brand", "order_month", "total_revenue", "brand_rank_by_revenue")


@query("win_lag")
def _win_lag(ctx):
    m = ctx.ref("fct_monthly_revenue")
    return m.select("order_month", "total_revenue", "prev_month_revenue", "prev_year_revenue")


@query("win_running_sum_rows")
def _win_running_sum_rows(ctx):
    return ctx.ref("fct_monthly_revenue").select("order_month", "total_revenue", "cumulative_revenue_ytd")


@query("win_running_sum_partition")
def _win_running_sum_partition(ctx):
    return ctx.ref("fct_customer_cohorts").select("user_id", "activity_month", "orders_in_month", "cumulative_orders")


@query("fn_safe_divide")
def _fn_safe_divide(ctx):
    p = ctx.ref("fct_returns")
    return p.select("product_id", "returned_units", "total_orders", safe_divide("returned_units", "total_orders").alias("ratio"),
                    safe_divide(F.col("returned_units"), F.col("returned_units") - F.col("returned_units")).alias("by_zero"))


@query("fn_numeric")
def _fn_numeric(ctx):
    """Numeric coercion: what is no number becomes NULL."""
    p = ctx.ref("stg_products")
    mixed = F.when(F.col("product_id") % 3 == 0, F.col("sku")).when(
        F.col("product_id") % 3 == 1, F.substring("sku", 5, 20)).otherwise(F.concat(F.col("retail_price").cast("string"), F.lit("0")))
    return p.select("product_id", mixed.alias("raw"), numeric(mixed).alias("value"))


@query("fn_date_trunc")
def _fn_date_trunc(ctx):
    o = ctx.ref("fct_orders")
    return o.select("order_id", month_start_ts("order_created_at").alias("month_ts"),
                    F.date_trunc("quarter", "order_created_at").cast("timestamp_ntz").alias("quarter_ts"),
                    F.trunc("order_date", "month").alias("month_date"), F.trunc("order_date", "quarter").alias("quarter_date"))


@query("fn_date_diff")
def _fn_date_diff(ctx):
    u = ctx.ref("dim_users")
    as_of = F.lit(ctx.as_of).cast("date")
    return u.select("user_id", day_diff(as_of, F.to_date("created_at")).alias("days"),
                    month_diff(as_of, F.to_date("created_at")).alias("months"))


@query("fn_timestamp_diff")
def _fn_timestamp_diff(ctx):
    o = ctx.ref("stg_orders")
    return o.select("order_id", ts_diff("HOUR", F.col("delivered_at"), F.col("created_at")).alias("hours"),
                    ts_diff("DAY", F.col("delivered_at"), F.col("created_at")).alias("days"),
                    ts_diff("SECOND", F.col("shipped_at"), F.col("created_at")).alias("seconds"),
                    ts_diff("HOUR", F.col("created_at"), F.col("delivered_at")).alias("negative_hours"))


@query("fn_calendar")
def _fn_calendar(ctx):
    o = ctx.ref("fct_orders")
    d = F.col("order_date")
    return o.select("order_id", F.dayofweek(d).alias("day_of_week"), us_week(d).alias("week_of_year"),
                    F.month(d).alias("month_number"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
                    F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"))



# --- documented-only metrics ----------------------------------
from cartwheel.plans import documented  # noqa: E402


@query("repeat_customer_rate")
def _repeat_customer_rate(ctx):
    return documented.repeat_customer_rate(ctx)


@query("cart_abandonment")
def _cart_abandonment(ctx):
    return documented.cart_abandonment(ctx)


@query("on_time_delivery_rate")
def _on_time_delivery_rate(ctx):
    return documented.on_time_delivery_rate(ctx)


@query("cohort_churn")
def _cohort_churn(ctx):
    return documented.cohort_churn(ctx)
