"""Final oracle SELECT per registered key."""

from __future__ import annotations

from cartwheel.oracle.duckdb_sql import sql

ORACLES: dict[str, str] = {}


def _model(name: str, cols: str) -> None:
    ORACLES[name] = sql(f"SELECT {cols} FROM {name}", name)


def _cast(cols: str, dbl=(), big=()) -> str:
    out = []
    for c in [c.strip() for c in cols.split(",") if c.strip()]:
        if c in dbl:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in big:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


_model("stg_orders", "*")
_model("stg_order_items", _cast(
    "order_item_id, order_id, user_id, product_id, inventory_item_id, status, sale_price, created_at, "
    "shipped_at, delivered_at, returned_at", dbl={"sale_price"}))
_model("stg_users", "*")
_model("stg_products", _cast(
    "product_id, product_name, brand, category, department, sku, retail_price, cost, distribution_center_id",
    dbl={"retail_price", "cost"}))
_model("stg_events", "*")
_model("stg_inventory_items", _cast(
    "inventory_item_id, product_id, cost, sold_at, created_at, product_category, product_name, product_brand, "
    "product_retail_price, product_department, product_sku, product_distribution_center_id, is_sold",
    dbl={"cost", "product_retail_price"}))
_model("stg_distribution_centers", "*")
_model("int_order_items_enriched", _cast(
    "order_item_id, order_id, user_id, product_id, distribution_center_id, order_status, order_created_at, "
    "order_shipped_at, order_delivered_at, order_returned_at, order_date, sale_price, cost, item_profit, "
    "product_name, brand, category, department, product_retail_price, user_country, user_city, "
    "user_traffic_source, user_signup_at",
    dbl={"sale_price", "cost", "item_profit", "product_retail_price"}))
_model("int_user_order_summary", _cast(
    "user_id, total_orders, total_revenue, total_profit, total_items, first_order_at, last_order_at, total_returns",
    dbl={"total_revenue", "total_profit"}))
_model("fct_orders", _cast(
    "order_id, user_id, user_country, user_city, order_status, order_date, order_created_at, shipped_at, "
    "delivered_at, returned_at, item_count, total_revenue, total_profit, line_item_count, is_first_order",
    dbl={"total_revenue", "total_profit"}, big={"line_item_count"}))
_model("dim_users", "*")
_model("dim_products", _cast(
    "product_id, product_name, brand, category, department, cost, retail_price, sku, distribution_center_id, "
    "margin_amount, margin_percentage, price_quartile, margin_tier, price_tier",
    dbl={"cost", "retail_price", "margin_amount"}))
ORACLES["dim_date_orders"] = sql("""
SELECT d.*, o.orders, o.first_orders
FROM dim_date d
JOIN (SELECT order_date AS date_key, COUNT(*) AS orders, COUNT(*) FILTER (WHERE is_first_order) AS first_orders
      FROM fct_orders GROUP BY 1) o ON d.date_key = o.date_key""", "dim_date", "fct_orders")
_model("dim_distribution_centers", "*")
_model("fct_daily_revenue", _cast(
    "order_date, total_orders, total_items, total_revenue, total_profit, unique_customers, new_customers, "
    "orders_returned, orders_cancelled, repeat_customers, avg_order_value, return_rate",
    dbl={"total_revenue", "total_profit"}))
_model("fct_monthly_revenue", _cast(
    "order_month, total_orders, total_revenue, total_profit, new_customers, active_days, prev_month_revenue, "
    "prev_year_revenue, cumulative_revenue_ytd, mom_growth_pct, yoy_growth_pct",
    dbl={"total_revenue", "total_profit", "prev_month_revenue", "prev_year_revenue", "cumulative_revenue_ytd"}))
_model("fct_geography_revenue", _cast(
    "country, order_month, total_orders, total_revenue, total_profit, unique_customers, avg_order_value, country_rank",
    dbl={"total_revenue", "total_profit"}, big={"country_rank"}))
_model("daily_revenue", _cast(
    "order_date, order_count, total_revenue, total_items_sold, avg_order_value", dbl={"total_revenue"}))
_model("fct_customer_orders", _cast(
    "user_id, first_order_at, last_order_at, customer_lifespan_days, days_since_last_order, total_orders, "
    "total_revenue, total_profit, total_items, total_returns, return_rate, avg_order_value, avg_items_per_order, "
    "customer_status, signup_cohort, age_group, country", dbl={"total_revenue", "total_profit"}))
_model("fct_rfm_scores", _cast(
    "user_id, recency_days, frequency, monetary, recency_score, frequency_score, monetary_score, rfm_code, "
    "rfm_segment", dbl={"monetary"}))
_model("fct_customer_cohorts", _cast(
    "user_id, signup_cohort, activity_month, months_since_signup, orders_in_month, items_in_month, "
    "revenue_in_month, is_active, cumulative_orders, cumulative_revenue",
    dbl={"revenue_in_month", "cumulative_revenue"}))
_model("fct_customer_active_months", _cast(
    "user_id, signup_cohort, activity_month, valid_to, months_since_signup, orders_in_month, items_in_month, "
    "revenue_in_month, cumulative_orders, cumulative_revenue", dbl={"revenue_in_month", "cumulative_revenue"}))
_model("fct_customer_retention", _cast(
    "signup_cohort, months_since_signup, cohort_size, active_customers, retention_rate, total_revenue, "
    "avg_revenue_per_active_customer, cumulative_revenue_per_customer", dbl={"total_revenue"}))
_model("fct_cohort_revenue", _cast(
    "signup_cohort, order_month, months_since_signup, total_cohort_users, active_customers, total_orders, "
    "total_revenue, cumulative_revenue_total, active_pct, avg_revenue_per_active_user, ltv_to_date",
    dbl={"total_revenue", "cumulative_revenue_total"}))
_model("fct_product_performance", _cast(
    "product_id, product_name, brand, category, department, product_retail_price, cost, total_units_sold, "
    "total_revenue, total_profit, total_orders_containing, avg_sale_price, first_sold_at, last_sold_at, "
    "units_returned, revenue_lost_to_returns, return_rate, profit_margin_pct, days_since_last_sale",
    dbl={"product_retail_price", "cost", "total_revenue", "total_profit", "revenue_lost_to_returns"}))
_model("fct_category_performance", _cast(
    "category, department, order_month, total_units_sold, total_revenue, total_profit, avg_sale_price, "
    "order_count, unique_customers, items_returned, return_rate, category_rank_by_revenue",
    dbl={"total_revenue", "total_profit"}))
_model("fct_brand_performance", _cast(
    "brand, order_month, total_units_sold, total_revenue, total_profit, avg_sale_price, order_count, "
    "unique_customers, distinct_products_sold, items_returned, return_rate, brand_rank_by_revenue",
    dbl={"total_revenue", "total_profit"}))
_model("fct_product_affinity", "*")
_model("fct_order_status", _cast(
    "order_month, order_status, order_count, item_count, revenue, pct_of_month_orders, pct_of_month_revenue, "
    "avg_order_value", dbl={"revenue"}))
_model("fct_fulfillment", _cast(
    "order_id, user_id, status, created_at, shipped_at, delivered_at, returned_at, total_revenue, item_count, "
    "processing_hours, shipping_hours, total_fulfillment_hours, is_shipped_same_day, is_delivered_within_3_days, "
    "is_delivered_within_7_days", dbl={"total_revenue"}))
_model("fct_fulfillment_summary", "*")
_model("fct_returns", _cast(
    "product_id, product_name, brand, category, department, total_orders, total_units_sold, total_revenue, "
    "returned_orders, returned_units, revenue_lost_to_returns, avg_days_to_return, return_rate",
    dbl={"total_revenue", "revenue_lost_to_returns"}))
_model("fct_distribution_center_performance", _cast(
    "distribution_center_id, order_month, items_shipped, total_revenue, unique_products, avg_processing_hours, "
    "items_returned, distribution_center_name, latitude, longitude, return_rate", dbl={"total_revenue"}))
_model("fct_sessions", "*")
_model("fct_web_funnel", "*")
_model("fct_traffic_source_performance", _cast(
    "traffic_source, event_month, total_sessions, unique_users, conversions, revenue, bounce_sessions, "
    "avg_events_per_session, conversion_rate, revenue_per_session, bounce_rate", dbl={"revenue"}))
_model("fct_browser_performance", _cast(
    "browser, event_month, total_sessions, conversions, revenue, conversion_rate, revenue_per_session",
    dbl={"revenue"}))
_model("vw_orders", _cast("order_id, order_date, user_country, order_status, revenue, item_count", dbl={"revenue"}))
_model("vw_users", _cast("user_id, country, city, age, gender, total_orders, first_order_at, lifetime_revenue",
                         dbl={"lifetime_revenue"}, big={"total_orders"}))
_model("vw_daily_revenue", _cast("order_date, daily_revenue, order_count, avg_order_value", dbl={"daily_revenue"}))

# --- metric queries ----------------------------------------------------------
from cartwheel.oracle.duckdb_sql import avg_exact, sdiv  # noqa: E402


def _daily(lo: str, hi: str) -> str:
    return sql(f"""
SELECT order_date AS date, CAST(SUM(daily_revenue) AS DOUBLE) AS total_revenue,
       CAST(SUM(order_count) AS BIGINT) AS total_orders
FROM vw_daily_revenue WHERE order_date BETWEEN DATE '{lo}' AND DATE '{hi}'
GROUP BY 1""", "vw_daily_revenue")


ORACLES["metric_daily_revenue"] = _daily("2025-12-01", "2025-12-30")
ORACLES["metric_daily_revenue_365"] = _daily("2024-12-31", "2025-12-30")
ORACLES["metric_revenue_by_country"] = sql("""
SELECT user_country AS country, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, COUNT(*) AS count
FROM vw_orders GROUP BY 1 ORDER BY SUM(revenue) DESC NULLS LAST, country ASC NULLS FIRST LIMIT 20""", "vw_orders")
ORACLES["metric_order_totals"] = sql(f"""
SELECT COUNT(*) AS count, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, {avg_exact('revenue')} AS avg_order_value
FROM vw_orders""", "vw_orders")
ORACLES["metric_user_totals"] = sql("""
SELECT COUNT(*) AS count, CAST(SUM(total_orders) AS BIGINT) AS total_orders_placed FROM vw_users""", "vw_users")
ORACLES["metric_orders_by_status"] = sql("""
SELECT order_status AS status, COUNT(*) AS count, CAST(SUM(revenue) AS DOUBLE) AS total_revenue
FROM vw_orders GROUP BY 1 ORDER BY count DESC, status ASC NULLS FIRST LIMIT 100""", "vw_orders")
ORACLES["metric_time_grain"] = sql(f"""
SELECT order_status AS status, CAST(date_trunc('quarter', order_date) AS DATE) AS order_date,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue, COUNT(*) AS count, {avg_exact('revenue')} AS avg_order_value
FROM vw_orders WHERE order_date BETWEEN DATE '2021-01-01' AND DATE '2024-12-31'
GROUP BY 1, 2""", "vw_orders")
ORACLES["metric_filtered"] = sql("""
SELECT * FROM (
  SELECT user_country AS country, COUNT(*) AS count, CAST(SUM(revenue) AS DOUBLE) AS total_revenue
  FROM vw_orders WHERE order_status IN ('Complete', 'Shipped') AND (user_country <> 'CHINA' OR user_country IS NULL)
  GROUP BY 1) t WHERE count > 100""", "vw_orders")

ORACLES["metric_users_by_first_order"] = sql("""
SELECT country, COUNT(*) AS count, CAST(SUM(total_orders) AS BIGINT) AS total_orders_placed FROM vw_users
WHERE first_order_at >= TIMESTAMP '2019-01-01' AND first_order_at < TIMESTAMP '2020-07-01' GROUP BY country""", "vw_users")
ORACLES["metric_dimensions_only"] = sql("""
SELECT DISTINCT user_country AS country, order_status AS status FROM vw_orders""", "vw_orders")
ORACLES["metric_ordered_by_unselected"] = sql(f"""
SELECT country, count FROM (
  SELECT user_country AS country, COUNT(*) AS count, {avg_exact('revenue')} AS mean FROM vw_orders GROUP BY 1
) ORDER BY mean DESC NULLS LAST, country ASC NULLS FIRST LIMIT 10""", "vw_orders")
ORACLES["metric_year_to_date"] = sql("""
SELECT order_status AS status, COUNT(*) AS count, CAST(SUM(revenue) AS DOUBLE) AS total_revenue
FROM vw_orders WHERE year(order_date) = 2025 GROUP BY 1""", "vw_orders")
ORACLES["metric_last_month"] = sql("""
SELECT order_date AS date, CAST(SUM(daily_revenue) AS DOUBLE) AS total_revenue, CAST(SUM(order_count) AS BIGINT) AS total_orders
FROM vw_daily_revenue WHERE strftime(order_date, '%Y-%m') = '2025-05' GROUP BY 1""", "vw_daily_revenue")
ORACLES["ordered_category_top20"] = sql("""
SELECT category, department, order_month, CAST(total_revenue AS DOUBLE) AS total_revenue FROM fct_category_performance
ORDER BY order_month DESC NULLS LAST, fct_category_performance.total_revenue DESC NULLS LAST, category, department LIMIT 20""",
                                        "fct_category_performance")

# --- ad-hoc analyses ---------------------------------------------------------
ORACLES["topk_products_by_return_rate"] = sql("""
SELECT product_name, return_rate, total_units_sold FROM fct_product_performance WHERE total_units_sold > 10
ORDER BY return_rate DESC NULLS LAST, product_id LIMIT 10""", "fct_product_performance")
ORACLES["champions_list"] = sql("""
SELECT user_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, rfm_segment FROM fct_rfm_scores
WHERE rfm_segment = 'Champions' ORDER BY user_id LIMIT 100""", "fct_rfm_scores")
ORACLES["monthly_growth_last_12"] = sql("""
SELECT order_month, CAST(total_revenue AS DOUBLE) AS total_revenue, mom_growth_pct, yoy_growth_pct
FROM fct_monthly_revenue ORDER BY order_month DESC LIMIT 12""", "fct_monthly_revenue")
ORACLES["latest_month_revenue"] = sql("""
SELECT order_month, CAST(total_revenue AS DOUBLE) AS total_revenue FROM fct_monthly_revenue
ORDER BY order_month DESC LIMIT 1""", "fct_monthly_revenue")
ORACLES["purchase_rate_by_source"] = sql(f"""
SELECT *, {sdiv('sessions_with_purchase', 'total_sessions')} AS purchase_rate FROM (
  SELECT traffic_source, CAST(SUM(total_sessions) AS BIGINT) AS total_sessions,
         CAST(SUM(sessions_with_purchase) AS BIGINT) AS sessions_with_purchase
  FROM fct_web_funnel GROUP BY 1) t""", "fct_web_funnel")
ORACLES["brands_over_10k"] = sql("""
SELECT brand, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue FROM fct_brand_performance
GROUP BY brand HAVING SUM(total_revenue) > 10000""", "fct_brand_performance")


def _cat_sales(lo: str, hi: str) -> str:
    return f"""SELECT category, CAST(SUM(sale_price) AS DOUBLE) AS total_sales, COUNT(*) AS units_sold
FROM int_order_items_enriched WHERE order_date BETWEEN DATE '{lo}' AND DATE '{hi}' GROUP BY category"""


ORACLES["category_sales_last_30_days"] = sql(_cat_sales("2025-12-01", "2025-12-30"), "int_order_items_enriched")
ORACLES["category_sales_last_365_days"] = sql(_cat_sales("2024-12-31", "2025-12-30"), "int_order_items_enriched")
ORACLES["top8_categories"] = sql(
    "SELECT * FROM (" + _cat_sales("2024-12-31", "2025-12-30") + ") s ORDER BY total_sales DESC NULLS LAST, category LIMIT 8",
    "int_order_items_enriched")
ORACLES["cohort_retention_lookup"] = sql("""
SELECT signup_cohort, months_since_signup, cohort_size, active_customers, retention_rate,
       CAST(total_revenue AS DOUBLE) AS total_revenue, avg_revenue_per_active_customer, cumulative_revenue_per_customer
FROM fct_customer_retention WHERE signup_cohort = '2020-01'""", "fct_customer_retention")
ORACLES["segment_summary"] = sql(f"""
SELECT rfm_segment, COUNT(*) AS customers, {avg_exact('recency_days')} AS avg_recency_days,
       {avg_exact('frequency')} AS avg_frequency, {avg_exact('monetary')} AS avg_monetary,
       CAST(SUM(monetary) AS DOUBLE) AS total_monetary
FROM fct_rfm_scores GROUP BY 1""", "fct_rfm_scores")
ORACLES["top_customers"] = sql("""
SELECT user_id, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, avg_order_value, customer_status
FROM fct_customer_orders ORDER BY total_revenue DESC NULLS LAST, user_id LIMIT 10""", "fct_customer_orders")
ORACLES["kpi_summary"] = sql(f"""
SELECT *, CASE WHEN COALESCE(total_orders, 0) > 0 THEN {sdiv('total_revenue', 'total_orders')} ELSE 0.0 END AS avg_order_value
FROM (
  SELECT CAST(SUM(tr) AS DOUBLE) AS total_revenue, CAST(SUM(tor) AS BIGINT) AS total_orders,
         CAST(MAX(tr) AS DOUBLE) AS max_daily_revenue, CAST(MIN(tr) AS DOUBLE) AS min_daily_revenue,
         {avg_exact('tr')} AS avg_daily_revenue, COUNT(*) AS days_of_data
  FROM (SELECT order_date, SUM(daily_revenue) AS tr, SUM(order_count) AS tor FROM vw_daily_revenue
        WHERE order_date BETWEEN DATE '2024-12-31' AND DATE '2025-12-30' GROUP BY 1) d
) k""", "vw_daily_revenue")
ORACLES["sql_adhoc_monthly_by_status"] = sql("""
SELECT order_month, order_status, order_count, CAST(revenue AS DOUBLE) AS revenue FROM fct_order_status
WHERE order_status IN ('Complete', 'Returned')""", "fct_order_status")

# --- data-quality checks -----------------------------------------------------
# The declared checks, written from the schema files one by one (n not_null,
# u unique), with the number of checks of each file; a test holds this list against the engine's.
DECLARED = {
    "staging": (21, """
        stg_orders order_id:nu user_id:n status:accepted
        stg_order_items order_item_id:nu order_id:n order_id:parent user_id:n product_id:n sale_price:n
        stg_users user_id:nu
        stg_products product_id:nu
        stg_events event_id:nu
        stg_inventory_items inventory_item_id:nu
        stg_distribution_centers distribution_center_id:nu"""),
    "intermediate": (5, """
        int_order_items_enriched order_item_id:nu order_id:n
        int_user_order_summary user_id:nu"""),
    "core": (7, """
        fct_orders order_id:nu user_id:n
        dim_users user_id:nu
        dim_products product_id:nu"""),
    "customers": (9, """
        fct_customer_orders user_id:nu customer_status:accepted
        fct_rfm_scores user_id:nu
        fct_customer_cohorts user_id:n activity_month:n
        fct_customer_retention signup_cohort:n months_since_signup:n"""),
    "products": (5, """
        fct_product_performance product_id:nu
        fct_category_performance category:n order_month:n
        fct_product_affinity product_name_a:n"""),
    "revenue": (7, """
        fct_daily_revenue order_date:nu
        fct_monthly_revenue order_month:nu
        fct_cohort_revenue signup_cohort:n order_month:n
        fct_geography_revenue country:n"""),
    "metrics": (2, """
        daily_revenue order_date:nu"""),
    "operations": (9, """
        fct_order_status order_month:n order_status:n
        fct_fulfillment order_id:nu
        fct_fulfillment_summary order_month:nu
        fct_returns product_id:nu
        fct_distribution_center_performance distribution_center_id:n"""),
    "web": (5, """
        fct_sessions session_id:nu
        fct_web_funnel event_date:n
        fct_traffic_source_performance traffic_source:n
        fct_browser_performance browser:n"""),
    "semantic": (6, """
        vw_orders order_id:nu
        vw_daily_revenue order_date:nu
        vw_users user_id:nu"""),
}
ACCEPTED = {"stg_orders.status": ["Shipped", "Complete", "Returned", "Cancelled", "Processing"],
            "fct_customer_orders.customer_status": ["New", "Repeat", "Loyal"]}
PARENTS = {"stg_order_items.order_id": ("stg_orders", "order_id")}


def declared() -> list[tuple]:
    """(model, column, test, argument) of every declared check."""
    out = []
    for count, text in DECLARED.values():
        before = len(out)
        for line in text.split("\n")[1:]:
            model, *columns = line.split()
            for column, tests in (c.split(":") for c in columns):
                name = f"{model}.{column}"
                if tests == "accepted":
                    out.append((model, column, "accepted_values", ACCEPTED[name]))
                elif tests == "parent":
                    out.append((model, column, "relationships", PARENTS[name]))
                else:
                    out += [(model, column, {"n": "not_null", "u": "unique"}[t], None) for t in tests]
        if len(out) - before != count:
            raise ValueError(f"{len(out) - before} checks listed, {count} declared: {text}")
    return out


def _check_sql(model: str, col: str, test: str, arg) -> str:
    head = f"SELECT '{model}' AS model, '{col}' AS column_name, '{test}' AS test, CAST("
    if test == "not_null":
        return head + f"COUNT(*) AS BIGINT) AS failures FROM {model} WHERE {col} IS NULL"
    if test == "unique":
        return head + (f"COUNT(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
                       f"GROUP BY {col} HAVING COUNT(*) > 1) d")
    if test == "accepted_values":
        vals = ", ".join("'" + v + "'" for v in arg)
        return head + f"COUNT(DISTINCT {col}) AS BIGINT) AS failures FROM {model} WHERE {col} NOT IN ({vals})"
    parent, pcol = arg
    return head + (f"COUNT(*) AS BIGINT) AS failures FROM {model} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")


def _checks_sql(checks) -> str:
    models = sorted({c[0] for c in checks} | {c[3][0] for c in checks if c[2] == "relationships"})
    return sql("\nUNION ALL\n".join(_check_sql(*c) for c in checks), *models)


for _test in ("not_null", "unique", "accepted_values", "relationships"):
    ORACLES[f"dq_{_test}"] = _checks_sql([c for c in declared() if c[2] == _test])
ORACLES["dq_report"] = _checks_sql(declared())

# --- primitive-level keys ----------------------------------------------------
from cartwheel.oracle.duckdb_sql import AS_OF, product_affinity_sql  # noqa: E402

ORACLES["join_left_equi"] = sql("""
SELECT oi.order_item_id, oi.order_id, o.status AS order_status, o.created_at AS order_created_at
FROM stg_order_items oi LEFT JOIN stg_orders o ON oi.order_id = o.order_id""", "stg_order_items", "stg_orders")
ORACLES["join_inner_equi"] = sql("""
SELECT p.product_id, p.distribution_center_id, d.distribution_center_name
FROM stg_products p JOIN stg_distribution_centers d ON p.distribution_center_id = d.distribution_center_id""",
                                 "stg_products", "stg_distribution_centers")
_GRID = f"""
SELECT u.user_id, m.activity_month
FROM dim_users u
CROSS JOIN (SELECT DISTINCT CAST(date_trunc('month', date_key) AS DATE) AS activity_month FROM dim_date) m
WHERE m.activity_month >= CAST(date_trunc('month', u.created_at) AS DATE)
  AND m.activity_month <= CAST(date_trunc('month', {AS_OF}) AS DATE) AND u.user_id IS NOT NULL"""
ORACLES["join_cross_range"] = sql(_GRID, "dim_users", "dim_date")
ORACLES["join_left_composite"] = sql(f"""
SELECT g.user_id, g.activity_month, CAST(COALESCE(o.n, 0) AS BIGINT) AS orders_in_month
FROM ({_GRID}) g
LEFT JOIN (SELECT user_id, CAST(date_trunc('month', order_created_at) AS DATE) AS m, COUNT(*) AS n
           FROM fct_orders GROUP BY 1, 2) o ON g.user_id = o.user_id AND g.activity_month = o.m""",
                                     "dim_users", "dim_date", "fct_orders")
ORACLES["join_left_on_date_expr"] = sql("""
SELECT s.session_id, s.user_id, CAST(COUNT(o.order_id) AS BIGINT) AS same_day_orders,
       CAST(COALESCE(SUM(o.total_revenue), 0) AS DOUBLE) AS same_day_revenue
FROM fct_sessions s
LEFT JOIN fct_orders o ON s.user_id = o.user_id AND CAST(s.session_start_at AS DATE) = CAST(o.order_created_at AS DATE)
GROUP BY s.session_id, s.user_id""", "fct_sessions", "fct_orders")
ORACLES["join_self_pairs"] = sql("SELECT * FROM (" + product_affinity_sql(2) + ") x", "stg_order_items", "stg_products")
ORACLES["join_cross_scalar"] = sql(f"""
SELECT g.product_id, CAST(g.revenue AS DOUBLE) AS revenue, {sdiv('g.revenue', 't.total')} AS revenue_share
FROM (SELECT product_id, SUM(sale_price) AS revenue FROM int_order_items_enriched GROUP BY 1) g
CROSS JOIN (SELECT SUM(sale_price) AS total FROM int_order_items_enriched) t""", "int_order_items_enriched")
ORACLES["agg_count_distinct_multi"] = sql("""
SELECT brand, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT user_id) AS customers,
       COUNT(DISTINCT product_id) AS products FROM int_order_items_enriched GROUP BY 1""", "int_order_items_enriched")
ORACLES["agg_conditional_distinct"] = sql("""
SELECT order_date, COUNT(DISTINCT user_id) AS unique_customers,
       COUNT(DISTINCT CASE WHEN is_first_order THEN user_id END) AS new_customers FROM fct_orders GROUP BY 1""", "fct_orders")
ORACLES["agg_countif"] = sql("""
SELECT date_trunc('month', order_created_at) AS order_month,
       COUNT(*) FILTER (WHERE order_status = 'Returned') AS returned,
       COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled,
       COUNT(*) FILTER (WHERE shipped_at IS NOT NULL) AS shipped,
       COUNT(*) FILTER (WHERE order_status IN ('Complete', 'Shipped')) AS open_or_done
FROM fct_orders GROUP BY 1""", "fct_orders")
ORACLES["agg_conditional_sum_avg"] = sql(f"""
SELECT product_id, CAST(SUM(CASE WHEN order_status = 'Returned' THEN sale_price ELSE 0 END) AS DOUBLE) AS revenue_lost_to_returns,
       {avg_exact("CASE WHEN order_status = 'Returned' THEN date_sub('day', order_delivered_at, order_returned_at) END")} AS avg_days_to_return
FROM int_order_items_enriched GROUP BY 1""", "int_order_items_enriched")
ORACLES["win_row_number_first"] = sql("""
SELECT order_id, user_id, created_at,
       row_number() OVER (PARTITION BY user_id ORDER BY created_at ASC NULLS FIRST, order_id) = 1 AS is_first_order
FROM stg_orders""", "stg_orders")
ORACLES["win_ntile_global"] = sql("""
SELECT user_id, CAST(total_revenue AS DOUBLE) AS total_revenue, last_order_at,
       CAST(ntile(4) OVER (ORDER BY total_revenue ASC NULLS FIRST, user_id ASC NULLS FIRST) AS BIGINT) AS revenue_quartile,
       CAST(ntile(7) OVER (ORDER BY last_order_at DESC NULLS LAST, user_id ASC NULLS FIRST) AS BIGINT) AS recency_septile
FROM int_user_order_summary""", "int_user_order_summary")
ORACLES["win_rank_partitioned"] = sql("""
SELECT brand, order_month, CAST(total_revenue AS DOUBLE) AS total_revenue, brand_rank_by_revenue
FROM fct_brand_performance""", "fct_brand_performance")
ORACLES["win_lag"] = sql("""
SELECT order_month, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(prev_month_revenue AS DOUBLE) AS prev_month_revenue,
       CAST(prev_year_revenue AS DOUBLE) AS prev_year_revenue FROM fct_monthly_revenue""", "fct_monthly_revenue")
ORACLES["win_running_sum_rows"] = sql("""
SELECT order_month, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(cumulative_revenue_ytd AS DOUBLE) AS cumulative_revenue_ytd
FROM fct_monthly_revenue""", "fct_monthly_revenue")
ORACLES["win_running_sum_partition"] = sql("""
SELECT user_id, activity_month, orders_in_month, cumulative_orders FROM fct_customer_cohorts""", "fct_customer_cohorts")
ORACLES["fn_safe_divide"] = sql(f"""
SELECT product_id, returned_units, total_orders, {sdiv('returned_units', 'total_orders')} AS ratio,
       {sdiv('returned_units', 'returned_units - returned_units')} AS by_zero FROM fct_returns""", "fct_returns")
ORACLES["fn_numeric"] = sql("""
SELECT product_id, raw, CAST(TRY_CAST(raw AS DECIMAL(30,4)) AS DOUBLE) AS value FROM (
  SELECT product_id, CASE product_id % 3 WHEN 0 THEN sku WHEN 1 THEN substr(sku, 5) ELSE CAST(retail_price AS VARCHAR) || '0' END AS raw
  FROM stg_products)""", "stg_products")
ORACLES["fn_date_trunc"] = sql("""
SELECT order_id, date_trunc('month', order_created_at) AS month_ts, date_trunc('quarter', order_created_at) AS quarter_ts,
       CAST(date_trunc('month', order_date) AS DATE) AS month_date, CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_date
FROM fct_orders""", "fct_orders")
ORACLES["fn_date_diff"] = sql(f"""
SELECT user_id, CAST(date_diff('day', CAST(created_at AS DATE), {AS_OF}) AS BIGINT) AS days,
       CAST(date_diff('month', CAST(created_at AS DATE), {AS_OF}) AS BIGINT) AS months FROM dim_users""", "dim_users")
ORACLES["fn_timestamp_diff"] = sql("""
SELECT order_id, CAST(date_sub('hour', created_at, delivered_at) AS BIGINT) AS hours,
       CAST(date_sub('day', created_at, delivered_at) AS BIGINT) AS days,
       CAST(date_sub('second', created_at, shipped_at) AS BIGINT) AS seconds,
       CAST(date_sub('hour', delivered_at, created_at) AS BIGINT) AS negative_hours FROM stg_orders""", "stg_orders")
ORACLES["fn_calendar"] = sql("""
SELECT order_id, CAST(dayofweek(order_date) + 1 AS BIGINT) AS day_of_week, CAST(strftime(order_date, '%U') AS BIGINT) AS week_of_year,
       CAST(month(order_date) AS BIGINT) AS month_number, CAST(quarter(order_date) AS BIGINT) AS quarter,
       CAST(year(order_date) AS BIGINT) AS year, strftime(order_date, '%A') AS day_name, strftime(order_date, '%B') AS month_name
FROM fct_orders""", "fct_orders")

# --- documented-only metrics -------------------------------------------------
ORACLES["repeat_customer_rate"] = sql(f"""
SELECT *, {sdiv('repeat_customers', 'customers')} AS repeat_customer_rate FROM (
  SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE total_orders > 1) AS repeat_customers
  FROM fct_customer_orders) t""", "fct_customer_orders")
ORACLES["cart_abandonment"] = sql(f"""
SELECT event_date, traffic_source, sessions_with_cart, sessions_with_purchase,
       1.0 - {sdiv('sessions_with_purchase', 'sessions_with_cart')} AS cart_abandonment_rate
FROM fct_web_funnel""", "fct_web_funnel")
ORACLES["on_time_delivery_rate"] = sql("""
SELECT order_month, orders_delivered, delivered_7_days, pct_delivered_within_7_days AS on_time_delivery_rate
FROM fct_fulfillment_summary""", "fct_fulfillment_summary")
ORACLES["cohort_churn"] = sql(f"""
SELECT signup_cohort, months_since_signup, cohort_size, active_customers,
       cohort_size - active_customers AS churned_customers,
       {sdiv('cohort_size - active_customers', 'cohort_size')} AS churn_rate
FROM fct_customer_retention""", "fct_customer_retention")
