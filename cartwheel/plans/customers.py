"""Customer marts (CUS1-CUS4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions import day_diff, month_diff, safe_divide
from cartwheel.operators.calendar import SPINE_START, month_grid, month_of, spine_end
from cartwheel.operators import quantiles, ranking
from cartwheel.plans.context import model


def customer_status(total_orders):
    """New (1 order), Repeat (2-5), else Loyal -- NULL and 0 fall to Loyal as in the reference."""
    return F.when(total_orders == 1, "New").when(total_orders.between(2, 5), "Repeat").otherwise("Loyal")


@model("fct_customer_orders", "customers")
def fct_customer_orders(ctx):
    s = ctx.ref("int_user_order_summary")
    u = ctx.ref("dim_users").select(F.col("user_id").alias("_u_id"), "signup_cohort", "age_group", "country")
    j = s.join(u, s["user_id"] == u["_u_id"], "left")
    as_of = F.lit(ctx.as_of).cast("date")
    status = customer_status(F.col("total_orders"))
    return j.select(
        F.col("_u_id").alias("user_id"), "first_order_at", "last_order_at",
        day_diff(F.to_date("last_order_at"), F.to_date("first_order_at")).alias("customer_lifespan_days"),
        day_diff(as_of, F.to_date("last_order_at")).alias("days_since_last_order"),
        "total_orders", "total_revenue", "total_profit", "total_items", "total_returns",
        safe_divide("total_returns", "total_orders").alias("return_rate"),
        safe_divide("total_revenue", "total_orders").alias("avg_order_value"),
        safe_divide("total_items", "total_orders").alias("avg_items_per_order"),
        status.alias("customer_status"), "signup_cohort", "age_group", "country")


# RFM segments, first match wins (order matters).
RFM_SEGMENTS = [
    ("Champions", lambda r, f, m: (r >= 4) & (f >= 4) & (m >= 4)),
    ("Loyal Customers", lambda r, f, m: (r >= 3) & (f >= 4) & (m >= 3)),
    ("Potential Loyalists", lambda r, f, m: (r >= 4) & (f >= 2) & (m >= 2)),
    ("Recent Customers", lambda r, f, m: (r >= 4) & (f == 1)),
    ("Promising", lambda r, f, m: (r >= 3) & (f == 1)),
    ("Needs Attention", lambda r, f, m: (r >= 2) & (f >= 2)),
    ("Can't Lose", lambda r, f, m: (r <= 2) & (f >= 4)),
    ("At Risk", lambda r, f, m: (r <= 2) & (f >= 2)),
]
RFM_ELSE = "Lost"


def rfm_segment(r, f, m):
    out = None
    for label, pred in RFM_SEGMENTS:
        cond = pred(r, f, m)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(RFM_ELSE)


#: What the ranking of the RFM scores gives; the other columns are the summary's.
SCORE_COLS = ["recency_score", "frequency_score", "monetary_score", "rfm_code", "rfm_segment"]


@model("fct_rfm_scores", "customers")
def fct_rfm_scores(ctx):
    """Three global quintiles together, without a single-task window.

    Over the stored summary (a build) they come from the quintiles' edges, which reads its narrow
    columns a few times and moves no row; a summary that is still to be computed is ranked, which computes it once.
    """
    return rfm_scores(ctx, quantiles.ntiles if "int_user_order_summary" in ctx.materialized else ranking.ntiles)


def rfm_scores(ctx, ntiles):
    """The scores by either way; by edges the plan is lazy, so Spark leaves the scores out where nobody reads them."""
    s = ctx.ref("int_user_order_summary")
    as_of = F.lit(ctx.as_of).cast("date")
    base = s.select("user_id", day_diff(as_of, F.to_date("last_order_at")).alias("recency_days"),
                    F.col("total_orders").alias("frequency"), F.col("total_revenue").alias("monetary"))
    scored = ntiles(base, "user_id", [("recency_days", 5, True, "recency_score"), ("frequency", 5, False, "frequency_score"),
                                      ("monetary", 5, False, "monetary_score")])
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return scored.select(
        "user_id", "recency_days", "frequency", "monetary", "recency_score", "frequency_score", "monetary_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_code"),
        rfm_segment(r, f, m).alias("rfm_segment"))


def _cohort_members(ctx):
    """Users with their cohort and the first and last month of their grid; without a signup there is none."""
    u = ctx.ref("dim_users").where(F.col("user_id").isNotNull() & F.col("created_at").isNotNull())
    signup_month = F.trunc(F.to_date("created_at"), "month")
    first = F.greatest(signup_month, month_of(ctx.param("spine_start", SPINE_START)))
    last = F.least(month_of(ctx.as_of), month_of(spine_end(ctx)))
    return u.select("user_id", "signup_cohort", signup_month.alias("_signup_month"), first.alias("_first"), last.alias("_last"))


def _orders_by_month(ctx):
    return ctx.ref("fct_orders").groupBy(
        F.col("user_id").alias("_o_user"),
        F.trunc(F.to_date("order_created_at"), "month").alias("_o_month")).agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("item_count").alias("_items"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("_revenue"))


@model("fct_customer_cohorts", "customers")
def fct_customer_cohorts(ctx):
    """User x month activity grid from the signup month to the as-of month.

    Instead of a cross join of users and months with a range filter, each user
    row explodes its own month range (at most the spine's 96 months).  Users
    are hash-partitioned by user_id *before* the explode, so the grid -- the
    largest frame here -- is generated in place and never shuffled.  The
    monthly order aggregate (combined map-side: a user with a huge share of
    orders still brings at most one row per month) is partitioned the same
    way and joined on (user_id, month), which keeps the user_id partitioning
    (spark.sql.requireAllClusterKeysForCoPartition is off); the running sums
    reuse it, so the whole model costs two shuffles of small inputs.  The
    window is also partitioned by signup_cohort (one per user), so a filter on
    the cohort reaches the users below the grid.

    A user is a few bytes in the exchange and up to 96 rows in the grid, so the number of partitions is
    fixed to ``spark.sql.shuffle.partitions``: merged by their bytes, a task would sort millions of grid rows.
    """
    parts = int(ctx.spark.conf.get("spark.sql.shuffle.partitions"))
    users = _cohort_members(ctx).repartition(parts, "user_id")
    grid = users.select("user_id", "signup_cohort", "_signup_month",
                        F.explode(month_grid(F.col("_first"), F.col("_last"))).alias("activity_month"))
    orders = _orders_by_month(ctx).repartition(parts, "_o_user").hint("merge")
    j = grid.join(orders, (grid["user_id"] == orders["_o_user"]) & (grid["activity_month"] == orders["_o_month"]), "left")
    n_orders = F.coalesce(F.col("_orders"), F.lit(0))
    joined = j.select(
        "user_id", "signup_cohort", "activity_month",
        month_diff("activity_month", "_signup_month").alias("months_since_signup"),
        n_orders.alias("orders_in_month"), F.coalesce(F.col("_items"), F.lit(0)).alias("items_in_month"),
        F.coalesce(F.col("_revenue"), F.lit(0)).alias("revenue_in_month"), (n_orders > 0).alias("is_active"))
    w = Window.partitionBy("user_id", "signup_cohort").orderBy("activity_month").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select("*", F.sum("orders_in_month").over(w).alias("cumulative_orders"),
                         F.sum("revenue_in_month").over(w).alias("cumulative_revenue"))


@model("fct_customer_active_months", "customers")
def fct_customer_active_months(ctx):
    """The cohort grid in sparse form: one row per user and month with orders.

    A row's cumulative values hold from ``activity_month`` to ``valid_to``, the month before the user's
    next active one (the end of the grid for the last); months before a user's first row are zero.
    Orders outside the user's grid are left out, as the grid leaves them out.
    """
    users, orders = _cohort_members(ctx), _orders_by_month(ctx)
    active = users.join(orders, (F.col("user_id") == F.col("_o_user")) & F.col("_o_month").between(F.col("_first"), F.col("_last")))
    by_month = Window.partitionBy("user_id", "signup_cohort").orderBy("_o_month")
    up_to = by_month.rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead("_o_month").over(by_month)
    return active.select(
        "user_id", "signup_cohort", F.col("_o_month").alias("activity_month"),
        F.coalesce(F.add_months(following, -1), F.col("_last")).alias("valid_to"),
        month_diff("_o_month", "_signup_month").alias("months_since_signup"), F.col("_orders").alias("orders_in_month"),
        F.coalesce(F.col("_items"), F.lit(0)).alias("items_in_month"), F.col("_revenue").alias("revenue_in_month"),
        F.sum("_orders").over(up_to).alias("cumulative_orders"), F.sum("_revenue").over(up_to).alias("cumulative_revenue"))


def cohort_months(ctx):
    """Cohort x month totals of the grid, from the sparse rows alone.

    The members of a cohort share their months, so its size is the same in each, and what its members
    have spent up to a month is the running sum of what the cohort spent.  The rows that are laid
    out are one per cohort and month (bounded by the calendar), not one per user and month.
    """
    sizes = _cohort_members(ctx).groupBy("signup_cohort", "_signup_month", "_first", "_last").agg(F.count("user_id").alias("users"))
    grid = sizes.select("signup_cohort", "_signup_month", "users", F.explode(month_grid(F.col("_first"), F.col("_last"))).alias("activity_month"))
    active = ctx.ref("fct_customer_active_months").groupBy(
        F.col("signup_cohort").alias("_cohort"), F.col("activity_month").alias("_month")).agg(
        F.count(F.lit(1)).alias("_active"), F.sum("orders_in_month").alias("_orders"), F.sum("revenue_in_month").alias("_revenue"))
    j = grid.join(active, (F.col("signup_cohort") == F.col("_cohort")) & (F.col("activity_month") == F.col("_month")), "left")
    revenue = F.coalesce(F.col("_revenue"), F.lit(0))
    so_far = Window.partitionBy("signup_cohort").orderBy("activity_month").rowsBetween(Window.unboundedPreceding, 0)
    return j.select(
        "signup_cohort", "activity_month", month_diff("activity_month", "_signup_month").alias("months_since_signup"),
        "users", F.coalesce(F.col("_active"), F.lit(0)).alias("active"), F.coalesce(F.col("_orders"), F.lit(0)).alias("orders"),
        revenue.alias("revenue"), F.sum(revenue).over(so_far).alias("cumulative_revenue"))


@model("fct_customer_retention", "customers")
def fct_customer_retention(ctx):
    c = cohort_months(ctx).select(
        "signup_cohort", "months_since_signup", F.col("users").alias("cohort_size"), F.col("active").alias("active_customers"),
        F.col("revenue").alias("total_revenue"), "cumulative_revenue")
    return c.select(
        "signup_cohort", "months_since_signup", "cohort_size", "active_customers",
        safe_divide("active_customers", "cohort_size").alias("retention_rate"), "total_revenue",
        safe_divide("total_revenue", "active_customers").alias("avg_revenue_per_active_customer"),
        safe_divide("cumulative_revenue", "cohort_size").alias("cumulative_revenue_per_customer"))
