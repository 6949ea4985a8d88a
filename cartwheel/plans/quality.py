"""Data-quality checks (DQ1-DQ5): the declared column tests, run as Spark jobs.

Failure counts follow the usual test semantics: not_null counts NULL rows;
unique counts values that occur more than once; accepted_values counts
distinct non-NULL values outside the list; relationships counts child rows
whose non-NULL key has no parent.  Per model the not_null and unique checks are one
keyed count (map-side combined) summed up; accepted_values is one more
aggregate, relationships a left-anti join of the counted keys.  The jobs of a report count a
text key by a short hash first and by its value only where a hash repeats.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartwheel.operators import quantiles
from cartwheel.plans.customers import SCORE_COLS, rfm_scores
from cartwheel.plans.intermediate import HAS_ID, INT1, ITEM_COLS, JOINED_ITEMS, KEPT_COLS, enriched_items, item_rows, items_with_orders
from cartwheel.plans.scheduler import THREADS, require_done, run_graph
from cartwheel.plans.staging import events
from cartwheel.session import checkpoint_dir

# The declared column tests, (model, column, test, argument).
ORDER_STATUSES = ["Shipped", "Complete", "Returned", "Cancelled", "Processing"]
CUSTOMER_STATUSES = ["New", "Repeat", "Loyal"]

CHECKS = [
    ("stg_orders", "order_id", "not_null", None), ("stg_orders", "order_id", "unique", None),
    ("stg_orders", "user_id", "not_null", None),
    ("stg_orders", "status", "accepted_values", ORDER_STATUSES),
    ("stg_order_items", "order_item_id", "not_null", None), ("stg_order_items", "order_item_id", "unique", None),
    ("stg_order_items", "order_id", "not_null", None),
    ("stg_order_items", "order_id", "relationships", ("stg_orders", "order_id")),
    ("stg_order_items", "user_id", "not_null", None), ("stg_order_items", "product_id", "not_null", None),
    ("stg_order_items", "sale_price", "not_null", None),
    ("stg_users", "user_id", "not_null", None), ("stg_users", "user_id", "unique", None),
    ("stg_products", "product_id", "not_null", None), ("stg_products", "product_id", "unique", None),
    ("stg_events", "event_id", "unique", None), ("stg_events", "event_id", "not_null", None),
    ("stg_inventory_items", "inventory_item_id", "unique", None),
    ("stg_inventory_items", "inventory_item_id", "not_null", None),
    ("stg_distribution_centers", "distribution_center_id", "unique", None),
    ("stg_distribution_centers", "distribution_center_id", "not_null", None),
    ("int_order_items_enriched", "order_item_id", "unique", None),
    ("int_order_items_enriched", "order_item_id", "not_null", None),
    ("int_order_items_enriched", "order_id", "not_null", None),
    ("int_user_order_summary", "user_id", "unique", None), ("int_user_order_summary", "user_id", "not_null", None),
    ("fct_orders", "order_id", "not_null", None), ("fct_orders", "order_id", "unique", None),
    ("fct_orders", "user_id", "not_null", None),
    ("dim_users", "user_id", "not_null", None), ("dim_users", "user_id", "unique", None),
    ("dim_products", "product_id", "not_null", None), ("dim_products", "product_id", "unique", None),
    ("fct_customer_orders", "user_id", "unique", None), ("fct_customer_orders", "user_id", "not_null", None),
    ("fct_customer_orders", "customer_status", "accepted_values", CUSTOMER_STATUSES),
    ("fct_rfm_scores", "user_id", "unique", None), ("fct_rfm_scores", "user_id", "not_null", None),
    ("fct_customer_cohorts", "user_id", "not_null", None), ("fct_customer_cohorts", "activity_month", "not_null", None),
    ("fct_customer_retention", "signup_cohort", "not_null", None),
    ("fct_customer_retention", "months_since_signup", "not_null", None),
    ("fct_product_performance", "product_id", "unique", None),
    ("fct_product_performance", "product_id", "not_null", None),
    ("fct_category_performance", "category", "not_null", None),
    ("fct_category_performance", "order_month", "not_null", None),
    ("fct_product_affinity", "product_name_a", "not_null", None),
    ("fct_daily_revenue", "order_date", "unique", None), ("fct_daily_revenue", "order_date", "not_null", None),
    ("fct_monthly_revenue", "order_month", "unique", None), ("fct_monthly_revenue", "order_month", "not_null", None),
    ("fct_cohort_revenue", "signup_cohort", "not_null", None), ("fct_cohort_revenue", "order_month", "not_null", None),
    ("fct_geography_revenue", "country", "not_null", None),
    ("daily_revenue", "order_date", "not_null", None), ("daily_revenue", "order_date", "unique", None),
    ("fct_order_status", "order_month", "not_null", None), ("fct_order_status", "order_status", "not_null", None),
    ("fct_fulfillment", "order_id", "unique", None), ("fct_fulfillment", "order_id", "not_null", None),
    ("fct_fulfillment_summary", "order_month", "unique", None),
    ("fct_fulfillment_summary", "order_month", "not_null", None),
    ("fct_returns", "product_id", "unique", None), ("fct_returns", "product_id", "not_null", None),
    ("fct_distribution_center_performance", "distribution_center_id", "not_null", None),
    ("fct_sessions", "session_id", "unique", None), ("fct_sessions", "session_id", "not_null", None),
    ("fct_web_funnel", "event_date", "not_null", None),
    ("fct_traffic_source_performance", "traffic_source", "not_null", None),
    ("fct_browser_performance", "browser", "not_null", None),
    ("vw_orders", "order_id", "unique", None), ("vw_orders", "order_id", "not_null", None),
    ("vw_daily_revenue", "order_date", "unique", None), ("vw_daily_revenue", "order_date", "not_null", None),
    ("vw_users", "user_id", "unique", None), ("vw_users", "user_id", "not_null", None),
]



def checks_of(kind: str) -> list:
    """All declared checks of one test kind."""
    return [c for c in CHECKS if c[2] == kind]


def column_failures(df: DataFrame, not_null=(), unique=(), accepted=()) -> DataFrame:
    """The column checks of one frame as rows (column_name, test, failures).

    ``accepted`` is [(column, values)].  A unique column makes one keyed count, from which the
    NULL counts and bad values of the other columns are summed as well, so a model with a
    key is read once; further unique columns, or a model without one, take a pass each.
    """
    checks = [(c, "not_null", F.col(c).isNull(), None) for c in not_null]
    checks += [(c, "accepted_values", F.col(c).isNotNull() & ~F.col(c).isin(*v), F.col(c)) for c, v in accepted]
    parts = []
    for k, key in enumerate(unique or (None,)):
        here = checks if k == 0 else []
        flat = [(i, bad) for i, (_, _, bad, value) in enumerate(here) if value is None]
        if key is not None:
            keyed = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"),
                                                             *[F.count_if(bad).alias(f"c{i}") for i, bad in flat])
            one = keyed.agg(F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull()).alias("u"),
                            *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i, _ in flat])
        elif flat:
            one = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in flat])
        rows = [F.struct(F.lit(here[i][0]).alias("column_name"), F.lit(here[i][1]).alias("test"),
                         F.col(f"c{i}").cast("long").alias("failures")) for i, _ in flat]
        if key is not None:
            rows.append(F.struct(F.lit(key).alias("column_name"), F.lit("unique").alias("test"), F.col("u").cast("long").alias("failures")))
        if rows:
            parts.append(one.select(F.inline(F.array(*rows))))
        for c, test, bad, value in here:
            if value is not None:  # distinct bad values, not rows
                parts.append(df.agg(F.countDistinct(F.when(bad, value)).alias("failures")).select(
                    F.lit(c).alias("column_name"), F.lit(test).alias("test"), "failures"))
    return union_all(parts)


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("_pk")).where(F.col("_pk").isNotNull())
    # the child's rows are counted by key before they are exchanged
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    orphans = counted.join(keys, F.col(column) == F.col("_pk"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


#: Bits of a text key's hash that its rows are counted by; of a billion different keys about one in a thousand shares its hash.
HASH_BITS = 40


def text_key_failures(df: DataFrame, key: str, not_null, folder: str) -> list[tuple]:
    """The unique check of the text column ``key`` and the not_null checks of some columns, as (column, test, failures).

    The rows are counted by a short hash, which takes a fraction of a long key in the exchange.  Equal values
    have equal hashes, so only rows whose hash repeats are counted by value.  The counts that say so (few
    where the checks hold) are stored in ``folder``, a new one that all executors share.
    """
    text, short = F.col(key), F.xxhash64(key).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    nulls = [f"c{i}" for i, _ in enumerate(not_null)]
    counts = df.groupBy(F.when(text.isNotNull(), short).alias("_hash")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(not_null, nulls)])
    telling = counts.where(" or ".join(["_n > 1", *[f"{n} > 0" for n in nulls]]))
    telling.write.option("compression", SCRATCH_CODEC).parquet(folder)
    stored = df.sparkSession.read.schema(counts.schema).parquet(folder)
    again = stored.where("_n > 1 and _hash is not null").select(F.col("_hash").alias("_again"))
    sums = stored.agg(F.count_if(F.expr("_n > 1 and _hash is not null")), *[F.coalesce(F.sum(n), F.lit(0)) for n in nulls]).first()
    repeated = 0
    if sums[0]:
        rows = df.where(text.isNotNull()).select(text.alias("_key"), short.alias("_hash"))
        rows = rows.join(again, F.col("_hash") == F.col("_again"), "left_semi")
        repeated = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").count()
    return [(key, "unique", repeated), *[(c, "not_null", int(n)) for c, n in zip(not_null, sums[1:])]]


def _frame(ctx, model: str, columns: list[str], nulls=()) -> DataFrame:
    """Only the columns a check reads; models that can leave out joins or numbering are asked to.

    Of the columns ``nulls`` only the NULLs are counted, so a mark may stand for the value.
    """
    if model == "stg_events":
        return events(ctx, *columns)
    if model == "stg_order_items" and set(columns) - set(nulls) <= set(KEPT_COLS) and set(columns) <= set(ITEM_COLS):
        marked = F.when(F.col(HAS_ID), F.lit(True)).alias("order_item_id")
        return item_rows(ctx, False).select(*[marked if c == "order_item_id" else c for c in columns])
    if model == INT1:
        return enriched_items(ctx, *columns)
    if model == "fct_rfm_scores" and model not in ctx.materialized and not set(columns) & set(SCORE_COLS):
        return rfm_scores(ctx, quantiles.ntiles).select(*columns)
    return ctx.ref(model).select(*columns)


def run_checks(ctx, checks=None) -> DataFrame:
    """All checks as one DataFrame: (model, column_name, test, failures); one pass over most models."""
    checks = CHECKS if checks is None else checks
    by_model: dict[str, list] = {}
    for chk in checks:
        by_model.setdefault(chk[0], []).append(chk)
    parts: list[DataFrame] = []
    for model, chks in by_model.items():
        of = lambda test: [c for _, c, t, _ in chks if t == test]
        accepted = [(c, arg) for _, c, t, arg in chks if t == "accepted_values"]
        columns = list(dict.fromkeys(of("not_null") + of("unique") + [c for c, _ in accepted]))
        if columns:
            nulls = set(of("not_null")) - {*of("unique"), *[c for c, _ in accepted]}
            found = column_failures(_frame(ctx, model, columns, nulls), of("not_null"), of("unique"), accepted)
            parts.append(found.select(F.lit(model).alias("model"), "column_name", "test", "failures"))
        for _, col, test, arg in chks:
            if test == "relationships":
                parent, pcol = arg
                found = relationships_failures(_frame(ctx, model, [col]), col, ctx.ref(parent), pcol)
                parts.append(found.select(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                                          F.lit(test).alias("test"), F.col("failures").cast("long").alias("failures")))
    return union_all(parts)


def read_from(ctx, check: tuple) -> tuple:
    """The check whose count holds for this one as well: the columns that the enriched items take over are the staged items' rows."""
    model, column, *rest = check
    if model == INT1 and INT1 not in ctx.materialized and column in ITEM_COLS:
        return ("stg_order_items", column, *rest)
    return check


#: Sources that are line items left joined with tables whose keys a check counts: the ids are the line items' where none repeats.
LINES = {("stg_order_items", "order_item_id"): [("stg_orders", "order_id", "unique")],
         ("stg_inventory_items", "inventory_item_id"): [("stg_orders", "order_id", "unique"), ("stg_products", "product_id", "unique")]}


def line_ids(ctx, model: str, key: str, counted: dict) -> DataFrame | None:
    """The key column of ``model`` without the joins that add other columns, if ``counted`` says that they keep its rows."""
    lines, needs = getattr(ctx.sources, "line_ids", None), LINES.get((model, key))
    if lines is None or needs is None or any(counted.get(c) != 0 for c in needs):
        return None
    return lines().select(F.col("id").alias(key))


# --- checks while writing, and concurrently -----------------------------------

class Observed:
    """Counts the NULLs of the not_null columns and the rows with bad values of one model, while it is written.

    The metrics sit in the last stage of the write, below nothing that shuffles, so a repeated task is
    counted once.  A bad-value check counts distinct values: where rows are bad it is left to a later read.
    """

    def __init__(self, model: str):
        self.checks = [c for c in CHECKS if c[0] == model and c[2] in ("not_null", "accepted_values")]
        self.observation = Observation(f"{model}-{uuid.uuid4().hex}") if self.checks else None

    def attach(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        bad = {"not_null": lambda c, _: F.col(c).isNull(),
               "accepted_values": lambda c, values: F.col(c).isNotNull() & ~F.col(c).isin(*values)}
        return df.observe(self.observation, *[F.count_if(bad[test](c, arg)).alias(f"c{i}")
                                              for i, (_, c, test, arg) in enumerate(self.checks)])

    def failures(self) -> dict[tuple[str, str, str], int]:
        """By (model, column, test), once the write has ended."""
        if not self.checks:
            return {}
        counted = [int(self.observation.get[f"c{i}"]) for i in range(len(self.checks))]
        return {(m, c, t): n for (m, c, t, _), n in zip(self.checks, counted) if t == "not_null" or n == 0}


def check_rows(ctx, checks=None, known: dict | None = None, threads: int = THREADS, before=None) -> list[tuple]:
    """(model, column_name, test, failures) of every check, in their order.

    ``known`` has failures that were counted already, or will be by the tasks ``before``, which write
    shared models.  The other checks of a model, and of those that are ``ALIKE`` where their model is not
    stored, are one job that waits for the shared models it reads, and for no others; jobs run at the same time.
    """
    checks, known, before = CHECKS if checks is None else checks, {} if known is None else known, before or {}
    read = {c[:3]: read_from(ctx, c) for c in checks}
    by_model: dict[str, dict] = {}
    for check in read.values():
        by_model.setdefault(check[0], {})[check[:3]] = check
    folder = f"{checkpoint_dir(ctx.spark).rstrip('/')}/counts-{uuid.uuid4().hex}"

    counted: dict = {}  # by the jobs that are done

    jobs: dict[str, list[str]] = {}
    for model in by_model:
        like = ALIKE.get(model, model)
        jobs.setdefault(model if like in before or like in ctx.materialized else like, []).append(model)

    def text_keys(model: str, left: list) -> list:
        """The checks of a model that count a text key, as rows."""
        rows = []
        for key in [c[1] for c in left if c[2] == "unique"]:
            plain = [c[1] for c in left if c[2] == "not_null"]
            ids = line_ids(ctx, model, key, known | counted)
            if ids is not None:
                df, plain = ids, [c for c in plain if c == key]
            else:
                df = _frame(ctx, model, list(dict.fromkeys([key, *plain])))
            if df.schema[key].dataType == StringType():
                rows += [(model, *r) for r in text_key_failures(df, key, plain, f"{folder}/{model}-{key}")]
                left = [c for c in left if c[:3] not in {r[:3] for r in rows}]
        return rows

    def job(models: list[str]):
        rows, left = [], []  # a row a check
        for model in models:
            own = [c for c in by_model[model].values() if c[:3] not in known]
            rows += text_keys(model, own)
            left += [c for c in own if c[:3] not in {r[:3] for r in rows}]
        rows += [tuple(r) for r in run_checks(ctx, left).collect()] if left else []
        counted.update({r[:3]: r[3] for r in rows})
        return rows

    tasks = before | {f"check {j}": (lambda models=models: job(models)) for j, models in jobs.items()}
    needs = {name: stored_reads(reads, before) for name, reads in SHARED.items()}
    needs |= {f"check {j}": stored_reads([r for m in models for r in READS.get(m, ())], before) for j, models in jobs.items()}
    for (model, _), keys in LINES.items():
        needs[f"check {model}"] = (*needs.get(f"check {model}", ()), *[f"check {k[0]}" for k in keys])
    done = require_done(run_graph(ctx.spark, tasks, needs, threads))
    found = known | {row[:3]: row[3] for j in jobs for row in done[f"check {j}"].value}
    return [(*c[:3], found[c[:3] if c[:3] in found else read[c[:3]][:3]]) for c in checks]


def report_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The report of a bounded list: one row for each declared check."""
    return spark.createDataFrame(rows, "model string, column_name string, test string, failures long")


#: Tables of one report only: read a few times, so they are stored small.
SCRATCH_CODEC = "zstd"
#: Models that most others read, with what each reads itself: the report writes them once, at the
#: same time as far as that allows, and observes their checks in the write.
SHARED = {JOINED_ITEMS: (), "fct_orders": (JOINED_ITEMS,), "int_user_order_summary": (JOINED_ITEMS,), "fct_sessions": (), "dim_users": ()}
#: The shared models that a model's checks read; the others wait for none.
READS = {"stg_order_items": (JOINED_ITEMS,), "fct_product_performance": (JOINED_ITEMS,), "fct_category_performance": (JOINED_ITEMS,),
         "fct_product_affinity": (JOINED_ITEMS,), "fct_returns": (JOINED_ITEMS,), "fct_distribution_center_performance": (JOINED_ITEMS,),
         "fct_orders": ("fct_orders",), "fct_sessions": ("fct_sessions",), "dim_users": ("dim_users",),
         "int_user_order_summary": ("int_user_order_summary",), "fct_customer_cohorts": ("fct_orders", "dim_users"),
         "fct_customer_orders": ("int_user_order_summary", "dim_users"), "fct_rfm_scores": ("int_user_order_summary",),
         "fct_customer_retention": ("fct_orders", "dim_users"), "fct_cohort_revenue": ("fct_orders", "dim_users"),
         "fct_daily_revenue": ("fct_orders",), "fct_monthly_revenue": ("fct_orders",), "fct_geography_revenue": ("fct_orders",),
         "daily_revenue": ("fct_orders",), "fct_order_status": ("fct_orders",), "fct_fulfillment": ("fct_orders",),
         "fct_fulfillment_summary": ("fct_orders",), "fct_web_funnel": ("fct_sessions",),
         "fct_traffic_source_performance": ("fct_sessions", "fct_orders"), "fct_browser_performance": ("fct_sessions", "fct_orders"),
         "vw_orders": ("fct_orders",), "vw_daily_revenue": ("fct_orders",), "vw_users": ("dim_users", "int_user_order_summary")}


#: The shared models that a report of NULL counts alone stores.  Of the others it reads a key or a month, which cost
#: a fraction of what the whole rows do: Spark leaves out of a plan that is not stored what no check reads.
NULL_SHARED = (JOINED_ITEMS, "fct_sessions")
#: Models whose checks read the rows of a shared model: where it is not stored, one job counts them all and Spark exchanges the rows once.
ALIKE = {"fct_fulfillment": "fct_orders", "fct_geography_revenue": "fct_orders", "vw_orders": "fct_orders",
         "fct_customer_orders": "int_user_order_summary", "fct_rfm_scores": "int_user_order_summary", "vw_users": "int_user_order_summary"}
#: Spark deletes a query's shuffle files when the query ends, instead of when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_reads(names, stored) -> set[str]:
    """The ``stored`` ones of some shared models and of what the others read."""
    return set().union(*[{n} if n in stored else stored_reads(SHARED[n], stored) for n in names])


@contextmanager
def shuffles_cleaned(spark: SparkSession):
    """Queries that are planned meanwhile, each run once, leave no shuffle files behind."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if was is None else spark.conf.set(SHUFFLE_CLEANUP, was)


def report(ctx, checks=None, threads: int = 2 * THREADS) -> DataFrame:
    """Declared checks (all by default) over models that are not built: shared ones are written once to the shared folder.

    The jobs run when this is called, many at a time, each a plan of one model (or of some that are ``ALIKE``);
    their counts (a row a check) make the frame.
    """
    checks = CHECKS if checks is None else checks
    shared = NULL_SHARED if all(c[2] == "not_null" for c in checks) else SHARED
    wanted = set().union(*[stored_reads(READS.get(read_from(ctx, c)[0], ()), shared) for c in checks])
    for name, reads in reversed(SHARED.items()):
        wanted |= set(reads) if name in wanted else set()
    if INT1 in ctx.materialized:  # a build's enriched items are read instead
        wanted.discard(JOINED_ITEMS)
    folder = f"{checkpoint_dir(ctx.spark).rstrip('/')}/checks-{uuid.uuid4().hex}"
    known: dict = {}

    def write(name: str):
        path = f"{folder}/{name}"
        seen, df = Observed(name), items_with_orders(ctx) if name == JOINED_ITEMS else ctx.ref(name)
        seen.attach(df).write.option("compression", SCRATCH_CODEC).parquet(path)
        ctx.replace(name, ctx.spark.read.schema(df.schema).parquet(path))
        known.update(seen.failures())

    before = {name: (lambda name=name: write(name)) for name in SHARED if name in wanted and name not in ctx.materialized}
    with shuffles_cleaned(ctx.spark):
        rows = check_rows(ctx, checks, known, threads, before)
    return report_frame(ctx.spark, rows)


class KeyCheckError(ValueError):
    """A declared key of a source does not hold."""


def require_keys(ctx, threads: int = THREADS) -> dict[tuple[str, str, str], int]:
    """The not_null and unique checks of the staging models; raises KeyCheckError if one fails.

    The marts use these keys (joins that keep the grain, plain counts for distinct ones), so
    the build calls this before it writes anything; it returns the counts for the report.
    """
    checks = [c for c in CHECKS if c[0].startswith("stg_") and c[2] in ("not_null", "unique")]
    rows = check_rows(ctx, checks, threads=threads)
    if bad := [f"{m}.{c} {t}: {n}" for m, c, t, n in rows if n]:
        raise KeyCheckError("; ".join(sorted(bad)))
    return {row[:3]: row[3] for row in rows}


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree: each union is analyzed once over a log-depth plan."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]
