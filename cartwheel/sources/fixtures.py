"""Derive the seven e-commerce sources from the driver's TPC-H-style tables.

The mapping is a set of deterministic functions of keys (see FIXTURES.md §3),
so the DuckDB oracle applies the same rules.  Everything is lazy DataFrame
code; the tables grow with the driver tables:

* lineitem -> order_items / inventory_items joins the mapped orders on the
  order key (a shuffle join on both sides, skew split by AQE),
* num_of_item is a pre-aggregated count per order joined back on the key,
* events get ``sequence_number`` from the distributed row numbering, so a very
  busy session is not numbered inside one task; readers that do not need the
  number take ``unnumbered_events`` and pay nothing for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.ranking import row_number

# Fixed values of the fixture mapping (FIXTURES.md §3).
YEAR_SHIFT = 24
SIGNUP_EPOCH = "2019-01-01 00:00:00"
SIGNUP_SPREAD_DAYS = 730
EVENT_TYPE_MAP = {"view": "product", "click": "cart", "signup": "home", "error": "cancel",
                  "purchase": "purchase"}
TRAFFIC_SOURCES = ["Email", "Adwords", "Organic", "Facebook"]  # by props.k % 4

# Schemas of the driver tables the adapter reads (given explicitly: no footer inference).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
DRIVER_TABLES = list(DRIVER_SCHEMAS)


# No explicit repartition on the order key here: a user-specified
# repartition pins the partitioning, and adaptive execution then cannot split
# a hot key (one order holding a large share of all line items would land in
# one task).  The joins get the planner's own exchanges, which AQE splits.


class DriverTables:
    """Driver tables read lazily, one ``spark.read`` per table on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._dfs = spark, sf_dir.rstrip("/"), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._dfs[name]


def read_driver(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def _add_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)


def map_users(t: dict[str, DataFrame]) -> DataFrame:
    # nation/region are tiny; the planner's size-checked broadcast (and AQE at
    # runtime) picks the broadcast without an eager count here
    nation, region = t["nation"], t["region"]
    c = t["customer"]
    k = F.col("c_custkey")
    geo = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    j = c.join(geo, c["c_nationkey"] == geo["n_nationkey"], "left")
    return j.select(
        k.alias("id"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 1 << 30).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        (F.lit(15) + k % 60).cast("long").alias("age"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.col("n_name"), F.lit("-"), (k % 5).cast("string")).alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("Z"), (k % 100).cast("string")).alias("postal_code"),
        (F.col("n_nationkey") * 2).cast("double").alias("latitude"),
        (F.col("n_nationkey") * -3).cast("double").alias("longitude"),
        F.col("c_mktsegment").alias("traffic_source"),
        F.timestamp_add("DAY", (k % SIGNUP_SPREAD_DAYS).cast("int"),
                        F.lit(SIGNUP_EPOCH).cast("timestamp_ntz")).alias("created_at"),
    )


def _order_status(key: Column) -> Column:
    st = F.col("o_orderstatus")
    return (F.when(st == "F", F.when(key % 4 == 0, "Returned").otherwise("Complete"))
            .when(st == "O", F.when(key % 3 == 0, "Processing").otherwise("Shipped"))
            .when(st == "P", F.when(key % 5 == 0, "Cancelled").otherwise("Complete")))


def map_orders(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("o_orderkey")
    item_counts = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_n_items"))
    created = _add_hours(F.timestamp_add("YEAR", F.lit(YEAR_SHIFT), F.col("o_orderdate")),
                         (key % 24).cast("int"))
    o = t["orders"].join(item_counts, "o_orderkey", "left").select(
        key.alias("order_id"), F.col("o_custkey").alias("user_id"),
        _order_status(key).alias("status"), created.alias("created_at"),
        (key * 7 % 73).cast("int").alias("_ship_h"), (key * 11 % 240).cast("int").alias("_del_h"),
        (key * 13 % 480).cast("int").alias("_ret_h"),
        F.coalesce(F.col("_n_items"), F.lit(0)).cast("long").alias("num_of_item"))
    s = F.col("status")
    shipped = F.when(s.isin("Shipped", "Complete", "Returned"), _add_hours(F.col("created_at"), F.col("_ship_h")))
    o = o.withColumn("shipped_at", shipped)
    delivered = F.when(s.isin("Complete", "Returned"), _add_hours(F.col("shipped_at"), F.col("_del_h")))
    o = o.withColumn("delivered_at", delivered)
    returned = F.when(s == "Returned", _add_hours(F.col("delivered_at"), F.col("_ret_h")))
    o = o.withColumn("returned_at", returned)
    return o.select("order_id", "user_id", "status", "created_at", "shipped_at", "delivered_at",
                    "returned_at", "num_of_item")


def _line_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                       F.date_format("l_shipdate", "yyyyMMdd"))


def map_order_items(t: dict[str, DataFrame], orders: DataFrame) -> DataFrame:
    li = t["lineitem"]
    o = orders.select(F.col("order_id").alias("l_orderkey"), "user_id", "status", "created_at",
                      "shipped_at", "delivered_at", "returned_at")
    # orders is as large as lineitem's key space: a shuffle join (the plan it
    # gets at scale anyway) whose exchanges AQE can split for a hot order
    j = li.join(o.hint("shuffle_merge"), "l_orderkey", "left")
    return j.select(
        _line_id().alias("id"), F.col("l_orderkey").alias("order_id"), "user_id",
        F.col("l_partkey").alias("product_id"), _line_id().alias("inventory_item_id"), "status",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("sale_price"),
        "created_at", "shipped_at", "delivered_at", "returned_at")


def map_products(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("p_partkey")
    centres = t["supplier"].select(F.count(F.lit(1))).scalar()  # products are spread over all centres
    price = F.col("p_retailprice").cast("decimal(10,2)")
    cost = (price * (F.lit(5) + k % 6).cast("decimal(3,0)") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(12,3)")
    return t["part"].select(
        k.alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") % 2 == 0, "Women").otherwise("Men").alias("department"),
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"), price.alias("retail_price"),
        cost.alias("cost"), (k % centres).cast("long").alias("distribution_center_id"))


def map_distribution_centers(t: dict[str, DataFrame]) -> DataFrame:
    """Every supplier is a centre."""
    return t["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    (F.col("s_nationkey") * 2).cast("double").alias("latitude"),
                    (F.col("s_nationkey") * -3).cast("double").alias("longitude"))


def _event_type() -> Column:
    e = F.col("event_type")
    out = None
    for src, dst in EVENT_TYPE_MAP.items():
        out = (F.when(e == src, dst) if out is None else out.when(e == src, dst))
    return out.otherwise(e)


def _traffic_source() -> Column:
    k = F.get_json_object("props", "$.k").cast("long") % 4
    out = None
    for i, name in enumerate(TRAFFIC_SOURCES):
        out = F.when(k == i, name) if out is None else out.when(k == i, name)
    return out


def map_events_unnumbered(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    half = F.when(F.hour("ts") < 12, "a").otherwise("b")
    null_s = F.lit(None).cast("string")
    return e.select(
        F.col("event_id").alias("id"), "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"), half).alias("session_id"),
        _event_type().alias("event_type"), null_s.alias("uri"),
        F.concat(F.lit("Browser"), (F.col("user_id") % 5).cast("string")).alias("browser"),
        _traffic_source().alias("traffic_source"), null_s.alias("city"), null_s.alias("state"),
        null_s.alias("postal_code"), null_s.alias("ip_address"), F.col("ts").alias("created_at"))


def map_events(t: dict[str, DataFrame]) -> DataFrame:
    """Events with their number in the session; only the sort keys are ranked, then joined back on the id."""
    base = map_events_unnumbered(t)
    keys = base.select(F.col("id").alias("_id"), "session_id", "created_at").where("_id is not null")
    ranked = row_number(keys, ["created_at", "_id"], partition_by=["session_id"], rn_col="sequence_number")
    numbered = base.join(ranked.select("_id", "sequence_number"), base["id"] == F.col("_id"), "left")
    return numbered.select("id", "user_id", "session_id", "sequence_number", "event_type", "uri", "browser",
                           "traffic_source", "city", "state", "postal_code", "ip_address", "created_at")


def map_inventory_items(t: dict[str, DataFrame], orders: DataFrame, products: DataFrame) -> DataFrame:
    li = t["lineitem"]
    o = orders.select(F.col("order_id").alias("l_orderkey"), F.col("created_at").alias("_order_at"))
    p = products.select(F.col("id").alias("l_partkey"), F.col("cost"), F.col("category").alias("product_category"),
                        F.col("name").alias("product_name"), F.col("brand").alias("product_brand"),
                        F.col("retail_price").alias("product_retail_price"),
                        F.col("department").alias("product_department"), F.col("sku").alias("product_sku"),
                        F.col("distribution_center_id").alias("product_distribution_center_id"))
    j = li.join(o.hint("shuffle_merge"), "l_orderkey", "left").join(p, "l_partkey", "left")
    return j.select(
        _line_id().alias("id"), F.col("l_partkey").alias("product_id"), "cost",
        F.when(F.col("l_linestatus") == "F", F.col("_order_at")).alias("sold_at"),
        F.col("_order_at").alias("created_at"), "product_category", "product_name", "product_brand",
        "product_retail_price", "product_department", "product_sku", "product_distribution_center_id")


class FixtureSources:
    """Lazily derived sources; each is built once per instance and shared."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._t = None
        self._cache: dict[str, DataFrame] = {}

    @property
    def tables(self) -> DriverTables:
        if self._t is None:
            self._t = read_driver(self.spark, self.sf_dir)
        return self._t

    def unnumbered_events(self) -> DataFrame:
        return map_events_unnumbered(self.tables)

    def line_ids(self) -> DataFrame:
        """The ids of order_items, and of inventory_items, of an own row for each line item: those of these
        sources where no order (for inventory: and no product) is stored twice, as their left joins keep the rows then."""
        return self.tables["lineitem"].select(_line_id().alias("id"))

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            t = self.tables
            if name == "orders":
                df = map_orders(t)
            elif name == "order_items":
                df = map_order_items(t, self("orders"))
            elif name == "users":
                df = map_users(t)
            elif name == "products":
                df = map_products(t)
            elif name == "events":
                df = map_events(t)
            elif name == "inventory_items":
                df = map_inventory_items(t, self("orders"), self("products"))
            elif name == "distribution_centers":
                df = map_distribution_centers(t)
            else:
                raise KeyError(f"unknown source {name!r}")
            self._cache[name] = df
        return self._cache[name]
