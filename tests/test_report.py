"""The check report: items joined once, text keys counted by their hash, the same counts whatever repeats."""

import contextlib
import io
import random
import uuid
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import pairs as pairing
from cartwheel.operators.pairs import possible_pairs
from cartwheel.plans import intermediate, quality
from cartwheel.registry import context
from cartwheel.session import checkpoint_dir
from cartwheel.sources.fixtures import DRIVER_SCHEMAS

ROWS = {
    "region": [(0, "ASIA")], "nation": [(0, "CHINA", 0)],
    "customer": [(k, f"Customer#{k:09d}", 0, 1.0, "BUILDING") for k in (1, 2, 3)],
    "supplier": [(1, "Supplier#1", 0, 1.0), (2, "Supplier#2", 0, 1.0)],
    "part": [(k, f"part {k}", f"Brand#{k}", "TIN", k, 10.0 + k) for k in (1, 2, 3)],
    "orders": [(k, k % 3 + 1, "FOP"[k % 3], 1.0, "1997-01-0%d" % (k % 9 + 1), "1-URGENT") for k in range(1, 13)],
    "lineitem": [(k, k % 3 + 1, 1, n, 1.0, 5.0 * n, 0.0, 0.0, "N", "FO"[k % 2], "1997-02-01") for k in range(1, 13) for n in (1, 2)],
    "events": [(k, "1997-01-01", k % 3 + 1, "view", 1.0, '{"k": 1}') for k in range(1, 6)],
}
#: An order and a product stored twice, a line stored twice, rows without a key, a line without an order.
TWICE = {"orders": [ROWS["orders"][3], (5, 3, "O", 1.0, "1998-01-01", "1-URGENT"), (None, None, "F", 1.0, None, None)],
         "part": [ROWS["part"][1]],
         "lineitem": [ROWS["lineitem"][0], (None, None, 1, 1, 1.0, None, 0.0, 0.0, "N", "F", None),
                      (99, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "F", "1997-02-01")]}


def stored(spark, folder: str, more: dict) -> str:
    for name, rows in ROWS.items():
        schema = DRIVER_SCHEMAS[name]
        df = spark.createDataFrame(rows + more.get(name, []), schema.replace("timestamp_ntz", "string"))
        for column in [c.split()[0] for c in schema.split(", ") if "timestamp_ntz" in c]:
            df = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("more", [{}, TWICE], ids=["once", "twice"])
def test_report_counts_as_the_models_own_rows(spark, tmp_out, more):
    folder = stored(spark, f"{tmp_out}/tables", more)
    got = {r[:3]: r[3] for r in map(tuple, quality.report(context(spark, folder)).collect())}
    want = {r[:3]: r[3] for r in map(tuple, quality.run_checks(context(spark, folder)).collect())}
    assert got == want and len(got) == len(quality.CHECKS)
    ids = [got["stg_order_items", "order_item_id", "unique"], got["stg_inventory_items", "inventory_item_id", "unique"]]
    assert min(ids) > 0 if more else ids == [0, 0]


def test_report_joins_the_items_with_their_orders_once(spark, tmp_out):
    ctx = context(spark, stored(spark, f"{tmp_out}/tables", TWICE))
    whole = {m: sorted(map(str, ctx.ref(m).collect())) for m in ("fct_returns", "fct_product_performance", "int_user_order_summary")}
    own = context(spark, f"{tmp_out}/tables")
    quality.report(own, quality.checks_of("unique"))
    assert intermediate.JOINED_ITEMS in own.materialized
    for model in ("fct_product_performance", "fct_category_performance", "fct_returns", "fct_product_affinity",
                  "fct_distribution_center_performance"):
        column = next(c[1] for c in quality.CHECKS if c[0] == model)
        assert "lineitem.parquet" not in plan(quality._frame(own, model, [column])), model
    for model, rows in whole.items():
        assert sorted(map(str, own.ref(model).collect())) == rows, model
    # the staged items are the marked rows, however many rows an order has
    items = ["order_id", "user_id", "product_id", "sale_price"]
    staged = context(spark, f"{tmp_out}/tables").ref("stg_order_items").select(*items).collect()
    assert sorted(map(str, intermediate.item_rows(own, False).select(*items).collect())) == sorted(map(str, staged))


def test_line_ids_are_read_without_joins_only_if_no_key_repeats(spark, tmp_out):
    ctx = context(spark, stored(spark, f"{tmp_out}/tables", {}))
    once = {("stg_orders", "order_id", "unique"): 0, ("stg_products", "product_id", "unique"): 0}
    for model, key in quality.LINES:
        df = quality.line_ids(ctx, model, key, once)
        assert "Join" not in plan(df) and "Exchange" not in plan(df)
        assert sorted(map(str, df.collect())) == sorted(map(str, ctx.ref(model).select(key).collect()))
        assert quality.line_ids(ctx, model, key, once | {("stg_orders", "order_id", "unique"): 1}) is None
        assert quality.line_ids(ctx, model, key, {}) is None
    assert quality.line_ids(ctx, "stg_inventory_items", "inventory_item_id", once | {("stg_products", "product_id", "unique"): 1}) is None


@pytest.mark.parametrize("bits", [0, 2, 40])
def test_text_keys_are_counted_by_value_where_hashes_repeat(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "HASH_BITS", bits)
    df = spark.createDataFrame([(f"k{i}", i if i % 5 else None) for i in range(40)] + [("k1", 1), ("k1", 1), ("k7", 1), (None, 1), (None, None), ("", 1)],
                               "k string, v int")
    folder = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    want = {r["column_name"] + r["test"]: r["failures"] for r in quality.column_failures(df, ["k", "v"], ["k"]).collect()}
    got = quality.text_key_failures(df, "k", ["k", "v"], folder)
    assert {c + t: n for c, t, n in got} == want == {"kunique": 2, "knot_null": 2, "vnot_null": 9}
    none = quality.text_key_failures(df.where("false"), "k", ["v"], folder + "-none")
    assert [r[2] for r in none] == [0, 0]


def test_orphans_are_counted_by_row(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert quality.relationships_failures(child, "k", parent, "k").collect()[0][0] == 2
    assert quality.relationships_failures(child.where("k = 1"), "k", parent, "k").collect()[0][0] == 0


def test_stored_join_marks_each_order_and_product_once(spark, tmp_out):
    folder = stored(spark, f"{tmp_out}/tables", TWICE)
    plain, own = context(spark, folder), context(spark, folder, min_support_count=1)
    quality.report(own, quality.checks_of("unique"))
    pairs = intermediate.order_products(own)
    assert "Exchange" not in plan(pairs)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, intermediate.order_products(plain).collect()))
    affinity = context(spark, folder, min_support_count=1).ref("fct_product_affinity")
    assert sorted(map(str, own.ref("fct_product_affinity").collect())) == sorted(map(str, affinity.collect()))


@pytest.mark.parametrize("buckets", [64, 100, 1 << 26])
def test_bits_let_through_the_pairs_of_full_buckets(spark, buckets):
    pairs = spark.createDataFrame([(a, b) for a in range(20) for b in range(a + 1, 20) for _ in range((a * b) % 4)], "item_a long, item_b long")
    bucket = F.pmod(F.xxhash64("item_a", "item_b"), F.lit(buckets))
    rows = [tuple(r) for r in pairs.select("item_a", "item_b", bucket).collect()]
    size = Counter(b for _, _, b in rows)
    assert Counter(map(tuple, possible_pairs(pairs, 3, buckets).collect())) == Counter((a, b) for a, b, k in rows if size[k] >= 3)


class SomeIdsMissing:
    """The sources of a context, with order items that have no id."""

    def __init__(self, sources):
        self.sources = sources

    def __call__(self, name):
        df = self.sources(name)
        return df.withColumn("id", F.when(F.col("product_id") != 1, F.col("id"))) if name == "order_items" else df


@pytest.mark.parametrize("more", [{}, TWICE], ids=["once", "twice"])
def test_null_report_stores_no_whole_rows_of_which_it_reads_a_key(spark, tmp_out, more):
    folder = stored(spark, f"{tmp_out}/tables", more)
    checks = quality.checks_of("not_null")
    own, plain = context(spark, folder), context(spark, folder)
    own.sources, plain.sources = SomeIdsMissing(own.sources), SomeIdsMissing(plain.sources)
    got = {r[:3]: r[3] for r in map(tuple, quality.report(own, checks).collect())}
    assert own.materialized == {intermediate.JOINED_ITEMS, "fct_sessions"}
    assert got == {r[:3]: r[3] for r in map(tuple, quality.run_checks(plain, checks).collect())} and len(got) == len(checks)
    assert got["stg_order_items", "order_item_id", "not_null"] == got["int_order_items_enriched", "order_item_id", "not_null"] > 0
    # the items' own columns are counted where they were stored, also the id
    columns = ["order_item_id", *intermediate.KEPT_COLS]
    assert "lineitem.parquet" not in plan(quality._frame(own, "stg_order_items", columns, columns))
    assert "lineitem.parquet" in plan(quality._frame(own, "stg_order_items", columns))


def test_null_report_counts_models_of_the_same_rows_in_one_job(spark, tmp_out, monkeypatch):
    ctx, jobs = context(spark, stored(spark, f"{tmp_out}/tables", TWICE)), []
    run = quality.run_checks
    monkeypatch.setattr(quality, "run_checks", lambda ctx, checks: jobs.append({c[0] for c in checks}) or run(ctx, checks))
    quality.report(ctx, quality.checks_of("not_null"))
    for model, like in quality.ALIKE.items():
        assert [j for j in jobs if model in j] == [j for j in jobs if like in j], model


def test_report_cleans_its_shuffles_and_leaves_the_session_as_it_was(spark, tmp_out, monkeypatch):
    ctx, seen = context(spark, stored(spark, f"{tmp_out}/tables", {})), []
    before = spark.conf.get(quality.SHUFFLE_CLEANUP, None)
    rows = quality.check_rows
    monkeypatch.setattr(quality, "check_rows", lambda *a: seen.append(spark.conf.get(quality.SHUFFLE_CLEANUP)) or rows(*a))
    quality.report(ctx, quality.checks_of("not_null")[:3])
    assert seen == ["true"] and spark.conf.get(quality.SHUFFLE_CLEANUP, None) == before


def test_first_pass_of_pairs_brings_about_a_byte_a_pair():
    rnd = random.Random(5)
    buckets = [rnd.randrange(1 << 22) for _ in range(40_000)] + [77] * 5_000 + [1 << 21] * 3 + [0] * 2
    batches = [pa.RecordBatch.from_pydict({"_bucket": buckets[i::7]}) for i in range(7)]
    packed = [b for k in range(2) for b in pairing.pack_buckets(3)(iter(batches[k::2]))]  # two tasks
    assert sum(len(x) for b in packed for x in b.column(1).to_pylist()) < 2 * 40_000
    rows = sorted(((s, d) for b in packed for s, d in zip(*[c.to_pylist() for c in b.columns])), key=lambda r: r[0])
    met = [pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([d], pa.binary())], ["_section", "_distances"]) for s, d in rows]
    full = {w * 64 + i for b in pairing.full_words(3)(iter(met)) for w, bits in zip(*[c.to_pylist() for c in b.columns])
            for i in range(64) if bits >> i & 1}
    assert full == {b for b, n in Counter(buckets).items() if n >= 3}


def test_pairs_of_stored_baskets_move_no_row_to_drop_rare_items(spark, tmp_out):
    spark.createDataFrame([(o, p) for o in range(40) for p in range(o % 5, 30, 7)], "o long, p long").write.parquet(f"{tmp_out}/baskets")
    items = spark.read.parquet(f"{tmp_out}/baskets")
    text = plan(pairing.frequent_pairs(items, "o", "p", 3))
    assert "LeftSemi" not in text
