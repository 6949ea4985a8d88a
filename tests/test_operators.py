"""Distributed operators against brute force / Spark's single-task windows."""

import itertools
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.pairs import frequent_pairs
from cartwheel.operators.ranking import ntile, ntiles, row_number


def _frame(spark, n=997, seed=7, null_every=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = rnd.randint(0, 40)
        if null_every and i % null_every == 0:
            v = None
        rows.append((i, v, f"g{rnd.randint(0, 6)}"))
    return spark.createDataFrame(rows, "id bigint, v bigint, g string").repartition(5)


def test_global_ntile_matches_window_ntile(spark):
    df = _frame(spark, null_every=13)
    for k in (4, 5, 7):
        ours = ntile(df, k, "v", "b", key="id")
        ref = df.select("id", F.ntile(k).over(Window.orderBy(F.col("v").asc_nulls_first(), "id")).alias("r"))
        bad = ours.join(ref, "id").where(F.col("b") != F.col("r")).count()
        assert bad == 0 and ours.count() == df.count()


def test_global_ntile_descending_nulls_last(spark):
    df = _frame(spark, null_every=11)
    ours = ntile(df, 5, "v", "b", key="id", descending=True)
    ref = df.select("id", F.ntile(5).over(Window.orderBy(F.col("v").desc_nulls_last(), "id")).alias("r"))
    assert ours.join(ref, "id").where(F.col("b") != F.col("r")).count() == 0


def test_ntile_with_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(1, 5), (2, 3)], "id bigint, v bigint")
    got = sorted((r.id, r.b) for r in ntile(df, 5, "v", "b", key="id").collect())
    assert got == [(1, 2), (2, 1)]


def test_partitioned_row_number_matches_window(spark):
    df = _frame(spark)
    ours = row_number(df, ["v", "id"], partition_by=["g"], rn_col="rn", size_col="n")
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.select("id", F.row_number().over(w).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("m"))
    j = ours.join(ref, "id")
    assert j.where((F.col("rn") != F.col("r")) | (F.col("n") != F.col("m"))).count() == 0
    assert j.count() == df.count()


def test_frequent_pairs_matches_brute_force(spark):
    rnd = random.Random(3)
    baskets = {}
    for o in range(300):
        size = rnd.choice([1, 2, 3, 5, 8])
        baskets[o] = sorted(set(rnd.randint(0, 25) for _ in range(size)))
    rows = [(o, p) for o, ps in baskets.items() for p in ps]
    df = spark.createDataFrame(rows, "order_id bigint, product_id bigint")
    for min_count in (1, 3, 6):
        brute = {}
        for ps in baskets.values():
            for a, b in itertools.combinations(ps, 2):
                brute[(a, b)] = brute.get((a, b), 0) + 1
        expect = {k: v for k, v in brute.items() if v >= min_count}
        got = {(r.item_a, r.item_b): r.co_count
               for r in frequent_pairs(df, "order_id", "product_id", min_count).collect()}
        assert got == expect


def _brute_pairs(baskets, min_count):
    brute = {}
    for ps in baskets.values():
        for a, b in itertools.combinations(sorted(set(ps)), 2):
            brute[(a, b)] = brute.get((a, b), 0) + 1
    return {k: v for k, v in brute.items() if v >= min_count}


def test_several_ntiles_at_once_match_windows(spark):
    df = _frame(spark, null_every=9).withColumn("w", F.col("id") % 17)
    ours = ntiles(df, "id", [("v", 5, True, "a"), ("w", 4, False, "b")])
    ref = df.select("id", F.ntile(5).over(Window.orderBy(F.col("v").desc_nulls_last(), "id")).alias("x"),
                    F.ntile(4).over(Window.orderBy(F.col("w").asc_nulls_first(), "id")).alias("y"))
    assert ours.join(ref, "id").where((F.col("a") != F.col("x")) | (F.col("b") != F.col("y"))).count() == 0
    assert ours.count() == df.count() and set(ours.columns) == {*df.columns, "a", "b"}


def test_frequent_pairs_with_huge_baskets_match_brute_force(spark):
    """Baskets far larger than a block, and a NULL basket that is no basket."""
    rnd = random.Random(11)
    baskets = {o: sorted(set(rnd.randint(0, 30) for _ in range(rnd.choice([2, 3, 4])))) for o in range(200)}
    for o in range(12):
        baskets[10_000 + o] = list(range(o, 30))
    rows = [(o, p) for o, ps in baskets.items() for p in ps] + [(None, p) for p in range(30)]
    df = spark.createDataFrame(rows, "order_id bigint, product_id bigint")
    for min_count in (1, 3, 14):
        got = {(r.item_a, r.item_b): r.co_count
               for r in frequent_pairs(df, "order_id", "product_id", min_count, block=4).collect()}
        assert got == _brute_pairs(baskets, min_count)


def test_no_join_key_of_pairs_holds_more_than_a_block(spark):
    from cartwheel.operators.pairs import block_rows
    df = spark.createDataFrame([(1, p) for p in range(1000)], "order_id bigint, product_id bigint")
    left, right = block_rows(df, "order_id", "product_id", 50)
    for side in (left, right):
        assert side.groupBy("_basket", "_i", "_j").count().agg(F.max("count")).first()[0] < 4 * 50


def test_pair_prefilter_keeps_every_frequent_pair(spark):
    """Also with few buckets, where rare pairs share one; with many, no rare pair's rows get through."""
    import random
    from itertools import combinations

    from cartwheel.operators.pairs import basket_pairs, possible_pairs

    rnd = random.Random(3)
    rows = sorted({(b, min(rnd.randrange(60), rnd.randrange(60))) for b in range(300) for _ in range(8)})
    df = spark.createDataFrame(rows, "order_id long, product_id long")
    held = {}
    for b, i in rows:
        held.setdefault(b, []).append(i)
    count = {}
    for items in held.values():
        for p in combinations(sorted(items), 2):
            count[p] = count.get(p, 0) + 1
    pairs = basket_pairs(df, "order_id", "product_id")
    assert pairs.count() == sum(count.values())
    for min_count in (2, 25):
        want = {p: n for p, n in count.items() if n >= min_count}
        for buckets in (1, 7, 1 << 20):
            left = possible_pairs(pairs, min_count, buckets).groupBy("item_a", "item_b").count().collect()
            left = {(r.item_a, r.item_b): r["count"] for r in left}
            assert {p: n for p, n in left.items() if n >= min_count} == want
            assert buckets < 100 or left == want
            got = frequent_pairs(df, "order_id", "product_id", min_count, buckets=buckets).collect()
            assert {(r.item_a, r.item_b): r.co_count for r in got} == want
