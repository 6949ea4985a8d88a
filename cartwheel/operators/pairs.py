"""Co-occurrence counting for pairs of items that share baskets.

Lossless pruning first: a pair can reach ``min_count`` shared baskets only if
each of its items is in at least ``min_count`` baskets, so rarer items are
removed where they are read (by bits of the kept items' hashes, broadcast; a rare item
that shares a hash stays, which costs rows but changes no result), and baskets left with
fewer than two items are dropped.

Every basket is cut into blocks of about ``block`` items by a hash, and the
blocks of a basket meet two by two: the join key is (basket, i, j), so no key
holds more than a block on either side whatever the size of a basket, and a
basket of one block (the usual case) is just (basket, 0, 0).  Each unordered
pair of items meets in exactly one (i, j).

A pair row is shuffled only if its pair can be frequent: a first pass counts the rows of
``BUCKETS`` hash buckets, and a bucket under ``min_count`` holds no frequent pair.  A task sorts the buckets
of its pairs and brings their distances, about a byte a pair and at most ``min_count`` rows a bucket, however
many pairs it makes.  The buckets that reach it, as bits of at most BUCKETS / 64 words, go to every task, which
keeps the pairs of these; the second pass counts them exactly, so a bucket that several rare pairs fill lets
them through but into no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512
#: Hash buckets of the first pass: a bound on its counts and on what is broadcast (a bit each, 64 to a word).
#: A bucket lets all its pairs through once a few rare ones fill it, so there are many.
BUCKETS = 1 << 27
#: Hash buckets of the items, fewer, as nearly all items may be kept: a bound on what is broadcast of them.
ITEM_BUCKETS = 1 << 25
#: Buckets that are counted together, and pairs that a task sorts at once.
SECTION = 1 << 16
SORTED_AT_ONCE = 1 << 22


def item_basket_counts(baskets: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """Baskets per item; ``baskets`` must already be distinct on (basket, item). A NULL basket is none."""
    return baskets.where(F.col(basket_col).isNotNull()).groupBy(item_col).agg(F.count(F.lit(1)).alias("basket_count"))


def block_rows(items: DataFrame, basket_col: str, item_col: str, block: int) -> tuple[DataFrame, DataFrame]:
    """The two sides of the block join: rows (_basket, _i, _j, item) with i <= j, own block i on the left, j on the right."""
    sizes = items.groupBy(F.col(basket_col).alias("_basket")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(item_col), blocks).cast("int")
    met = items.join(sizes, F.col(basket_col) == F.col("_basket")).select(
        "_basket", F.col(item_col).alias("_item"), own.alias("_own"), (blocks - 1).alias("_last"))
    left = met.select("_basket", F.col("_own").alias("_i"), F.explode(F.sequence("_own", "_last")).alias("_j"),
                      F.col("_item").alias("_l"))
    right = met.select(F.col("_basket").alias("_basket"), F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"),
                       F.col("_own").alias("_j"), F.col("_item").alias("_r"))
    return left, right


def frequent_pairs(baskets: DataFrame, basket_col: str, item_col: str, min_count: int,
                   item_counts: DataFrame | None = None, block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """(item_a, item_b, co_count) with item_a < item_b and co_count >= min_count.

    ``baskets`` must be distinct on (basket, item).
    """
    min_count = max(int(min_count), 1)
    items = baskets.select(basket_col, item_col).where(F.col(basket_col).isNotNull() & F.col(item_col).isNotNull())
    if min_count > 1:
        counts = item_counts if item_counts is not None else item_basket_counts(items, basket_col, item_col)
        bucket = _bucket(item_col, buckets=min(buckets, ITEM_BUCKETS))
        kept = counts.where(F.col("basket_count") >= min_count).select(bucket.alias("_bucket"))
        items = in_buckets(items, bucket, words_of(kept))
    pairs = possible_pairs(basket_pairs(items, basket_col, item_col, block), min_count, buckets)
    return pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("co_count")).where(F.col("co_count") >= min_count)


def basket_pairs(items: DataFrame, basket_col: str, item_col: str, block: int = BLOCK) -> DataFrame:
    """(item_a, item_b) with item_a < item_b, a row for each basket that holds both."""
    left, right = block_rows(items, basket_col, item_col, block)
    met = left.join(right, ["_basket", "_i", "_j"]).where("_i < _j OR _l < _r")
    return met.select(F.least("_l", "_r").alias("item_a"), F.greatest("_l", "_r").alias("item_b"))


def possible_pairs(pairs: DataFrame, min_count: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``pairs`` whose hash bucket holds at least ``min_count`` rows: all of every frequent pair."""
    if min_count <= 1:
        return pairs
    buckets_of = pairs.select(_bucket("item_a", "item_b", buckets=buckets).alias("_bucket"))
    packed = buckets_of.mapInArrow(pack_buckets(min_count), "_section long, _distances binary")
    # a task counts the sections that meet in it one after the other
    met = packed.repartition("_section").sortWithinPartitions("_section")
    return in_buckets(pairs, _bucket("item_a", "item_b", buckets=buckets), met.mapInArrow(full_words(min_count), "_word long, _bits long"))


def _bucket(*columns: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def words_of(buckets: DataFrame) -> DataFrame:
    """The ``_bucket`` numbers as bits: (_word, _bits), 64 buckets to a word."""
    return buckets.groupBy(F.expr("shiftright(_bucket, 6)").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bucket & 63 as int))")).alias("_bits"))


def in_buckets(rows: DataFrame, bucket: Column, words: DataFrame) -> DataFrame:
    """The rows whose bucket is set in ``words`` (each word once), which are broadcast."""
    met = rows.withColumn("_bucket", bucket).join(F.broadcast(words), F.expr("shiftright(_bucket, 6) = _word"))
    return met.where("shiftright(_bits, cast(_bucket & 63 as int)) & 1L = 1L").select(*rows.columns)


def pack_buckets(min_count: int) -> Callable:
    """Rows (_bucket) to rows (_section, _distances): by section, the sorted places of its buckets as distances.

    A place comes as often as its bucket did, at most ``min_count`` times each time a task sorts.
    """
    def sections(buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(buckets, return_counts=True)
        found = np.repeat(found, np.minimum(n, min_count))
        numbers, starts = np.unique(found // SECTION, return_index=True)
        places = [np.diff(x % SECTION, prepend=0).astype("<u2").tobytes() for x in np.split(found, starts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([zlib.compress(x, 1) for x in places], pa.binary())],
                                         ["_section", "_distances"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            rows += batch.num_rows
            if rows >= SORTED_AT_ONCE:
                yield from sections(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield from sections(np.concatenate(held))

    return pack


def full_words(min_count: int) -> Callable:
    """Rows of ``pack_buckets``, in the order of their sections, to the words of the buckets with ``min_count`` rows or more."""
    def words(section: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits = np.packbits(counts >= min_count, bitorder="little").view("<i8")
        at = np.flatnonzero(bits)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at + section * (SECTION // 64), pa.int64()), pa.array(bits[at], pa.int64())], ["_word", "_bits"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        section, counts = None, np.zeros(SECTION, np.int64)
        for batch in batches:
            for number, distances in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != section:
                    if section is not None:
                        yield from words(section, counts)
                    section, counts = number, np.zeros(SECTION, np.int64)
                places = np.cumsum(np.frombuffer(zlib.decompress(distances), "<u2"), dtype=np.int64)
                counts += np.bincount(places, minlength=SECTION)
        if section is not None:
            yield from words(section, counts)

    return full
