"""Distributed row numbering and ntile.

``row_number()``/``ntile()`` over a window with no (or a very hot) partition
key make Spark move the whole window partition into one task.  Here the rows
are range-partitioned on the full sort key instead, so a large window
partition is spread over many tasks:

1. ``repartitionByRange`` on (partition keys, order keys) and sort inside each
   range; the order keys must end in a unique tie-break, so the order is total.
2. position inside a range = ``monotonically_increasing_id`` minus the range
   index shifted by 33 bits (how Spark composes that id).
3. per (range, window key): row count and first position (small: one row per
   range for a global window), turned into offsets by a window over ranges.
4. join the offsets back; ``rn = offset + position - first + 1``.

The numbered rows feed two branches (the per-range counts and the rows
themselves).  Column pruning makes those branches plan separate range
exchanges, and each samples its own boundaries from shuffled input whose row
order is not fixed, so the tagged rows are materialized once with a reliable
``checkpoint()`` in the session's checkpoint folder: both branches read the
same positions, also when an executor is lost and tasks re-run.  Callers pass
narrow frames (sort keys and a unique key), so little is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir


def _sort_exprs(cols) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def row_number(df: DataFrame, order_by, partition_by=(), rn_col: str = "_rn",
               size_col: str | None = None) -> DataFrame:
    """Add ``rn_col`` = row_number() over (partition by ... order by ...).

    ``order_by``: column names (ascending, NULLs first) or sort Columns such as
    ``F.col('x').desc_nulls_last()``; it must end in a unique key.  With
    ``size_col`` the row count of each window partition is added too.
    """
    part = list(partition_by)
    sort = _sort_exprs(part) + _sort_exprs(order_by)
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    pid = F.spark_partition_id()
    tagged = ranged.select(
        "*",
        pid.alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_pos"),
    )
    checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    stats = tagged.groupBy("_pid", *part).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if size_col:
        stats = stats.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*part)))
    stats = stats.drop("_cnt")
    if part:
        cond = tagged["_pid"] == stats["_pid"]
        for c in part:
            cond = cond & tagged[c].eqNullSafe(stats[c])
        joined = tagged.join(stats, cond, "inner").drop(stats["_pid"])
        for c in part:
            joined = joined.drop(stats[c])
    else:
        # one row per range partition: the size bound is the partition count
        joined = tagged.join(F.broadcast(stats), "_pid", "inner")
    out = joined.withColumn(rn_col, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
    return out.drop("_pid", "_pos", "_first", "_before")


def ntile_of(rn: Column, n: Column, k: int) -> Column:
    """SQL ``ntile(k)`` bucket of the rn-th of n rows: the first n % k buckets hold one extra row."""
    q = F.floor(n / F.lit(k)).cast("long")
    r = (n - q * k).cast("long")
    big = q + 1
    small = F.greatest(q, F.lit(1))
    first_part = F.floor((rn - 1) / big).cast("long") + 1
    second_part = r + F.floor((rn - 1 - r * big) / small).cast("long") + 1
    return F.when(rn <= r * big, first_part).otherwise(second_part).cast("long")


def ntile(df: DataFrame, k: int, column: str, out_col: str, key: str, descending: bool = False) -> DataFrame:
    """Add ``out_col`` = ntile(k) over (order by column, key) without a single-task window.

    Ascending with NULLs first, or descending with NULLs last; ``key`` is unique and breaks
    ties.  Only the column and the key are ranked (and written once); the bucket is
    joined back on the key.
    """
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()
    ranked = row_number(df.select(key, column), [order, F.col(key).asc_nulls_first()], rn_col="_nt_rn", size_col="_nt_n")
    buckets = ranked.select(F.col(key).alias("_nt_key"), ntile_of(F.col("_nt_rn"), F.col("_nt_n"), k).alias(out_col))
    return df.join(buckets, df[key].eqNullSafe(buckets["_nt_key"])).drop("_nt_key")


def ntiles(df: DataFrame, key: str, scores) -> DataFrame:
    """Several numeric ntiles of a narrow frame at once: ``scores`` is [(column, k, descending, out_col)].

    Every row is ranked once per score under one (score, value, key) order, so the
    frame is computed and written once; the scores of a key then meet in one group.
    """
    each = [F.struct(
        F.lit(i).alias("_score"), F.when(F.col(c).isNull(), 1 if desc else -1).otherwise(0).alias("_nulls"),
        (F.col(c) * (-1 if desc else 1)).cast("decimal(38,6)").alias("_value")) for i, (c, _, desc, _) in enumerate(scores)]
    long = df.select("*", F.inline(F.array(*each)))
    ranked = row_number(long, ["_nulls", "_value", F.col(key).asc_nulls_first()], partition_by=["_score"],
                        rn_col="_nt_rn", size_col="_nt_n")
    out = [F.max(F.when(F.col("_score") == i, ntile_of(F.col("_nt_rn"), F.col("_nt_n"), k))).alias(name)
           for i, (_, k, _, name) in enumerate(scores)]
    return ranked.groupBy(key).agg(*[F.first(c).alias(c) for c in df.columns if c != key], *out)
