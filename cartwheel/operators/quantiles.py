"""Global ntile by its edges: no row is sorted, moved or written.

The bucket of a row follows from comparing it with k - 1 edge rows, the last rows of the
buckets before the last.  The edges are found by exact counting, each step over a smaller part:

1. rows, least and greatest value (one row a score);
2. rows by value bin (``BINS`` equal widths): the bin that holds each edge rank;
3. inside those bins, rows by value: the value of each edge;
4. rows tied at an edge value, by bins of the key, ``KEY_ROUNDS`` times, each inside the bin found
   before: the ties may be most of the table, and keys need not be dense;
5. the few tied rows of the last bin are numbered by key: the edge row itself.

Only counts are shuffled, combined map-side, so a value that a third of all rows share costs
one row a task.  Everything is one lazy plan: nothing runs while planning, nothing is written,
and a lost executor repeats tasks.  The edges reach the rows as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1 << 16
KEY_ROUNDS = 2
_VALUE = "decimal(38,6)"


def _value(df: DataFrame, column: str) -> Column:
    """The column as an exact number in its own order."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp_ltz"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, T.IntegralType) and not (isinstance(kind, T.DecimalType) and kind.scale <= 6):
        raise TypeError(f"{column}: {kind.simpleString()} has no exact bins, use ranking.ntile")
    return c.cast(_VALUE)


def _bin(x: Column, low: Column, high: Column) -> Column:
    """Bin of x between low and high, never falling as x grows; null is before all."""
    width = (high - low).cast("double")
    at = F.try_divide((x - low).cast("double"), width) * (BINS - 1)
    return F.when(x.isNull(), -1).otherwise(F.coalesce(F.floor(at), F.lit(0))).cast("int")


def _holding(rows: DataFrame, place: list[str], at: list[str], *more: Column) -> DataFrame:
    """Of the rows of every ``place``, counted by ``at`` and laid end to end in its order, those counts that hold a wanted rank.

    ``wants`` of a place is its (tile, rank) list; it comes back as the ranks inside what holds them.
    """
    counts = rows.groupBy(*place, "wants", *at).agg(F.count(F.lit(1)).alias("_n"), *more)
    w = Window.partitionBy(*place, "wants").orderBy(*[F.col(c).asc_nulls_first() for c in at])
    laid = counts.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))
    here = F.filter("wants", lambda x: (x["rank"] > F.col("_before")) & (x["rank"] <= F.col("_before") + F.col("_n")))
    inside = F.transform(here, lambda x: F.struct(x["tile"].alias("tile"), (x["rank"] - F.col("_before")).alias("rank")))
    return laid.withColumn("wants", inside).where(F.size("wants") > 0).drop("_n", "_before")


def _meet(long: DataFrame, marks: DataFrame, by: list[str], *also: Column) -> DataFrame:
    """The rows of ``long`` in a place of ``marks``: at most k - 1 places a score, so they are broadcast."""
    named = marks.select(*[F.col(c).alias(f"_m_{c}") if c in by else c for c in marks.columns])
    same = F.lit(True)
    for c in by:
        same = same & (F.col(c) == F.col(f"_m_{c}"))
    for c in also:
        same = same & c
    return long.join(F.broadcast(named), same).drop(*[f"_m_{c}" for c in by])


def edge_rows(long: DataFrame, tiles: dict[int, int]) -> DataFrame:
    """(score, nulls, value, key, wants) of the rows at bucket ends; ``wants`` lists the tiles that end there.

    ``long``: rows (score, nulls, value, key), ordered by the last three inside a score; ``tiles``: k by score.
    Every step reads ``long`` once and the step before once, so the plan grows by one scan a step.
    """
    value = F.when(F.col("nulls") == 0, F.col("value"))
    k = F.coalesce(*[F.when(F.col("score") == s, F.lit(n)) for s, n in tiles.items()]).cast("long")
    span = long.groupBy("score").agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_rows"))
    last = lambda j: (j * F.floor(F.col("_rows") / F.col("_k")) + F.least(j, F.col("_rows") % F.col("_k"))).cast("long")
    span = span.withColumn("_k", k).where("_k > 1").select("score", "_low", "_high", F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("_k") - 1), lambda j: F.struct(j.alias("tile"), last(j).alias("rank"))).alias("wants"))

    of_value = F.when(F.col("nulls") < 0, -2).when(F.col("nulls") > 0, BINS).otherwise(_bin(F.col("value"), F.col("_low"), F.col("_high")))
    marks = _holding(_meet(long, span, ["score"]).withColumn("bin", of_value), ["score", "_low", "_high"], ["bin"])

    marks = _holding(_meet(long, marks, ["score"], of_value == F.col("bin")), ["score", "bin"], ["nulls", "value"],
                     F.min("key").alias("low_0"), F.max("key").alias("high_0")).drop("bin")

    by, parts, found = ["score", "nulls", "value"], [], []
    key = F.col("key").cast("decimal(20,0)")
    for step in range(KEY_ROUNDS):
        low, high = f"low_{step}", f"high_{step}"
        part = _bin(key, F.col(low).cast("decimal(20,0)"), F.col(high).cast("decimal(20,0)"))
        parts += [low, high]
        marks = _holding(_meet(long, marks, by, *found).withColumn(f"part_{step}", part), [*by, *parts], [f"part_{step}"],
                         F.min("key").alias(f"low_{step + 1}"), F.max("key").alias(f"high_{step + 1}"))
        parts.append(f"part_{step}")
        found.append(part == F.col(f"part_{step}"))
    return _holding(_meet(long, marks, by, *found), [*by, *parts], ["key"]).select(*by, "key", "wants")


def ntiles(df: DataFrame, key: str, scores) -> DataFrame:
    """Add several global ntiles at once: ``scores`` is [(column, k, descending, out_col)].

    Each is ntile(k) over (order by column, key): ascending with nulls first, or descending with
    nulls last.  Columns are whole numbers, decimals of at most 6 places, dates or timestamps;
    ``key`` is a whole number, unique (rows with equal keys and values share a bucket; a null
    key is before all).  With fewer rows than buckets the last ones stay empty; an empty table gives an empty table.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key}: the key must be a whole number, use ranking.ntile")

    def order(column: str, descending: bool) -> Column:
        value = _value(df, column)
        return F.struct(
            F.when(value.isNull(), 1 if descending else -1).otherwise(0).alias("nulls"),
            F.coalesce(-value if descending else value, F.lit(0)).cast(_VALUE).alias("value"), F.col(key).cast("long").alias("key"))

    places = [order(c, desc) for c, _, desc, _ in scores]
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("score"), p["nulls"].alias("nulls"), p["value"].alias("value"), p["key"].alias("key"))
        for i, p in enumerate(places)])))
    edges = edge_rows(long, {i: k for i, (_, k, _, _) in enumerate(scores)})
    named = {(i, j): f"e{i}_{j}" for i, (_, k, _, _) in enumerate(scores) for j in range(1, k)}
    parts = ("nulls", "value", "key")
    one = F.lit(None)
    if named:
        at = {e: (F.col("score") == e[0]) & F.array_contains(F.col("wants.tile"), F.lit(e[1]).cast("long")) for e in named}
        row = edges.agg(*[F.max(F.when(at[e], F.col(p))).alias(f"{n}_{p}") for e, n in named.items() for p in parts])
        one = row.select(F.struct(*[F.struct(*[F.col(f"{n}_{p}").alias(p) for p in parts]).alias(n) for n in named.values()]).alias("edges")).scalar()
    # a column of its own: named once in the plan, the subquery is planned and run once
    edge = "_ntile_edges"
    tiles = [F.lit(1).cast("long") + sum(((places[i] > F.col(edge)[named[i, j]]).cast("long") for j in range(1, k)), F.lit(0))
             for i, (_, k, _, _) in enumerate(scores)]
    return df.withColumn(edge, one).select(*df.columns, *[t.alias(name) for t, (_, _, _, name) in zip(tiles, scores)])


def ntile(df: DataFrame, k: int, column: str, out_col: str, key: str, descending: bool = False) -> DataFrame:
    """Add ``out_col`` = ntile(k) over (order by column, key); see ``ntiles``."""
    return ntiles(df, key, [(column, k, descending, out_col)])
