"""Sharding by balanced label propagation; the law kept is ``bytes`` (sizes near equal).

Documents with equal texts are linked through their group.  Documents start in a shard by
their id; then, round by round, Spark counts the bytes of every group by shard, sends
each document towards the shard that holds most of its group among those with room, and
admits movers into a shard up to the room left and, from another shard, up to the opposite flow.
Admission needs no global sort: movers are counted by priority band (a small table),
and the bands that fit move.  A group larger than a shard fills one and spills into
the next.

Documents without a link then fill every shard up to its share: they are laid end to
end, in bands of a hash, and cut where the shares end.

Defined cases: a null text is empty, has size 1 and belongs to the group of empty
texts; rows that repeat a document are linked like other equal texts and ordered by
a row number; a null ``doc_id`` is sharded like any other; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import cut

SHARDS = 16
ROUNDS = 8
#: Bands of a hash: admission and numbering work band by band.
BANDS = 1024
LAW = "bytes"


def band(*of: str) -> Column:
    return F.pmod(F.xxhash64(*of, F.lit("band")), F.lit(BANDS)).cast("int")


def _running(bands: DataFrame, value: str, out: str, by: list[str]) -> DataFrame:
    """Sum of ``value`` over the earlier bands; one row a band (and shard)."""
    w = Window.orderBy("band") if not by else Window.partitionBy(*by).orderBy("band")
    return bands.withColumn(out, F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _propagate(linked: DataFrame, share: int, shards: int) -> DataFrame:
    """One round over (row, group, size, shard)."""
    load = linked.groupBy("shard").agg(F.sum("size").alias("load"))
    room = linked.sparkSession.range(shards).select(F.col("id").cast("int").alias("_at")).join(
        load, F.col("_at") == F.col("shard"), "left").select("_at", (F.lit(share) - F.coalesce("load", F.lit(0))).alias("room"))
    room = F.broadcast(room)  # one row a shard
    tally = linked.groupBy("group", "shard").agg(F.sum("size").alias("held"))
    # what a group holds where; ties go to a shard by a hash, so that flows in both directions balance
    weight = F.struct("held", F.xxhash64("group", "shard").alias("tie"), "shard")
    tally = cut(tally.select("group", "shard", weight.alias("weight")), "tally")
    best = tally.join(room, F.col("shard") == F.col("_at")).groupBy(F.col("group").alias("_group")).agg(
        F.max(F.when(F.col("room") > share // 8, F.col("weight"))).alias("open"), F.max("weight").alias("top"))
    # rows go where more of their group is: to a shard with room, else to the one with most (by exchange)
    goal = F.when(F.col("open") > F.col("weight"), F.col("open")).when(F.col("top") > F.col("weight"), F.col("top"))
    wanted = tally.join(best, F.col("group") == F.col("_group")).select(
        "_group", F.col("shard").alias("_shard"), goal["shard"].alias("target")).where("target is not null")
    asked = linked.join(wanted, (F.col("group") == F.col("_group")) & (F.col("shard") == F.col("_shard")), "left").select(
        "row", "group", "size", "shard", F.coalesce("target", "shard").alias("target"), band("group", "row").alias("band"))
    bands = asked.where("shard <> target").groupBy("shard", "target", "band").agg(F.sum("size").alias("asked"))
    flow = bands.groupBy("shard", "target").agg(F.sum("asked").alias("flow"))  # at most shards x shards rows
    back = flow.select(F.col("target").alias("_from"), F.col("shard").alias("_to"), F.col("flow").alias("back"))
    swap = flow.join(F.broadcast(back), (F.col("shard") == F.col("_from")) & (F.col("target") == F.col("_to"))).select(
        F.col("shard").alias("_s"), F.col("target").alias("_t"), F.least("flow", "back").alias("quota"))
    swapped = _running(bands, "asked", "before", ["shard", "target"]).join(
        F.broadcast(swap), (F.col("shard") == F.col("_s")) & (F.col("target") == F.col("_t"))).where(
        "before + asked <= quota").select("_s", "_t", F.col("band").alias("_band"))  # at most shards x shards x BANDS rows
    entering = bands.groupBy("target", "band").agg(F.sum("asked").alias("asked"))
    entered = _running(entering, "asked", "before", ["target"]).join(room, F.col("target") == F.col("_at")).where(
        "before + asked <= room").select(F.col("target").alias("_rt"), F.col("band").alias("_rb"))  # at most shards x BANDS rows
    out = asked.join(F.broadcast(swapped), (F.col("shard") == F.col("_s")) & (F.col("target") == F.col("_t"))
                     & (F.col("band") == F.col("_band")), "left").join(
        F.broadcast(entered), (F.col("target") == F.col("_rt")) & (F.col("band") == F.col("_rb")), "left")
    moves = F.col("_s").isNotNull() | F.col("_rt").isNotNull()
    return out.select("row", "group", "size", F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard"))


def _fill(single: DataFrame, linked: DataFrame, shards: int, total: int) -> DataFrame:
    """(row, shard) of the documents without a link.

    Documents over a hundredth of a share (at most 100 a shard, whatever the input) go one by one,
    largest first, where most is missing.  The others are laid end to end and cut at what is then missing.
    """
    load = {r["shard"]: r["load"] for r in linked.groupBy("shard").agg(F.sum("size").alias("load")).collect()}
    missing = [total / shards - load.get(k, 0) for k in range(shards)]
    large, single = single.where(F.col("size") > total / shards / 100), single.where(F.col("size") <= total / shards / 100)
    dealt = []
    for r in sorted(large.collect(), key=lambda r: (-r["size"], r["row"])):
        k = max(range(shards), key=lambda k: (missing[k], -k))
        missing[k] -= r["size"]
        dealt.append((r["row"], k))
    first = single.sparkSession.createDataFrame(dealt, "row long, shard int")
    free = int(single.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"])
    wanted = [max(0.0, x) for x in missing]
    scale = free / (sum(wanted) or 1)
    edges, at = [], 0.0
    for k in range(shards):
        at += wanted[k] * scale
        edges.append(at)
    single = single.withColumn("band", band("row"))
    before = _running(single.groupBy("band").agg(F.sum("size").alias("size")), "size", "before", []).select(
        F.col("band").alias("_band"), "before")
    inside = Window.partitionBy("band").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = single.withColumn("up", F.sum("size").over(inside)).join(
        F.broadcast(before), F.col("band") == F.col("_band")).withColumn("middle", F.col("before") + F.col("up") - F.col("size") / 2)
    shard = F.lit(shards - 1)
    for k in reversed(range(shards - 1)):
        shard = F.when(F.col("middle") < edges[k], F.lit(k)).otherwise(shard)
    return placed.select("row", shard.alias("shard")).union(first)


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("group"), F.monotonically_increasing_id().alias("row")), "rows")
    total = int(rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"])
    # written, so that the joins below deal out both sides themselves and can split a large group
    groups = cut(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("group").alias("_group")), "groups")
    narrow = rows.select("row", "group", "size")
    first = F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int").alias("shard")
    linked = cut(narrow.join(groups, F.col("group") == F.col("_group")).select("row", "group", "size", first), "linked")
    for _ in range(rounds):
        linked = cut(_propagate(linked, total // shards, shards), "linked")
    single = narrow.join(groups, F.col("group") == F.col("_group"), "left_anti").select("row", "size")
    placed = _fill(single, linked, shards, total).union(linked.select("row", "shard")).select(F.col("row").alias("_row"), "shard")
    placed = cut(rows.join(placed, F.col("row") == F.col("_row")).select("doc_id", "size", "text_crc32", "shard", "row"), "placed")
    return _numbered(placed).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _numbered(placed: DataFrame) -> DataFrame:
    """Slots from 0 in every shard: rows are numbered inside (shard, band), bands by their sizes."""
    placed = placed.withColumn("band", band("row"))
    sizes = placed.groupBy("shard", "band").agg(F.count(F.lit(1)).alias("n"))
    before = _running(sizes, "n", "before", ["shard"]).select(
        F.col("shard").alias("_shard"), F.col("band").alias("_band"), "before")  # at most SHARDS * BANDS rows
    inside = Window.partitionBy("shard", "band").orderBy("row")
    return placed.withColumn("slot", F.row_number().over(inside) - 1).join(
        F.broadcast(before), (F.col("shard") == F.col("_shard")) & (F.col("band") == F.col("_band"))).withColumn(
        "slot", (F.col("slot") + F.col("before")).cast("long"))
