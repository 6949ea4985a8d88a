"""SimHash near-duplicates with anchor points of a covering code.

Fingerprints have 64 bits.  The bits are split into ``PARTS`` parts; two fingerprints
that differ in at most ``distance`` bits differ in at most ``distance // PARTS`` bits of
one part.  The anchors of a part are the 4096 words of the perfect binary Golay code
of length 23 (shorter parts are padded with zeros): every part lies within the
covering radius 3 of exactly one anchor, its own, and is replicated to every anchor within
radius plus the part's threshold.  Of two linked fingerprints one then meets the
other at the other's own anchor, where the full 64 bits are compared.

Equal fingerprints are one node, so exact copies never multiply.  An anchor with
more than ``block`` fingerprints is cut into a grid of blocks, each pair of blocks
compared in its own group; a group reports one link per fingerprint and local
component, not its pairs.

Defined cases: a null text has no words and fingerprint zero, linked like any
other; a text of one to three words has its whole word sequence as its only
shingle; rows that repeat a document give equal rows; a null ``doc_id`` never
names a component that has another id (its ``component_id`` is null only if all
ids of the component are null); an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut, unused, worker_cache
from cartwheel.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCK = 1024
#: (first bit, bits) of each part.
PARTS = ((0, 22), (22, 21), (43, 21))
RADIUS = 3
#: Generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 values of the word shingles."""
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        ones += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the signed 64-bit fingerprint and the columns ``others`` of every row."""
    def run(batches):
        for batch in batches:
            out = [fingerprint(t.encode().lower().split() if t else [], shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64)), *batch.columns[2:]],
                                  ["doc_id", "fp", *others])

    docs = docs.select("doc_id", "text", *others)
    kinds = [f"{name} {docs.schema[name].dataType.simpleString()}" for name in others]
    return docs.mapInArrow(run, ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long", *kinds]))


def golay_tables(threshold: int):
    """For every 23-bit syndrome: the offsets from a word to the code words within RADIUS + threshold.

    The code is linear, so the code words near w are w ^ e for the errors e of weight at
    most RADIUS + threshold that have w's syndrome.
    """
    def syndrome(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for k in range(22, 10, -1):
            x = np.where(x >> k & 1, x ^ (GOLAY << (k - 11)), x)
        return x

    errors = [np.zeros(1, np.int64)]
    for _ in range(RADIUS + threshold):
        grown = (errors[-1][:, None] | (1 << np.arange(23))[None, :]).ravel()
        errors.append(np.unique(grown[np.bitwise_count(grown) > np.bitwise_count(errors[-1][0])]))
    every = np.concatenate(errors)
    s = syndrome(every)
    order = np.argsort(s, kind="stable")
    first = np.searchsorted(s[order], np.arange(2049))
    return syndrome, every[order], first


def anchors(fps: np.ndarray, part: int, distance: int = DISTANCE):
    """(index of the fingerprint, anchor, is its own) for one part."""
    threshold = distance // len(PARTS)
    syndrome, errors, first = worker_cache(f"golay{threshold}", lambda: golay_tables(threshold))
    at, bits = PARTS[part]
    words = (fps >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)
    s = syndrome(words)
    n = first[s + 1] - first[s]
    index = np.repeat(np.arange(len(fps)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    e = errors[np.repeat(first[s], n) + offset]
    return index, words[index] ^ e, np.bitwise_count(e) <= RADIUS


def _replicas(distinct: DataFrame, distance: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in range(len(PARTS)):
                index, anchor, own = anchors(signed.view(np.uint64), part, distance)
                yield pa.record_batch([pa.array((anchor * len(PARTS) + part).astype(np.int32)),
                                       pa.array(signed[index]), pa.array(own)], ["anchor", "fp", "own"])

    return distinct.select("fp").mapInArrow(run, "anchor int, fp long, own boolean")


def _dealt(replicas: DataFrame, block: int) -> DataFrame:
    """Rows (anchor, i, j, fp, left, right): left rows are compared with right rows of a group.

    The table of hot anchors has at most 3 x 4096 rows whatever the input, so it is broadcast.
    """
    hot = replicas.groupBy("anchor").agg(F.count_if("own").alias("own_n"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") > block).select("anchor", F.ceil(F.col("own_n") / block).cast("int").alias("ki"),
                                   F.ceil(F.col("n") / block).cast("int").alias("kj"))
    met = replicas.join(F.broadcast(hot), "anchor", "left")
    i = F.pmod(F.xxhash64("fp", F.lit(1)), F.greatest("ki", F.lit(1))).cast("int")
    j = F.pmod(F.xxhash64("fp", F.lit(2)), F.col("kj")).cast("int")
    upto = lambda k: F.sequence(F.lit(0), F.greatest(F.col(k), F.lit(1)) - 1)
    cold = met.where("kj is null").select("anchor", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp",
                                          F.col("own").alias("left"), F.lit(True).alias("right"))
    left = met.where("kj is not null and own").select("anchor", i.alias("i"), F.explode(upto("kj")).alias("j"), "fp",
                                                      F.lit(True).alias("left"), F.lit(False).alias("right"))
    right = met.where("kj is not null").select("anchor", F.explode(upto("ki")).alias("i"), j.alias("j"), "fp",
                                               F.lit(False).alias("left"), F.lit(True).alias("right"))
    return cold.union(left).union(right)


def stars(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least fingerprint of its component) among the left-right pairs within distance."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    li, ri = at[:len(left)], at[len(left):]
    u, v = [], []
    for a in range(0, len(left), 256):
        near = np.bitwise_count((left[a:a + 256, None] ^ right[None, :]).view(np.uint64)) <= distance
        x, y = np.nonzero(near)
        x, y = li[a + x], ri[y]
        u.append(x[x != y]), v.append(y[x != y])
    u, v = np.concatenate(u) if u else np.zeros(0, int), np.concatenate(v) if v else np.zeros(0, int)
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links between distinct fingerprints whose components are those of all pairs within distance."""
    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy()
        left, right = (table.column(c).to_numpy() for c in ("left", "right"))
        u, v = stars(fp[left], fp[right], distance)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    dealt = _dealt(cut(_replicas(distinct, distance), "replicas"), block)
    return dealt.groupBy("anchor", "i", "j").applyInArrow(compare, "u long, v long")


def _rooted(every: DataFrame, distance: int, block: int) -> DataFrame:
    """(fp, first_id, root) of every distinct fingerprint; root is the least fingerprint of its component."""
    distinct = cut(every.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct, distance, block))
    return cut(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least doc_id reachable over links."""
    every = cut(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(every, distance, block)
    # written, so that the join deals out both sides itself and can split a large component
    least = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return every.join(named, every["fp"] == named["_fp"]).drop("_fp")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """One row of every component of ``docs``: the one with the smallest doc_id.

    A row without a doc_id stays only if no document with one is in its component.  Rows are
    told apart by a digest of all their columns, so rows that share a doc_id, or lack one, are
    kept or dropped by their own component; of those in one component the least digest stays.
    """
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, F.unhex(F.sha2(F.to_json(F.struct(*docs.columns)), 256)))
    every = cut(fingerprints(keyed, shingle, (row,)), "fingerprints")
    rooted = _rooted(every, distance, block).select(F.col("fp").alias("_fp"), "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", row))
    kept = cut(every.join(rooted, every["fp"] == rooted["_fp"]).groupBy("root").agg(first.alias("first")).select(
        F.col("first")[row].alias(row)), "kept")
    return keyed.join(kept, row, "left_semi").dropDuplicates([row]).drop(row)
