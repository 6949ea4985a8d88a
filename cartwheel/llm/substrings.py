"""Substring dedup: repeated windows of words found behind a count-min prefilter.

A window is ``window`` consecutive words of one document.  Its signature is the
least hash of its ``GRAM``-word pieces; equal windows have equal signatures, and
neighbouring windows mostly share one, so a document has few of them.

1. Every task sketches the signatures of its documents (each once a document) into
   the cells of a count-min sketch; the sparse partition sketches are merged by a
   sum.  A window's estimate is the least of its cells, never under the number of
   documents that hold it.
2. The cells counted twice or more become a bitmap.  Its size is set by the text
   bytes and bounded by ``MAX_LOG2_WIDTH`` (``ROWS * 2**MAX_LOG2_WIDTH / 8`` bytes);
   beyond that bound the filter lets more windows through and still loses none.
3. Documents with a window estimated repeated are suspects and are stored.  Only
   their estimated windows are grouped, by 96 bits of XXH3-128 over the words
   themselves (two different windows among 10^13 share them with a chance under
   1 in 1000), with the least doc_id as the only state of a group.
4. The other documents are finished in place: their text never crosses the network.

Defined cases: a null text has no words; shorter texts than a window lose nothing;
rows that repeat a doc_id are not smaller than each other, so both stay whole
unless a smaller id holds the window; a row without a doc_id neither takes nor loses
words; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut

WINDOW = 50
GRAM = 25
ROWS = 2
MAX_LOG2_WIDTH = 31
#: Cells of a partition sketch held before they are handed over.
HELD_CELLS = 1 << 21
#: Windows in a batch that goes back to Spark.
BATCH_WINDOWS = 1 << 17
#: Odd multipliers: the polynomial base and its inverse, the mixer, and one for each sketch row.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
MIX = 0xBF58476D1CE4E5B9
ROW_KEYS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def signatures(texts: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all windows of the documents, and the number of windows of each document."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    gram = min(GRAM, window)
    counts = np.maximum(lengths - window + 1, 0)
    total = int(lengths.sum())
    if not counts.any():
        return np.zeros(0, np.uint64), counts
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for t in texts for w in t), np.uint64, total)
    up, down = np.full(total, BASE, np.uint64), np.full(total, UNBASE, np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * down, dtype=np.uint64)))
    g = (sums[gram:] - sums[:-gram]) * up[:total - gram + 1]
    g = (g ^ (g >> np.uint64(29))) * np.uint64(MIX)
    g ^= g >> np.uint64(32)
    span, width = window - gram + 1, 1
    while width * 2 <= span:  # least of ever longer runs
        g = np.minimum(g[:-width], g[width:])
        width *= 2
    if span > width:
        g = np.minimum(g[:-(span - width)], g[span - width:])
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(firsts, counts)
    return g[index], counts


def cells(signature: np.ndarray, log2_width: int) -> np.ndarray:
    """The sketch cells of signatures, one row of the result for each row of the sketch."""
    shift = np.uint64(64 - log2_width)
    return np.stack([(signature * np.uint64(k) >> shift) + np.uint64(r << log2_width) for r, k in enumerate(ROW_KEYS)])


def _words(batch) -> list[list[bytes]]:
    return [t.encode().split() if t else [] for t in batch.column("text").to_pylist()]


def _sketch(docs: DataFrame, window: int, log2_width: int) -> DataFrame:
    """(cell, n): the merged sketch."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sig, counts = signatures(_words(batch.slice(at, 512)), window)
                doc = np.repeat(np.arange(len(counts)), counts)
                new = np.ones(len(sig), bool)
                new[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
                sig, doc = sig[new], doc[new]
                order = np.lexsort((sig, doc))
                sig, doc = sig[order], doc[order]
                new = np.ones(len(sig), bool)
                new[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
                held.append(cells(sig[new], log2_width).ravel())
                size += len(held[-1])
                if size >= HELD_CELLS:
                    yield _counted(held)
                    held, size = [], 0
        if held:
            yield _counted(held)

    return docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    cell, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.record_batch([pa.array(cell.astype(np.int64)), pa.array(n.astype(np.int64))], ["cell", "n"])


def _bitmap(sketch: DataFrame, log2_width: int) -> np.ndarray:
    """Bits of the cells counted twice or more; built in chunks by Spark, at most ROWS * 2**log2_width / 8 bytes."""
    low = 1 << 16

    def pack(table: pa.Table) -> pa.Table:
        cell = table.column("cell").to_numpy()
        bits = np.zeros(low, bool)
        bits[cell % low] = True
        return pa.table({"chunk": pa.array([int(cell[0]) // low]), "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    repeated = sketch.where("n >= 2").select("cell", F.floor(F.col("cell") / low).alias("chunk"))
    chunks = repeated.groupBy("chunk").applyInArrow(pack, "chunk long, bits binary")
    out = np.zeros(max(ROWS << log2_width, low) // 8, np.uint8)
    for row in chunks.toLocalIterator():
        at = row["chunk"] * low // 8
        out[at:at + low // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _repeated(sig: np.ndarray, bitmap: np.ndarray, log2_width: int) -> np.ndarray:
    """Whether the windows are estimated repeated."""
    out = np.ones(len(sig), bool)
    for c in cells(sig, log2_width):
        out &= (bitmap[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _estimated(words: list[list[bytes]], bits: np.ndarray, window: int, log2_width: int) -> list[np.ndarray]:
    """For every document the starts of its windows that are estimated repeated."""
    sig, counts = signatures(words, window)
    hit = np.nonzero(_repeated(sig, bits, log2_width))[0]
    ends = np.cumsum(counts)
    return [part - (end - n) for part, end, n in zip(np.split(hit, np.searchsorted(hit, ends))[:-1], ends, counts)]


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, for every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.select(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    log2_width = min(MAX_LOG2_WIDTH, max(16, math.ceil(math.log2(size + 1)) - 2))
    shared = spark.sparkContext.broadcast(_bitmap(_sketch(docs, window, log2_width), log2_width))

    def suspects(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                starts = _estimated(_words(part), shared.value, window, log2_width)
                yield part.filter(pa.array([len(s) > 0 for s in starts]))

    def finished(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words = _words(part)
                clean = np.array([not len(s) for s in _estimated(words, shared.value, window, log2_width)])
                kept = [w for w, c in zip(words, clean) if c]
                yield pa.record_batch([part.column("doc_id").filter(pa.array(clean)), pa.array([len(w) for w in kept], pa.int64()),
                                       pa.array([0] * len(kept), pa.int64()),
                                       pa.array([b" ".join(w).decode() for w in kept], pa.string())],
                                      ["doc_id", "n_words", "n_removed", "kept"])

    def windows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                words = _words(part)
                starts = _estimated(words, shared.value, window, log2_width)
                rows, digests = [], []
                for row, (w, found) in enumerate(zip(words, starts)):
                    joined = b" ".join(w)
                    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
                    begins = np.concatenate(([0], ends[:-1] + 1))[found].tolist()
                    digests += [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(begins, ends[found + window - 1].tolist())]
                    rows.append(np.full(len(found), row))
                if digests:
                    keys = np.frombuffer(b"".join(digests), np.dtype([("k1", "<i8"), ("k2", "<i4"), ("rest", "<i4")]))
                    row, start = np.concatenate(rows), np.concatenate(starts).astype(np.int32)
                    for a in range(0, len(row), BATCH_WINDOWS):
                        b = a + BATCH_WINDOWS
                        at_rows = pa.array(row[a:b])
                        yield pa.record_batch([part.column("row").take(at_rows), part.column("doc_id").take(at_rows), pa.array(start[a:b]),
                                               pa.array(keys["k1"][a:b]), pa.array(keys["k2"][a:b])],
                                              ["row", "doc_id", "start", "k1", "k2"])

    def removed(batches):
        for batch in batches:
            ids, n_words, n_removed, kept = batch.column("doc_id"), [], [], []
            for w, found in zip(_words(batch), batch.column("starts").to_pylist()):
                gone = np.zeros(len(w) + 1, np.int64)
                s = np.array(found or [], np.int64)
                np.add.at(gone, s, 1)
                np.add.at(gone, s + window, -1)
                stay = np.cumsum(gone)[:-1] == 0
                n_words.append(len(w)), n_removed.append(int(len(w) - stay.sum()))
                kept.append(b" ".join([x for x, y in zip(w, stay.tolist()) if y]).decode())
            yield pa.record_batch([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                  ["doc_id", "n_words", "n_removed", "kept"])

    out = f"doc_id {kind}, n_words long, n_removed long, kept string"
    found = docs.mapInArrow(suspects, f"doc_id {kind}, text string").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = cut(found, "suspects")
    every = found.mapInArrow(windows, f"row long, doc_id {kind}, start int, k1 long, k2 int")
    least = every.groupBy("k1", "k2").agg(F.min("doc_id").alias("least")).select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "least")
    later = every.join(least, (every["k1"] == least["_k1"]) & (every["k2"] == least["_k2"])).where("doc_id > least")
    starts = later.groupBy(F.col("row").alias("_row")).agg(F.collect_list("start").alias("starts"))
    touched = found.join(starts, found["row"] == starts["_row"], "left").select("doc_id", "text", "starts")
    return docs.mapInArrow(finished, out).union(touched.mapInArrow(removed, out))
