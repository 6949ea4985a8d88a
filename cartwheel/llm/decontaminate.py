"""Benchmark decontamination by an embedding of edit distance and LSH.

Texts are words: ASCII letters lower-cased, ASCII punctuation read as space.  A document
is contaminated by an item if some passage is within ``1 - SIMILARITY`` of the item's
length in word edits (insert, delete, replace).

1. Places of a document with too few of the items' pairs of neighbouring words cannot be
   within the distance (an edit spoils two pairs at most) and go no further.
2. An item of ``2 * SEGMENT`` words or more is cut into segments of ``SEGMENT`` words or a
   few more, a shorter one is a single segment.  However the edits lie, one segment holds
   at most its share of them, so the distortion of the embedding does not grow with the item.
3. The CGK random walk embeds whole segments, and windows of the segments' exact lengths, one
   from every word of a document: at step j the walk copies the word under it and stays or
   moves on by a random bit of (j, word).  Few edits give few different positions.
4. Repeated bit sampling: a table hashes ``SAMPLED`` random positions of one walk; equal
   hashes make a candidate.  ``WALKS * TABLES`` tables bring recall at the distance limit
   above the target (tests measure it, also for items of 400 words).
5. Candidates whose surroundings hold too few of the item's own word pairs are dropped (also
   lossless); the others are verified exactly: the least number of edits between the whole item and
   any passage around the place of the window, by a bit-parallel automaton.

The benchmark is a query set: it is read in blocks of ``BLOCK_ITEMS`` items, and every
block goes over all documents.  Documents stay in their tasks; nothing is shuffled.

Defined cases: a null text, or one shorter than the windows, matches nothing beyond its
words; items under ``MIN_WORDS`` words match nothing; rows that repeat a document give
repeated rows; items with equal texts each match; empty tables give an empty table.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import worker_cache

SIMILARITY = 0.8
MIN_WORDS = 5
#: Least words of a segment of a cut item.
SEGMENT = 10
WALKS = 8
TABLES = 8
SAMPLED = 4
#: Items of one block; bounds what the driver reads and a worker holds at once.
BLOCK_ITEMS = 2000
#: Windows embedded at a time.
BATCH_WINDOWS = 16384
#: Candidates, and words around candidates, looked at together.
BATCH_CANDIDATES = 1 << 18
BATCH_PASSAGES = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def _table() -> bytes:
    out = bytearray(range(256))
    for c in range(128):
        out[c] = c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32
    return bytes(out)


FOLD = _table()


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


def allowed(n_words: int, similarity: float = SIMILARITY) -> int:
    return int(n_words * (1 - similarity) + 1e-9)


def fewest_edits(pattern: dict[int, int], length: int, text: list[int]) -> int:
    """Least edits between a pattern (bit masks by word) and any passage of the text."""
    mask, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score, best = mask, 0, length, length
    get = pattern.get
    for c in text:
        same = get(c, 0)
        x = same | down
        h = (((same & up) + up) ^ up) | same
        plus, minus = down | ~(h | up), up & h
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
            best = min(best, score)
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(x | plus)) & mask, plus & x & mask
    return best


class Block:
    """The embedded items of one block."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY, seed: int = 0):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item_id, text in items:
            w = words_of(text)
            if len(w) >= MIN_WORDS:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w]))
        self.pad = len(self.vocabulary) + 1
        self.limits = [allowed(len(w), similarity) for w in self.words]
        self.masks = []
        for w in self.words:
            masks: dict[int, int] = {}
            for k, x in enumerate(w.tolist()):
                masks[x] = masks.get(x, 0) | 1 << k
            self.masks.append(masks)
        self.pairs = np.zeros(1 << 22, bool)  # by hash: pairs of neighbouring words that an item holds
        self.own = np.zeros(1 << 22, bool)  # by hash: (item, pair)
        for k, w in enumerate(self.words):
            self.pairs[self._pair(w[:-1], w[1:])] = True
            self.own[self._own(k, self._pair(w[:-1], w[1:]))] = True
        places: dict[int, list[int]] = {}  # items of similar length are looked for in the same places
        classes: dict[int, list[tuple[int, int, int]]] = {}  # segments (item, offset, share of the edits) by length
        for k, w in enumerate(self.words):
            size = MIN_WORDS
            while int(size * 1.2) <= len(w):
                size = int(size * 1.2)
            places.setdefault(size, []).append(k)
            n = max(1, len(w) // SEGMENT)
            cuts = [len(w) * j // n for j in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                classes.setdefault(b - a, []).append((k, a, self.limits[k] // n))
        self.classes = {size: self._class(size, segments, seed) for size, segments in sorted(classes.items())}
        # (reach, pairs held at least, lengths of the segments); an edit spoils two pairs of neighbours at most
        self.places = [(max(len(self.words[k]) + self.limits[k] for k in members),
                        min(len(self.words[k]) - 1 - 2 * self.limits[k] for k in members),
                        {size for size, c in self.classes.items() if not c["items"].isdisjoint(members)})
                       for _, members in sorted(places.items())]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 1_000_003 + right * 7_919) % len(self.pairs)

    def _own(self, item: np.ndarray | int, pair: np.ndarray) -> np.ndarray:
        return (pair + item * 2_654_435_761) & (len(self.own) - 1)

    def _class(self, size: int, segments: list[tuple[int, int, int]], seed: int) -> dict:
        rng = np.random.default_rng((seed, size))
        steps = 2 * size
        share = max(x[2] for x in segments)
        found = {
            "size": size, "reach": size + share, "least": size - 1 - 2 * share, "items": {x[0] for x in segments},
            "bits": rng.integers(0, 2, (WALKS, steps, self.pad + 1), dtype=np.int8),
            "sampled": rng.integers(0, steps, (WALKS, TABLES, SAMPLED)), "tables": []}
        flat = np.concatenate([self.words[k][at:at + size] for k, at, _ in segments])
        starts = np.arange(len(segments)) * size
        members = np.array([x[:2] for x in segments])
        for hashes in self.hashes(flat, starts, starts + size, found):
            order = np.argsort(hashes, kind="stable")
            found["tables"].append((hashes[order], members[order]))
        return found

    def hashes(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: dict):
        """The table hashes of the windows that begin at starts, none going past its end."""
        size = c["size"]
        for walk in range(WALKS):
            at, copied = np.zeros(len(starts), np.int64), []
            for bits in c["bits"][walk]:
                here = starts + at
                word = np.where((at < size) & (here < ends), words[np.minimum(here, len(words) - 1)], self.pad)
                copied.append(word.view(np.uint64))
                at += bits[word]
            for sample in c["sampled"][walk]:
                h = np.zeros(len(starts), np.uint64)
                for j in sample.tolist():
                    h = (h ^ copied[j]) * MIX
                    h ^= h >> np.uint64(31)
                yield h

    def candidates(self, words: np.ndarray, firsts: np.ndarray, ends: np.ndarray):
        """Arrays (word, place, item): at the word a window shares a table hash with a segment of the item, which
        then begins about the place; firsts and ends bound the documents."""
        held = np.zeros(len(words), bool)
        held[:-1] = self.pairs[self._pair(words[:-1], words[1:])] & (words[:-1] > 0) & (words[1:] > 0)
        held[ends[ends > 0] - 1] = False
        held = np.concatenate(([0], np.cumsum(held)))
        end_of = np.repeat(ends, ends - firsts)
        every = np.arange(len(words))
        covered: dict[int, np.ndarray] = {}
        for reach, least, sizes in self.places:
            upto = np.minimum(every + reach, end_of)
            begin = np.nonzero(held[upto] - held[every] >= least)[0]
            if not len(begin):
                continue
            change = np.zeros(len(words) + 1, np.int64)
            change[begin] += 1
            np.subtract.at(change, upto[begin], 1)
            inside = np.cumsum(change[:-1]) > 0
            for size in sizes:
                covered[size] = covered[size] | inside if size in covered else inside
        found, n_found = [], 0
        for size, inside in covered.items():
            c = self.classes[size]
            kept = np.nonzero(inside)[0]
            kept = kept[held[np.minimum(kept + c["reach"], end_of[kept])] - held[kept] >= c["least"]]
            for a in range(0, len(kept), BATCH_WINDOWS):
                start = kept[a:a + BATCH_WINDOWS]
                for h, (keys, segments) in zip(self.hashes(words, start, end_of[start], c), c["tables"]):
                    lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                    hit = np.nonzero(hi > lo)[0]
                    many = hi[hit] - lo[hit]
                    parts = np.nonzero(np.diff(np.cumsum(many) // BATCH_CANDIDATES))[0] + 1
                    for hit, many in zip(np.split(hit, parts), np.split(many, parts)):
                        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - lo[hit], many)
                        word = np.repeat(start[hit], many)
                        found.append((word, word - segments[at, 1], segments[at, 0]))
                        n_found += len(word)
                        if n_found >= BATCH_CANDIDATES:
                            yield tuple(map(np.concatenate, zip(*found)))
                            found, n_found = [], 0
        if found:
            yield tuple(map(np.concatenate, zip(*found)))

    def _holds(self, pair: np.ndarray, item: np.ndarray, first: np.ndarray, end: np.ndarray, lengths: np.ndarray,
               limits: np.ndarray) -> np.ndarray:
        """Whether the words from first to end hold as many of the item's pairs as a passage within the distance must."""
        out = np.zeros(len(item), bool)
        order = np.argsort(end - first)
        at = 0
        while at < len(order):
            wide = int((end - first)[order[min(len(order) - 1, at + 4095)]])
            rows = order[at:at + min(4096, max(1, BATCH_PASSAGES // max(wide, 1)))]
            at += len(rows)
            where = first[rows, None] + np.arange(max(wide - 1, 0))[None, :]
            inside = where < end[rows, None] - 1
            met = pair[np.where(inside, where, 0)] if len(pair) else np.zeros(where.shape, np.int64)
            held = inside & (met >= 0) & self.own[self._own(item[rows, None], met)]
            out[rows] = held.sum(axis=1) >= lengths[item[rows]] - 1 - 2 * limits[item[rows]]
        return out

    def matches(self, texts: list[str | None]) -> list[tuple[int, object, int, int]]:
        """(text, item id, words of the item, edits) of every contaminated text and item."""
        get = self.vocabulary.get
        ids = [[get(w, 0) for w in words_of(t)] for t in texts]
        ends = np.cumsum([len(x) for x in ids])
        if not self.words or not len(ends) or not ends[-1]:
            return []
        flat = np.array([x for one in ids for x in one], np.int64)
        firsts = np.concatenate(([0], ends[:-1]))
        pair = np.where((flat[:-1] > 0) & (flat[1:] > 0), self._pair(flat[:-1], flat[1:]), -1)
        limits, lengths = np.array(self.limits), np.array([len(w) for w in self.words])
        span = len(flat) + 2 * int(lengths.max())  # places lie less than this apart
        best: dict[tuple[int, int], int] = {}
        seen = set()
        for word, start, item in self.candidates(flat, firsts, ends):
            doc, limit, n = np.searchsorted(ends, word, "right"), limits[item], lengths[item]
            near = np.maximum(limit, 1)  # places next to each other are verified at once
            start = start - start % near
            _, one = np.unique((doc * len(limits) + item) * span + start, return_index=True)
            places = np.stack([
                doc, item, np.maximum(firsts[doc], start - limit), np.minimum(ends[doc], start + near + n + 2 * limit)])[:, one]
            for doc, item, a, b in places[:, self._holds(pair, *places[1:], lengths, limits)].T.tolist():
                if (doc, item, a, b) in seen or best.get((doc, item)) == 0:
                    continue
                seen.add((doc, item, a, b))
                edits = fewest_edits(self.masks[item], len(self.words[item]), flat[a:b].tolist())
                if edits <= self.limits[item]:
                    best[doc, item] = min(edits, best.get((doc, item), edits))
        return [(doc, self.ids[item], len(self.words[item]), edits) for (doc, item), edits in sorted(best.items())]


def _blocks(benchmark: DataFrame):
    """The items with a text, BLOCK_ITEMS at a time."""
    held: list[tuple] = []
    for r in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        held.append((r["item_id"], r["text"]))
        if len(held) == BLOCK_ITEMS:
            yield held
            held = []
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, item_words and n_edits for every document row and item within the distance."""
    docs = docs.select("doc_id", "text")
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, item_words long, n_edits long"
    out = docs.sparkSession.createDataFrame([], schema)

    def against(items: list[tuple]) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches):
            block = worker_cache(f"benchmark {name}", lambda: Block(items, similarity))
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    found = block.matches(part.column("text").to_pylist())
                    rows = pa.array([f[0] for f in found], pa.int64())
                    yield pa.record_batch([part.column("doc_id").take(rows),
                                           *(pa.array([f[k] for f in found], t) for k, t in ((1, item_type), (2, pa.int64()), (3, pa.int64())))],
                                          ["doc_id", "item_id", "item_words", "n_edits"])

        return docs.mapInArrow(run, schema)

    item_type = pa.string() if kinds[1] == "string" else pa.int64() if kinds[1] == "bigint" else pa.int32()
    for items in _blocks(benchmark):
        out = out.union(against(items))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows whose text is contaminated.

    Every row is judged by its own text where it lies: no join by doc_id, so rows that share one,
    or lack one, neither drop nor keep each other, and no column name can clash.
    """
    def against(items: list[tuple]):
        name = uuid.uuid4().hex

        def run(batches):
            block = worker_cache(f"benchmark {name}", lambda: Block(items, similarity))
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    hit = np.zeros(part.num_rows, bool)
                    hit[[f[0] for f in block.matches(part.column(text).to_pylist())]] = True
                    yield part.filter(pa.array(~hit))

        return run

    text = next(k for k, c in enumerate(docs.columns) if c == "text")
    for items in _blocks(benchmark):
        docs = docs.mapInArrow(against(items), docs.schema)
    return docs
