"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers read space + text.  Byte offsets where a token of A and one of B both end
cut the tokens into groups; every A token of a group is linked to every B token of it.

What is known of a byte range (lo, hi] of a text is a ``Fragment``: the tokens that end in
the range up to its first common end (open prefix), the closed groups after it, and the
tokens after the last common end (open suffix).  A range without a common end is open as a
whole.  Putting two neighbouring fragments together joins the left one's suffix with the
right one's prefix into a group; this is associative, so a text may be cut anywhere and its
fragments be composed in any bracketing.

A text of up to ``CHUNK`` characters is one range.  Longer texts are cut into ranges that tasks
tokenize on their own (each reads on to the next safe cut on either side); their fragments are
composed in a tree of FAN by FAN rows across Spark tasks.  A safe cut is before a single
space between two characters that are no white space: neither tokenizer has tokens over it, so
the stretch between two safe cuts is tokenized by itself, and what has been met lately is
looked up.

``align`` then counts in how many documents an id pair is linked (``pair_counts``), and sums
these counts over the links of each document.  The counts of the ``FREQUENT`` most frequent pairs
go to every task (16 bytes each); links of other pairs are joined with the table of pairs.

Defined cases: null and empty texts, and texts that a tokenizer does not give back byte for byte
(such as those with U+2581), have no tokens: zeros and an empty digest.  Rows are kept apart
by their place in a written table, so repeated rows or ids each count as a document.  Ties at
the highest count all count as best.  A stretch without a safe cut, however long, is tokenized in
one piece.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut, worker_cache

#: Characters of a range; a task holds one range's tokens, and FAN composed fragments.
CHUNK = 32_768
FAN = 8
#: Stretches (of one generation) that a worker keeps, and the longest of them in characters.
KEPT = 200_000
KEPT_CHARS = 64
#: Pairs whose counts go to every task.
FREQUENT = 262_144
#: A Latin word with at most one mark after it: two pieces of A's own split, which go straight to its model.
PLAIN = re.compile(" ([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]?)")
#: A's printable letter for a space.
GAP = "\u0120"
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: U+2581 stands for a space in B's pieces, so a text that holds it does not come back.
SPACE_MARK = "▁"


# --- groups and fragments -----------------------------------------------------

NONE = np.zeros(0, np.int32)
Open = tuple[np.ndarray, np.ndarray]


class Groups(NamedTuple):
    """Closed groups in order: the ids of A and B, and how many of each a group has."""
    a: np.ndarray = NONE
    b: np.ndarray = NONE
    a_sizes: np.ndarray = NONE
    b_sizes: np.ndarray = NONE

    def __add__(self, other: Groups) -> Groups:
        return Groups(*map(np.concatenate, zip(self, other)))

    def pairs(self) -> np.ndarray:
        """Linked id pairs (A id << 32 | B id), one by one."""
        group = np.repeat(np.arange(len(self.a_sizes)), self.a_sizes)  # of each A token
        partners = self.b_sizes[group]
        first = (np.cumsum(self.b_sizes) - self.b_sizes)[group]  # its first partner in b
        within = np.arange(partners.sum()) - np.repeat(np.cumsum(partners) - partners, partners)
        return (np.repeat(self.a.astype(np.int64), partners) << 32) | self.b[np.repeat(first, partners) + within]

    def text(self, shown: Shown) -> str:
        """a1,a2|b1;a3|b2,b3"""
        sizes = self.a_sizes + self.b_sizes
        start = np.cumsum(sizes) - sizes
        out = np.empty(len(self.a) + len(self.b), object)
        for ids, counts, begin, last in ((self.a, self.a_sizes, start, shown.bar), (self.b, self.b_sizes, start + self.a_sizes, shown.semicolon)):
            ends = np.cumsum(counts)
            place = np.arange(len(ids)) + np.repeat(begin - (ends - counts), counts)
            out[place] = shown.comma[ids]
            out[place[ends - 1]] = last[ids[ends - 1]]
        return "".join(out.tolist())[:-1]


class Shown:
    """Decimal ids with each of the marks that may follow them."""

    def __init__(self, n: int):
        self.comma, self.bar, self.semicolon = (np.array([f"{k}{mark}" for k in range(n)], object) for mark in ",|;")


class Fragment(NamedTuple):
    """Tokens ending in a byte range. ``split``: it holds a common end; without one all tokens are in prefix."""
    split: bool = False
    prefix: Open = (NONE, NONE)
    closed: Groups = Groups()
    suffix: Open = (NONE, NONE)

    def __add__(self, other: Fragment) -> Fragment:
        if not self.split:
            return Fragment(other.split, _meet(self.prefix, other.prefix), other.closed, other.suffix)
        inner = _meet(self.suffix, other.prefix)
        if not other.split:
            return Fragment(True, self.prefix, self.closed, inner)
        met = Groups(*inner, *[np.array([len(x)], np.int32) for x in inner]) if len(inner[0]) else Groups()
        return Fragment(True, self.prefix, self.closed + met + other.closed, other.suffix)


def _meet(x: Open, y: Open) -> Open:
    return np.concatenate((x[0], y[0])), np.concatenate((x[1], y[1]))


#: A common end and nothing else: the start of a text.
START = Fragment(split=True)


def fragment_of(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of tokens with their end offsets."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(common):
        return Fragment(False, (a, b))
    i, j = np.searchsorted(a_ends, common, "right"), np.searchsorted(b_ends, common, "right")
    closed = Groups(a[i[0]:i[-1]], b[j[0]:j[-1]], np.diff(i).astype(np.int32), np.diff(j).astype(np.int32))
    return Fragment(True, (a[:i[0]], b[:j[0]]), closed, (a[i[-1]:], b[j[-1]:]))


# --- tokenizers ---------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The byte of each printable character of a byte-level vocabulary: itself where printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Two tokenizers and what each of their ids stands for in bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.model = self.a.model.tokenize
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        self.letters, vocabulary = {b: c for c, b in letters.items()}, self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            self.bytes_a[k] = bytes(letters[c] for c in entry)
        self.bytes_b = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace(SPACE_MARK, " ").encode())
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in entries], np.int64) for entries in (self.bytes_a, self.bytes_b))
        self.shown = Shown(max(len(self.bytes_a), len(self.bytes_b)))
        self.met: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}

    def _tokenized(self, some: list[str]):
        """(A ids, B ids) of stretches, which begin with a space, as bytes; None if a stretch's own bytes do not come back."""
        of_a: list = [None] * len(some)
        for k, s in enumerate(some):
            if m := PLAIN.fullmatch(s):
                word = m[1] if m[1].isascii() else "".join([self.letters[b] for b in m[1].encode()])
                of_a[k] = [t.id for t in self.model(f"{GAP}{word}")] + ([t.id for t in self.model(m[2])] if m[2] else [])
        rest = [k for k, ids in enumerate(of_a) if ids is None]
        for k, e in zip(rest, self.a.encode_batch([some[k] for k in rest], add_special_tokens=False)):
            of_a[k] = e.ids
        of_b = self.b.encode([s[1:] for s in some], num_threads=1)
        back_a, back_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for s, a, b in zip(some, of_a, of_b):
            data = s.encode()
            same = SPACE_MARK not in s and b"".join(map(back_a, a)) == data and b"".join(map(back_b, b)) == data
            yield s, (array("i", a).tobytes(), array("i", b).tobytes()) if same else None

    def tokens(self, lists: list[list[str]]) -> list[Open | None]:
        """The ids of texts given as lists of stretches; None where the bytes do not come back."""
        met, before = self.met, self.before
        new, rare = [], {}
        for s in set().union(*lists):
            if s not in met:
                if s in before:
                    met[s] = before[s]
                else:
                    new.append(s)
        for at in range(0, len(new), 2048):
            for s, ids in self._tokenized(new[at:at + 2048]):
                (met if len(s) <= KEPT_CHARS else rare)[s] = ids
        out = []
        for one in lists:
            ids = [met[s] if s in met else rare[s] for s in one]
            out.append(None if None in ids else tuple(np.frombuffer(b"".join([x[k] for x in ids]), np.int32) for k in (0, 1)))
        if len(met) > KEPT:
            self.met, self.before = {}, met
        return out

    def fragment(self, ids: Open, lo: int = 0, hi: int | None = None) -> Fragment:
        """The fragment of those of the tokens that end in (lo, hi]."""
        a, b = ids
        a_ends, b_ends = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        if hi is not None:
            in_a, in_b = (a_ends > lo) & (a_ends <= hi), (b_ends > lo) & (b_ends <= hi)
            a, a_ends, b, b_ends = a[in_a], a_ends[in_a], b[in_b], b_ends[in_b]
        return fragment_of(a, a_ends, b, b_ends)


def stretches(text: str) -> list[str]:
    """Space + text cut at its safe cuts, every stretch with the space it begins with."""
    return [f" {s}" for s in SAFE.split(text)] if text else []


# --- ranges of long texts -----------------------------------------------------

def _cut_before(text: str, at: int) -> int:
    """The last safe cut of ``text`` at or before ``at``, else 0."""
    while at > 0:
        if SAFE.match(text, at):
            return at
        at = text.rfind(" ", 0, at)
    return 0


def ranges(text: str, chunk: int):
    """(context, first, last) of the ranges of space + text: the range covers the context's characters first to last."""
    whole = f" {text}"
    for lo in range(0, len(whole), chunk):
        hi = min(lo + chunk, len(whole))
        begin = _cut_before(whole, lo)
        after = SAFE.search(whole, hi) if hi < len(whole) else None
        yield whole[begin:after.start() if after else len(whole)], lo - begin, hi - begin


def range_fragment(pair: Pair, context: str, first: int, last: int) -> Fragment | None:
    """The fragment of the tokens that end in the range; None if the bytes of a stretch do not come back."""
    ids = pair.tokens([stretches(context[1:])])[0]
    return None if ids is None else pair.fragment(ids, len(context[:first].encode()), len(context[:last].encode()))


# --- Spark ---------------------------------------------------------------------

COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
PARTS = ["prefix_a", "prefix_b", "a", "b", "a_sizes", "b_sizes", "suffix_a", "suffix_b"]
FRAGMENT = "row long, n long, same boolean, split boolean, " + ", ".join(f"{c} array<int>" for c in PARTS)


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _finished(found: list[Groups | None], shown: Shown) -> list[pa.Array]:
    """The columns of COUNTS; None: no tokens."""
    found = [Groups() if g is None else g for g in found]
    pairs, times = zip(*[np.unique(g.pairs(), return_counts=True) for g in found])
    count = lambda name: pa.array([len(getattr(g, name)) for g in found], pa.int64())
    digests = [hashlib.sha256(g.text(shown).encode()).hexdigest() if len(g.a) else "" for g in found]
    return [count("a"), count("b"), count("a_sizes"), pa.array([int(t.sum()) for t in times], pa.int64()), pa.array(digests, pa.string()),
            _lists(list(pairs), pa.int64()), _lists([t.astype(np.int32) for t in times], pa.int32())]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pair(path_a: str, path_b: str) -> Pair:
    return worker_cache(f"align {path_a} {path_b}", lambda: Pair(path_a, path_b))


def _short(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Texts of one range: a fragment each, finished where it is made."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        pair = _pair(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids = pair.tokens([stretches(t) for t in part.column("text").to_pylist()])
                found = [None if x is None else (START + pair.fragment(x)).closed for x in ids]
                yield pa.record_batch([part.column("doc_id"), *_finished(found, pair.shown)], ["doc_id", *_names(COUNTS)])

    return docs.mapInArrow(run, f"doc_id {kind}, {COUNTS}")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Fragments (row, n, fragment or None) as a batch of FRAGMENT."""
    held = [f or Fragment() for _, _, f in rows]
    flat = [[*f.prefix, *f.closed, *f.suffix] for f in held]
    return pa.record_batch([pa.array([r for r, _, _ in rows], pa.int64()), pa.array([n for _, n, _ in rows], pa.int64()),
                            pa.array([f is not None for _, _, f in rows], pa.bool_()), pa.array([f.split for f in held], pa.bool_()),
                            *[_lists([x[k].astype(np.int32) for x in flat], pa.int32()) for k in range(len(PARTS))]], _names(FRAGMENT))


def _fragments(batch) -> list[tuple]:
    """(row, n, fragment or None) of every row of a batch or table of FRAGMENT."""
    columns = [[x.values.to_numpy() for x in batch.column(c)] for c in PARTS]
    out = []
    for k, (row, n, same, split) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("row", "n", "same", "split")])):
        x = [c[k] for c in columns]
        out.append((row, n, Fragment(split, (x[0], x[1]), Groups(*x[2:6]), (x[6], x[7])) if same else None))
    return out


def _long(docs: DataFrame, path_a: str, path_b: str, chunk: int, fan: int) -> DataFrame:
    """Texts of several ranges: tokenized range by range, their fragments composed in a tree."""
    held = cut(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "long-texts")
    longest = held.agg(F.max(F.length("text"))).first()[0] or 0

    def pieces(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                some = []
                for n, (context, first, last) in enumerate(ranges(text.as_py(), chunk)):
                    some.append((row, n, context, first, last))
                    if len(some) == 64:
                        yield piece_batch(some)
                        some = []
                if some:
                    yield piece_batch(some)

    def piece_batch(some):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*some), types)], ["row", "n", "context", "first", "last"])

    def fragments(batches):
        pair = _pair(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                yield _batch([(r["row"], r["n"], range_fragment(pair, r["context"], r["first"], r["last"]))
                              for r in batch.slice(at, 16).to_pylist()])

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(_fragments(table), key=lambda r: r[1])
        out = Fragment()
        for _, _, f in rows:
            out = None if out is None or f is None else out + f
        return pa.Table.from_batches([_batch([(rows[0][0], rows[0][1] // fan, out)])])

    def finish(batches):
        shown = _pair(path_a, path_b).shown
        for batch in batches:
            for row, _, f in _fragments(batch):
                yield pa.record_batch([pa.array([row], pa.int64()), *_finished([None if f is None else (START + f).closed], shown)],
                                      ["row", *_names(COUNTS)])

    cuts = held.select("row", "text").mapInArrow(pieces, "row long, n long, context string, first long, last long")
    out, most = cuts.repartition("row", "n").mapInArrow(fragments, FRAGMENT), -(-(longest + 1) // chunk)
    while most > 1:
        out = out.groupBy("row", F.expr(f"n div {fan}").alias("at")).applyInArrow(compose, FRAGMENT)
        most = -(-most // fan)
    done = out.mapInArrow(finish, f"row long, {COUNTS}").withColumnRenamed("row", "done")
    return held.select("row", "doc_id").join(done, F.col("row") == F.col("done")).select("doc_id", *_names(COUNTS))


def groups(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """row, doc_id, the counts, groups_sha256, and the linked id pairs with how often each is linked; a written table."""
    docs = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    both = _short(docs.where(~is_long), path_a, path_b).union(_long(docs.where(is_long), path_a, path_b, chunk, fan))
    return cut(both.select(F.monotonically_increasing_id().alias("row"), "*"), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair (A id << 32 | B id), n (documents that hold it linked), best (n is the highest of its A id)."""
    counts = cut(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # a row for each id of A's vocabulary at most
    return counts.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    aligned = groups(docs, path_a, path_b, chunk, fan)
    pairs = cut(pair_counts(aligned), "pairs")
    top = pairs.orderBy(F.col("n").desc(), "pair").limit(frequent).toPandas().sort_values("pair")
    kept = aligned.sparkSession.sparkContext.broadcast(
        (top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    carried = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def look_up(batches):
        ids, n, best = kept.value
        ids = np.append(ids, -1)  # no pair: beyond the last
        n, best = np.append(n, 0), np.append(best, False)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes = part.column("pairs").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                ids_here = part.column("pairs").flatten().to_numpy()
                times = part.column("times").flatten().to_numpy().astype(np.int64)
                place = np.searchsorted(ids[:-1], ids_here)
                known = ids[place] == ids_here
                owner = np.repeat(np.arange(part.num_rows), sizes)
                total = np.zeros((2, part.num_rows), np.int64)
                np.add.at(total[0], owner[known], (n[place] * times)[known])
                np.add.at(total[1], owner[known], np.where(best[place], times, 0)[known])
                rest = np.bincount(owner[~known], minlength=part.num_rows)
                offsets = pa.array(np.concatenate(([0], np.cumsum(rest))).astype(np.int32))
                yield pa.record_batch(
                    [*[part.column(c) for c in carried], pa.array(total[0]), pa.array(total[1]),
                     pa.ListArray.from_arrays(offsets, pa.array(ids_here[~known])),
                     pa.ListArray.from_arrays(offsets, pa.array(times[~known]))],
                    [*carried, "sum_kept", "best_kept", "rest", "rest_times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    looked = cut(aligned.mapInArrow(look_up, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                             "sum_kept long, best_kept long, rest array<long>, rest_times array<long>"), "looked-up")
    rest = looked.select("row", F.inline(F.arrays_zip(F.col("rest").alias("link"), F.col("rest_times").alias("times"))))
    more = rest.join(pairs, F.col("link") == F.col("pair")).groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("n") * F.col("times")).alias("sum_rest"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rest"))
    both = looked.drop("rest", "rest_times").join(more, F.col("row") == F.col("_row"), "left")
    return both.select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                       (F.col("best_kept") + F.coalesce("best_rest", F.lit(0))).alias("n_best"),
                       (F.col("sum_kept") + F.coalesce("sum_rest", F.lit(0))).alias("count_sum"), "groups_sha256")
