"""Hidden Markov language model trained by Baum-Welch, with an add-one unigram base.

Tokens are lower-cased words and one end a document.  Vocabularies grow with the
corpus, so the model does not emit words but word classes: the most frequent words
have a class each, the others share ``BUCKETS`` classes by their last three characters,
and a word of a shared class follows with its add-one probability within the class.
The likelihood of a text is then exactly

    P(classes under the hidden Markov model) x product of P(word | its class),

the first factor by the scaled forward recursion over the whole text.

Training: word counts are summed by Spark over all training documents; Baum-Welch
expectations are computed by each task over its documents, in pieces of ``PIECE``
tokens, and summed by Spark into one small table (states x classes).  The first
rounds hold the transition matrix at the identity (each document in one state), which
separates the languages; the later rounds are full Baum-Welch.

Scoring: counts of the most frequent words (at most ``HEAD_WORDS``) are broadcast;
the other words of a document are joined with the count table, as (row, word, n).

Defined cases: a null text is empty, so it has just the end; a row without a
``doc_id`` is a training document; rows that repeat a document count each time; an empty
table gives an empty table, and without any training document every probability
falls back to the add-one form.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut

STATES = 8
OWN_CLASSES = 2047
BUCKETS = 1024
CLASSES = OWN_CLASSES + BUCKETS + 1
END = CLASSES - 1
HEAD_WORDS = 1 << 17
PIECE = 256
TIED_ROUNDS = 4
FULL_ROUNDS = 2
#: Pseudo-count of every class in every state, and of every transition.
PRIOR = 0.01
#: Partial counts held by a task before they are handed over.
HELD_WORDS = 200_000
#: Tokens in a batch of the recursions.
BATCH_TOKENS = 200_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def bucket(word: str) -> int:
    return OWN_CLASSES + zlib.crc32(word[-3:].encode()) % BUCKETS


def bucket_column(word: Column) -> Column:
    return (F.crc32(F.right(word, F.lit(3))) % BUCKETS + OWN_CLASSES).cast("int")


# --- word counts --------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the given documents, partial counts first."""
    def run(batches):
        held: dict[bytes, int] = {}
        get = held.get
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(first, 256).to_pylist():
                    for w in text.encode().lower().split() if text else ():
                        held[w] = get(w, 0) + 1
                    if len(held) > HELD_WORDS:
                        yield out(held)
                        held.clear()
        yield out(held)

    def out(held):
        return pa.record_batch([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
                               ["word", "c"])

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_of(vocabulary: DataFrame) -> list[tuple[str, int]]:
    """The most frequent words with their counts, most frequent first: all words above the least
    count (to an eighth of a binary order) that leaves at most HEAD_WORDS of them."""
    level = F.floor(F.log2("c") * 8).cast("int")
    steps = sorted(((r["level"], r["n"]) for r in vocabulary.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, total = None, 0
    for at, n in steps:
        total += n
        if total > HEAD_WORDS:
            break
        least = at
    if least is None:
        return []
    rows = vocabulary.where(level >= least).select("word", "c").collect()
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


# --- the recursions --------------------------------------------------------------

class TimeMajor:
    """Sequences side by side, longest first: step t holds the t-th symbol of the ``active[t]`` sequences that have one."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        steps = int(self.lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(1, steps + 1), side="right")
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        firsts = (np.cumsum(lengths) - lengths)[self.order]
        seq = np.repeat(np.arange(len(lengths)), self.lengths)
        t = np.arange(self.at[-1]) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.symbols = np.empty(self.at[-1], np.int64)
        self.symbols[self.at[t] + seq] = symbols[np.repeat(firsts, self.lengths) + t]


def forward(m: TimeMajor, start, move, emit, keep: bool = False):
    """Natural log likelihood of every sequence (in m's order); with ``keep`` also the scaled alphas and scales."""
    log = np.zeros(len(m.lengths))
    alphas = np.empty((m.at[-1], len(start))) if keep else None
    scales = np.empty(m.at[-1]) if keep else None
    a = None
    for t, n in enumerate(m.active.tolist()):
        lo = m.at[t]
        a = (start if a is None else a[:n] @ move) * emit[m.symbols[lo:lo + n]]
        s = a.sum(axis=1)
        a /= s[:, None]
        log[:n] += np.log(s)
        if keep:
            alphas[lo:lo + n], scales[lo:lo + n] = a, s
    return (log, alphas, scales) if keep else log


def expectations(m: TimeMajor, start, move, emit):
    """Baum-Welch counts: (states x classes emitted, transitions, starts)."""
    _, gamma, scales = forward(m, start, move, emit, keep=True)
    moved = np.zeros_like(move)
    for t in range(len(m.active) - 2, -1, -1):
        lo, hi, n = m.at[t], m.at[t + 1], m.active[t + 1]
        # from here on rows of gamma hold alpha * beta; beta of step t + 1 is gamma / alpha, kept in b
        e = emit[m.symbols[hi:hi + n]] / scales[hi:hi + n, None]
        b = e if t == len(m.active) - 2 else np.concatenate((e[:len(beta)] * beta, e[len(beta):]))
        a = gamma[lo:lo + n]
        moved += (a.T @ b) * move
        beta = b @ move.T
        gamma[lo:lo + n] = a * beta
    symbols = m.symbols
    emitted = np.stack([np.bincount(symbols, gamma[:, k], emit.shape[0]) for k in range(len(start))])
    return emitted, moved, gamma[:len(m.lengths)].sum(axis=0)


def tied_expectations(symbols: np.ndarray, lengths: np.ndarray, start, emit):
    """Baum-Welch counts when the transition matrix is the identity: one state a sequence."""
    logs = np.add.reduceat(np.log(emit)[symbols], np.cumsum(lengths) - lengths, axis=0) + np.log(start)
    post = np.exp(logs - logs.max(axis=1, keepdims=True))
    post /= post.sum(axis=1, keepdims=True)
    each = np.repeat(post, lengths, axis=0)
    emitted = np.stack([np.bincount(symbols, each[:, k], emit.shape[0]) for k in range(len(start))])
    return emitted, np.diag((post * (lengths - 1)[:, None]).sum(axis=0)), post.sum(axis=0)


def _batches(batches, limit: int = BATCH_TOKENS):
    """(rows, symbols, lengths) of whole documents, a bounded number of tokens at a time where documents allow."""
    for batch in batches:
        rows, held, size = [], [], 0
        for row, data in enumerate(batch.column("classes")):
            held.append(np.frombuffer(data.as_buffer(), np.uint16))
            rows.append(row)
            size += len(held[-1])
            if size >= limit:
                yield batch, rows, np.concatenate(held).astype(np.int64), np.array([len(x) for x in held])
                rows, held, size = [], [], 0
        if held:
            yield batch, rows, np.concatenate(held).astype(np.int64), np.array([len(x) for x in held])


def train(tokens: DataFrame, class_counts: np.ndarray):
    """(start, move, emit as classes x states) from the class sequences of the training documents."""
    share = (class_counts + PRIOR) / (class_counts + PRIOR).sum()
    noise = np.random.default_rng(7).gamma(2.0, size=(CLASSES, STATES))  # a fixed start, the same at every size
    emit = share[:, None] * noise
    emit /= emit.sum(axis=0)
    start, move = np.full(STATES, 1 / STATES), np.eye(STATES)
    for k in range(TIED_ROUNDS + FULL_ROUNDS):
        tied = k < TIED_ROUNDS
        emitted, moved, started = _round(tokens, start, move, emit, tied)
        emit = (emitted + PRIOR).T
        emit /= emit.sum(axis=0)
        start = (started + 1) / (started + 1).sum()
        if not tied or k == TIED_ROUNDS - 1:
            move = moved + (0.05 * moved.sum(axis=1, keepdims=True) / STATES + 1 if tied else PRIOR)
            move /= move.sum(axis=1, keepdims=True)
    return start, move, emit


def _round(tokens: DataFrame, start, move, emit, tied: bool):
    def run(batches):
        total = np.zeros(STATES * CLASSES + STATES * STATES + STATES)
        for _, _, symbols, lengths in _batches(batches):
            if tied:
                found = tied_expectations(symbols, lengths, start, emit)
            else:
                pieces = -(-lengths // PIECE)
                cuts = np.full(pieces.sum(), PIECE)
                cuts[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * PIECE
                found = expectations(TimeMajor(symbols, cuts), start, move, emit)
            total += np.concatenate([x.ravel() for x in found])
        at = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "v"])

    total = np.zeros(STATES * CLASSES + STATES * STATES + STATES)
    for r in tokens.select("classes").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        total[r["at"]] = r["v"]
    a, b = STATES * CLASSES, STATES * CLASSES + STATES * STATES
    return total[:a].reshape(STATES, CLASSES), total[a:b].reshape(STATES, STATES), total[b:]


# --- the whole model --------------------------------------------------------------

def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    training = docs.where(~held_out(F.col("doc_id")))
    n_ends = training.count()
    vocabulary = cut(word_counts(training), "vocabulary")
    sums = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, n_types = sums["n"] + n_ends, sums["v"] + (n_ends > 0)
    head = head_of(vocabulary)
    buckets = vocabulary.groupBy(bucket_column(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in buckets:
        class_n[r["k"]], class_v[r["k"]] = r["n"], r["v"]
    for k, (word, c) in enumerate(head[:OWN_CLASSES]):  # these leave their bucket
        class_n[k], class_v[k] = c, 1
        class_n[bucket(word)] -= c
        class_v[bucket(word)] -= 1
    class_n[END] = n_ends
    below = np.log10(class_n + class_v + 1)
    words = spark.sparkContext.broadcast((
        [w.encode() for w, _ in head], np.array([c for _, c in head], np.int64), below))

    def sequences(batches):
        names, counts, down = words.value
        index = {w: k for k, w in enumerate(names)}
        classes = np.array([k if k < OWN_CLASSES else bucket(w.decode()) for k, w in enumerate(names)] + [END], np.int64)
        logs = np.log10(np.append(counts, n_ends) + 1.0)
        inner = np.where(classes < OWN_CLASSES, 0.0, logs - down[classes])
        inner[-1] = 0.0
        find, end = index.get, len(names)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                n, known, top, within, seqs = [], [], [], [], []
                tail_words, tail_n, tail_at = [], [], [0]
                for text in part.column("text").to_pylist():
                    w = text.encode().lower().split() if text else []
                    at = np.array([*[find(x, -1) for x in w], end], np.int64)
                    seq = classes[at]
                    missing = np.nonzero(at < 0)[0].tolist()
                    tail: dict[str, int] = {}
                    for k in missing:
                        word = w[k].decode()
                        tail[word] = tail.get(word, 0) + 1
                    memo = {word: bucket(word) for word in tail}
                    if missing:
                        seq[missing] = [memo[w[k].decode()] for k in missing]
                    hit = at[at >= 0]
                    n.append(len(at))
                    known.append(len(hit) if n_ends else 0)
                    top.append(logs[hit].sum())
                    within.append(inner[hit].sum() - sum(m * down[memo[x]] for x, m in tail.items()))
                    seqs.append(seq.astype(np.uint16).tobytes())
                    tail_words += tail.keys()
                    tail_n += tail.values()
                    tail_at.append(len(tail_words))
                tails = pa.StructArray.from_arrays([pa.array(tail_words, pa.string()), pa.array(tail_n, pa.int64())], ["word", "n"])
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(top, pa.float64()), pa.array(within, pa.float64()), pa.array(seqs, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(tail_at, pa.int32()), tails)],
                    ["doc_id", "held_out", "n_tokens", "known", "top", "within", "classes", "tail"])

    tokens = docs.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        sequences, f"doc_id {kind}, held_out boolean, n_tokens long, known long, top double, within double, "
                   "classes binary, tail array<struct<word:string,n:bigint>>")
    tokens = cut(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    start, move, emit = train(tokens.where("not held_out"), class_n)

    def likelihood(batches):
        for batch, rows, symbols, lengths in _batches(batches, 2 * BATCH_TOKENS):
            m = TimeMajor(symbols, lengths)
            log = np.empty(len(lengths))
            log[m.order] = forward(m, start, move, emit) / np.log(10)
            part = batch.slice(rows[0], len(rows))
            yield pa.record_batch([part.column(c) for c in ("doc_id", "held_out", "n_tokens", "known", "top", "within", "row")]
                                  + [pa.array(log)], ["doc_id", "held_out", "n_tokens", "known", "top", "within", "row", "hidden"])

    scored = tokens.drop("tail").mapInArrow(likelihood, f"doc_id {kind}, held_out boolean, n_tokens long, known long, top double, "
                                                        "within double, row long, hidden double")
    rare = tokens.select(F.col("row").alias("_row"), F.explode("tail").alias("t")).select("_row", "t.word", "t.n")
    met = rare.join(vocabulary, "word").groupBy("_row").agg(
        F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_log"))
    both = scored.join(met, scored["row"] == met["_row"], "left")
    tail = F.coalesce("tail_log", F.lit(0.0))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("top") + tail - F.col("n_tokens") * float(np.log10(n_all + n_types + 1))).alias("base_score"),
        (F.col("hidden") + F.col("within") + tail).alias("score"))
