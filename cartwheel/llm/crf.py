"""Language identification by a linear-chain conditional random field over words.

The score of a labelling of a text is the sum of its words' features (character n-grams, affixes,
a lexicon) and of learned transitions between neighbouring words' languages. Forward-backward
gives every word a probability for each language, so text that switches language is labelled word by
word; a document's language is the one with the highest mean over its words with letters.

Training: for every language the rows in ``SAMPLE`` hash buckets give one row each (the one with the
least hash), of which ``RUN`` words are taken, so the sample is bounded by languages x SAMPLE x RUN
words whatever the input.  Part of them stay runs of one language, the others are spliced into
sequences that switch, from which the transitions learn.  The sequences are a written table;
every step of L-BFGS is a Spark job that sums likelihood and gradient over its partitions.
The lexicon (words that occur mostly in one language) counts all labelled rows.

A text of more than ``BLOCK`` words is read in blocks: one pass gives each block's product of
potentials, from which the messages at the block borders follow, a second pass the probabilities
inside.  So memory is bounded by a block, and the result is that of the whole text.

Defined cases: a null text, one without letters, or any text where no language could be learned gives
``und`` and score 0; words without letters take part in the chain but not in the mean; ties go to
the language that sorts first; rows without a doc_id are used for training, as their remainder
is not the held-out one; repeated rows share a hash and enter the sample once; an empty table gives
an empty table.  At most ``LANGUAGES`` languages (the most frequent) are learned.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut

#: Rows a language gives to the training sample, and words of each.
SAMPLE = 1024
RUN = 48
LANGUAGES = 128
#: Words in the lexicon: at least LEAST documents hold them, at least SHARES[0] of these in one language.
LEXICON = 65_536
LEAST = 5
SHARES = (0.6, 0.9, 0.99)
#: Hashed features, L2 penalty, evaluations at most, and the relative gain below which training ends.
BITS = 15
PENALTY = 0.02
EVALUATIONS = 20
GAIN = 0.02
MEMORY = 6
#: Words whose probabilities are computed at once.
BLOCK = 100_000
#: Different words whose emissions a task keeps.
KEPT_WORDS = 200_000
PARTITIONS = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]{}|«»„“”…-–—*#"
UNKNOWN = "und"


# --- words and features ---------------------------------------------------------

def words_of(text: str) -> list[str]:
    """Lower-case words without the punctuation at their edges (a word of nothing else is empty)."""
    return [w.strip(EDGES) for w in WORD.findall(text.lower())]


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


class Lexicon(NamedTuple):
    """Words that occur mostly in one language: the row of the feature each has."""
    rows: dict[str, int]


class Model(NamedTuple):
    languages: list[str]
    lexicon: Lexicon
    weights: np.ndarray  # features x languages: hashed n-grams, then (language, share) of the lexicon, then no entry
    moves: np.ndarray    # languages x languages
    start: np.ndarray


class Features:
    """Hashed n-grams (1 to 3 characters anywhere, 4 at an edge; edges are marked, so these hold the affixes) of words."""

    def __init__(self, words: list[str], lexicon: Lexicon, none: int):
        codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        self.ends = np.cumsum(sizes)
        self.first = self.ends - sizes
        self.owner = np.repeat(np.arange(len(words)), sizes)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # positions and features
        n_codes, sums = len(codes), np.zeros(len(codes), np.uint32)
        for n in range(1, 5):
            if n_codes < n:
                break
            sums = (sums[:n_codes - n + 1] + codes[n - 1:]) * np.uint32(0x9E3779B1)
            sums ^= sums >> np.uint32(15)
            at = np.flatnonzero(self.owner[:n_codes - n + 1] == self.owner[n - 1:])
            if n == 4:
                at = at[(codes[at] == 2) | (codes[at + 3] == 3)]
            self.grams.append((at, ((sums[at] + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)))
        self.entries = np.array([lexicon.rows.get(w, none) for w in words], np.int64)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Words x languages."""
        total = np.zeros((len(self.owner), weights.shape[1]))
        for at, feature in self.grams:
            total[at] += weights[feature]
        # every word has its two marks, so no span is empty
        return np.add.reduceat(total, self.first, axis=0) + weights[self.entries] if len(self.first) else np.zeros((0, weights.shape[1]))

    def gradient(self, residual: np.ndarray, n_features: int) -> np.ndarray:
        """Features x languages: the residual of each word added to its features."""
        out = np.zeros((n_features, residual.shape[1]))
        for k in range(residual.shape[1]):
            for at, feature in self.grams:
                out[:, k] += np.bincount(feature, residual[self.owner[at], k], n_features)
            out[:, k] += np.bincount(self.entries, residual[:, k], n_features)
        return out


class Emissions:
    """Emissions of words; those of the words met lately (at most ``KEPT_WORDS`` and those of one call) are kept."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, self.model.weights.shape[1]))

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.place) > KEPT_WORDS:
            self._clear()
        place, old = self.place, len(self.place)
        index = [place.setdefault(w, len(place)) for w in words]
        if len(place) > old:
            new = Features(list(islice(place, old, None)), self.model.lexicon, len(self.model.weights) - 1)
            self.rows = np.concatenate((self.rows, new.emissions(self.model.weights)))
        return self.rows[index]


def emissions(words: list[str], model: Model) -> np.ndarray:
    """Emissions of words; each different word is computed once."""
    return Emissions(model).of(words)


# --- forward-backward ------------------------------------------------------------

class Chain:
    """Scaled forward and backward messages of sequences laid end to end.

    A step is the matrix of exp(move + emission), or, where a sequence begins, exp(start +
    emission) in every row.  The steps are cut into pieces that numpy handles side by side: products
    of the pieces first, then the messages at their borders, then those inside.
    """

    def __init__(self, emission: np.ndarray, begins: np.ndarray, moves: np.ndarray, start: np.ndarray):
        n, k = emission.shape
        self.n, self.k = n, k
        self.length = max(1, int(np.sqrt(n)))
        pieces = -(-n // self.length)
        pad = pieces * self.length - n
        top = emission.max(1, initial=-np.inf, keepdims=True) if n else emission
        self.logs = np.where(np.isfinite(top[:, 0]), top[:, 0], 0) if n else np.zeros(0)
        local = np.exp(np.concatenate((emission - self.logs[:, None], np.zeros((pad, k))))).reshape(pieces, self.length, k)
        begins = np.concatenate((begins, np.zeros(pad, bool))).reshape(pieces, self.length)
        self.local, self.begins, self.moves, self.start = local, begins, np.exp(moves), np.exp(start)

    def _ahead(self, at: np.ndarray, s: int) -> np.ndarray:
        """Messages (pieces x any x languages) times the matrices of step s, which are never laid out."""
        out = (at.reshape(-1, self.k) @ self.moves).reshape(at.shape)
        new = np.flatnonzero(self.begins[:, s])
        if len(new):
            out[new] = at[new].sum(-1, keepdims=True) * self.start
        out *= self.local[:, s, None, :]
        if (len(out) - 1) * self.length + s >= self.n:  # the last piece has ended
            out[-1] = at[-1]
        return out

    def _back(self, at: np.ndarray, s: int) -> np.ndarray:
        """The matrices of step s times messages (pieces x languages)."""
        held = self.local[:, s] * at
        out = held @ self.moves.T
        new = np.flatnonzero(self.begins[:, s])
        if len(new):
            out[new] = (held[new] @ self.start)[:, None]
        if (len(out) - 1) * self.length + s >= self.n:
            out[-1] = at[-1]
        return out

    def products(self) -> np.ndarray:
        out = np.broadcast_to(np.eye(self.k), (len(self.local), self.k, self.k)).copy()
        for s in range(self.length):
            out = self._ahead(out, s)
            out /= out.sum((1, 2), keepdims=True)
        return out

    def product(self) -> np.ndarray:
        """The product of all steps, scaled."""
        out = np.eye(self.k)
        for p in self.products():
            out = out @ p
            out /= out.sum()
        return out

    def run(self, before: np.ndarray | None = None, after: np.ndarray | None = None):
        """Probabilities of each label, forward and backward messages, and the log of each forward scale."""
        pieces, k = len(self.local), self.k
        before = np.full(k, 1 / k) if before is None else before
        after = np.ones(k) if after is None else after
        products = self.products()
        heads, tails = np.empty((pieces, k)), np.empty((pieces, k))
        at = before
        for c in range(pieces):
            heads[c] = at
            at = at @ products[c]
            at = at / at.sum()
        at = after
        for c in range(pieces - 1, -1, -1):
            tails[c] = at
            at = products[c] @ at
            at = at / at.sum()
        forward, scale = np.empty((pieces, self.length, k)), np.empty((pieces, self.length))
        at = heads
        for s in range(self.length):
            at = self._ahead(at[:, None], s)[:, 0]
            scale[:, s] = at.sum(1)
            at = at / scale[:, s, None]
            forward[:, s] = at
        backward = np.empty((pieces, self.length, k))
        at = tails
        for s in range(self.length - 1, -1, -1):
            backward[:, s] = at
            at = self._back(at, s)
            at = at / at.sum(1, keepdims=True)
        flat = lambda x: x.reshape(-1, *x.shape[2:])[:self.n]
        forward, backward = flat(forward), flat(backward)
        both = forward * backward
        return both / both.sum(1, keepdims=True), forward, backward, np.log(flat(scale)) + self.logs


def likelihood(emission: np.ndarray, begins: np.ndarray, labels: np.ndarray, moves: np.ndarray, start: np.ndarray):
    """Log likelihood of labelled sequences, and its derivatives by emission, moves and start."""
    chain = Chain(emission, begins, moves, start)
    probability, forward, backward, logs = chain.run()
    rows, inner = np.arange(len(labels)), np.flatnonzero(~begins)
    value = emission[rows, labels].sum() + start[labels[begins]].sum() + moves[labels[inner - 1], labels[inner]].sum() - logs.sum()
    residual = -probability
    residual[rows, labels] += 1
    ahead = backward[inner] * np.exp(emission[inner] - chain.logs[inner, None])
    joint = forward[inner - 1][:, :, None] * chain.moves[None] * ahead[:, None, :]
    moved = -(joint / joint.sum((1, 2), keepdims=True)).sum(0)
    np.add.at(moved, (labels[inner - 1], labels[inner]), 1)
    return value, residual, moved, residual[begins].sum(0)


# --- training ---------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """crc32 of the decimal doc_id mod 4 is 2; false without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def lexicon_of(labelled: DataFrame, languages: list[str]) -> Lexicon:
    """Words with the row of their feature; documents that hold a word are counted over all labelled rows."""
    def counts(batches):
        held: Counter = Counter()

        def rows():
            words, langs = zip(*held)
            return pa.record_batch([pa.array(words, pa.string()), pa.array(langs, pa.string()), pa.array(list(held.values()), pa.int64())],
                                   ["word", "lang", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                held.update([(w, lang) for w in {w.strip(EDGES) for w in set(WORD.findall(text.as_py().lower()))}])
                if len(held) > 200_000:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    each = labelled.select("lang", "text").mapInArrow(counts, "word string, lang string, n long")
    of_word = each.groupBy("word", "lang").agg(F.sum("n").alias("n")).groupBy("word").agg(
        F.max(F.struct("n", "lang")).alias("most"), F.sum("n").alias("n"))
    share = F.col("most.n") / F.col("n")
    top = of_word.where((F.col("n") >= LEAST) & (share >= SHARES[0])).orderBy(F.col("n").desc(), "word").limit(LEXICON).select(
        "word", F.col("most.lang").alias("lang"), share.alias("share")).collect()  # at most LEXICON rows
    first = 1 << BITS
    place = {x: k for k, x in enumerate(languages)}
    return Lexicon({r.word: first + place[r.lang] * len(SHARES) + sum(r.share >= s for s in SHARES[1:])
                    for r in top if r.lang in place and has_letter(r.word)})


def sequences(labelled: DataFrame, languages: list[str], sample: int, run: int) -> DataFrame:
    """words and labels (a label a word) of the training sequences, a written table."""
    bucket = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(sample)).alias("bucket")
    rows = labelled.where(F.col("lang").isin(*languages)).select("lang", "text", bucket, F.xxhash64("text").alias("hash"))
    least = rows.groupBy("lang", "bucket").agg(F.min("hash").alias("hash"))  # at most languages x sample rows
    chosen = rows.join(F.broadcast(least), ["lang", "bucket", "hash"]).groupBy("lang", "bucket").agg(F.first("text").alias("text"))

    def splice(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["lang"])
        random = np.random.default_rng(rows[0]["bucket"])
        words, labels, pieces = [], [], []
        for r in rows:
            mine, label = words_of(r["text"]), languages.index(r["lang"])
            at = int(random.integers(0, max(1, len(mine) - run)))
            mine = mine[at:at + run]
            whole = mine[:len(mine) * 2 // 3]
            if whole:
                words.append(whole)
                labels.append([label] * len(whole))
            rest = mine[len(whole):]
            while rest:
                n = int(random.integers(2, 10))
                pieces.append((rest[:n], label))
                rest = rest[n:]
        random.shuffle(pieces)
        if pieces:
            words.append([w for p, _ in pieces for w in p])
            labels.append([label for p, label in pieces for _ in p])
        return pa.table({"words": pa.array(words, pa.list_(pa.string())), "labels": pa.array(labels, pa.list_(pa.int32()))})

    spliced = chosen.groupBy("bucket").applyInArrow(splice, "words array<string>, labels array<int>")
    return cut(spliced.repartition(PARTITIONS, F.xxhash64("words")), "sequences")


def _minimize(evaluate, x: np.ndarray, evaluations: int) -> np.ndarray:
    """L-BFGS with halved steps; ``evaluate`` gives value and gradient."""
    value, gradient = evaluate(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < evaluations:
        direction, parts = -gradient, []
        for s, y in reversed(steps):
            a = s @ direction / (s @ y)
            direction = direction - a * y
            parts.append(a)
        if steps:
            s, y = steps[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction / max(1.0, np.abs(gradient).max())
        for (s, y), a in zip(steps, reversed(parts)):
            direction = direction + s * (a - y @ direction / (s @ y))
        size, slope = 1.0, gradient @ direction
        while used < evaluations:
            there = x + size * direction
            new_value, new_gradient = evaluate(there)
            used += 1
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            return x
        change = new_gradient - gradient
        if change @ (there - x) > 1e-10:
            steps = [*steps, (there - x, change)][-MEMORY:]
        gain = value - new_value
        x, value, gradient = there, new_value, new_gradient
        if gain < GAIN * abs(value):
            break
    return x


def train(labelled: DataFrame, sample: int = SAMPLE, run: int = RUN, evaluations: int = EVALUATIONS) -> Model:
    """The model of the rows (lang, text) whose text and lang are not null."""
    labelled = labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()
    languages = sorted(r.lang for r in counted)
    k = len(languages)
    n_features = (1 << BITS) + k * len(SHARES) + 1
    if not k:
        return Model([], Lexicon({}), np.zeros((n_features, 0)), np.zeros((0, 0)), np.zeros(0))
    context = labelled.sparkSession.sparkContext
    rows = sequences(labelled, languages, sample, run)
    lexicon = context.broadcast(lexicon_of(labelled, languages))
    shapes = [(n_features, k), (k, k), (k,)]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])

    def split(x):
        return [part.reshape(s) for part, s in zip(np.split(x, ends[:-1]), shapes)]

    def evaluate(x):
        held = context.broadcast(x)

        def partial(batches):
            weights, moves, start = split(held.value)
            total, value, count = np.zeros(len(held.value)), 0.0, 0
            for batch in batches:
                words = batch.column("words").flatten().to_pylist()
                if not words:
                    continue
                labels = batch.column("labels").flatten().to_numpy()
                begins = np.zeros(len(words), bool)
                lengths = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
                begins[np.cumsum(lengths) - lengths] = True
                features = Features(words, lexicon.value, n_features - 1)
                one, residual, moved, started = likelihood(features.emissions(weights), begins, labels, moves, start)
                total += np.concatenate((features.gradient(residual, n_features).ravel(), moved.ravel(), started))
                value, count = value + one, count + len(words)
            yield pa.record_batch([pa.array([value]), pa.array([count], pa.int64()), pa.array([total.astype("<f4").tobytes()], pa.binary())],
                                  ["value", "count", "gradient"])

        value, gradient, count = 0.0, np.zeros(len(x)), 0
        for r in rows.mapInArrow(partial, "value double, count long, gradient binary").toLocalIterator():  # a row a partition
            value, count, gradient = value + r["value"], count + r["count"], gradient + np.frombuffer(r["gradient"], "<f4")
        held.destroy()
        count = max(count, 1)
        return -value / count + PENALTY / count * 100 * (x @ x) / 2, -gradient / count + PENALTY / count * 100 * x

    weights, moves, start = split(_minimize(evaluate, np.zeros(ends[-1]), evaluations))
    return Model(languages, lexicon.value, weights.astype(np.float32), moves, start)


# --- labelling ---------------------------------------------------------------------

def _blocks(text: str, size: int):
    """Words of a text, ``size`` at a time."""
    held = []
    for m in WORD.finditer(text.lower()):
        held.append(m[0].strip(EDGES))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def probabilities(text: str, model: Model, block: int = BLOCK, kept: Emissions | None = None):
    """(words, words x languages) of the blocks of a text, by messages over the whole of it."""
    kept = kept or Emissions(model)
    begins = lambda k, words: np.arange(len(words)) + k == 0
    chain = lambda k, words: Chain(kept.of(words), begins(k, words), model.moves, model.start)
    products = [chain(k, words).product() for k, words in enumerate(_blocks(text, block))]
    n = len(model.languages)
    after = [np.ones(n)]
    for p in reversed(products[1:]):
        at = p @ after[-1]
        after.append(at / at.sum())
    after.reverse()
    before = np.full(n, 1 / n)
    for k, words in enumerate(_blocks(text, block)):
        yield words, chain(k, words).run(before, after[k])[0]
        before = before @ products[k]
        before = before / before.sum()


def _label(texts: list[str | None], model: Model, block: int, kept: Emissions | None = None):
    """Per text an iterator of (words, probabilities); texts of a slice run together until ``block`` words."""
    kept = kept or Emissions(model)
    held: list[tuple[int, list[str]]] = []
    size = 0

    def flush():
        words = [w for _, one in held for w in one]
        begins = np.zeros(len(words), bool)
        ends = np.cumsum([len(one) for _, one in held])
        begins[np.concatenate(([0], ends[:-1]))] = True
        found = Chain(kept.of(words), begins, model.moves, model.start).run()[0]
        for (at, one), end in zip(held, ends):
            yield at, one, found[end - len(one):end]

    for at, text in enumerate(texts):
        if not text:
            continue
        if len(text) > 8 * block:  # it may hold more than a block of words
            for words, found in probabilities(text, model, block, kept):
                yield at, words, found
            continue
        words = words_of(text)
        if words:
            held.append((at, words))
            size += len(words)
        if size >= block:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def predict(docs: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """doc_id, lang_pred, score, n_words (with letters) and n_switches (neighbours among them with different labels) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        k, kept = len(model.languages), Emissions(held.value)
        letters: dict[str, bool] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                total, count, switches = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                last: dict[int, int] = {}
                for row, words, found in _label(texts, model, block, kept) if k else ():
                    for w in set(words).difference(letters):
                        letters[w] = has_letter(w)
                    found = found[[letters[w] for w in words]]
                    if len(letters) > BLOCK:
                        letters = {}
                    if len(found):
                        best = found.argmax(1)
                        total[row] += found.sum(0)
                        count[row] += len(found)
                        switches[row] += np.count_nonzero(np.diff(best)) + (last.get(row, best[0]) != best[0])
                        last[row] = best[-1]
                mean = total / np.maximum(count, 1)[:, None]
                best = mean.argmax(1) if k else np.zeros(len(texts), np.int64)
                langs = [model.languages[b] if n else UNKNOWN for b, n in zip(best, count)]
                scores = [float(min(1.0, mean[r, b])) if n else 0.0 for r, (b, n) in enumerate(zip(best, count))]
                yield pa.record_batch([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                       pa.array(count), pa.array(switches)], ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, n_words long, n_switches long")


def label_words(docs: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """doc_id, first (place of the run's first word), words, lang and score of every run of one language, for code-switched text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "first", "words", "lang", "score"]

    def run(batches):
        model = held.value
        for batch in batches:
            for row in range(batch.num_rows):
                part, seen = batch.slice(row, 1), 0
                for _, words, found in _label(part.column("text").to_pylist(), model, block) if model.languages else ():
                    best = found.argmax(1)
                    edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(best)]
                    runs = list(zip(edges, edges[1:]))
                    yield pa.record_batch([
                        part.column("doc_id").take(pa.array([0] * len(runs))), pa.array([seen + a for a, _ in runs], pa.int64()),
                        pa.array([words[a:b] for a, b in runs], pa.list_(pa.string())),
                        pa.array([model.languages[best[a]] for a, _ in runs]), pa.array([float(found[a:b, best[a]].mean()) for a, b in runs])], names)
                    seen += len(words)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, first long, words array<string>, lang string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words and n_switches; the rows that are not held out train the model."""
    model = train(docs.where(~held_out(F.col("doc_id"))), **options)
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
