import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import crf as C
from cartwheel.llm.common import documents

SF = "/root/testdata/sf0.001"


def random_chain(seed, lengths, k=3):
    r = np.random.default_rng(seed)
    n = sum(lengths)
    begins = np.zeros(n, bool)
    begins[np.cumsum([0, *lengths[:-1]])] = True
    return r.normal(size=(n, k)) * 3, begins, r.normal(size=(k, k)), r.normal(size=k), r.integers(0, k, n)


def enumerated(emission, moves, start):
    """Marginals and log partition of one sequence, by all labellings."""
    n, k = emission.shape
    total, marginal = 0.0, np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        p = np.exp(start[labels[0]] + sum(emission[t, x] for t, x in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += p
        marginal[np.arange(n), labels] += p
    return marginal / total, np.log(total)


@pytest.mark.parametrize("lengths", [[1], [6], [3, 1, 4, 2], [2] * 9])
def test_forward_backward_equals_enumeration(lengths):
    emission, begins, moves, start, labels = random_chain(len(lengths), lengths)
    value, residual, _, _ = C.likelihood(emission, begins, labels, moves, start)
    at, want = 0, 0.0
    for n in lengths:
        marginal, partition = enumerated(emission[at:at + n], moves, start)
        hot = np.zeros((n, 3))
        hot[np.arange(n), labels[at:at + n]] = 1
        assert np.allclose(residual[at:at + n], hot - marginal)
        mine = labels[at:at + n]
        want += start[mine[0]] + sum(emission[at + t, x] for t, x in enumerate(mine)) + sum(moves[a, b] for a, b in zip(mine, mine[1:])) - partition
        at += n
    assert np.isclose(value, want)


def test_derivatives():
    emission, begins, moves, start, labels = random_chain(5, [4, 7])
    _, residual, moved, started = C.likelihood(emission, begins, labels, moves, start)
    for array, gradient in ((emission, residual), (moves, moved), (start, started)):
        for at in list(np.ndindex(array.shape))[:9]:
            array[at] += 1e-5
            up = C.likelihood(emission, begins, labels, moves, start)[0]
            array[at] -= 2e-5
            down = C.likelihood(emission, begins, labels, moves, start)[0]
            array[at] += 1e-5
            assert np.isclose((up - down) / 2e-5, gradient[at], atol=1e-4)


def test_long_chains_do_not_underflow():
    emission, begins, moves, start, labels = random_chain(7, [20_000])
    value, residual, _, _ = C.likelihood(emission * 30, begins, labels, moves, start)
    assert np.isfinite(value) and np.isfinite(residual).all()


def slow_features(word):
    """(n-gram length, n-gram) of a word between its marks."""
    marked = f"\x02{word}\x03"
    return [(n, marked[a:a + n]) for n in range(1, 5) for a in range(len(marked) - n + 1)
            if n < 4 or a == 0 or a + n == len(marked)]


def test_features():
    """Equal n-grams share a feature, and a word's emission is the sum over its n-grams and its lexicon entry."""
    words, none = ["haus", "", "häuser", "a", "the", "haus"], (1 << C.BITS) + 3
    lexicon = C.Lexicon({"the": 1 << C.BITS})
    f = C.Features(words, lexicon, none)
    seen = {}
    for at, feature in f.grams:
        for a, x in zip(at.tolist(), feature.tolist()):
            seen.setdefault(int(f.owner[a]), []).append(x)
    for k, w in enumerate(words):
        assert len(seen[k]) == len(slow_features(w))
    assert sorted(seen[0]) == sorted(seen[5])
    weights = np.random.default_rng(1).normal(size=(none + 1, 2))
    want = [weights[seen[k]].sum(0) + weights[lexicon.rows.get(w, none)] for k, w in enumerate(words)]
    assert np.allclose(f.emissions(weights), want)
    residual = np.random.default_rng(2).normal(size=(len(words), 2))
    slow = np.zeros((none + 1, 2))
    for k, w in enumerate(words):
        np.add.at(slow, [*seen[k], lexicon.rows.get(w, none)], residual[k])
    assert np.allclose(f.gradient(residual, none + 1), slow)


@pytest.fixture(scope="module")
def model(spark):
    return C.train(documents(spark, SF).where(~C.held_out(F.col("doc_id"))), sample=256)


def test_blocks_equal_the_whole(spark, model):
    text = "\n".join(r.text for r in documents(spark, SF).limit(12).collect())
    words = C.words_of(text)
    whole = C.Chain(C.emissions(words, model), np.arange(len(words)) == 0, model.moves, model.start).run()[0]
    for block in (7, 1000, 10 ** 6):
        parts = list(C.probabilities(text, model, block))
        assert [w for p, _ in parts for w in p] == words
        assert np.allclose(np.concatenate([f for _, f in parts]), whole, atol=1e-6)


def test_held_out_accuracy(spark, model):
    docs = documents(spark, SF)
    found = C.predict(docs, model).join(docs.select(F.col("doc_id"), "lang"), "doc_id").where(C.held_out(F.col("doc_id"))).collect()
    assert len(found) > 30 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switched_text(spark, docs, model):
    """Stretches of held-out documents in turn: words are labelled, borders found within a word or two."""
    held = documents(spark, SF).where(C.held_out(F.col("doc_id"))).collect()
    parts, want = [], []
    for k, lang in enumerate(["en", "de", "fr", "es", "de", "en"]):
        words = next(r.text for r in held[k:] if r.lang == lang and len(r.text.split()) > 60).split()[20:40]
        parts += words
        want += [lang] * len(words)
    rows = C.label_words(docs([(1, " ".join(parts))]), model).orderBy("first").collect()
    got = [r.lang for r in rows for _ in r.words]
    assert [w for r in rows for w in r.words] == C.words_of(" ".join(parts))
    assert np.mean([a == b for a, b in zip(got, want)]) > 0.9 and len(rows) <= 12


def test_odd_rows(docs, odd_rows, model):
    rows = [*odd_rows, (20, "123 ... 456"), (21, "€ 5"), (22, "x"), (None, "der die das")]
    table = docs(rows).withColumns({n: F.lit("x") for n in ("bucket", "hash", "words", "word", "n", "score", "held_out")})
    got = C.identify(table, sample=16, evaluations=4)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert len(found) == len(rows)
    by_id = {i: t for i, t in rows}
    for i, held, lang, score, *_ in found:
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i is not None:
            letters = any(map(str.isalpha, by_id[i] or ""))
            assert (lang == "en" and 0 < score <= 1) if letters else (lang == "und" and score == 0)


def test_nothing_to_learn_from(docs):
    assert C.identify(docs([])).collect() == []
    table = docs([(1, "some words"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in C.identify(table).collect()) == [(1, "und", 0.0), (2, "und", 0.0)]


def test_word_emissions_are_kept_between_calls(model, monkeypatch):
    made = []

    class Counting(C.Features):
        def __init__(self, words, *rest):
            made.extend(words)
            super().__init__(words, *rest)

    monkeypatch.setattr(C, "Features", Counting)
    kept, one, two = C.Emissions(model), ["der", "the", "der", ""], ["les", "the", "x1"]
    first, second = kept.of(one), kept.of(two)
    assert sorted(made) == sorted({*one, *two})
    assert np.array_equal(first, C.emissions(one, model)) and np.array_equal(second, C.emissions(two, model))


def test_messages_equal_the_laid_out_matrices():
    random = np.random.default_rng(5)
    n, k = 23, 3
    emission, moves, start = random.normal(size=(n, k)), random.normal(size=(k, k)), random.normal(size=k)
    begins = np.isin(np.arange(n), (0, 1, 9, 22))
    chain, want = C.Chain(emission, begins, moves, start), np.eye(k)
    steps = [np.exp((start[None] if b else moves) + e) * np.ones((k, 1)) for b, e in zip(begins, emission)]
    for m in steps:
        want = want @ m
    assert np.allclose(chain.product(), want / want.sum())
    found = chain.run()[0]
    for at in range(n):
        left, right = np.full(k, 1 / k), np.ones(k)
        for m in steps[:at + 1]:
            left = left @ m / (left @ m).sum()
        for m in reversed(steps[at + 1:]):
            right = m @ right / (m @ right).sum()
        assert np.allclose(found[at], left * right / (left @ right))
