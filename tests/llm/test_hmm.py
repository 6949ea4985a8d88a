import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import hmm as H


@pytest.fixture(autouse=True)
def few_words(monkeypatch):
    """Small tables, so that broadcast, joined and shared-class words all occur."""
    monkeypatch.setattr(H, "HEAD_WORDS", 40)


def random_model(r, states=3, symbols=5):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return norm(r.random(states), 0), norm(r.random((states, states)), 1), norm(r.random((symbols, states)), 0)


def paths(seq, start, move, emit):
    """Every state path with its probability."""
    for path in itertools.product(range(len(start)), repeat=len(seq)):
        p = start[path[0]] * emit[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:]):
            p *= move[a, b] * emit[x, b]
        yield path, p


def test_forward_and_expectations_equal_enumeration():
    r = np.random.default_rng(4)
    model = random_model(r)
    seqs = [r.integers(0, 5, n) for n in (1, 4, 6, 2, 6, 1)]
    m = H.TimeMajor(np.concatenate(seqs), np.array([len(s) for s in seqs]))
    log = np.empty(len(seqs))
    log[m.order] = H.forward(m, *model)
    emitted, moved, started = np.zeros((3, 5)), np.zeros((3, 3)), np.zeros(3)
    for s, value in zip(seqs, log):
        total = sum(p for _, p in paths(s, *model))
        assert math.isclose(value, math.log(total))
        for path, p in paths(s, *model):
            started[path[0]] += p / total
            for k, x in zip(path, s):
                emitted[k, x] += p / total
            for a, b in zip(path, path[1:]):
                moved[a, b] += p / total
    got = H.expectations(m, *model)
    for a, b in zip(got, (emitted, moved, started)):
        assert np.allclose(a, b)


def test_tied_expectations_are_those_of_the_identity():
    r = np.random.default_rng(5)
    start, _, emit = random_model(r)
    seqs = [r.integers(0, 5, n) for n in (1, 4, 6, 3)]
    flat, lengths = np.concatenate(seqs), np.array([len(s) for s in seqs])
    full = H.expectations(H.TimeMajor(flat, lengths), start, np.eye(3), emit)
    for a, b in zip(H.tied_expectations(flat, lengths, start, emit), full):
        assert np.allclose(a, b)


def test_long_texts_do_not_underflow():
    r = np.random.default_rng(6)
    m = H.TimeMajor(r.integers(0, 5, 5000), np.array([5000]))
    assert -math.inf < H.forward(m, *random_model(r))[0] < -1000


def corpus():
    r = random.Random(8)
    tongues = [[f"{p}{k}{e}" for k in range(80)] for p, e in (("a", "ing"), ("b", "ung"), ("c", "que"))]
    return [(k, " ".join(r.choice(tongues[k % 3][:r.choice((8, 80))]) for _ in range(r.randint(20, 90)))) for k in range(300)]


def test_base_score_and_counts(docs, odd_rows):
    rows = corpus()[:60] + odd_rows
    kept = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for i, t in rows if kept(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str((i, not kept(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n)),
                   sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows)
    got = sorted((str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)), r.base_score) for r in H.score(docs(rows)).collect())
    assert [a for a, _ in got] == [a for a, _ in want]
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for (_, a), (_, b) in zip(got, want))


def test_held_out_texts_are_likelier_than_under_the_base(docs):
    rows = H.score(docs(corpus())).where("held_out").collect()
    assert len(rows) > 20
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 for r in rows)


def test_classes_agree_between_python_and_spark(spark):
    words = ["a", "ab", "abc", "überß", "日本語文", "x😀yz"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    assert [r.k for r in table.select(H.bucket_column(table["word"]).alias("k")).collect()] == [H.bucket(w) for w in words]


def test_empty_and_all_held_out(docs):
    assert H.score(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = H.score(docs([(held, "alone here")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score <= 0
