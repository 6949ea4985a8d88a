import random

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import substrings as S


def expected(rows, window):
    first = {}
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = {k + d for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k:k + window])] < i for d in range(window)}
        out.append(str((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


def got(table):
    return sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in table.collect())


def make(seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    passages = [[r.choice(words) for _ in range(n)] for n in (8, 9, 30, 60)]
    rows = []
    for k in range(60):
        w = [r.choice(words) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice(passages)
        rows.append((r.randint(0, 50), " ".join(w)))
    return rows


def test_equals_brute_force(docs, odd_rows):
    rows = make(1) + odd_rows
    assert got(S.dedup(docs(rows), window=8)) == expected(rows, 8)


def test_default_window(docs, odd_rows):
    rows = odd_rows + [(100, " ".join(f"a{k}" for k in range(55))), (101, "x " + " ".join(f"a{k}" for k in range(52)) + " y"),
                       (102, " ".join(f"a{k}" for k in range(49)))]
    assert got(S.dedup(docs(rows))) == expected(rows, 50)


def test_a_full_sketch_loses_nothing(docs, monkeypatch):
    """At the narrowest sketch most windows collide; the exact pass still decides."""
    monkeypatch.setattr(S, "MAX_LOG2_WIDTH", 4)
    rows = make(2)
    assert got(S.dedup(docs(rows), window=8)) == expected(rows, 8)


def test_equal_windows_have_equal_signatures():
    r = np.random.default_rng(1)
    passage = [b"p%d" % k for k in range(50)]
    a = [b"x%d" % k for k in r.integers(0, 99, 33)] + passage
    b = passage + [b"y%d" % k for k in r.integers(0, 99, 20)]
    sig, counts = S.signatures([a, [], b], 50)
    assert counts.tolist() == [34, 0, 21] and sig[33] == sig[34] and len(np.unique(sig)) > 3


def test_extra_columns_and_empty(docs):
    table = docs(make(3)).withColumns({"row": F.lit(1), "starts": F.lit(2), "kept": F.lit(3)})
    assert S.dedup(table, window=8).count() == 60
    assert S.dedup(docs([])).count() == 0
