import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cartwheel.llm import simhash as S
from cartwheel.llm.components import components


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(fps))]


def expected(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(fps, 4)
    least = {r: min((i for (i, _), q in zip(rows, roots) if q == r and i is not None), default=None) for r in roots}
    return sorted(str((i, f"{f:016x}", least[r])) for (i, _), f, r in zip(rows, fps, roots))


def got(table):
    return sorted(str((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id)) for r in table.collect())


def test_every_near_pair_meets_at_an_own_anchor():
    r = random.Random(3)
    for distance in range(5):
        for _ in range(200):
            x = r.getrandbits(64)
            y = x
            for b in r.sample(range(64), distance):
                y ^= 1 << b
            pair = np.array([x, y], np.uint64)
            met = False
            for part in range(len(S.PARTS)):
                index, anchor, own = S.anchors(pair, part)
                assert own[index == 0].sum() == own[index == 1].sum() == 1  # one own anchor a part
                own_x = set(anchor[(index == 0) & own].tolist())
                met |= bool(own_x & set(anchor[index == 1].tolist()))
            assert met


def test_equals_brute_force(docs, odd_rows):
    r = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    rows = list(odd_rows)
    for k in range(40):
        base = [r.choice(words) for _ in range(120)]
        for c in range(r.randint(1, 5)):
            copy = list(base)
            for _ in range(c):
                copy[r.randrange(120)] = r.choice(words)
            rows.append((100 + 10 * k + c, " ".join(copy)))
    assert got(S.near_duplicates(docs(rows))) == expected(rows)


def test_hot_anchor_is_split_and_loses_nothing(docs):
    """Hundreds of near copies with a block of 16: every anchor of the group is cut into a grid."""
    r = random.Random(2)
    base = [f"v{r.randrange(5000)}" for _ in range(300)]
    rows = []
    for k in range(150):
        copy = list(base)
        copy[r.randrange(300)] = f"n{k}"
        rows.append((k, " ".join(copy)))
    assert got(S.near_duplicates(docs(rows), block=16)) == expected(rows)


def test_one_per_group(docs, odd_rows):
    table = docs(odd_rows).withColumns({"fp": F.lit(0), "component_id": F.lit("x")})
    kept = S.one_per_group(table)
    assert kept.columns == table.columns
    by_root = {}
    for i, t in odd_rows:
        by_root.setdefault(slow_fingerprint(t), []).append(i)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 4 in ids and 5 not in ids and 6 in ids and 7 not in ids


def test_one_per_group_with_null_and_repeated_ids(docs):
    """Every component keeps exactly one row, whatever ids its rows carry."""
    r = random.Random(5)
    texts = [" ".join(f"u{r.randrange(9000)}" for _ in range(60)) for _ in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[2]), (3, texts[3]), (3, texts[4]),
            (3, texts[5]), (2, texts[5]), (2, texts[6]), (2, texts[6]), (None, texts[7]), (9, texts[7]), (8, texts[7])]
    kept = sorted(((x.doc_id, x.text) for x in S.one_per_group(docs(rows)).collect()), key=lambda x: texts.index(x[1]))
    assert kept == list(zip([None, None, 7, 3, 3, 2, 2, 8], texts))


def test_empty(docs):
    assert S.near_duplicates(docs([])).count() == 0 and S.one_per_group(docs([])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}}
