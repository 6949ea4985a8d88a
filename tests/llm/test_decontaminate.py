import random

import pytest

from cartwheel.llm import decontaminate as D

R = random.Random(11)
WORDS = [f"w{k}" for k in range(60)] + ["the", "of", "and"] * 20
ITEMS = [(k, " ".join(R.choice(WORDS) for _ in range(R.randint(15, 70)))) for k in range(40)]


def edited(words, k):
    words = list(words)
    for _ in range(k):
        at = R.randrange(len(words))
        how = R.random()
        if how < 0.4:
            words[at] = R.choice(WORDS)
        elif how < 0.7:
            del words[at]
        else:
            words.insert(at, R.choice(WORDS))
    return words


def slow_edits(item, text):
    """Least edits between the item and any passage: the textbook table with free ends in the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_automaton_equals_the_table():
    for _ in range(200):
        item = [R.randint(1, 4) for _ in range(R.randint(1, 12))]
        text = [R.randint(0, 5) for _ in range(R.randint(0, 30))]
        masks = {}
        for k, x in enumerate(item):
            masks[x] = masks.get(x, 0) | 1 << k
        assert D.fewest_edits(masks, len(item), text) == slow_edits(item, text)


@pytest.fixture(scope="module")
def planted():
    texts = []
    for k in range(300):
        before, after = ([R.choice(WORDS) for _ in range(R.randint(0, 120))] for _ in range(2))
        words = D.words_of(ITEMS[k % 40][1])
        words = [w.decode() for w in words]
        n = D.allowed(len(words))
        middle = edited(words, R.choice((0, n // 2, n, n, 3 * n))) if k % 3 else []
        texts.append(" ".join(before + middle + after))
    return texts


def test_recall_and_precision_against_brute_force(planted):
    truth = {}
    for d, t in enumerate(planted):
        words = D.words_of(t)
        for i, item in ITEMS:
            w = D.words_of(item)
            e = slow_edits(w, words)
            if e <= D.allowed(len(w)):
                truth[d, i] = e
    got = {(d, i): e for d, i, _, e in D.Block(ITEMS).matches(planted)}
    assert set(got) <= set(truth) and all(e >= truth[k] for k, e in got.items())
    assert len(got) >= 0.95 * len(truth) and len(truth) > 100


@pytest.mark.parametrize("n", (72, 100, 200, 400))
@pytest.mark.parametrize("where", ("everywhere", "at the start"))
def test_recall_of_long_items(n, where):
    """Copies edited up to the limit, the edits over the whole item or all in its first third."""
    r = random.Random(n)
    words = [f"v{k}" for k in range(2000)]
    items = [(k, " ".join(r.choice(words) for _ in range(n))) for k in range(60)]
    texts = []
    for _, item in items:
        item = item.split()
        part = n if where == "everywhere" else n // 3
        copy = list(item[:part])
        for _ in range(D.allowed(n)):
            at, how = r.randrange(len(copy)), r.random()
            copy[at:at + 1] = [r.choice(words)] if how < 0.5 else [] if how < 0.75 else [r.choice(words), copy[at]]
        around = [[r.choice(words) for _ in range(50)] for _ in range(2)]
        texts.append(" ".join(around[0] + copy + item[part:] + around[1]))
    got = {(d, i) for d, i, _, _ in D.Block(items).matches(texts)}
    assert len(got & {(k, k) for k in range(60)}) >= 58


def test_query_tables(spark, docs, planted, odd_rows, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)  # many blocks
    items = spark.createDataFrame(ITEMS + [(100, None), (101, ""), (102, "w1 w2"), (None, ITEMS[0][1])], "item_id long, text string")
    rows = list(enumerate(planted)) + [(None, ITEMS[3][1]), (500, ITEMS[3][1].upper().replace(" ", ", ")), (500, ITEMS[3][1])]
    rows += [(None if i is None else 1000 + i, t) for i, t in odd_rows]
    found = D.contaminated(docs(rows), items).collect()
    hits = {(r.doc_id, r.item_id) for r in found}
    assert {(None, 3), (500, 3)} <= hits and sum((r.doc_id, r.item_id) == (500, 3) for r in found) == 2
    assert {d for d, i in hits if i is None} == {d for d, i in hits if i == 0}
    clean = D.without_contaminated(docs(rows), items)
    kept = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    # each row by its own text: of the rows without an id only the one that holds the item goes
    gone = {d for d, _ in hits if d is not None}
    assert kept == sorted([(i, t) for i, t in rows if i not in gone and (i is not None or t != ITEMS[3][1])], key=str)
    assert 500 not in {i for i, _ in kept}
    assert clean.columns == docs([]).columns


def test_folding():
    assert D.words_of("The Cat's, 3.5%% ÉTÉ!") == "the cat s 3 5 ÉtÉ".encode().split()


def test_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(docs([(1, "a b")]), none).count() == 0
    assert D.contaminated(docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
