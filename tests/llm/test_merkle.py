import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import merkle as M
from .conftest import DOCS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(digests, fanout):
    """The top and, for every leaf, the (left, right) siblings on its way there."""
    paths = [[] for _ in digests]
    under = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        runs = [range(a, min(a + fanout, len(digests))) for a in range(0, len(digests), fanout)]
        for run in runs:
            for k in run:
                for leaf in under[k]:
                    paths[leaf].append(("".join(digests[j] for j in run if j < k), "".join(digests[j] for j in run if j > k)))
        under = [[leaf for k in run for leaf in under[k]] for run in runs]
        digests = [sha("".join(digests[k] for k in run)) for run in runs]
    return digests[0], paths


def slow(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        mine = sorted(by_lang[g], key=lambda r: (r[0] is not None, r[0] or 0, slow_leaf(r)))
        trees.append((mine, *slow_tree([slow_leaf(r) for r in mine], fanout)))
    if not trees:
        return []
    root, above = slow_tree([t[1] for t in trees], fanout)
    out = []
    for (mine, top, paths), upper in zip(trees, above):
        for r, path in zip(mine, paths):
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                seen = (*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4]))
            node = slow_leaf(seen)
            for left, right in path + upper:
                node = sha(left + node + right)
            out.append((r[0], slow_leaf(r), top, root, sha("".join(x + y for x, y in path + upper)), node, node == root))
    return out


def run(table, fanout=8):
    seen = F.when(M.in_tampered_sample(F.col("doc_id")), M.lowered(F.col("text"))).otherwise(F.col("text"))
    found = M.verify(table, seen, fanout).withColumn("proof", M.siblings(F.col("path")))
    return [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()]


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("fanout", [2, 8])
def test_equals_brute_force(spark, fanout):
    """Trees of 1, fanout, fanout + 1 and many leaves, a tree without a language, one that holds most rows."""
    sizes = {"en": 150, None: 9, "de": 1, "fr": fanout, "é": fanout + 1, "": 2}
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            at += 1
            rows.append((at * 7919 % 100003, None if at % 5 == 0 else "s", lang, None if at % 7 == 0 else at,
                         None if at % 11 == 0 else f"Text É number {at}\nLINE"))
    assert sorted(run(spark.createDataFrame(rows, DOCS.fromDDL(
        "doc_id long, source string, lang string, n_chars long, text string")), fanout), key=key) == sorted(slow(rows, fanout), key=key)


def test_odd_rows(docs, odd_rows):
    """Nulls, empty and long texts, repeated rows, and columns named like the operator's own."""
    names = ["tree", "lo", "hi", "size", "digest", "seen", "path", "children", "subroot", "_tree", "named"]
    table = docs(odd_rows).withColumns({n: F.lit("x") for n in names})
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in odd_rows]
    assert sorted(run(table), key=key) == sorted(slow(rows), key=key)


def test_any_change_of_a_field_is_seen(docs):
    """Only the changed rows fail; a change that leaves the text as it is passes."""
    table = docs([(k, f"Row {k}") for k in range(40)])
    found = M.verify(table, F.when(F.col("doc_id") == 17, F.concat("text", F.lit(" "))).otherwise(F.col("text")))
    assert [r.doc_id for r in found.where("NOT verified").collect()] == [17]


def test_one_row_and_none(docs):
    (row,) = run(docs([(5, "alone")]))
    assert row[1] == row[2] == row[3] and row[4] == sha("")
    assert run(docs([])) == []


def test_intervals(docs):
    """Every level's intervals lie side by side, within their parents, and cover their tree."""
    rows = docs([(k, f"t{k}") for k in range(100)])
    manifest = M.build(rows.select(M.tree_key(F.col("lang")).alias("tree"), "doc_id", M.leaf(F.col("text")).alias("digest")), ["doc_id"], 4)
    for nodes in manifest.levels:
        spans = sorted((r.lo, r.hi) for r in nodes.collect())
        assert spans[0][0] == 0 and spans[-1][1] == 99 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
        assert all([(c.lo, c.hi) for c in r.children] == sorted((c.lo, c.hi) for c in r.children)
                   and r.children[0].lo == r.lo and r.children[-1].hi == r.hi for r in nodes.collect())
