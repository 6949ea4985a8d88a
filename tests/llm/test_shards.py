import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import shards as S


def check(rows, got, shards=16):
    want = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.size
    return sizes


def split_groups(rows, got):
    held = defaultdict(set)
    for r in got:
        held[r.text_crc32].add(r.shard)
    return sum(len(s) > 1 for s in held.values())


@pytest.fixture
def rows():
    r = random.Random(9)
    rows = [(k, "x" * r.randint(50, 400) + str(k)) for k in range(1500)]
    for g in range(60):
        rows += [(2000 + 10 * g + c, f"group {g} " * 20) for c in range(r.randint(2, 9))]
    return rows


def test_sizes_and_links(docs, rows):
    got = S.assign(docs(rows)).collect()
    sizes = check(rows, got)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) < 0.02 * mean
    assert split_groups(rows, got) == 0


def test_a_group_of_a_third_fills_whole_shards(docs, rows):
    rows = rows + [(10_000 + k, "hot text " * 30) for k in range(800)]
    got = S.assign(docs(rows)).collect()
    sizes = check(rows, got)
    mean = sum(sizes.values()) / 16
    assert max(abs(s - mean) for s in sizes.values()) < 0.05 * mean
    hot = defaultdict(int)
    for r in got:
        if r.doc_id >= 10_000:
            hot[r.shard] += 1
    top = sorted(hot.values(), reverse=True)
    assert sum(top[:8]) > 0.85 * 800  # a random deal puts half there


def test_only_links(docs):
    rows = [(2 * k + c, f"pair {k} " * 5) for k in range(2000) for c in range(2)]
    got = S.assign(docs(rows)).collect()
    sizes = check(rows, got)
    assert max(sizes.values()) < 1.15 * sum(sizes.values()) / 16
    assert split_groups(rows, got) < 0.6 * 2000  # at random 15 of 16


def test_odd_rows_and_empty(docs, odd_rows):
    table = docs(odd_rows).withColumns({"shard": F.lit(1), "row": F.lit(2), "group": F.lit("g")})
    check(odd_rows, S.assign(table).collect())
    assert S.assign(docs([])).count() == 0
