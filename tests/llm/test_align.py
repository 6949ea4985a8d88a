import hashlib
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm import align as A

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
BPE = Tokenizer.from_file(PATHS[0])
BPE.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
PAIR = A.Pair(*PATHS)
TEXT = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "ing", "é", "日本", "😀", "▁", "<|endoftext|>", "<s>", "<0x41>", "9", " ", ".", "Haus"]),
                max_size=14).map("".join) | st.text(max_size=30)


def slow_groups(text):
    """Groups (A ids, B ids) from the two libraries run over the whole text."""
    if not text:
        return []
    data = f" {text}".encode()
    letters = {c: b for c, b in A._byte_letters().items()}
    a = BPE.encode(f" {text}", add_special_tokens=False)
    b = PIECES.encode(text)
    a_bytes = [bytes(letters[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if PIECES.is_byte(k) else p.replace("▁", " ").encode() for k in b for p in [PIECES.id_to_piece(k)]]
    if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return []
    a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
    common = sorted(set(a_ends) & set(b_ends))
    out = [([], []) for _ in common]
    for side, ids, ends in ((0, a.ids, a_ends), (1, b, b_ends)):
        for k, e in zip(ids, ends):
            out[bisect_left(common, e)][side].append(k)
    return out


def slow(rows):
    found = [slow_groups(t) for _, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in found]
    count = Counter(p for one in links for p in one)
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for (i, _), groups, mine in zip(rows, found, links):
        form = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(mine.values()),
                    sum(t for p, t in mine.items() if count[p] == highest[p[0]]), sum(t * count[p] for p, t in mine.items()),
                    hashlib.sha256(form.encode()).hexdigest() if groups else ""))
    return out


def form(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def key(row):
    return tuple(str(x) for x in row)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_stretches_equal_whole_texts(text):
    ids = PAIR.tokens([A.stretches(text)])[0]
    assert ("" if ids is None else (A.START + PAIR.fragment(ids)).closed.text(PAIR.shown)) == form(slow_groups(text))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 9), st.randoms())
def test_ranges_compose_in_any_bracketing(text, chunk, random):
    """Fragments of ranges cut anywhere give the whole text's groups, in whatever order neighbours are composed."""
    if not text:
        return
    parts = [A.range_fragment(PAIR, *r) for r in A.ranges(text, chunk)]
    if any(p is None for p in parts):
        assert slow_groups(text) == []
        return
    parts = [A.START, *parts]
    while len(parts) > 1:
        k = random.randrange(len(parts) - 1)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    assert parts[0].closed.text(PAIR.shown) == form(slow_groups(text))
    assert not len(parts[0].suffix[0]) and not len(parts[0].suffix[1])


def test_every_latin_letter():
    for c in map(chr, range(33, 0x250)):
        for text in (c, f"the {c}", f"a{c} b", f"x {c}{c}. {c}'s"):
            ids = PAIR.tokens([A.stretches(text)])[0]
            assert ("" if ids is None else (A.START + PAIR.fragment(ids)).closed.text(PAIR.shown)) == form(slow_groups(text)), text


def test_open_fragments_are_needed():
    """Ranges of one character do leave tokens open on both sides."""
    parts = [A.range_fragment(PAIR, *r) for r in A.ranges("unbelievable tokenization", 1)]
    assert any(not p.split for p in parts) and any(p.split and len(p.prefix[0]) for p in parts)


@pytest.mark.parametrize("frequent", [A.FREQUENT, 5, 0])
def test_equals_brute_force(spark, docs, odd_rows, frequent):
    rows = odd_rows + [(20 + k, f"The house number {k % 4} <|endoftext|> der Straße ist né à {'x' * k} 日本語{k}\n\n  end") for k in range(40)]
    rows += [(90, "bad ▁ mark"), (91, "the the the the"), (92, "nospaces" * 300), (93, "日本" * 500)]
    table = docs(rows).withColumns({n: F.lit("x") for n in ("row", "n", "pairs", "pair", "best", "done", "at", "closed", "link")})
    got = A.align(table, *PATHS, chunk=1000, fan=2, frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(slow(rows), key=key)


def test_the_cut_changes_nothing(spark, docs, odd_rows):
    one = A.align(docs(odd_rows), *PATHS).collect()
    many = A.align(docs(odd_rows), *PATHS, chunk=4096, fan=3).collect()
    assert sorted(map(tuple, one), key=key) == sorted(map(tuple, many), key=key)


def test_empty(docs):
    assert A.align(docs([]), *PATHS).collect() == []
    assert sorted(tuple(r) for r in A.align(docs([(1, None), (2, "")]), *PATHS).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
