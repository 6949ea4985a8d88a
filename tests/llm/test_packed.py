import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm import packed as K

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = K.WordEncoder(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert own(text) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "word", "É", "'s", "\n", "9"]), max_size=8))
def test_special_tokens_in_texts(parts):
    assert own("".join(parts)) == library("".join(parts))


def test_special_token_ids():
    assert own("hello <|endoftext|> world") == library("hello <|endoftext|> world") == [3306, 49407, 1002]


def test_every_latin_letter():
    for c in map(chr, range(33, 0x250)):
        if unicodedata.category(c)[0] != "C":
            for text in (c, f"a{c}", f"{c}b.", f"the{c}, {c}{c}"):
                assert own(text) == library(text), text


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_pack_and_random_access(bits):
    r = np.random.default_rng(bits)
    documents = [r.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 3, 1000, 1, 5000)]
    data = K.image([5, None, 7, 8, 9], documents, bits, block_ids=64)
    read = []
    f = K.PackedFile(lambda at, size: read.append(size) or data[at:at + size])
    every = np.concatenate(documents)
    assert f.lengths.tolist() == [0, 3, 1000, 1, 5000] and f.known.tolist() == [True, False, True, True, True]
    assert (f.ids(0, len(every)) == every).all()
    for a, b in ((0, 1), (63, 65), (64, 128), (900, 2222), (6003, 6004), (10, 10)):
        read.clear()
        assert (f.ids(a, b) == every[a:b]).all()
        assert sum(read) <= ((b - a) // 64 + 2) * 64 * bits // 8 + 8


def test_width():
    assert [K.width_of(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_files_hold_all_documents_in_order(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(K, "FILE_IDS", 50)
    rows = odd_rows + [(k, f"text number {k} " * (k % 7)) for k in range(200, 260)]
    table = docs(rows).withColumns({"start": F.lit(0), "ids": F.lit("x"), "tie": F.lit(1)})
    manifest = K.write(table, PATH, end=2)
    found = sorted(K.read(manifest).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [i for i, _ in order]
    assert sorted(str((r.doc_id, list(r.ids))) for r in found) == sorted(str((i, library(t) + [2])) for i, t in rows)
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += len(r.ids)
    sums = {r.start: r.ids_crc32 for r in K.checksums(manifest).collect()}
    assert sums == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found}


def test_empty(docs):
    assert K.checksums(K.write(docs([]), PATH, end=2)).count() == 0
