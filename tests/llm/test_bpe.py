import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
ENCODER = bpe.Encoder(PATH, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
TOKENS = sorted(ENCODER.transducer.ranks)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(TOKENS), max_size=8))
def test_texts_made_of_vocabulary_entries(parts):
    text = b"".join(parts).decode("utf-8", "replace")
    assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_long_runs_and_small_caches(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_STATES", 50)
    monkeypatch.setattr(bpe, "KEPT_MATCHES", 10)
    small = bpe.Encoder(PATH, P.PATTERN)
    for text in ("-" * 1000, " " * 700 + "x", "ab" * 900, "the theory of theorems " * 50, "\n\n\n a", "ä" * 333):
        assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_what_an_encoder_keeps_is_small():
    """Moves and neighbours are plain numbers, a state one key; no more of them are kept than asked for."""
    t = bpe.Encoder(PATH, P.PATTERN, 2000, 100).transducer
    for k in range(2000):
        word = f"unheardof{k * 7919}ly".encode()
        assert t.encode(word) == tuple(LIBRARY._encode_single_piece(word))
    assert len(t.emitted) > 10 and all(type(x) is int for x in (*t.moves, *t.moves.values(), *t.fits))
    assert all(type(key) is bytes for key in t.index)
    assert len(t.states) < 2100 and len(t.fits) <= 2000


def test_lookahead_is_bounded():
    """Tokens come out before a long match ends."""
    t = bpe.Transducer(ENCODER.transducer.ranks)
    state, emitted = 0, 0
    for byte in b"internationalisationalists" * 4:
        state, ids = t._move(state, byte)
        emitted += len(ids)
        assert len(t.states[state][1]) <= 2 * max(map(len, TOKENS))
    assert emitted > 10


@pytest.mark.parametrize("step", [1, 2, 3, 5])
def test_utf8_stream(step):
    data = "aé日😀\x00ñ".encode() * 3
    s = bpe.Utf8Stream()
    assert "".join(s.push(data[k:k + step]) for k in range(0, len(data), step)) + s.close() == data.decode()


def test_utf8_stream_replaces_broken_bytes():
    s = bpe.Utf8Stream()
    assert s.push(b"a\xe6\x97") == "a" and s.close() == "\ufffd"


def test_round_trip(docs, odd_rows):
    one = bpe.round_trip(docs(odd_rows), PATH, P.PATTERN).collect()
    two = bpe.decode(bpe.encode(docs(odd_rows), PATH, P.PATTERN), PATH).collect()
    want = sorted(str((i, LIBRARY.encode_ordinary(t or ""), t or "")) for i, t in odd_rows)
    for rows in (one, two):
        assert sorted(str((r.doc_id, list(r.ids), r.text)) for r in rows) == want


def test_empty(docs):
    assert bpe.round_trip(docs([]), PATH, P.PATTERN).count() == 0
