"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding.  The last token of the BPE encoding of every prefix is fixed by that
prefix: it is the token whose left neighbour (the last token where it begins) and
itself do not merge across their border.  A state of the transducer is the last
token emitted and the bytes read since; reading a byte finds the last token of the
longer prefix, and emits the tokens that lie on the way to every position where a
vocabulary entry may still be under way (the lookahead is bounded by the longest
entry).  States and moves are made when first met and kept, as are the ids of whole
matches of the pattern.

Decoding.  Token bytes are pushed into ``Utf8Stream``, which gives out complete
characters and holds an unfinished one (at most three bytes) until the next push.

Defined cases: a null or empty text has no ids and decodes to nothing; rows that
repeat a document or lack a ``doc_id`` give one row each; an empty table gives an
empty table; ids that the vocabulary lacks raise an error.
"""

from __future__ import annotations

import base64
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cartwheel.llm.common import Kept, worker_cache

#: Matches (of one generation) and states that a worker keeps; beyond it they are made anew.
KEPT_MATCHES = 250_000
KEPT_STATES = 300_000
#: Documents that a task encodes before it hands over a batch.
BATCH = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _small(numbers: tuple):
    """The numbers in bytes where they fit, which are indexed alike and take a fraction of a tuple."""
    return bytes(numbers) if max(numbers) < 256 else numbers


class Transducer:
    """Piecewise encoder; ``encode`` gives the ids of one match of the pattern."""

    def __init__(self, ranks: dict[bytes, int], kept: int | None = None):
        self.ranks, self.kept = ranks, kept or KEPT_STATES
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t))}
        self.fits: dict[int, bool] = {}  # by the ranks of both
        self.derived: dict[bytes, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, int] = {}  # the next state, and above it the place of the ids it emits
        self.emitted: list[tuple] = [()]
        self.places: dict[tuple, int] = {(): 0}
        self.ends: dict[int, tuple] = {}
        self._state(None, b"", (0,), (0,))

    def _state(self, prev: bytes | None, pending: bytes, last: tuple, live: tuple) -> int:
        """last: length of the last token at every position of pending; live: where an entry may be under way."""
        place = 0 if prev is None else 1 if not prev else self.ranks[prev] + 2
        key = place.to_bytes(4, "big") + pending
        known = self.index.get(key)
        if known is None:
            known = self.index[key] = len(self.states)
            self.states.append((key, _small(last), _small(live)))
        return known

    def merged(self, piece: bytes) -> list[bytes]:
        """The merges by rank, applied to a short piece; used to compare two neighbours."""
        get, none = self.ranks.get, 1 << 60
        parts = [piece[k:k + 1] for k in range(len(piece))]
        order = [get(piece[k:k + 2], none) for k in range(len(piece) - 1)]
        while order and (best := min(order)) < none:
            k = order.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del order[k]
            if k:
                order[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(order):
                order[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def _fits(self, left: bytes | None, token: bytes) -> bool:
        """The encoding of left + token is exactly these two."""
        if left is None:
            known = self.derived.get(token)
            if known is None:
                known = self.derived[token] = self.merged(token) == [token]
            return known
        key = self.ranks[left] << 32 | self.ranks[token]
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= self.kept:
                self.fits.clear()
            known = self.fits[key] = self.merged(left + token) == [left, token]
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        key, last, live = self.states[state]
        place = int.from_bytes(key[:4], "big")
        prev, pending = None if place == 0 else b"" if place == 1 else self.tokens[place - 2], key[4:]
        text = pending + bytes((byte,))
        n, ranks, prefixes = len(text), self.ranks, self.prefixes
        for j in live:
            token = text[j:]
            if token in ranks and self._fits(None, token):
                left = text[j - last[j]:j] if j else prev
                if left is None or self._fits(left, token):
                    break
        last = (*last, n - j)
        alive = [j for j in live if text[j:] in prefixes]
        cut = n
        for j in alive:  # where the ways of all live positions meet
            while cut != j:
                if cut > j:
                    cut -= last[cut]
                else:
                    j -= last[j]
        ids, k = [], cut
        while k:
            token = text[k - last[k]:k]
            if k == cut:
                prev = token
            ids.append(ranks[token])
            k -= last[k]
        alive.append(n)
        if alive[0] != cut:  # no entry can begin there any more, so its left neighbour no longer matters
            prev = b""
        return self._state(prev, text[cut:], (0, *last[cut + 1:]), tuple(j - cut for j in alive)), tuple(reversed(ids))

    def _place(self, ids: tuple) -> int:
        known = self.places.get(ids)
        if known is None:
            known = self.places[ids] = len(self.emitted)
            self.emitted.append(ids)
        return known

    def _end(self, state: int) -> tuple:
        key, last, _ = self.states[state]
        pending = key[4:]
        k, ids = len(pending), []
        while k:
            ids.append(self.ranks[pending[k - last[k]:k]])
            k -= last[k]
        return tuple(reversed(ids))

    def encode(self, piece: bytes) -> tuple:
        known = self.ranks.get(piece)
        if known is not None:
            return (known,)
        if len(self.states) > self.kept:
            self._clear()
        state, out, moves, emitted = 0, [], self.moves, self.emitted
        for byte in piece:
            at = state << 8 | byte
            move = moves.get(at)
            if move is None:
                move, ids = self._move(state, byte)
                move = moves[at] = move | self._place(ids) << 32
            if move < 1 << 32:
                state = move
            else:
                state = move & 0xFFFFFFFF
                out += emitted[move >> 32]
        end = self.ends.get(state)
        if end is None:
            end = self.ends[state] = self._end(state)
        return (*out, *end)


#: Finds a character that ``latin_pattern`` does not cover.
BEYOND_LATIN = re.compile("[^\\x00-\\u024f]").search


def latin_pattern(pattern: str) -> str:
    """The pattern for the standard library's faster engine, right for texts below U+0250: the
    classes of letters, numbers and white space are spelt out."""
    def spelt(kinds) -> str:
        found = [c for c in range(0x250) if kinds(chr(c))]
        return "".join(f"\\u{c:04x}" for c in found)

    classes = {
        r"\p{L}": spelt(lambda c: unicodedata.category(c)[0] == "L"), r"\p{N}": spelt(lambda c: unicodedata.category(c)[0] == "N"),
        r"\s": spelt(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")}
    out, inside, k = "", False, 0
    while k < len(pattern):
        name = next((n for n in (*classes, r"\S") if pattern.startswith(n, k)), None)
        if name == r"\S":
            out += f"[^{classes[chr(92) + 's']}]"
        elif name:
            out += classes[name] if inside else f"[{classes[name]}]"
        else:
            inside = pattern[k] == "[" or (inside and pattern[k] != "]")
            out += pattern[k]
        k += len(name or " ")
    return out


class Encoder:
    """Whole texts: each match of the pattern goes through the transducer."""

    def __init__(self, path: str, pattern: str, states: int | None = None, matches: int | None = None):
        self.transducer = Transducer(read_ranks(path), states)
        self.find = regex.compile(pattern).findall
        self.plain = re.compile(latin_pattern(pattern)).findall
        self.known = Kept(matches or KEPT_MATCHES, lambda match: np.array(self.transducer.encode(match.encode()), np.int32).tobytes())

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text, as 32-bit integers."""
        if not text:
            return np.zeros(0, np.int32)
        matches = self.find(text) if BEYOND_LATIN(text) else self.plain(text)
        return np.frombuffer(b"".join(map(self.known.__getitem__, matches)), np.int32)


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


class Utf8Stream:
    """Incremental UTF-8: push bytes, get the complete characters so far."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and lack its rest."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b < 0x80:
                return 0
            if b >= 0xC0:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                return back if back < need else 0
        return 0

    def push(self, data: bytes) -> str:
        data = self.held + data
        keep = self._unfinished(data)
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""
    docs = docs.select("doc_id", "text")

    def run(batches):
        encoder = worker_cache(f"bpe {path} {pattern}", lambda: Encoder(path, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), id_lists(ids)], ["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def _bytes_of(path: str) -> list:
    ranks = read_ranks(path)
    out = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decoded(tokens: list, ids: list[int], chunk: int = 4096) -> str:
    """The text of ids, pushed through the stream a chunk of tokens at a time."""
    stream, out = Utf8Stream(), []
    for at in range(0, len(ids), chunk):
        out.append(stream.push(b"".join(map(tokens.__getitem__, ids[at:at + chunk]))))
    return "".join(out) + stream.close()


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The given doc_id and ids with their text."""
    encoded = encoded.select("doc_id", "ids")

    def run(batches):
        tokens = worker_cache(f"bpe bytes {path}", lambda: _bytes_of(path))
        for batch in batches:
            column = batch.column(1)
            ends, values = column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)
            texts = [decoded(tokens, values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch([batch.column(0), column, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, states: int | None = None, matches: int | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one Python stage: doc_id, ids and the decoded text.

    With fewer ``states`` and ``matches`` than KEPT_STATES and KEPT_MATCHES a worker takes less memory and more time.
    """
    docs = docs.select("doc_id", "text")

    def run(batches):
        encoder = worker_cache(f"bpe {path} {pattern} {states} {matches}", lambda: Encoder(path, pattern, states, matches))
        tokens = worker_cache(f"bpe bytes {path}", lambda: _bytes_of(path))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), id_lists(ids), pa.array([decoded(tokens, x.tolist()) for x in ids], pa.string())],
                                      ["doc_id", "ids", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
