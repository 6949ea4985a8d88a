"""Token ids in packed binary files: fixed width, block offsets, random access.

A file (``.bpk``, little-endian) holds

    magic 'BPK1' | bits u32 | ids a block u32 | blocks u32 | documents u64 | ids u64
    block offsets u64[blocks + 1] | doc_id i64[documents] | has a doc_id u8[documents]
    | ids of a document u64[documents] | blocks

Every id takes the least bits the vocabulary needs; a block starts on a byte, so
``PackedFile.ids(a, b)`` reads and unpacks only the blocks it needs, with numpy.

``write`` deals the rows out by ranges of doc_id and lets each task encode its texts
and write files of bounded size to the shared folder.  Names are unique to an
attempt, and only files listed in the manifest (a committed table) count, so a lost
or repeated task leaves nothing that is read.

Defined cases: a null or empty text gives just the end id; rows without a doc_id come
first; rows that repeat a doc_id are ordered by their texts, so the files are the same
whatever the input's order; an empty table writes no file and gives an empty table.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Kept, cut, scratch, worker_cache

BLOCK_IDS = 4096
#: A file is closed after the document that brings it to this many ids.
FILE_IDS = 8_000_000
#: Words and pieces (of one generation) that a worker keeps.
KEPT_WORDS = 400_000
KEPT_PIECES = 200_000
HEAD = "<4sIIIQQ"


def width_of(vocabulary: int) -> int:
    """Least bits that hold every id under ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    planes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits in (8, 16, 32):
        return planes[:, :bits // 8].tobytes()
    return np.packbits(np.unpackbits(planes, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.zeros((n, 32), np.uint8)
    planes[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").ravel()


def image(doc_ids: list, documents: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """A whole file of the given documents."""
    lengths = np.array([len(d) for d in documents], "<u8")
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    blocks = [pack(ids[a:a + block_ids], bits) for a in range(0, len(ids), block_ids)]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([struct.pack(HEAD, b"BPK1", bits, block_ids, len(blocks), len(documents), len(ids)), offsets.tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), lengths.tobytes(), *blocks])


class PackedFile:
    """Reads a file through ``read(offset, size)``; only headers are read at first."""

    def __init__(self, read):
        magic, self.bits, self.block_ids, n_blocks, self.n_docs, self.n_ids = struct.unpack(HEAD, read(0, struct.calcsize(HEAD)))
        if magic != b"BPK1":
            raise ValueError("not a packed token file")
        self.read, at = read, struct.calcsize(HEAD)
        self.offsets = np.frombuffer(read(at, 8 * (n_blocks + 1)), "<u8")
        at += 8 * (n_blocks + 1)
        table = read(at, 17 * self.n_docs)
        self.doc_ids = np.frombuffer(table, "<i8", self.n_docs)
        self.known = np.frombuffer(table, np.uint8, self.n_docs, 8 * self.n_docs).astype(bool)
        self.lengths = np.frombuffer(table, "<u8", self.n_docs, 9 * self.n_docs).astype(np.int64)
        self.first = at + 17 * self.n_docs

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the file, from the blocks that hold them."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block_ids, (stop - 1) // self.block_ids + 1
        data = self.read(self.first + int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        out = []
        for k in range(a, b):
            at = int(self.offsets[k] - self.offsets[a])
            n = min(self.block_ids, self.n_ids - k * self.block_ids)
            out.append(unpack(data[at:at + int(self.offsets[k + 1] - self.offsets[k])], self.bits, n))
        return np.concatenate(out)[start - a * self.block_ids:stop - a * self.block_ids]


def opened(path: str, data: bytes | None = None):
    """Write ``data`` to a path of the shared folder, or give its ``read(offset, size)``."""
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    store, inner = fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))
    if data is not None:
        with store.open_output_stream(inner) as out:
            out.write(data)
        return None
    source = store.open_input_file(inner)
    return lambda offset, size: source.read_at(size, offset)


#: A Latin word with at most one mark after it: two pieces of the tokenizer's own split (U+0130 is out: its
#: lower case has a combining mark).
SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]?)")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class WordEncoder:
    """Ids of whole texts with the tokenizers library, as little-endian unsigned 32-bit integers.

    Its pieces never cross white space, so a text's ids are those of its words; words that this
    worker has met are looked up.  The lower-case letters of a simple word are one piece, which
    goes straight to the library's model; any other word goes through the whole library, which
    gives the special tokens' ids where a text holds their strings.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words = Kept(KEPT_WORDS, self._word)
        self.pieces = Kept(KEPT_PIECES, self._piece)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, data: bytes) -> bytes:
        word = data.decode()
        m = SIMPLE.fullmatch(word)
        if m:
            return self.pieces[m[1].lower()] + (self.pieces[m[2]] if m[2] else b"")
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.words.__getitem__, text.encode().split()))


def write(docs: DataFrame, path: str, end: int, folder: str | None = None) -> DataFrame:
    """Encode every row and write the files; returns the manifest (path, first, n_ids, n_docs), first being the ids before the file.

    The rows are dealt out by ranges of (doc_id, text checksum), so ids that repeat, or rows
    without one, are split too.
    """
    from tokenizers import Tokenizer

    folder = folder or scratch(docs.sparkSession, "packed")
    bits = width_of(Tokenizer.from_file(path).get_vocab_size())

    def files(batches):
        encoder = worker_cache(f"words {path}", lambda: WordEncoder(path))
        task, doc_ids, held, size, number = TaskContext.get().partitionId(), [], [], 0, 0
        last = struct.pack("<I", end)

        def close():
            name = f"{folder}-{task:06d}-{number:06d}-{uuid.uuid4().hex}.bpk"
            opened(name, image(doc_ids, held, bits))
            return pa.record_batch([pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([name]), pa.array([size], pa.int64()),
                                    pa.array([len(held)], pa.int64())], ["task", "number", "path", "n_ids", "n_docs"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    doc_ids.append(doc)
                    held.append(np.frombuffer(encoder.encode(text) + last, "<u4"))
                    size += len(held[-1])
                    if size >= FILE_IDS:
                        yield close()
                        doc_ids, held, size, number = [], [], 0, number + 1
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.crc32(F.coalesce("text", F.lit(""))).alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("text")]
    listed = cut(rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(
        files, "task int, number int, path string, n_ids long, n_docs long"), "manifest")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return listed.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"), "n_ids", "n_docs")


def _read(manifest: DataFrame, column: str, kind: str, of) -> DataFrame:
    """doc_id, start, n_tokens and ``of(ids, offsets)`` of runs of documents, one task a file."""
    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                file = PackedFile(opened(path))
                ends = np.cumsum(file.lengths)
                starts = ends - file.lengths
                for a in range(0, file.n_docs, 256):
                    b = min(a + 256, file.n_docs)
                    ids = file.ids(int(starts[a]), int(ends[b - 1]))
                    offsets = np.concatenate((starts[a:b], ends[b - 1:b])) - starts[a]
                    yield pa.record_batch([
                        pa.array(file.doc_ids[a:b], mask=~file.known[a:b]), pa.array(first + starts[a:b]), pa.array(file.lengths[a:b]),
                        of(ids, offsets)], ["doc_id", "start", "n_tokens", column])

    # a given number of partitions is not coalesced, however few bytes the manifest has
    spread = manifest.select("path", "first").repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column} {kind}")


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (array of int) of every document, from the files."""
    return _read(manifest, "ids", "array<int>", lambda ids, offsets: pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))))


def checksums(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers, from the files."""
    def crc(ids, offsets):
        data = memoryview(ids.astype("<u4").tobytes())
        return pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.int64())

    return _read(manifest, "ids_crc32", "long", crc)
