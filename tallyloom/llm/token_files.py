"""Token ids in files of patched frame-of-reference blocks.

A file: blocks of BLOCK ids, then the index, then the footer. A block holds its minimum, the width that
covers PERCENTILE of its differences to the minimum, those differences packed at that width, and an
exception list (position, upper bits) for the larger ones. The index holds the byte position of each block
and, per document, its id and its number of ids; so any range of ids is read without the blocks before it.

All numbers are little-endian. Block head: minimum u32, width u8, exceptions u16. Footer: ids u64, blocks u64,
documents u64, index position u64, MAGIC. Index: block positions u64, document ids i64, null flags u8, counts u64.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import id_and_text
from tallyloom.llm.files import default_folder, in_arrow, new_file, one_each, open_file
from tallyloom.llm.tokens import ID, WORDS, encoder
from tallyloom.session import materialise

MAGIC = b"PFORIDS1"
BLOCK = 256
LANE = 64  # values that share `width` words of 64 bits
PERCENTILE = 0.9
HEAD, FOOTER = struct.Struct("<IBH"), struct.Struct("<QQQQ8s")
RUN = 4_096  # blocks encoded or decoded at once


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) u64 below 2**width as (n, BLOCK * width // LANE) words."""
    lanes = values.reshape(-1, LANE)
    words = np.zeros((len(lanes), width), np.uint64)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        words[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return words.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width) if width else np.zeros((len(words) * BLOCK // LANE, 0), np.uint64)
    values = np.zeros((len(lanes), LANE), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        got = lanes[:, word] >> np.uint64(shift)
        if shift + width > 64:
            got |= lanes[:, word + 1] << np.uint64(64 - shift)
        values[:, i] = got & mask
    return values.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of `ids` (u32); the last one is filled up with its last id."""
    if not len(ids):
        return []
    blocks = np.pad(ids, (0, -len(ids) % BLOCK), mode="edge").reshape(-1, BLOCK).astype(np.uint64)
    least = blocks.min(axis=1)
    deltas = blocks - least[:, None]
    bits = np.frexp(deltas.astype(np.float64))[1].astype(np.uint8)  # bit length
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    widths = np.partition(bits, rank, axis=1)[:, rank]
    over = bits > widths[:, None]
    out: list[bytes] = [b""] * len(blocks)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        low = deltas[rows] & np.uint64((1 << width) - 1)
        packed = _pack(low, width).astype("<u8", copy=False)
        for at, row in enumerate(rows.tolist()):
            where = np.flatnonzero(over[row])
            high = (deltas[row, where] >> np.uint64(width)).astype("<u4")
            head = HEAD.pack(int(least[row]), width, len(where))
            out[row] = head + packed[at].tobytes() + where.astype("<u2").tobytes() + high.tobytes()
    return out


def decode_blocks(data: bytes, positions: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at `positions` in `data`."""
    heads = [HEAD.unpack_from(data, at) for at in positions.tolist()]
    widths = np.array([h[1] for h in heads])
    values = np.zeros((len(heads), BLOCK), np.uint64)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        size = BLOCK * width // 8
        words = [data[positions[row] + HEAD.size : positions[row] + HEAD.size + size] for row in rows]
        values[rows] = _unpack(np.frombuffer(b"".join(words), "<u8").reshape(len(rows), -1), width)
    for row, (_, width, patches) in enumerate(heads):
        if patches:
            at = int(positions[row]) + HEAD.size + BLOCK * width // 8
            where = np.frombuffer(data, "<u2", patches, at)
            values[row, where] |= np.frombuffer(data, "<u4", patches, at + 2 * patches).astype(np.uint64) << np.uint64(width)
    return (values + np.array([h[0] for h in heads], np.uint64)[:, None]).astype(ID).reshape(-1)


class Writer:
    """One file, written in runs of blocks."""

    def __init__(self, stream):
        self.stream, self.size = stream, 0
        self.held: list[bytes] = []
        self.waiting = self.n_ids = 0
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // ID.itemsize)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= RUN * BLOCK * ID.itemsize:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), ID)
        ready = len(ids) if last else len(ids) - len(ids) % BLOCK
        for at in range(0, ready, RUN * BLOCK):
            blocks = encode_blocks(ids[at : min(ready, at + RUN * BLOCK)])
            for block in blocks:
                self.starts.append(self.size)
                self.size += len(block)
            self.stream.write(b"".join(blocks))
        self.n_ids += ready
        self.held = [ids[ready:].tobytes()]
        self.waiting = len(self.held[0])

    def close(self) -> None:
        self._flush(True)
        nulls = np.array([d is None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        for part in (np.array(self.starts, "<u8"), ids, nulls, np.array(self.counts, "<u8")):
            self.stream.write(part.tobytes())
        self.stream.write(FOOTER.pack(self.n_ids, len(self.starts), len(self.doc_ids), self.size, MAGIC))
        self.stream.close()


class Reader:
    """Random access by id number."""

    def __init__(self, file):
        self.file, size = file, file.size()
        self.n_ids, blocks, docs, self.index_at, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        index = file.read_at(size - FOOTER.size - self.index_at, self.index_at)
        self.starts = np.append(np.frombuffer(index, "<u8", blocks), self.index_at).astype(np.int64)
        at = 8 * blocks
        ids, nulls = np.frombuffer(index, "<i8", docs, at), np.frombuffer(index, "u1", docs, at + 8 * docs)
        self.doc_ids = [None if n else d for d, n in zip(ids.tolist(), nulls.tolist())]
        self.counts = np.frombuffer(index, "<u8", docs, at + 9 * docs).astype(np.int64)

    def ids(self, start: int, count: int) -> np.ndarray:
        if count <= 0:
            return np.zeros(0, ID)
        first, last = start // BLOCK, (start + count - 1) // BLOCK + 1
        begin = int(self.starts[first])
        data = self.file.read_at(int(self.starts[last]) - begin, begin)
        return decode_blocks(data, self.starts[first:last] - begin)[start - first * BLOCK :][:count]


def write_token_files(
    docs: DataFrame, vocabulary: str, *, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, append `end_id`, and write files in ascending id order.

    Returns the files: part, path, n_docs, n_ids, start (ids in all files before). Texts are
    range-partitioned by id, so each task writes one file, and encoded once. A null text is empty; rows
    without an id come first; rows that repeat an id follow each other, by a hash of the text. No rows: no files.
    """
    folder = default_folder(docs.sparkSession, folder, "token-files")
    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    end = ID.type(end_id).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer, path = encoder(vocabulary), None, ""
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if writer is None:
                    path, stream = new_file(folder, ".pfor")
                    writer = Writer(stream)
                writer.add(doc_id, words.encode(text) + end)
        if writer:
            writer.close()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_docs": len(writer.doc_ids), "n_ids": writer.n_ids}], FILES)

    files = materialise(in_arrow(ordered, write, "part long, path string, n_docs long, n_ids long", uses=WORDS), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


FILES = pa.schema({"part": pa.int64(), "path": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64()})
DOCS = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "ids": pa.binary()})


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (little-endian u32) of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    yield from _documents(Reader(file), row["start"])

    return in_arrow(one_each(files.select("path", "start")), read, "doc_id long, start long, ids binary")


def _documents(reader: Reader, base: int) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(reader.counts)
    at = 0
    while at < len(ends):
        begin = int(ends[at] - reader.counts[at])
        # as many documents as fill a run, one at least
        to = max(at + 1, int(np.searchsorted(ends, begin + RUN * BLOCK, side="right")))
        data = reader.ids(begin, int(ends[to - 1]) - begin).tobytes()
        rows = []
        for doc in range(at, to):
            stop = int(ends[doc])
            start = stop - int(reader.counts[doc])
            rows.append((reader.doc_ids[doc], base + start, data[(start - begin) * ID.itemsize : (stop - begin) * ID.itemsize]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), DOCS)], schema=DOCS)
        at = to
