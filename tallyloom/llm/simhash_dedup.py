"""Near-duplicates by SimHash: fingerprints embedded as bit counts of their segments, a grid range join, exact checks.

A fingerprint's segments have 0 to `bits` set bits each; these counts are a point. Fingerprints that differ in d bits
have points at most d apart by Manhattan distance, so a range join of points finds every pair to check. The
grid has a cell around every point: points at most two apart have a point between them, at most one from either, and are both
entered under its cell. A fingerprint enters its own cell and those one step away.

Equal fingerprints are one node. A cell's nodes come sorted to one task, which holds at most CELL of them, checks their Hamming
distances and reports links enough to join what links there. Fuller cells are not checked: their nodes enter a
finer grid, and the finest, of one-bit segments, has at most 65 nodes a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bytes_of, id_and_text
from tallyloom.llm.components import components
from tallyloom.llm.files import in_arrow
from tallyloom.session import materialise

SEED = 42
DISTANCE = 2
GRIDS = (4, 2, 1)  # bits a segment, from coarse to fine
CELL = 256
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def fingerprint(text: bytes, width: int) -> int:
    """A bit is set where more than half the shingles' hashes, repeats counted, have it; 0 without words."""
    words = text.lower().split()  # of bytes: ASCII only
    size = min(width, len(words))
    if not size:
        return 0
    total = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, 4_096):
        part = words[at : at + 4_096 + size - 1]
        grams = map(b" ".join, zip(*[part[i:] for i in range(size)]))
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, *, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (as a signed long) per input row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in bytes_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    own = id_and_text(docs, id_col, text_col)
    return in_arrow(own.withColumn("doc_id", F.col("doc_id").cast("long")), run, "doc_id long, fingerprint long")


def segment_counts(values: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64 / bits): set bits of each segment."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(values), -1, bits).sum(axis=2)


def cell_keys(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells that each fingerprint enters, and which fingerprint it is.

    A key is a sum of products, one a segment, so that a step along a segment adds or takes its factor. Cells that share a key
    by chance cost a check only.
    """
    counts = segment_counts(values, bits)
    factors = np.arange(1, counts.shape[1] + 1, dtype=np.uint64) * K1
    factors = ((factors ^ (factors >> np.uint64(31))) * K2) | np.uint64(1)
    own = (counts.astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)
    owner, segment = np.nonzero(counts < bits)
    lower, below = np.nonzero(counts > 0)
    keys = np.concatenate([own, own[owner] + factors[segment], own[lower] - factors[below]])
    return keys, np.concatenate([np.arange(len(values)), owner, lower])


def _entries(nodes: DataFrame, bits: int) -> DataFrame:
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                values = batch.column(0).slice(at, 2_048).to_numpy().view(np.uint64)
                keys, which = cell_keys(values, bits)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(values[which].view(np.int64))], ["key", "node"])

    return in_arrow(nodes.select("node"), enter, "key long, node long")


def cell_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Index pairs within the Hamming distance, enough of them to join all that link."""
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(len(values) - 1):
        for j in (np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((i, j))
    return out


def _checked(entries: DataFrame, distance: int, cell: float) -> DataFrame:
    """a, b: links inside the cells; a row without b for each node of a cell too full to check."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, full = None, np.zeros(0, np.uint64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(keys))
            a, b = [], []

            def close() -> None:
                if not full and len(held) > 1:
                    for i, j in cell_links(held, distance):
                        a.append(held[i])
                        b.append(held[j].view(np.int64))

            # runs of one key, the first and last of a batch being parts of cells perhaps
            alone = (ends - starts == 1) & (np.arange(len(starts)) > 0) & (np.arange(len(starts)) < len(starts) - 1)
            for start, end in zip(starts[~alone].tolist(), ends[~alone].tolist()):
                if keys[start] != last:
                    close()
                    last, held, full = keys[start], np.zeros(0, np.uint64), False
                more = values[start:end]
                if not full and len(held) + len(more) <= cell:
                    held = np.unique(np.concatenate([held, more]))
                    continue
                spilled = more if full else np.concatenate([held, more])
                held, full = np.zeros(0, np.uint64), True
                a += spilled.tolist()
                b += [None] * len(spilled)
            yield _pairs(a, b)
        if not full and len(held) > 1:
            links = cell_links(held, distance)
            yield _pairs([held[i] for i, _ in links], [held[j].view(np.int64) for _, j in links])

    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    return in_arrow(dealt, check, "a long, b long")


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(b, pa.int64())], ["a", "b"])


def fingerprint_links(nodes: DataFrame, *, distance: int = DISTANCE, grids: tuple[int, ...] = GRIDS, cell: int = CELL) -> DataFrame:
    """a, b: links between fingerprints (`node`, distinct longs) of at most `distance` differing bits, enough to join all that link."""
    if not 0 <= distance <= 2 or grids[-1] != 1:
        raise ValueError("a cell joins points two apart at most, and the last grid must have one-bit segments")
    links = None
    for bits in grids:
        found = materialise(_checked(_entries(nodes, bits), distance, cell if bits > 1 else math.inf), "simhash-links")
        here = found.where("b is not null")
        links = here if links is None else links.unionByName(here)
        full = found.where("b is null").select(F.col("a").alias("node"))
        if not full.take(1):
            break
        nodes = materialise(full.distinct(), "full-cells")
    return links


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 3, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (a signed long), component_id per input row.

    Fingerprints of at most `distance` (0 to 2) differing bits link; rows without words have fingerprint 0, which links like any
    other. component_id is the smallest id reachable, its own included. Rows without an id link nothing and have no component;
    rows that repeat an id are judged each by its text. All texts are read whole.
    """
    rows = materialise(fingerprints(docs, shingle_words=shingle_words, id_col=id_col, text_col=text_col), "fingerprints")
    first = rows.where("doc_id is not null").groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first"))
    nodes = materialise(first, "simhash-nodes")
    joined = components(fingerprint_links(nodes, distance=distance))
    placed = nodes.join(joined.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("root"), "first")
    least = placed.groupBy("root").agg(F.min("first").alias("component"))
    named = placed.join(least, "root").select(F.col("node").alias("fingerprint"), "component")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    return rows.join(named, "fingerprint", "left").select("doc_id", "fingerprint", component)
