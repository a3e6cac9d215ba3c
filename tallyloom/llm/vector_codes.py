"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

A vector is cut into equal parts; each part position has a codebook, learned by rounds of assignment and averaging, all
in whole numbers. For every entry the codebook keeps all entries sorted by their distance from it. A search walks the
list of the best entry so far, never measures an entry twice, jumps to the list of an entry that is nearer, and
stops where the list is beyond twice the current distance: what follows is farther than the current entry.

Spark deals the vectors out; tasks send sums and counts of each entry, and the driver holds codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.files import in_arrow
from tallyloom.operators.joins import attach_by_key
from tallyloom.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST = 1 << 24  # components are held between -MOST and MOST, so that distances fit 64 bits
STRIDE = 32  # places of a list measured at once
ROWS = 2_048  # vectors searched at once
FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Lists:
    """A codebook's entries in the order of their distance from each entry, in strides: places, squared distances, values, squared lengths."""

    entries: np.ndarray
    places: np.ndarray
    spans: np.ndarray
    values: np.ndarray
    lengths: np.ndarray

    def valued(self, parts: np.ndarray) -> np.ndarray:
        """The values in a type in which products with `parts` add up exactly."""
        kind = exact_type(self.entries, parts)
        return self.values if kind == self.values.dtype else self.entries.astype(kind)[self.places]


def exact_type(a: np.ndarray, b: np.ndarray) -> np.dtype:
    """The fastest type whose sums of products of rows of whole numbers `a` and `b` are exact."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    return np.dtype(np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64)


def neighbour_lists(entries: np.ndarray, stride: int = STRIDE) -> Lists:
    """Equal distances by lower index. The last stride is filled up with places out of reach."""
    count, size = entries.shape
    spans = np.stack([((entries - e) ** 2).sum(axis=1) for e in entries])
    order = np.argsort(spans, axis=1, kind="stable")
    fill = ((0, 0), (0, -count % stride))
    places = np.pad(order, fill, mode="edge").reshape(count, -1, stride)
    spans = np.pad(np.take_along_axis(spans, order, axis=1), fill, constant_values=FAR).reshape(places.shape)
    values = entries.astype(exact_type(entries, entries))[places]
    return Lists(entries, places, spans, values, (entries**2).sum(axis=1))


def _walk(parts: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    count, strides = len(lists.entries), lists.places.shape[1]
    values = lists.valued(parts)
    own, length = parts.astype(values.dtype), (parts**2).sum(axis=1)
    best = ((parts - lists.entries[0]) ** 2).sum(axis=1)
    entry, stride = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    seen = np.zeros((len(parts), count), bool)
    seen[:, 0] = True
    live = np.arange(len(parts))
    while len(live):
        at = entry[live], stride[live]
        place, now = lists.places[at], best[live]
        reached = lists.spans[at] <= 4 * now[:, None]  # squares: twice the distance
        fresh = reached & ~seen[live[:, None], place]
        seen[live[:, None], place] |= reached
        product = np.einsum("nsd,nd->ns", values[at], own[live]).astype(np.int64)
        distance = length[live, None] + lists.lengths[place] - 2 * product
        distance[~fresh] = FAR
        nearest = distance.min(axis=1)
        index = np.where(distance == nearest[:, None], place, count).min(axis=1)
        nearer = (nearest < now) | ((nearest == now) & (index < entry[live]))
        jumping = live[nearer]
        best[jumping], entry[jumping], stride[jumping] = nearest[nearer], index[nearer], 0
        stride[live[~nearer]] += 1
        live = live[nearer | (reached[:, -1] & (stride[live] < strides))]
    return entry, best


def nearest(parts: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each row, the lower index among equals."""
    found = [_walk(parts[at : at + ROWS], lists) for at in range(0, len(parts), ROWS)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _whole(vector: list[float]) -> bytes:
    scaled = np.clip(np.array(vector, np.float64), -MOST / SCALE, MOST / SCALE) * SCALE
    return np.floor(scaled).astype("<i4").tobytes()


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, whole: components as 32-bit integers; without the rows that cannot be coded."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.array([_whole(v) for v in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), whole], ["vec_id", "label", "whole"])

    kept = own.where("vector is not null").where(finite).withColumn("vector", F.col("vector").cast("array<double>"))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    return in_arrow(kept, convert, f"vec_id {kinds['vec_id']}, label {kinds['label']}, whole binary")


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("whole")).to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def _cut(whole: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(whole, parts, axis=1)


def learn(whole: DataFrame, first: np.ndarray, parts: int, rounds: int) -> list[np.ndarray]:
    """Codebooks by part position: the parts of `first`, then `rounds` rounds of assignment and floor of the mean."""
    codebooks, size = _cut(first, parts), first.shape[1]
    width, count = size // parts, len(first)
    for _ in range(rounds):
        shared = whole.sparkSession.sparkContext.broadcast([neighbour_lists(c) for c in codebooks])  # parts * entries lists

        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists = shared.value
            sums, counts = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    for p, own in enumerate(_cut(_matrix(batch.slice(at, ROWS), size), parts)):
                        index, _ = nearest(own, lists[p])
                        np.add.at(sums[p], index, own)
                        counts[p] += np.bincount(index, minlength=count)
            used = np.flatnonzero(counts.ravel())
            columns = [pa.array(used, pa.int64()), pa.array(counts.ravel()[used], pa.int64())]
            columns.append(pa.array(list(sums.reshape(-1, width)[used]), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["entry", "n", "sums"])

        each = in_arrow(whole.select("whole"), totals, "entry long, n long, sums array<long>")
        added = each.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
        codebooks = [c.copy() for c in codebooks]
        for row in added.collect():  # parts * entries rows at most
            p, i = divmod(row["entry"], count)
            codebooks[p][i] = [row[f"s{j}"] // row["n"] for j in range(width)]
        shared.unpersist()
    return codebooks


def encode(whole: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (an index byte for each part), error (squared distances summed over the parts)."""
    shared = whole.sparkSession.sparkContext.broadcast([neighbour_lists(c) for c in codebooks])  # parts * entries lists
    size = sum(c.shape[1] for c in codebooks)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                found = [nearest(own, lists[p]) for p, own in enumerate(_cut(_matrix(rows, size), len(lists)))]
                codes = np.column_stack([index for index, _ in found]).astype(np.uint8)
                error = pa.array(sum(distance for _, distance in found), pa.int64())
                columns = [rows.column(0), rows.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), error]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    return in_arrow(whole, code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")


def codebook_text(codebooks: list[np.ndarray]) -> str:
    """All components as decimal integers by part, entry and position, comma-joined."""
    return ",".join(str(x) for c in codebooks for x in c.ravel().tolist())


def compress(
    vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error of each coded row; the codebooks).

    Left out are rows whose vector is null or holds a null or a component that is not finite, and vectors of another
    length than that of the smallest vec_id kept. Components become floor(1024 * x), held within 16,384 either way. Codebooks
    start with the rows of the smallest ids, nulls last, repeated ids by vector; with fewer rows they are shorter. Rows
    that repeat an id are coded each. label_error sums the error over equal labels, nulls together; null where that passes
    a long. Without rows to code: no rows and no codebooks. A length that the parts do not divide is an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index is one byte: 1 to 256 entries")
    whole = materialise(whole_vectors(vectors, id_col, vector_col, label_col), "whole-vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole")]
    head = whole.orderBy(*order).first()
    if head is None:
        return _described(whole.select("vec_id", "label", F.col("whole").alias("code"), F.lit(0).cast("long").alias("error"))), []
    size = len(head["whole"]) // 4
    if size == 0 or size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    whole = whole.where(F.octet_length("whole") == 4 * size)
    first = [row["whole"] for row in whole.orderBy(*order).limit(entries).collect()]  # `entries` rows
    start = np.frombuffer(b"".join(first), "<i4").reshape(-1, size).astype(np.int64)
    codebooks = learn(whole, start, parts, rounds)
    return _described(materialise(encode(whole, codebooks), "vector-codes")), codebooks


def _described(coded: DataFrame) -> DataFrame:
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    return attach_by_key(coded, sums, ["label"])


def digest(codebooks: list[np.ndarray]) -> Column:
    return F.lit(hashlib.sha256(codebook_text(codebooks).encode()).hexdigest())


def decode(codes: DataFrame, codebooks: list[np.ndarray], spark: SparkSession) -> DataFrame:
    """`codes` with `vector`: the entries that the code names, as numbers of the original scale."""
    shared = spark.sparkContext.broadcast([(c / SCALE).tolist() for c in codebooks])  # the codebooks

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [[x for p, i in enumerate(code) for x in shared.value[p][i]] for code in batch.column("code").to_pylist()]
            yield batch.append_column("vector", pa.array(values, pa.list_(pa.float64())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema.fields)
    return in_arrow(codes, back, f"{kinds}, vector array<double>")
