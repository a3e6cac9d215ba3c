"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures, links confirmed on full sets.

Texts with equal shingle sets form one class. Each class has a signature of SLOTS values of BITS bits; two sets of the
wanted similarity differ in at most `max_distance` slots, but for a chance of MISS. A signature is cut into
chunks so that, by pigeonhole, two signatures within the distance have a chunk with at most RADIUS errors; each
chunk is entered under every choice of RADIUS slots left out, so every such pair shares a bucket.

Buckets are never expanded into pairs. Each is compared with its pivot, its smallest member (a star). Where the
members of a pivot's cell still lie in several components, they are compared across components in blocks that hold
each member once, and those that are close in tiles of bounded size. Candidates within the distance are confirmed on full shingle sets; components join what links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations, combinations_with_replacement, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bloom_filtered, bytes_of, id_and_text, text_mark
from tallyloom.llm.components import components
from tallyloom.llm.files import in_arrow, in_pandas
from tallyloom.session import materialise, scratch_path, temporary_copies

SLOTS, BITS, RADIUS, MISS = 64, 16, 1, 1e-5
BLOCK = 4_096
# members compared by signature at once, and those compared by their full sets: so many, or of so many bytes
TILE, TILE_BYTES, GROUP_BYTES = 512, 2 << 20, 8 << 20
LEAST_LONG = -(1 << 63)
CACHED_WORDS = 300_000
FACTORS = (np.random.default_rng(20_231).integers(0, 1 << 63, SLOTS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def max_distance(percent: int) -> int:
    """Slots in which two sets of this similarity differ at most, but for a chance of MISS; the most that the chunks allow."""
    p = (1 - percent / 100) * (1 - 2.0**-BITS)
    tail, d = 1.0, -1
    while tail > MISS and d < SLOTS:
        d += 1
        tail -= math.comb(SLOTS, d) * p**d * (1 - p) ** (SLOTS - d)
    return chunk_count(d) * (RADIUS + 1) - 1


def chunk_count(distance: int) -> int:
    """With `distance` < chunks * (RADIUS + 1), some chunk has at most RADIUS errors."""
    return distance // (RADIUS + 1) + 1


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * K2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles, ascending; A-Z lower-cased, words between ASCII white space."""
    words = text.lower().split()  # of bytes: ASCII only
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(codes):
        return codes
    size = min(width, len(codes))
    out = codes[: len(codes) - size + 1] + np.uint64(size)
    for i in range(1, size):
        out = mixed(out) * K1 + codes[i : len(codes) - size + 1 + i]
    return np.unique(mixed(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4_096):
        least = np.minimum(least, (shingles[at : at + 4_096, None] * FACTORS).min(axis=0))
    return (mixed(least) >> np.uint64(64 - BITS)).astype("<u2")


def bucket_keys(signatures: np.ndarray, distance: int) -> np.ndarray:
    """(n, keys): a hash for each chunk and each choice of RADIUS of its slots to leave out."""
    cuts = np.linspace(0, SLOTS, chunk_count(distance) + 1).round().astype(int)
    keys = []
    for chunk, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for out in combinations(range(a, b), min(RADIUS, b - a)):
            key = np.full(len(signatures), (chunk << 32) + sum((i + 1) << 8 * n for n, i in enumerate(out)), np.uint64)
            for slot in range(a, b):
                if slot not in out:
                    key = mixed(key) * K1 + signatures[:, slot]
            keys.append(mixed(key))
    return np.column_stack(keys)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, SLOTS)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, mark, n_shingles, set_id (a 128-bit hash of the set; null when empty), signature of each input row."""
    names = ["doc_id", "mark", "n_shingles", "set_id", "signature"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, ids, signatures = [], [], []
            for text in bytes_of(batch):
                shingles = shingle_set(text, width, hashes)
                sizes.append(len(shingles))
                ids.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return in_arrow(docs, sketch, "doc_id long, mark long, n_shingles long, set_id binary, signature binary")


def cells(nodes: DataFrame, distance: int) -> DataFrame:
    """pivot, node: every member of a shared bucket under the bucket's smallest member.

    The entries are shuffled once; a bucket comes sorted, so its first entry is the pivot and none is held back.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = bucket_keys(_matrix(batch.column(1).to_pylist()), distance).view(np.int64)
                for at in range(0, len(keys), 1_000):
                    part = keys[at : at + 1_000]
                    ids = np.repeat(batch.column(0).slice(at, len(part)).to_numpy(), part.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(part.ravel()), pa.array(ids)], ["key", "node"])

    def under_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            opens = np.append(last is None or keys[0] != last, keys[1:] != keys[:-1])
            pivots = np.append(pivot, members[opens])[np.cumsum(opens)]
            last, pivot = keys[-1], pivots[-1]
            apart = pivots != members
            yield pa.RecordBatch.from_arrays([pa.array(pivots[apart]), pa.array(members[apart])], ["pivot", "node"])

    entries = in_arrow(nodes.select("node", "signature"), enter, "key long, node long")
    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    return in_arrow(dealt, under_pivots, "pivot long, node long").distinct()


def _near(pairs: DataFrame, nodes: DataFrame, distance: int) -> DataFrame:
    """The pairs (pivot, node) whose signatures lie within the distance."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(i).to_pylist()) for i in (2, 3))
                close = pa.array((a != b).sum(axis=1) <= distance)
                yield batch.select([0, 1]).filter(close)

    signatures = nodes.select("node", "signature")
    both = pairs.join(signatures, "node").join(signatures.select(F.col("node").alias("pivot"), F.col("signature").alias("other")), "pivot")
    return in_arrow(both.select("pivot", "node", "signature", "other"), measure, "pivot long, node long")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, shingles: the full sets of the wanted nodes (node, doc_id, mark), from their whole texts; stored.

    A Bloom filter of the wanted rows, which Spark builds and applies to the scan, keeps other texts out of the exchange. What it
    lets through by chance falls out in the join.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, width, hashes).tobytes() for t in bytes_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    wanted = materialise(wanted, "wanted")
    # the optimizer takes a side with a comparison for a selective one; every id passes
    chosen = wanted.where(F.col("doc_id") >= LEAST_LONG)
    own = docs.join(chosen, ["doc_id", "mark"]).select("node", "text")
    with bloom_filtered(docs.sparkSession, wanted.count()):
        return materialise(in_arrow(own, build, "node long, shingles binary"), "sets")


def _texts_of(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, doc_id, mark: a text for each of the wanted nodes."""
    return nodes.select("node", "doc_id", "mark").join(wanted.distinct(), "node", "left_semi")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star_links(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(*(batch.column(i).to_pylist() for i in (2, 3)))
            ok = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in pairs]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = near.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("other")), "pivot")
    return in_arrow(both.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "shingles", "other"), confirm, "a long, b long")


MEMBER = "struct<node:long,component:long,n_shingles:long,signature:binary>"


def _blocks(members: DataFrame) -> DataFrame:
    """pivot, block, members: cells dealt into blocks of about BLOCK members, each member in one.

    Within a cell, a component of half a block or more has blocks of its own; smaller components share blocks.
    """
    # figures are written before they are joined, so that a join can split a hot pivot
    sizes = materialise(members.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("n")), "component-sizes")
    large = F.col("n") >= BLOCK // 2
    small = materialise(sizes.where(~large).groupBy("pivot").agg(F.sum("n").alias("rest")), "cell-rests")
    kinds = sizes.join(small, "pivot", "left").select(
        "pivot", "component", large.alias("large"), F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK).alias("parts")
    )
    kinds = materialise(kinds, "kinds")
    salt = F.when(F.col("large"), F.xxhash64("node")).otherwise(F.xxhash64("component"))
    owner = F.when(F.col("large"), F.concat(F.lit("c"), F.col("component").cast("string"))).otherwise("small")
    block = F.concat_ws(":", owner, F.pmod(salt, F.col("parts")).cast("string"))
    dealt = members.join(kinds, ["pivot", "component"]).withColumn("block", block)
    held = F.collect_list(F.struct("node", "component", "n_shingles", "signature"))  # about BLOCK members
    return dealt.groupBy("pivot", "block").agg(held.alias("members"))


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """members, others of each two blocks of a cell that may hold links; `others` is null for a block with itself.

    Blocks of one large component are left out, with themselves and with one another: their members are joined already. Pairs are
    found by name first, so that those of one cell are dealt out over tasks.
    """
    names = materialise(blocks.select("pivot", "block"), "block-names")
    own = F.substring_index("first", ":", 1)
    apart = (own == "small") | (own != F.substring_index("second", ":", 1))
    pairs = names.withColumnRenamed("block", "first").join(names.withColumnRenamed("block", "second"), "pivot").where("first < second").where(apart)
    first = blocks.select("pivot", F.col("block").alias("first"), "members")
    second = blocks.select("pivot", F.col("block").alias("second"), F.col("members").alias("others"))
    two = pairs.join(first, ["pivot", "first"]).join(second, ["pivot", "second"]).select("members", "others")
    one = blocks.where("block like 'small:%'").select("members", F.lit(None).cast(f"array<{MEMBER}>").alias("others"))
    return one.unionByName(two)


def _tiles(sizes: np.ndarray) -> list[slice]:
    """Runs of at most TILE members, or of about TILE_BYTES of sets."""
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i - start == TILE or (i > start and held + 8 * size > TILE_BYTES):
            out.append(slice(start, i))
            start, held = i, 0
        held += 8 * size
    return out + [slice(start, len(sizes))] * (start < len(sizes))


def _close_pairs(signatures: np.ndarray, component: np.ndarray, distance: int, others_from: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs across components within the distance; with `others_from`, of one row before it and one from it on."""
    a, b = [np.zeros(0, int)], [np.zeros(0, int)]
    for i in range(others_from or len(component) - 1):
        at = others_from or i + 1
        other = np.flatnonzero(component[at:] != component[i]) + at
        close = other[(signatures[other] != signatures[i]).sum(axis=1) <= distance]
        a.append(np.full(len(close), i))
        b.append(close)
    return np.concatenate(a), np.concatenate(b)


def _close_tiles(pairs: DataFrame, distance: int) -> DataFrame:
    """bytes, members: for each two tiles of a block pair, the members close to one of another component; none where nothing is."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, two = batch.column(0)[row].values, batch.column(1)[row].values
                held = one if two is None else pa.concat_arrays([one, two])
                node, component, size = (held.field(i).to_numpy() for i in range(3))
                signatures = _matrix(held.field(3).to_pylist())
                first = _tiles(size[: len(one)])
                second = [slice(t.start + len(one), t.stop + len(one)) for t in _tiles(size[len(one) :])]
                for x, y in product(first, second) if two is not None else combinations_with_replacement(first, 2):
                    at = np.r_[x] if x == y else np.r_[x, y]
                    cut = 0 if x == y else x.stop - x.start
                    a, b = _close_pairs(signatures[at], component[at], distance, cut)
                    if len(a):
                        at = at[np.unique(np.concatenate([a, b]))]
                        yield _tile_row(8 * int(size[at].sum()), held.take(pa.array(at)))

    return in_arrow(pairs, find, f"bytes long, members array<{MEMBER}>")


def _tile_row(size: int, members: pa.StructArray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([size]), pa.ListArray.from_arrays(pa.array([0, len(members)], pa.int32()), members)], ["bytes", "members"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 strips over the shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(shared.sum()), 4_096):
        a, b = np.searchsorted(column, (at, at + 4_096))
        strip = np.zeros((len(sets), 4_096), np.float32)
        strip[owner[a:b], column[a:b] - at] = 1
        out += strip @ strip.T
    return out.astype(np.int64)


def block_links(sets: list[np.ndarray], signatures: np.ndarray, component: np.ndarray, distance: int, percent: int) -> list[tuple[int, int]]:
    """Links across components inside one pair of blocks, enough of them to join all that link."""
    a, b = _close_pairs(signatures, component, distance)
    if not len(a):
        return []
    sizes = np.array([len(s) for s in sets])
    if len(a) > 500:
        both = _overlaps(sets)[a, b]
        ok = 100 * both >= percent * (sizes[a] + sizes[b] - both)
    else:
        ok = np.array([linked(sets[i], sets[j], percent) for i, j in zip(a, b)])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for i, j in zip(a[ok].tolist(), b[ok].tolist()):
        x, y = root(int(component[i])), root(int(component[j]))
        if x != y:
            parent[x] = y
            out.append((i, j))
    return out


def _cross_links(members: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, distance: int, percent: int) -> DataFrame:
    """Links between members of a cell that lie in different components."""
    blocks = materialise(_blocks(members), "blocks")
    close = materialise(_close_tiles(_block_pairs(blocks), distance).withColumn("tile", F.monotonically_increasing_id()), "close-tiles")
    rows = close.select("tile", F.inline("members"))
    sets = _sets_of(docs, _texts_of(nodes, rows.select("node")), width)

    def confirm(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby("tile", sort=False):
            shingles = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
            nodes = part["node"].to_numpy()
            found = block_links(shingles, _matrix(part["signature"]), part["component"].to_numpy(), distance, percent)
            out += [(nodes[i], nodes[j]) for i, j in found]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    # whole tiles in frames of about GROUP_BYTES of sets
    held = close.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    group = F.pmod(F.xxhash64("tile"), F.lit(1 + held // GROUP_BYTES)).alias("_g")
    dealt = rows.join(sets, "node").select(group, "tile", "node", "component", "signature", "shingles")
    return in_pandas(dealt.groupBy("_g"), docs.sparkSession, confirm, "a long, b long")


def _joined(own: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v: the nodes that link, and the smallest of their component."""
    distance = max_distance(percent)
    # different sets of fewer than `least` shingles cannot reach the similarity
    least = -(-percent // (100 - percent)) if percent < 100 else 1
    large = nodes.where(F.col("n_shingles") >= least)
    stars = materialise(cells(large, distance), "cells")
    near = materialise(_near(stars, large, distance), "near")
    ends = near.select("pivot").unionByName(near.select(F.col("node").alias("pivot"))).withColumnRenamed("pivot", "node")
    sets = _sets_of(own, _texts_of(nodes, ends), width)
    links = materialise(_star_links(near, sets, percent), "star-links")
    joined = components(links)
    # its members are dealt out by several figures of their own: written once, not joined for each
    members = materialise(_open_cells(stars, joined, large), "open-cells")
    more = materialise(_cross_links(members, own, nodes, width, distance, percent), "cross-links")
    if more.take(1):
        joined = components(joined.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(more))
    return joined


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, kept, chosen of each input row; `mark` is a hash of the text.

    A text's set is its distinct shingles of `shingle_words` words; with fewer words the whole sequence is one shingle; a
    text without words, or null, has none and links with nothing. Texts link when 100 * intersection >= `percent` *
    union. component_id is the smallest id reachable; `kept` where it is the row's own. `chosen`: of the component's texts
    under that id, the one with the smallest mark. Rows without an id are linked with nothing, kept and chosen
    (component_id null). Rows that repeat an id are judged each by its text.
    """
    spark = docs.sparkSession
    own = id_and_text(docs, id_col, text_col)
    own = own.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_mark(F.col("text")).alias("mark"))
    rows = materialise(sketches(own, shingle_words), "sketches")
    text = F.struct("doc_id", "mark")
    path = scratch_path(spark, "places")
    with temporary_copies(spark):
        classes = rows.where("doc_id is not null and set_id is not null").groupBy("set_id")
        classes = classes.agg(F.min(text).alias("text"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
        # a number of its own for each class, as texts may share an id; fixed by the write
        nodes = materialise(classes.select(F.monotonically_increasing_id().alias("node"), "set_id", "text.*", "n_shingles", "signature"), "classes")
        joined = _joined(own, nodes, shingle_words, percent)
        placed = nodes.join(joined.withColumnRenamed("u", "node"), "node", "left")
        placed = placed.select("set_id", F.coalesce("v", "node").alias("root"), text.alias("text"))
        firsts = placed.groupBy("root").agg(F.min("text").alias("first"))
        placed = placed.select("set_id", "root").join(firsts, "root").drop("root")
        placed.write.parquet(path)
    found = rows.join(spark.read.schema(placed.schema).parquet(path), "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    chosen = F.col("doc_id").isNull() | F.col("first").isNull() | (text == F.col("first"))
    return found.select("doc_id", "mark", "n_shingles", component.alias("component_id"), kept.alias("kept"), chosen.alias("chosen"))


def drop_near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs`, all columns, with one document of each component: the one with the smallest id, and mark among texts of that id.

    Of rows that repeat an id with its text one stays. Rows without an id or without words stay.
    """
    found = near_duplicates(docs, shingle_words=shingle_words, percent=percent, id_col=id_col, text_col=text_col)
    rows = found.where("doc_id is not null").groupBy("doc_id", "mark").agg(F.bool_or("chosen").alias("chosen"), F.count(F.lit(1)).alias("n"))
    odd = materialise(rows.where("not chosen or n > 1"), "dropped")
    # the row as one column, so that its names cannot clash
    held = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), text_mark(F.col(text_col)).alias("mark"))
    rest = held.join(odd, ["doc_id", "mark"], "left_anti").select("row.*")
    repeated = odd.where("chosen")
    if not repeated.take(1):
        return rest
    return rest.unionByName(held.join(repeated, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"]).select("row.*"))


def _open_cells(stars: DataFrame, joined: DataFrame, nodes: DataFrame) -> DataFrame:
    """pivot, node, component, n_shingles, signature of the cells that have two or more members, in more than one component.

    The pivot itself was compared with all of them.
    """
    component = F.coalesce("v", "node").alias("component")
    placed = materialise(stars.join(joined.withColumnRenamed("u", "node"), "node", "left").select("pivot", "node", component), "placed")
    open_ = placed.groupBy("pivot").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("pivot")
    # written, so that the join below can split a hot pivot
    open_ = materialise(open_, "open-pivots")
    return placed.join(open_, "pivot", "left_semi").join(nodes.select("node", "n_shingles", "signature"), "node")
