"""SimHash near-duplicates against plain rules."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import simhash_dedup

from .fixtures import LOWER, no_documents, odd_documents, texts


def plain_fingerprint(text, width=3):
    words = (text or "").translate(LOWER).encode().split()
    grams = [words] if 0 < len(words) < width else [words[i : i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance):
    """Component by row of (id, fingerprint)."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [n for n, (i, _) in enumerate(rows) if i is not None]
    for a, b in itertools.combinations(live, 2):
        if (rows[a][1] ^ rows[b][1]).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = {}
    for n in live:
        least[root(n)] = min(least.get(root(n), rows[n][0]), rows[n][0])
    return [least[root(n)] if rows[n][0] is not None else None for n in range(len(rows))]


def test_odd_documents(spark):
    got = simhash_dedup.near_duplicates(odd_documents(spark)).collect()
    rows = [(i, plain_fingerprint(t)) for i, t in texts()]
    expected = [(i, f, c) for (i, f), c in zip(rows, plain_components(rows, 2))]
    mine = [(r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in got]
    assert sorted(mine, key=repr) == sorted(expected, key=repr)
    assert simhash_dedup.near_duplicates(no_documents(spark)).count() == 0


def cluster(seed, size, flips):
    """Fingerprints around one centre, and some far from it."""
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    out = {centre, 0, 1, (1 << 64) - 1, (1 << 63) - 1}
    while len(out) < size:
        value = centre
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            value ^= 1 << bit
        out.add(value if rng.random() < 0.8 else rng.getrandbits(64))
    return sorted(out)


def linked_sets(values, pairs):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    groups = {}
    for v in values:
        groups.setdefault(root(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("cell", [2, 4, 256])
def test_links_join_what_links(spark, distance, cell):
    # with small cells the finer grids have to answer
    values = cluster(7, 900, 4)
    nodes = spark.createDataFrame([(v - (1 << 64) * (v >> 63),) for v in values], "node long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_dedup.fingerprint_links(nodes, distance=distance, cell=cell).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in got)
    plain = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= distance]
    assert linked_sets(values, got) == linked_sets(values, plain)
    # linear in the fingerprints, not in their pairs
    assert len(got) <= 65 * len(values)


@pytest.mark.parametrize("bits", simhash_dedup.GRIDS)
def test_grid_reaches_every_pair_within_two_bits(bits):
    rng = random.Random(bits)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        values = np.array([a, b], np.uint64)
        keys, which = simhash_dedup.cell_keys(values, bits)
        assert set(keys[which == 0]) & set(keys[which == 1])
        counts = simhash_dedup.segment_counts(values, bits).astype(int)
        assert np.abs(counts[0] - counts[1]).sum() <= (a ^ b).bit_count()


def test_finest_cells_are_bounded(spark):
    # all 65 fingerprints within one bit of a centre meet in its cell
    values = np.array([0] + [1 << i for i in range(64)], np.uint64)
    keys, which = simhash_dedup.cell_keys(values, 1)
    assert max(np.unique(keys, return_counts=True)[1]) == 65


def test_long_text_is_read_whole(spark):
    rng = random.Random(3)
    long = " ".join(str(rng.getrandbits(30)) for _ in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, long + " tail"), (3, long.upper())], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(docs).collect()}
    assert got[1].fingerprint % (1 << 64) == plain_fingerprint(long)
    assert got[3].component_id == 1


def test_no_distance_beyond_two(spark):
    with pytest.raises(ValueError):
        simhash_dedup.fingerprint_links(spark.range(1).select(F.col("id").alias("node")), distance=3)
