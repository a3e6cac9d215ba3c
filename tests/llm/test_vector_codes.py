"""Vector codes against plain searches."""

import collections
import math
import random

import numpy as np
import pytest

from tallyloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label string, code string, error string, entry int, whole int, n int"


def rows_of(vectors):
    return [(i, v, l, "x", "y", 1, 2, 3) for i, v, l in vectors]


def plain(vectors, parts, entries, rounds):
    """codes and errors in the order of the kept rows, by measuring every entry."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], l) for i, v, l in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def find(q, book):
        return min((sum((a - b) ** 2 for a, b in zip(q, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for _, v, _ in kept:
                members[find(cut(v)[p], books[p])[1]].append(cut(v)[p])
            for i, own in members.items():
                books[p][i] = tuple(sum(c) // len(own) for c in zip(*own))
    out = []
    for i, v, l in kept:
        found = [find(q, book) for q, book in zip(cut(v), books)]
        out.append((i, l, bytes(n for _, n in found), sum(d for d, _ in found)))
    sums = collections.Counter()
    for _, l, _, e in out:
        sums[l] += e
    return collections.Counter((*row, sums[row[1]]) for row in out), books


def sample(count, size, seed=1):
    rng = random.Random(seed)
    out = [(i, [round(rng.gauss(0, 0.3), 2) for _ in range(size)], rng.choice(["a", "b", None])) for i in range(count)]
    # ties: repeated vectors and components at the same distance from two entries
    out += [(count + i, list(out[i % 5][1]), "a") for i in range(20)] + [(500 + i, [0.0] * size, None) for i in range(10)]
    return out


@pytest.mark.parametrize("parts, entries, rounds", [(4, 8, 3), (2, 256, 1), (1, 1, 2), (4, 20, 0)])
def test_codes(spark, parts, entries, rounds):
    vectors = sample(150, 8)
    odd = [(9_001, None, "a"), (9_002, [1.0] * 7 + [float("nan")], "a"), (9_003, [None] + [0.0] * 7, "b"), (9_004, [float("-inf")] * 8, "b"), (9_005, [0.5] * 3, "a"), (9_006, [], "a")]
    df = spark.createDataFrame(rows_of(vectors + odd), SCHEMA)
    got, books = vector_codes.compress(df, parts=parts, entries=entries, rounds=rounds)
    expected, plain_books = plain(vectors, parts, entries, rounds)
    found = collections.Counter((r.vec_id, r.label, bytes(r.code), r.error, r.label_error) for r in got.collect())
    assert found == expected
    assert [[tuple(e) for e in b.tolist()] for b in books] == plain_books


def test_repeated_and_missing_ids(spark):
    vectors = [(1, [0.1, 0.2], "a"), (1, [0.1, 0.2], "a"), (None, [0.3, 0.1], None), (2, [5.0, -5.0], None)]
    got, books = vector_codes.compress(spark.createDataFrame(rows_of(vectors), SCHEMA), parts=2)
    assert got.count() == 4 and len(books[0]) == 4
    # equal entries: the lower index
    assert [bytes(r.code) for r in got.where("vec_id = 1").collect()] == [b"\0\0"] * 2


def test_no_vectors(spark):
    got, books = vector_codes.compress(spark.createDataFrame(rows_of([(1, None, "a")]), SCHEMA))
    assert got.count() == 0 and books == []
    assert set(got.columns) == {"vec_id", "label", "code", "error", "label_error"}


def test_lengths_that_do_not_divide(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame(rows_of([(1, [1.0, 2.0, 3.0], "a")]), SCHEMA))


@pytest.mark.parametrize("spread", [5, 1_000, 1_670, 1 << 20, 1 << 24])
def test_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (100, 6))
    parts = np.concatenate([rng.integers(-spread, spread + 1, (3_000, 6)), entries])
    index, distance = vector_codes.nearest(parts, vector_codes.neighbour_lists(entries))
    full = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    if spread > 10_000:
        return
    # codebook and vectors of other magnitudes
    index, distance = vector_codes.nearest(parts * 999, vector_codes.neighbour_lists(entries // 999))
    full = ((parts[:, None, :] * 999 - (entries // 999)[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_types_are_exact():
    a = np.array([[4_095, 4_096]])
    assert vector_codes.exact_type(a, np.array([[2_047, 0]])) == np.float32
    assert vector_codes.exact_type(a, np.array([[2_048, 0]])) == np.float64
    assert vector_codes.exact_type(a, np.array([[1 << 40, 0]])) == np.int64


def test_search_leaves_entries_unmeasured():
    # clusters far apart: the lists end long before all entries are reached
    entries = np.repeat(np.arange(16)[:, None] * 10_000, 16, axis=0) + np.arange(256)[:, None] % 16
    lists = vector_codes.neighbour_lists(entries.astype(np.int64), stride=16)
    assert (lists.spans[:, 0] < 4 * 16**2).all() and (lists.spans[:, 1] > 4 * 16**2).all()
    index, _ = vector_codes.nearest(entries.astype(np.int64), lists)
    assert (index == np.arange(256)).all()


def test_decode(spark):
    df = spark.createDataFrame(rows_of(sample(20, 4)), SCHEMA)
    got, books = vector_codes.compress(df, rounds=0)
    back = {r.vec_id: r.vector for r in vector_codes.decode(got, books, spark).collect()}
    for i, v, _ in sample(20, 4):
        assert all(abs(a - b) <= 2 / 1024 for a, b in zip(v, back[i]))
