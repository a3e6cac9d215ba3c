"""Line dedup and near-duplicates against plain rules."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hamming_dedup, line_dedup
from tallyloom.llm.components import components

from .fixtures import LOWER, SCHEMA, line_key, no_documents, odd_documents, prose, split_lines, texts


def plain_lines(rows, min_docs, keep_first, mark):
    owners, firsts = collections.defaultdict(set), {}
    for i, t in rows:
        for pos, line in enumerate(split_lines(t)):
            if key := line_key(line):
                owners[key].add(i)
                # an absent id comes first
                at = ((i is not None, i or 0), mark[t or ""], pos)
                firsts[key] = min(firsts.get(key, at), at)
    out = []
    for i, t in rows:
        kept = []
        for pos, line in enumerate(split_lines(t)):
            key = line_key(line)
            at = ((i is not None, i or 0), mark[t or ""], pos)
            if not key or len(owners[key]) < min_docs or (keep_first and at == firsts[key]):
                kept.append(line)
        out.append((i, len(split_lines(t)), len(split_lines(t)) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(spark, keep_first, min_docs):
    docs = odd_documents(spark)
    mark = {r.text or "": r.m for r in docs.select("text", line_dedup.text_mark(F.col("text")).alias("m")).collect()}
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=min_docs, keep_first=keep_first)
    got = line_dedup.dedup_lines(docs, bitmaps)
    assert set(got.columns) == set(docs.columns) | {"n_dropped"}
    found = collections.Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect())
    assert found == plain_lines(texts(), min_docs, keep_first, mark)


def test_hot_lines_and_large_documents(spark, monkeypatch):
    # one line in every document, salted; one document of several containers
    monkeypatch.setattr(line_dedup, "HOT_PARTS", 10)
    lines = line_dedup._salted(line_dedup._hashed_lines(spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("hot\nhot").alias("text")), 1))
    # 6,000 lines of one key in parts of about 1,000
    sizes = [r["count"] for r in lines.groupBy("salt").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1_300
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 1_000)
    rows = [(i, f"hot\nown {i}\nhot") for i in range(1_500)] + [(9_999, "\n".join(["hot", "u"] * 40_000 + ["end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=10))
    out = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got.collect()}
    assert out[7] == (3, 2, "own 7") and len(out) == 1_501
    assert out[9_999] == (80_001, 40_000, "\n".join(["u"] * 40_000 + ["end"]))
    first = line_dedup.keep_bitmaps(docs, min_docs=10, keep_first=True)
    kept = line_dedup.dedup_lines(docs, first).where(F.col("text").startswith("hot"))
    assert [r.text for r in kept.collect()] == ["hot\nown 0"]


def test_bitmaps_are_compressed(spark):
    docs = spark.createDataFrame([(i, "same\n" + "\n".join(f"{i} {n}" for n in range(100))) for i in range(3)], "doc_id long, text string")
    for row in line_dedup.keep_bitmaps(docs, min_docs=3).collect():
        assert row.n_dropped == 1 and {k: bytes(v) for k, v in row.keep.items()} == {0: b"\xfe"}
    assert line_dedup.keep_bitmaps(docs, min_docs=4).count() == 0


def test_no_documents(spark):
    docs = no_documents(spark)
    assert line_dedup.dedup_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=1)).count() == 0
    assert line_dedup.drop_repeated_lines(docs, min_docs=1).columns == docs.columns
    assert hamming_dedup.near_duplicates(docs).count() == 0
    assert hamming_dedup.drop_near_duplicates(docs).count() == 0


def test_drop_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "a\nb", 1), (2, "a", 2), (3, "", 3), (4, None, 4), (5, "a\nc", 5)], "doc_id long, text string, n_lines int")
    got = {r.doc_id: (r.text, r.n_lines) for r in line_dedup.drop_repeated_lines(docs, min_docs=3).collect()}
    assert got == {1: ("a\nb", 1), 3: ("", 3), 4: ("", 4), 5: ("c", 5)}


# ---------------------------------------------------------------- near-duplicates


def shingles(text, width):
    words = [w for w in (text or "").translate(LOWER).encode().split()]
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < width else [tuple(words[i : i + width]) for i in range(len(words) - width + 1)])


def plain_components(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [n for n, (i, _) in enumerate(rows) if i is not None and sets[n]]
    for a, b in itertools.combinations(live, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = collections.defaultdict(list)
    for n in live:
        least[root(n)].append(rows[n][0])
    out = []
    for n, (i, _) in enumerate(rows):
        c = min(least[root(n)]) if n in set(live) else i
        out.append((i, len(sets[n]), c, i == c))
    return collections.Counter(out)


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(spark, width):
    got = hamming_dedup.near_duplicates(odd_documents(spark), shingle_words=width)
    found = collections.Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert found == plain_components(texts(), width, 80)


def test_near_copies_around_the_threshold(spark):
    # a chain of edits and a star of copies of one text, with ids in no order
    rng = random.Random(5)
    rows, ids = [], iter(rng.sample(range(10_000), 400))
    base = prose(3, 150).split()
    chain = base
    for step in range(40):
        chain = list(chain)
        chain[rng.randrange(len(chain))] = f"step{step}"
        rows.append((next(ids), " ".join(chain)))
    for copy in range(200):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        rows.append((next(ids), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = hamming_dedup.near_duplicates(docs, shingle_words=4)
    found = collections.Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert found == plain_components(rows, 4, 80)


def test_cells_with_many_components_go_in_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 24), ("TILE", 8), ("GROUP_BYTES", 4_000)):
        monkeypatch.setattr(hamming_dedup, name, value)
    test_near_copies_around_the_threshold(spark)
    monkeypatch.setattr(hamming_dedup, "TILE_BYTES", 3_000)
    test_near_copies_around_the_threshold(spark)


def test_blocks_hold_each_member_once(spark):
    # 20,000 look-alikes of one pivot, all of them apart
    size = 20_000
    members = spark.range(1, size + 1).select(
        F.lit(0).cast("long").alias("pivot"), F.col("id").alias("node"), F.col("id").alias("component"), F.lit(9).cast("long").alias("n_shingles"), F.lit(b"").alias("signature")
    )
    blocks = hamming_dedup._blocks(members)
    held = blocks.select(F.size("members").alias("n")).toPandas()["n"]
    assert held.sum() == size and held.max() < 2 * hamming_dedup.BLOCK
    assert hamming_dedup._block_pairs(blocks).count() == len(held) * (len(held) + 1) // 2


def test_tiles_are_bounded_in_bytes():
    sizes = np.array([10, 20, 3 << 20, 5, 5] + [1] * 1_200)
    tiles = hamming_dedup._tiles(sizes)
    assert [t.start for t in tiles[1:]] == [t.stop for t in tiles[:-1]] and tiles[-1].stop == len(sizes)
    assert all(t.stop - t.start <= hamming_dedup.TILE for t in tiles)
    assert all(8 * sizes[t].sum() <= hamming_dedup.TILE_BYTES or t.stop - t.start == 1 for t in tiles)


def test_other_texts_stay_out_of_the_exchange(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), (F.col("id") * 7).alias("mark"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = hamming_dedup.materialise(docs, "texts")
        wanted = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("node"), "doc_id", "mark")
        sets = hamming_dedup._sets_of(docs, wanted, 2)
        assert sets.count() == 100
        with hamming_dedup.bloom_filtered(spark, 100):
            chosen = hamming_dedup.materialise(wanted, "wanted").where(F.col("doc_id") >= hamming_dedup.LEAST_LONG)
            plan = docs.join(chosen, ["doc_id", "mark"])._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clashing_names(spark):
    names = ["_id", "_mark", "row", "mark", "first", "chosen", "component", "node", "_keep", "_gone"]
    docs = spark.createDataFrame([(1, "a b c d e f", *names), (2, "A b c d e f", *names), (3, None, *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = hamming_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_pigeonhole_misses_no_signature_within_the_distance():
    rng = np.random.default_rng(1)
    distance = hamming_dedup.max_distance(80)
    assert distance >= 25 and distance + 1 == hamming_dedup.chunk_count(distance) * (hamming_dedup.RADIUS + 1)
    a = rng.integers(0, 1 << 16, (300, hamming_dedup.SLOTS)).astype("<u2")
    b = a.copy()
    for row in b:
        where = rng.choice(hamming_dedup.SLOTS, distance, replace=False)
        row[where] += 1
    x, y = (hamming_dedup.bucket_keys(m, distance) for m in (a, b))
    assert all(set(p) & set(q) for p, q in zip(x, y))


def test_overlaps_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9_000, rng.integers(1, 3_000)).astype(np.uint64)) for _ in range(12)]
    got = hamming_dedup._overlaps(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(12) for j in range(12) if i != j)


def test_drop_near_duplicates(spark):
    docs = odd_documents(spark)
    kept = hamming_dedup.drop_near_duplicates(docs, shingle_words=4)
    assert kept.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    expected = collections.Counter()
    flags = plain_components(texts(), 4, 80)
    by_row = {}
    for (i, t), (j, n, c, k) in zip(texts(), _in_order(texts(), 4)):
        by_row[(i, t)] = k
    for row, k in by_row.items():
        if k:
            expected[row] = 1
    assert sum(flags.values()) == len(texts())
    assert found == expected


def _in_order(rows, width):
    table = plain_components(rows, width, 80)
    sets = [len(shingles(t, width)) for _, t in rows]
    out = []
    for (i, _), n in zip(rows, sets):
        hit = next(key for key in table if key[0] == i and key[1] == n)
        out.append(hit)
    return out


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, n) for n in range(2, 60)] + [(200, 200), (301, 300), (300, 301), (None, 1)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.u: r.v for r in got} == {**{i: 100 for i in range(101, 141)}, **{n: 1 for n in range(2, 60)}, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_that_share_an_id(spark):
    # (5, a) is a near copy of 3; (5, b) is like nothing, (7, c) and (7, d) are near copies under one id
    near = prose(61, 300).split(" ")
    a, b, c = " ".join(near[:150] + ["changed"] + near[151:]), prose(62, 300), prose(63, 300)
    rows = [(3, " ".join(near)), (5, a), (5, b), (7, c), (7, c + " tail"), (8, prose(64, 300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = hamming_dedup.near_duplicates(docs).join(docs.withColumn("mark", hamming_dedup.text_mark(F.col("text"))), ["doc_id", "mark"])
    got = {(r.doc_id, r.text): (r.component_id, r.kept) for r in found.collect()}
    assert got[rows[0]] == (3, True)
    assert got[(5, a)] == (3, False) and got[(5, b)] == (5, True)
    # kept by the id; one of the two is chosen
    assert got[rows[3]] == got[rows[4]] == (7, True)
    assert [r.chosen for r in found.where("doc_id = 7").orderBy("mark").collect()] == [True, False]
    kept = [(r.doc_id, r.text) for r in hamming_dedup.drop_near_duplicates(docs).collect()]
    assert len(kept) == 4 and {rows[0], (5, b), rows[5]} <= set(kept)


def test_clashing_names_of_lines(spark):
    names = ["_id", "_mark", "_keep", "_gone", "id", "marked", "mark", "keep", "gone", "row", "N_Lines"]
    docs = spark.createDataFrame([(i, "same\nown" + str(i), *names) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = line_dedup.dedup_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=3))
    assert got.columns == [*docs.columns, "n_dropped"]
    assert {(r.text, r.N_Lines, r.n_dropped, r._id, r.row) for r in got.collect()} == {(f"own{i}", 2, 1, "_id", "row") for i in range(3)}
    assert line_dedup.drop_repeated_lines(docs, min_docs=3).columns == docs.columns
