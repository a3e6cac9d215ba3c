"""Packing and decontamination against plain rules."""

import collections
import random
import zlib

import numpy as np
import pytest

from tallyloom.llm import edit_decontam, packing, tokens

from .fixtures import no_documents, odd_documents, prose, texts

VOCABULARY = tokens.vocabulary("word_bpe_49k.json")


def whole_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids


def check_packed(rows, capacity):
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [64, 4_096])
def test_pieces_and_sequences(spark, capacity):
    docs = odd_documents(spark)
    pieces = packing.token_pieces(docs, VOCABULARY, capacity=capacity, end_id=1, with_ids=True)
    got = packing.pack(pieces, capacity=capacity, group_pieces=100).collect()
    expected = collections.Counter()
    for i, t in texts():
        ids = [*whole_ids(t), 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            expected[(i, piece, at, len(part) // 4, zlib.crc32(part), part)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == expected
    n = check_packed(got, capacity)
    least = -(-sum(r.length for r in got) // capacity)
    assert least <= n <= least * 1.05 + 1


def test_packing_of_nothing_and_clashing_names(spark):
    assert packing.pack(packing.token_pieces(no_documents(spark), VOCABULARY, capacity=64, end_id=1), capacity=64).count() == 0
    rows = [(None, 0, n, "x") for n in (3, 5, 5, 7, 10)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, length long, held string"), capacity=10).collect()
    assert check_packed(got, 10) == 3 and {r.held for r in got} == {"x"}


def fullness(bins):
    return sum((bins.capacity - room) ** 2 for room, held in zip(bins.free, bins.held) if held)


def test_search_raises_squared_fill_and_empties_bins():
    rng = np.random.default_rng(4)
    saved = 0
    for _ in range(60):
        lengths = rng.integers(20, 60, 60)
        bins = packing.Bins(lengths, 100)
        bins.fill()
        before, count = fullness(bins), len(bins.held)
        bins.search()
        assert fullness(bins) >= before
        assert sorted(p for held in bins.held for p in held) == list(range(60))
        assert all(100 - sum(lengths[p] for p in held) == room >= 0 for held, room in zip(bins.held, bins.free))
        saved += count - sum(map(bool, bins.held))
    # a packing that best fit leaves open and exchanges close
    bins = packing.Bins(np.array([6, 5, 4, 3, 2]), 10)
    bins.held, bins.free = [[0, 3], [1, 4], [2]], [1, 3, 6]
    bins.search()
    assert sum(map(bool, bins.held)) == 2


def test_search_treats_all_underfull_bins():
    bins = packing.Bins(np.random.default_rng(5).integers(700, 4_096, 1_500), 4_096)
    bins.fill()
    count = sum(map(bool, bins.free))
    assert count > 600
    bins.search()
    under = sorted((at for at, room in enumerate(bins.free) if room and bins.held[at]), key=lambda at: -bins.free[at])
    assert not any(bins._trade(a, b) for n, a in enumerate(under) for b in under[n + 1 :])
    assert sorted(p for held in bins.held for p in held) == list(range(1_500))


def test_exchanges():
    two_for_one = packing.Bins(np.array([7, 4, 5]), 10)
    two_for_one.held, two_for_one.free = [[0], [1, 2]], [3, 1]
    assert two_for_one._trade(1, 0) and sorted(two_for_one.held[0]) == [1, 2] and two_for_one.free[0] == 1
    one_for_one = packing.Bins(np.array([5, 3, 6]), 10)
    one_for_one.held, one_for_one.free = [[0, 1], [2]], [2, 4]
    assert one_for_one._trade(1, 0) and one_for_one.free == [1, 5]
    move = packing.Bins(np.array([6, 4]), 10)
    move.held, move.free = [[0], [1]], [4, 6]
    assert move._trade(1, 0) and move.held == [[0, 1], []]


# ---------------------------------------------------------------- decontamination


def plain_search(item, text):
    """Edit distances of the item to the best stretch that ends at each place (Sellers)."""
    row = list(range(len(item) + 1))
    out = []
    for c in text:
        new = [0]
        for i, p in enumerate(item, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[i - 1] + 1))
        row = new
        out.append(row[-1])
    return out


def test_myers_distances():
    rng = random.Random(2)
    for _ in range(150):
        item = "".join(rng.choice("abé ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 120)))
        assert edit_decontam.myers(item, text) == plain_search(item, text)


def edited(rng, item, edits):
    chars = list(item)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("qxz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("qxz"))
    return "".join(chars)


def test_leaks(spark):
    rng = random.Random(3)
    items = [(n, prose(50 + n, 30)) for n in range(12)] + [(90, None), (91, ""), (92, "tiny"), (None, prose(99, 30)), (3, prose(53, 30))]
    normal = {i: edit_decontam.normalised(t) for i, t in items[:12]}
    rows = list(texts())
    for n in range(60):
        i = n % 12
        budget = int(0.05 * len(normal[i]))
        passage = edited(rng, items[i][1], n % (budget + 4))
        rows.append((1_000 + n, f"{prose(n, 40)}\n{passage.upper() if n % 2 else passage}\t{prose(200 + n, 40)}"))
    docs = odd_documents(spark, rows)
    tests = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, doc_id string")
    got = edit_decontam.find_leaks(docs, tests)
    found = collections.Counter((r.doc_id, r.item_id, r.distance) for r in got.collect())
    expected = collections.Counter()
    for i, t in rows:
        plain = edit_decontam.normalised(t)
        for j, item in ((j, edit_decontam.normalised(x)) for j, x in items):
            if len(item) >= 40 and i is not None and i >= 1_000:
                least = min(plain_search(item, plain))
                if least <= int(0.05 * len(item)):
                    expected[(i, j, least)] += 1
    assert found == expected and len(expected) > 25
    plain_of = {i: edit_decontam.normalised(t) for i, t in rows}
    exact = [r for r in got.collect() if r.distance == 0]
    assert exact and all(plain_of[r.doc_id][r.start : r.end] == normal[r.item_id] for r in exact if r.item_id is not None)
    # in blocks of one item each
    small = edit_decontam.find_leaks(docs, tests, block_chars=1)
    assert collections.Counter((r.doc_id, r.item_id, r.distance) for r in small.collect()) == expected
    kept = edit_decontam.drop_leaks(docs, tests, block_chars=300)
    leaked = {i for i, _, _ in expected}
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(i for i, _ in rows if i not in leaked)


def test_no_documents_or_items(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert edit_decontam.find_leaks(odd_documents(spark), items).count() == 0
    assert edit_decontam.drop_leaks(odd_documents(spark), items).count() == len(texts())
    some = spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    assert edit_decontam.find_leaks(no_documents(spark), some).count() == 0


def test_short_items_may_be_edited(spark):
    item = "what colour is the sky"  # 22 characters: one edit
    rows = [(1, "Q: What color is the sky?"), (2, "what colour is the skys"), (3, "somewhat colour is the sky"), (4, "what colr is the sky"), (5, "what colour is the skyy what colour is  THE sky!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "the sky")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.start, r.end) for r in edit_decontam.find_leaks(docs, items).collect()}
    assert {k: v[0] for k, v in got.items() if k[1] == 1} == {(1, 1): 1, (2, 1): 1, (5, 1): 0}
    plain = edit_decontam.normalised(rows[4][1])
    assert plain[got[(5, 1)][1] : got[(5, 1)][2]] == item
    # eight characters have no budget and are no evidence for dropping
    assert {k[0] for k in got if k[1] == 2} == {1, 3, 4, 5}
    assert sorted(r.doc_id for r in edit_decontam.drop_leaks(docs, items).collect()) == [3, 4]


def test_pack_with_clashing_names(spark):
    rows = [(1, 0, 30, "s", "o", "p", "r", "g"), (2, 0, 60, "s", "o", "p", "r", "g"), (3, 0, 100, "s", "o", "p", "r", "g")]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, sequence_id string, Offset string, _piece_id string, _room string, _group string")
    got = packing.pack(pieces, capacity=100)
    assert got.columns == ["doc_id", "piece", "length", "_piece_id", "_room", "_group", "sequence_id", "offset"]
    out = {r.doc_id: r for r in got.collect()}
    assert out[1].sequence_id == out[2].sequence_id != out[3].sequence_id and out[1]._piece_id == "p" and out[1]._group == "g"


def test_short_items_are_found_as_whole_words(spark):
    rows = [(1, "So: What is\n RUST? Yes."), (2, "what is rusty? what is rust"), (3, "concat cat_ cats"), (4, "cats, a Cat."), (5, "cat"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "What is rust?"), (2, "cat"), (3, " "), (4, "cats,")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in edit_decontam.find_leaks(docs, items).collect()}
    assert got == {(1, 1, 0, 4, 17), (4, 2, 0, 8, 11), (4, 4, 0, 0, 5), (5, 2, 0, 0, 3)}
    # no evidence for dropping
    assert edit_decontam.drop_leaks(docs, items).count() == 6
