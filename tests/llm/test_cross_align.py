"""Cross-tokenizer alignment against plain rules."""

import collections
import hashlib
import random

import pytest

from tallyloom.llm import cross_align
from tallyloom.llm.tokens import vocabulary

from .fixtures import no_documents, odd_documents, texts

PATHS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return cross_align.Aligner(*PATHS)


def plain_tokens(text):
    """(id, end) lists by both tokenizers, offsets from the tokens' own bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    out = []
    for ids, to_bytes in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte_of[c] for c in a.id_to_token(i))),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        at, tokens, whole = 0, [], b""
        for i in ids:
            whole += to_bytes(i)
            at += len(to_bytes(i))
            tokens.append((i, at))
        if not text or whole != b" " + text.encode():
            return [], []
        out.append(tokens)
    return out


def plain_rows(rows):
    counts, docs = collections.Counter(), []
    for i, t in rows:
        a, b = plain_tokens(t or "")
        by_end = {end: n for n, (_, end) in enumerate(b)}
        links = [(n, by_end[end]) for n, (_, end) in enumerate(a) if end in by_end]
        groups, x, y = [], 0, 0
        for n, m in links:
            groups.append(",".join(str(i) for i, _ in a[x : n + 1]) + "|" + ",".join(str(i) for i, _ in b[y : m + 1]))
            x, y = n + 1, m + 1
        pairs = [(a[n][0], b[m][0]) for n, m in links]
        counts.update(pairs)
        docs.append((i, len(a), len(b), pairs, ";".join(groups)))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return collections.Counter(
        (i, n_a, n_b, len(pairs), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), groups, hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for i, n_a, n_b, pairs, groups in docs
    )


ODD = [
    (101, "ﬁ and ▁ are not given back"), (102, "<|endoftext|> is text, <s> too"), (103, "  blanks   and\n\n\ttabs \r\n"), (104, "日本語 と emoji 👩‍👩‍👧 é é"),
    (105, "a\x00b\x7f"), (106, " "), (107, "x" * 3_000), (108, "don't we'll it's 12,345.67"), (109, "don't we'll it's 12,345.67"),
]


def test_score(spark):
    rows = texts() + ODD
    got = cross_align.score(odd_documents(spark, rows), *PATHS, with_groups=True)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]
    found = collections.Counter(tuple(r) for r in got.select(names).collect())
    assert found == plain_rows(rows)
    by_id = {r[0]: r for r in found}
    assert by_id[101][1:] == (0, 0, 0, 0, 0, 0, "", "") and by_id[102][3] > 0


def test_no_documents(spark):
    got = cross_align.score(no_documents(spark), *PATHS)
    assert got.count() == 0
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("seed", range(30))
def test_galloping(seed):
    rng = random.Random(seed)
    top = rng.choice([3, 50, 5_000])
    longer = sorted(rng.sample(range(top), rng.randint(0, min(top, 900))))
    shorter = sorted(rng.sample(range(top), rng.randint(0, min(top, 40))))
    mine, other = cross_align.common_ends(shorter, longer)
    assert [shorter[i] for i in mine] == [longer[j] for j in other] == sorted(set(shorter) & set(longer))


def test_galloping_skips():
    # few ends against many: a search of logarithmic length each
    class Counted(list):
        reads = 0

        def __getitem__(self, at):
            Counted.reads += 1
            return list.__getitem__(self, at)

    longer = Counted(range(100_000))
    mine, other = cross_align.common_ends([5, 40_000, 99_999], longer)
    assert mine == [0, 1, 2] and other == [5, 40_000, 99_999] and Counted.reads < 150


def test_words_give_the_ids_of_whole_texts(both):
    rng = random.Random(8)
    signs = ["a", "The", "word.", "End,", "don't", "é", "日本", " ", "  ", "\n", "\t", "\r\n", ".", "12", "!", "\xa0", "\u3000", "\x1c", "\x85", "'s", "Größe,", "été", "\u200b", "́", "😀", "<s>", "\x00", "-"]
    assert both.by_word
    for _ in range(4_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        if rng.random() < 0.9:
            both.learn([text])
        a, b = both.tokens(text)
        assert a.tolist() == both.a.model.encode(" " + text, add_special_tokens=False).ids and b.tolist() == both.b.encode(text), repr(text)
    assert sum(map(len, both.tokens("▁ x"))) == 0


def test_long_words_are_not_held(both):
    both.learn(["y" * 5_000 + " z", None, ""])
    assert all("y" * 5_000 not in table and "z" in table for table in both.words)
    assert len(both.tokens("y" * 5_000)[0]) > 0


def test_full_tables_start_anew(monkeypatch):
    own = cross_align.Aligner(*PATHS)
    monkeypatch.setattr(cross_align, "CACHED_WORDS", 5)
    rng = random.Random(4)
    for _ in range(50):
        text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(1, 9)))
        own.learn([text])
        assert all(len(table) <= 5 for table in own.words)
        assert own.tokens(text)[0].tolist() == own.a.encode(text)


def test_token_bytes_join_to_the_text(both):
    for text in ["plain words", "  two  blanks", "ünïcödé 日本", "<s> <|endoftext|>"]:
        a, b = both.tokens(text)
        assert b"".join(both.a.bytes[i] for i in a) == b"".join(both.b.bytes[i] for i in b) == b" " + text.encode()
