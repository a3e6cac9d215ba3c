"""Token files and WARC archives: exact round trips."""

import collections
import gzip
import hashlib
import io
import zlib

import numpy as np
import pytest

from tallyloom.llm import token_files, tokens, warc
from tallyloom.llm.files import open_file

from .fixtures import no_documents, odd_documents, texts

VOCABULARY = tokens.vocabulary("word_bpe_49k.json")


def whole_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids


ODD = ["it's I'LL we'RE. can't,", "a<|endoftext|>b <|ENDOFTEXT|>", "ΑΣ. ΣΑΣ,", "İ, İ. Å. é. x́,", "\x85a\xa0b\x1cc", "3.14,x 12th", "...,,, ,. .", "ß. ÿ, ×÷ a× ."]


def test_words_give_the_ids_of_the_whole_text():
    words = tokens.WordEncoder(VOCABULARY, most=50)
    for text in [t for _, t in texts()] + ODD:
        assert np.frombuffer(words.encode(text), tokens.ID).tolist() == whole_ids(text)
    assert len(words) <= 50


@pytest.mark.parametrize("percentile", [0.0, 0.5, 0.9, 1.0])
def test_blocks(percentile):
    rng = np.random.default_rng(3)
    kinds = [
        np.zeros(0), np.zeros(1), np.full(700, 9), rng.integers(0, 50_000, 1_000), rng.integers(0, 2**32, 513),
        np.where(rng.random(2_000) < 0.05, 2**32 - 1, rng.integers(5, 9, 2_000)), np.arange(256),
    ]
    for ids in kinds:
        ids = ids.astype("<u4")
        blocks = token_files.encode_blocks(ids, percentile)
        starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
        back = token_files.decode_blocks(b"".join(blocks), starts) if blocks else np.zeros(0)
        assert back[: len(ids)].tolist() == ids.tolist() and len(back) - len(ids) < token_files.BLOCK


def test_outliers_are_patched():
    ids = np.full(256, 100, "<u4")
    ids[::20] = 40_000
    (block,) = token_files.encode_blocks(ids)
    _, width, patches = token_files.HEAD.unpack_from(block)
    assert (width, patches) == (0, 13) and len(block) < 100


def test_token_files(spark, tmp_path):
    rows = texts() + [(100 + n, t) for n, t in enumerate(ODD)]
    files = token_files.write_token_files(odd_documents(spark, rows).repartition(5), VOCABULARY, end_id=1, folder=str(tmp_path))
    got = token_files.read_token_files(files).collect()
    found = collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    assert found == collections.Counter((i, (*whole_ids(t), 1)) for i, t in rows)
    by_start = sorted(got, key=lambda r: r.start)
    ids = [r.doc_id if r.doc_id is not None else -(10**9) for r in by_start]
    assert ids == sorted(ids)
    assert [r.start for r in by_start] == np.cumsum([0] + [len(r.ids) // 4 for r in by_start])[:-1].tolist()
    # a range from the middle, by the index of block starts
    file = max(files.collect(), key=lambda f: f.n_ids)
    with open_file(file.path) as opened:
        reader = token_files.Reader(opened)
        assert reader.n_ids == file.n_ids and len(reader.doc_ids) == file.n_docs
        whole = reader.ids(0, reader.n_ids)
        assert reader.ids(1_000, 700).tolist() == whole[1_000:1_700].tolist() and len(reader.ids(5, 0)) == 0


def test_runs_of_blocks(monkeypatch):
    monkeypatch.setattr(token_files, "RUN", 2)
    out = io.BytesIO()
    close = out.close
    out.close = lambda: None
    writer = token_files.Writer(out)
    docs = [np.arange(n, dtype="<u4") * 7 for n in (1, 0, 900, 3_000, 255, 256)]
    for i, ids in enumerate(docs):
        writer.add(i if i else None, ids.tobytes())
    writer.close()
    data = out.getvalue()
    close()

    class File:
        size = staticmethod(lambda: len(data))
        read_at = staticmethod(lambda n, at: data[at : at + n])

    batches = [row for batch in token_files._documents(token_files.Reader(File), 10) for row in batch.to_pylist()]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in batches] == [d.tolist() for d in docs]
    assert [r["start"] for r in batches] == [10, 11, 11, 911, 3_911, 4_166] and batches[0]["doc_id"] is None


def test_no_documents(spark, tmp_path):
    files = token_files.write_token_files(no_documents(spark), VOCABULARY, end_id=1, folder=str(tmp_path))
    assert files.count() == 0 and token_files.read_token_files(files).count() == 0


# ---------------------------------------------------------------- WARC

PAGES = [
    (1, "http://a/1", "<p>é</p>"), (2, None, None), (3, "http://a/3 \r\nX: y", ""), (4, "u", "<p>é</p>"), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (4, "again", "<p>é</p>"), (None, "n", "<p>é</p>"), (None, "m", "alone"), (7, "big", "x\r\n\r\n" * 600_000), (8, "big", "x\r\n\r\n" * 600_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, refers_to string, payload_bytes int")


def plain_records(rows, min_bytes):
    last = collections.defaultdict(list)
    for i, _, html in rows:
        last[html or ""].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in last[html or ""] if x is not None]
        refers = max(ids) if len(last[html or ""]) > 1 and ids and max(ids) != i and len(data) >= min_bytes else None
        out.append((i, len(data), warc.payload_digest(data), "response" if refers is None else "revisit", refers))
    return collections.Counter(out)


@pytest.mark.parametrize("min_bytes", [0, 20])
def test_archives(spark, tmp_path, min_bytes):
    streams = warc.write_monolithic(warc.mark_revisits(pages(spark).repartition(3), min_bytes=min_bytes), folder=str(tmp_path / "whole"), most_bytes=1 << 20)
    archives = warc.normalise(streams, folder=str(tmp_path / "members"))
    back = warc.read_archives(archives).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back) == plain_records(PAGES, min_bytes)
    payloads = {(r.page_id, bytes(r.payload).decode()) for r in back if r.record_type == "response"}
    assert payloads <= {(i, h or "") for i, _, h in PAGES}
    assert sum(r.n_records for r in archives.collect()) == len(PAGES)
    for row in archives.collect():
        with open(row.path, "rb") as file, open(row.index_path) as index:
            data, lines = file.read(), [line.split("\t") for line in index.read().splitlines()]
        assert len(lines) == row.n_records and sum(int(n) for _, n, *_ in lines) == len(data) == row.n_bytes
        for offset, length, kind, name in lines:
            # each member by itself is one record
            one = zlib.decompressobj(31)
            text = one.decompress(data[int(offset) : int(offset) + int(length)])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            assert f"WARC-Type: {kind}\r\n".encode() in text and name.encode() in text


def test_several_members_and_damage(spark, tmp_path):
    one, two = (warc.record(i, "u", b"abc", None, "2020-01-01T00:00:00Z") for i in (1, 2))
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    paths = lambda *names: spark.createDataFrame([(str(tmp_path / n),) for n in names], "path string")
    archives = warc.normalise(paths("two.warc.gz", "none.warc.gz"), folder=str(tmp_path / "out"))
    assert sorted(r.n_records for r in archives.collect()) == [0, 2]
    assert sorted(r.page_id for r in warc.read_archives(archives).collect()) == [1, 2]
    for name, data in (("cut", gzip.compress(one + two[:-30])), ("odd", gzip.compress(b"no record\r\n"))):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="inside a record|no WARC record"):
            warc.normalise(paths(name), folder=str(tmp_path / "bad")).collect()


def test_no_pages(spark):
    none = warc.write_monolithic(warc.mark_revisits(pages(spark, [])))
    assert warc.read_archives(warc.normalise(none)).count() == 0


def test_digest():
    assert warc.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(warc.payload_digest(hashlib.sha1(b"x").digest())) == 32


def test_long_header_lines(spark):
    exact = "data:" + "x" * (warc.HEAD_LINE - len("WARC-Target-URI: data:"))
    urls = {1: "data:text/html," + "Ab" * 50_000, 2: exact, 3: exact + "Y", 4: exact[:-1], 5: "http://a/"}
    pages = spark.createDataFrame([(i, u, f"page {i}", None) for i, u in urls.items()], "page_id long, url string, html string, refers_to long")
    back = warc.read_archives(warc.normalise(warc.write_monolithic(pages)))
    assert {r.page_id: (r.url, bytes(r.payload)) for r in back.collect()} == {i: (u, f"page {i}".encode()) for i, u in urls.items()}


@pytest.mark.parametrize("name, by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_other_tokenizers_encode_whole_texts(name, by_word):
    from tokenizers import Tokenizer

    path = tokens.vocabulary(name)
    own, whole = tokens.WordEncoder(path), Tokenizer.from_file(path)
    assert own.by_word is by_word
    for text in ["Two  Words\nand more", "ÀB c<|endoftext|>", " x", "It's 12.", "", None]:
        assert np.frombuffer(own.encode(text), tokens.ID).tolist() == (whole.encode(text, add_special_tokens=False).ids if text else [])


def test_workers_let_go_of_other_tables():
    from tallyloom.llm import files

    files.held("one")["a"], files.held("two")["b"] = 1, 2
    files.let_go("one")
    assert files.held("one") == {"a": 1} and files.held("two") == {}
    files.let_go()
    assert files.held("one") == {}
