"""The registered queries and the pipeline over the small test tables."""

import collections
import hashlib
import pathlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tallyloom.llm import edit_decontam, line_dedup, tokens, warc
from tallyloom.llm.queries import ORACLES, QUERIES

from tallyloom.session import materialise, shared_root

from .test_cross_align import plain_rows
from .test_dedup import plain_components, plain_lines
from .test_files import plain_records, whole_ids
from .test_packing_and_leaks import check_packed
from .test_simhash import plain_components as plain_classes
from .test_simhash import plain_fingerprint
from .test_texts import plain_repeats, plain_secrets
from .test_vector_codes import plain as plain_codes

FOLDER = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.sql("select doc_id, text from documents").fetchall()


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def get(name):
        if name not in made:
            made[name] = QUERIES[name](spark, str(FOLDER)).collect()
        return made[name]

    return get


def crc(i, of):
    return zlib.crc32(str(i).encode()) % of


def test_registered():
    names = entry_points.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(duck, result, name):
    rows = result(name)
    theirs = duck.sql(ORACLES[name])
    assert sorted(rows[0].__fields__) == sorted(theirs.columns)
    assert collections.Counter(tuple(r[c] for c in theirs.columns) for r in rows) == collections.Counter(theirs.fetchall())


def test_op1(docs, result):
    texts = dict(docs)
    for r in result("op1_secret_scan"):
        base = plain_secrets(texts[r.doc_id])
        names = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == names
    assert len(result("op1_secret_scan")) == len(docs)


def test_op2(docs, result):
    texts = dict(docs)
    for r in result("op2_suffix_repetition"):
        if len(texts[r.doc_id] or "") < 6_000:
            want = plain_repeats(texts[r.doc_id], 10)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered_words, r.longest_repeat) == want
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_op3(duck, result):
    rows = duck.sql("select page_id, url, html from pages").fetchall()
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in result("op3_warc_normaliser"))
    assert got == plain_records(rows, 0)
    assert result("op3_warc_normaliser")[0].payload_digest != warc.payload_digest(b"")


def test_op4(docs, result):
    start, want = 0, {}
    for i, t in sorted(docs):
        ids = np.array([*whole_ids(t), 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in result("op4_token_files")} == want


def test_op5(docs, result):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in result("op5_hamming_minhash"))
    assert got == plain_components(docs, 4, 80)


def test_op6(duck, result):
    lang = dict(duck.sql("select doc_id, lang from documents").fetchall())
    rows = result("op6_zstd_language")
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.9


def test_op7(duck, docs, result):
    items = {i: edit_decontam.normalised(t) for i, t in duck.sql("select item_id, text from benchmark").fetchall()}
    exact = {(d, i) for d, t in docs for i, item in items.items() if item in edit_decontam.normalised(t)}
    found = {(r.doc_id, r.item_id): r for r in result("op7_edit_decontamination")}
    assert exact == {k for k, r in found.items() if r.distance == 0}
    assert all(r.distance <= 0.05 * len(items[r.item_id]) for r in found.values())


def test_op8(duck, result):
    quality = dict(duck.sql("select doc_id, quality from labels").fetchall())
    rows = result("op8_nbsvm_quality")
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    known = [r for r in rows if r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in known) / len(known) > 0.9


def test_op10(docs, result):
    rows = result("op10_best_fit_packing")
    want = collections.Counter()
    for i, t in docs:
        ids = np.array([*whole_ids(t), 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4_096)):
            part = ids[at : at + 4_096]
            want[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_packed(rows, 4_096) <= -(-sum(r.length for r in rows) // 4_096) + 1


def test_op11(docs, result):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = collections.Counter(tuple(r[n] for n in names) for r in result("op11_cross_alignment"))
    assert got == collections.Counter({(*k[:7], k[8]): n for k, n in plain_rows(docs).items()})


def test_op12(duck, result):
    vectors = duck.sql("select vec_id, embedding, label from embeddings").fetchall()
    want, books = plain_codes(vectors, 4, 256, 4)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    got = collections.Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in result("op12_vector_codes"))
    assert got == collections.Counter({(i, code.hex(), error, total, digest): n for (i, _, code, error, total), n in want.items()})


def test_op13(docs, result):
    rows = [(i, plain_fingerprint(t)) for i, t in docs]
    want = collections.Counter((i, f"{f:016x}", c) for (i, f), c in zip(rows, plain_classes(rows, 2)))
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in result("op13_simhash_dedup")) == want


def test_pipeline_stage_by_stage(spark, duck):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], str(FOLDER)), "stage"))
    assert all(t.columns == docs.columns for t in tables[:-1])
    read = [[(r.doc_id, r.text) for r in t.collect()] for t in tables[:-1]]
    raw, good, lines, single, clean = read
    # quality: rows go, texts stay; clean documents stay, most of the junk goes
    assert set(good) < set(raw)
    kept, quality = {i for i, _ in good}, duck.sql("select doc_id, quality from labels").fetchall()
    assert sum(i in kept for i, q in quality if q) >= 0.98 * sum(q for _, q in quality)
    assert sum(i in kept for i, q in quality if not q) <= 0.5 * sum(1 - q for _, q in quality)
    # lines
    marks = {r.text or "": r.m for r in tables[1].select("text", line_dedup.text_mark(F.col("text")).alias("m")).collect()}
    plain = plain_lines(good, corpus_pipeline.LINE_DOCS, True, marks)
    assert sorted(lines) == sorted((i, t) for i, _, gone, t in plain.elements() if not gone or t.strip())
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())
    # near-duplicates
    assert sorted(single) == sorted((i, dict(lines)[i]) for i, _, _, own in plain_components(lines, 5, 80) if own)
    # decontamination
    items = [edit_decontam.normalised(t) for (t,) in duck.sql("select text from benchmark").fetchall()]
    leaks = [(i, t) for i, t in single if any(item in edit_decontam.normalised(t) for item in items)]
    assert set(clean) <= set(single) - set(leaks) and len(single) - len(clean) <= len(leaks) + 2
    # packing
    rows = tables[-1].collect()
    assert {r.doc_id for r in rows} == {i for i, _ in clean}
    assert sum(r.length for r in rows) == sum(len(whole_ids(t)) + 1 for _, t in clean)
    check_packed(rows, 4_096)


def test_run(spark):
    root = pathlib.Path(shared_root(spark).removeprefix("file://")) / "tallyloom"
    before = set(root.iterdir()) if root.exists() else set()
    assert entry_points.queries()["pipeline"](spark, str(FOLDER)).count() > 100
    # only the result stays
    assert [p.name.split("-")[0] for p in set(root.iterdir()) - before if p.is_dir()] == ["pipeline"]
    assert tokens.vocabulary(corpus_pipeline.VOCABULARY).endswith(".json")
