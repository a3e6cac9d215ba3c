"""The operators' queries over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    cross_align, edit_decontam, hamming_dedup, line_dedup, nbsvm, packing, repetition, secret_scan, simhash_dedup, token_files, vector_codes,
    warc, zstd_lang,
)
from tallyloom.llm.tokens import vocabulary

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LINE_SQL = r"""
with lines as (
  select doc_id, i, string_split(coalesce(text, ''), chr(10))[i] as line
  from documents, lateral (select unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i)
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), often as (
  select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
)
select doc_id, count(*)::bigint as n_lines, count(o.key)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (o.key is null), '')) as kept_sha256
from keyed k left join often o on k.key = o.key group by doc_id
"""


@query("op9_line_dedup", LINE_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in ten or more documents go everywhere."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=10))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 4096


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written in id order and read back."""
    files = token_files.write_token_files(table(spark, folder, "documents"), vocabulary(VOCABULARY), end_id=END_ID)
    back = token_files.read_token_files(files)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    docs = table(spark, folder, "documents")
    return packing.pack(packing.token_pieces(docs, vocabulary(VOCABULARY), capacity=SEQUENCE, end_id=END_ID), capacity=SEQUENCE)


SECRET_SAMPLE_DOCS = 500


@query("op1_secret_scan")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every text: the base patterns' spans, and those the Markov models add."""
    docs = table(spark, folder, "documents")
    model = secret_scan.train(secret_scan.samples_from(docs, sample_docs=SECRET_SAMPLE_DOCS))
    found = secret_scan.find_secrets(docs, model)
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("base"), i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(secret_scan.KINDS)],
        F.sha2(secret_scan.rendered(F.col("base")), 256).alias("base_sha256"),
        secret_scan.rendered(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_markov"),
    )


@query("op2_suffix_repetition")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition figures and verdicts of every text."""
    figures = repetition.repetition_figures(table(spark, folder, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return figures.select(*first, "n_covered_words", "longest_repeat")


# base 32 of a SHA-1 in hexadecimal: five digits are four letters
_LETTERS_SQL = " || ".join(f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> {bits}) & 31) + 1]" for bits in (15, 10, 5, 0))
PAGE_SQL = f"""
select page_id, strlen(payload)::bigint as payload_bytes,
  array_to_string(list_transform(list_transform(range(8), lambda i: ('0x' || sha1(payload)[5 * i + 1 : 5 * i + 5])::int), lambda v: {_LETTERS_SQL}), '')
    as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to
from (select page_id, coalesce(html, '') as payload, max(page_id) over (partition by coalesce(html, '')) as last from pages)
"""


@query("op3_warc_normaliser", PAGE_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records in whole-file streams, normalised to a member a record, and read back."""
    pages = warc.mark_revisits(table(spark, folder, "pages"))
    archives = warc.normalise(warc.write_monolithic(pages))
    back = warc.read_archives(archives, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def fold(of: int) -> Column:
    """crc32 of the document id as text, modulo `of`; -1 without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)), F.lit(-1))


@query("op6_zstd_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, from dictionaries of two thirds of the documents."""
    docs = table(spark, folder, "documents")
    found = zstd_lang.classify(docs, zstd_lang.learn_dictionaries(docs.where(fold(3) != 1)))
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


@query("op7_edit_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents, with up to a twentieth of their characters edited."""
    return edit_decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_nbsvm_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text, learned from the labels of four fifths of the documents."""
    docs = table(spark, folder, "documents")
    model = nbsvm.train(docs, table(spark, folder, "labels").where(fold(5) != 0))
    rated = nbsvm.score(docs, model)
    return rated.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


NEAR_SQL = r"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), sets as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) end) as shingle from words
), sizes as materialized (
  select doc_id, count(shingle) as n from documents left join sets using (doc_id) group by doc_id
), shared as materialized (
  select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as materialized (
  select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)
), ways as materialized (
  select x, y from links union all select y, x from links
), reached as (
  select doc_id, doc_id as component from documents union select y, component from reached join ways on doc_id = x
)
select doc_id, n::bigint as n_shingles, least as component_id, doc_id = least as kept
from sizes join (select doc_id, min(component) as least from reached group by doc_id) using (doc_id)
"""


@query("op5_hamming_minhash", NEAR_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose sets of four-word shingles are alike by 80 per cent."""
    return hamming_dedup.near_duplicates(table(spark, folder, "documents"), shingle_words=4, percent=80).drop("mark", "chosen")


BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"


@query("op11_cross_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizers' ids aligned over every text, with the links' counts over all texts."""
    docs = table(spark, folder, "documents")
    found = cross_align.score(docs, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The same codebooks and codes by plain scans: every part against every entry of its codebook."""
    steps = [f"""
kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as q from kept, range({parts}) r(p)
), books0 as (
  select p, row_number() over (partition by p order by vec_id) - 1 as i, q as e from parts
  qualify row_number() over (partition by p order by vec_id) <= {entries}
)"""]  # fmt: skip
    apart = "list_sum(list_transform(list_zip(q, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    for n in range(rounds + 1):
        steps.append(f"found{n} as materialized (select vec_id, label, p, q, min({apart} * {entries} + i) as m from parts join books{n} using (p) group by all)")
        if n < rounds:
            steps.append(f"""
sums{n} as (
  select p, i, list(mean order by k) as e from (
    select p, i, k, ((s - ((s % c) + c) % c) // c)::bigint as mean from (
      select p, m % {entries} as i, k, sum(q[k])::bigint as s, count(*) as c from found{n}, range(1, 4096) r(k) where k <= len(q) group by all))
  group by all
), books{n + 1} as materialized (select p, i, coalesce(s.e, b.e) as e from books{n} b left join sums{n} s using (p, i))""")  # fmt: skip
    last = f"""
select vec_id, string_agg(printf('%02x', (m % {entries})::int), '' order by p) as code, sum(m // {entries})::bigint as error,
  any_value(label) as label from found{rounds} group by vec_id"""
    digest = f"select sha256(string_agg(array_to_string(e, ','), ',' order by p, i)) from books{rounds}"
    return f"""with {", ".join(steps)}, coded as ({last})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, ({digest}) as codebooks_sha256 from coded"""


@query("op12_vector_codes", _codes_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Four-byte codes of all vectors, with their errors."""
    coded, codebooks = vector_codes.compress(table(spark, folder, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", vector_codes.digest(codebooks).alias("codebooks_sha256"))


@query("op13_simhash_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose fingerprints of three-word shingles differ in two bits at most."""
    found = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
