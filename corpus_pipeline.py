"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, as a table written and read again, and all but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import edit_decontam, hamming_dedup, line_dedup, nbsvm, packing
from tallyloom.llm.queries import END_ID, SEQUENCE, VOCABULARY, fold, table
from tallyloom.llm.tokens import vocabulary
from tallyloom.session import scratch_path, temporary_copies

LEAST_SCORE = 0.3
LINE_DOCS = 10
SHINGLE_WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the NB support vectors, fitted on the labels, reject go."""
    model = nbsvm.train(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return nbsvm.keep_good(docs, model, least=LEAST_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in ten or more documents stay in the first only; documents with no word left go."""
    kept = line_dedup.drop_repeated_lines(docs, min_docs=LINE_DOCS)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return hamming_dedup.drop_near_duplicates(docs, shingle_words=SHINGLE_WORDS, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to small edits, go."""
    return edit_decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    pieces = packing.token_pieces(docs, vocabulary(VOCABULARY), capacity=SEQUENCE, end_id=END_ID)
    return packing.pack(pieces, capacity=SEQUENCE)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

# trained models, signatures and edit distances have no form in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the stages store on their way, and the tables between them, are removed."""
    docs, last = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    with temporary_copies(spark):
        for number, (name, stage) in enumerate(STAGES, 1):
            path = last if number == len(STAGES) else scratch_path(spark, name.replace(" ", "-"))
            with temporary_copies(spark):
                kept = stage(spark, docs, sf_dir)
                kept.write.parquet(path)
            docs = spark.read.schema(kept.schema).parquet(path)
    return docs
