"""Language by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content zstandard dictionary of its own texts, reduced like every text to lower-case letters
and blanks. A text is compressed block by block with each; blocks keep the dictionary in reach however long the text
is. Among equal sizes the language with more training texts wins. Narrow margins are rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import id_and_text
from tallyloom.llm.files import in_arrow

UNDETERMINED = "und"
BETWEEN = re.compile(r"[\W\d_]+")  # all but letters
BLOCK = 4_096
LEVEL = 6
HALF = 3.0  # bytes of difference that halve the odds


def letters(text: str) -> str:
    return BETWEEN.sub(" ", text.lower()).strip()


def shares(parts: list[bytes], room: int) -> list[bytes]:
    """The parts cut to one length, the largest at which all of them fit; shorter parts leave their room to the others."""
    left, most = room, 0
    for done, size in enumerate(sorted(map(len, parts))):
        most = left // (len(parts) - done)
        if size > most:
            break
        left -= size
    return [part[: max(most, 1)].decode(errors="ignore").encode() for part in parts]


def learn_dictionaries(labelled: DataFrame, *, dict_bytes: int = 65_536, sample_docs: int = 200, label_col: str = "lang", text_col: str = "text") -> list[tuple[str, bytes]]:
    """(language, dictionary) by falling number of texts: `dict_bytes` from about `sample_docs` texts a language.

    A bounded sample: texts are taken by a hash, at a rate by language that its count sets. Each gives one stretch, at a place
    of the whole text that the hash chooses, and all stretches taken fit the dictionary. Rows without label or text are left
    out; copies of a text count once. Rows that are not taken stay in their tasks.
    """
    own = labelled.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null and text <> ''")
    hashed = own.withColumn("h", F.xxhash64("text"))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).where("n > 0")
    # one row a language
    rate = F.broadcast(counts.select(F.col("lang").alias("named"), "n", (F.lit(float(sample_docs)) / F.col("n")).alias("rate")))
    even = F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003.0
    taken = hashed.join(rate, (F.col("lang") == F.col("named")) & (even < F.col("rate")))
    # twice a share in characters, as letters are fewer
    width = F.ceil(2.0 * dict_bytes / F.least("n", F.lit(sample_docs))).cast("int")
    room = F.greatest(F.length("text") - width + 1, F.lit(1))
    place = (F.pmod(F.shiftrightunsigned("h", 20), room) + 1).cast("int")
    taken = taken.select("lang", "h", "n", F.substring("text", place, width).alias("part")).dropDuplicates(["lang", "h"])
    rows = taken.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("h", "part"))).alias("parts"), F.first("n").alias("n")).collect()
    out = []
    for row in sorted(rows, key=lambda r: (-r["n"], r["lang"])):
        parts = [letters(p["part"]).encode() for p in row["parts"]]
        out.append((row["lang"], b"\n".join(shares(parts, dict_bytes - len(parts) + 1))))
    return out


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]], level: int = LEVEL):
        import zstandard

        self.languages = [language for language, _ in dictionaries]
        self.packers = []
        for _, content in dictionaries:
            data = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level)
            self.packers.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False).compress)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the smallest result and its share of the odds."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        data = letters(text).encode()
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
        sizes = [sum(len(pack(block)) for block in blocks) for pack in self.packers]
        best = min(sizes)
        return self.languages[sizes.index(best)], 1.0 / sum(2.0 ** max(-500.0, (best - s) / HALF) for s in sizes)


COLUMNS = pa.schema({"doc_id": pa.int64(), "lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()})


def classify(
    docs: DataFrame, dictionaries: list[tuple[str, bytes]], *, min_score: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score, rejected per input row, from the whole text.

    `und` with score 0 for a null text, one without a letter, or where no language was learned. `rejected`: `und`, or
    a score below `min_score`, that is, another language's dictionary did about as well.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # dict_bytes a language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            got = [classifier.predict(t) for t in batch.column(1).to_pylist()]
            names, scores = [n for n, _ in got], [s for _, s in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([s < min_score for s in scores])], schema=COLUMNS
            )

    own = id_and_text(docs, id_col, text_col)
    return in_arrow(own.withColumn("doc_id", own["doc_id"].cast("long")), label, "doc_id long, lang_pred string, score double, rejected boolean")
