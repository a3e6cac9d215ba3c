"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that other columns of the input cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, join) -> Column:
    """Each place of an array joined with all before it by `join` (sums, maxima): in each round from twice as far.

    As many passes as the logarithm of the length, so that long arrays stay cheap.
    """

    def rounds(first: Column) -> Column:
        def step(held: Column, k: Column) -> Column:
            reach = F.pow(F.lit(2), k).cast("int")
            return F.transform(held, lambda x, i: F.when(i >= reach, join(x, F.get(held, i - reach))).otherwise(x))

        return F.aggregate(F.sequence(F.lit(0), F.log2(F.size(first)).cast("int")), first, step)

    return F.when(F.size(values) > 1, bind(values, rounds)).otherwise(values)


def text_mark(text: Column) -> Column:
    """Tells rows of one document id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 texts of a batch; null texts as empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def runs(texts: list[bytes], most: int = 4 << 20) -> list[range]:
    """Row ranges of about `most` bytes of text each, so that a batch is worked on in bounded memory."""
    out, start, total = [], 0, 0
    for row, text in enumerate(texts):
        total += len(text)
        if total >= most:
            out.append(range(start, row + 1))
            start, total = row + 1, 0
    return out + [range(start, len(texts))] * (start < len(texts))


BLOOM = "spark.sql.optimizer.runtime.bloomFilter"


@contextlib.contextmanager
def bloom_filtered(spark: SparkSession, keys: int) -> Iterator[None]:
    """Let Spark filter the larger side of joins that are run inside by a Bloom filter of `keys` rows, 16 bits each.

    Spark's bounds on a filter stay (8 MB): with more rows it lets more through, and the join decides in any case.
    """
    wanted = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": "0",
        "creationSideThreshold": "1g",
        "expectedNumItems": str(max(1_000, keys)),
        "numBits": str(16 * max(1_000, keys)),
    }
    before = {name: spark.conf.get(f"{BLOOM}.{name}") for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(f"{BLOOM}.{name}", value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(f"{BLOOM}.{name}", value)
