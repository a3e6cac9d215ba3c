"""Reading raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECT_COLUMN = "_malformed_line"
FAULTS_COLUMN = "_faulty_columns"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes.

    Set `multi_line` for text tables whose fields hold line breaks. Such a file cannot be split,
    so deliver those tables as many files. `infer` costs an extra read; prefer a schema.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def load_with_schema(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Enforce a schema: typed rows that fit it, and the raw text of those that do not.

    A row is rejected for a value that does not convert or for the wrong number of fields; the
    rejects name the columns at fault. The verdict looks at every column, whichever of them a
    query selects later, so column pruning cannot let a bad row through.
    """
    raw_schema = StructType(
        [*[StructField(name, StringType()) for name in schema.names], StructField(REJECT_COLUMN, StringType())]
    )
    raw = (
        spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT_COLUMN)
        .schema(raw_schema)
        .csv(path)
    )
    faults = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    judged = raw.withColumn(FAULTS_COLUMN, F.filter(F.array(*faults), lambda fault: fault.isNotNull()))
    fits = F.col(REJECT_COLUMN).isNull() & (F.size(FAULTS_COLUMN) == 0)
    good = judged.filter(fits).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, judged.filter(~fits)


def load_or_fail(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Enforce a schema and stop the job at the first line that breaks it, as a bulk COPY does.

    Only columns that the job reads are checked.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a zone folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
