"""Line deduplication by range-partitioned line hashes, answered with compressed keep bitmaps.

Native: DataFrame functions only. Lines become (hash, document, position) rows without their text.
These are range-partitioned by hash and sorted by document and position inside it, so that one
streaming pass sees the first occurrence of each key and counts its documents. Keys with at least a
thousandth of all lines, or a million of them, are split by document into as many sub-ranges as keep each below that.

A keep bitmap is a map from container number to bytes, 32,768 lines a container, lowest bit first;
a set bit keeps the line. Containers and trailing bytes that keep everything are left out, and a
document that loses nothing has no bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bind, id_and_text, text_mark
from tallyloom.session import materialise

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX, HEX_NOT = "0123456789ABCDEF", "FEDCBA9876543210"
CONTAINER = 32_768
HOT_PARTS, HOT_ROWS = 1_000, 1_000_000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def _hashed_lines(docs: DataFrame, min_key_chars: int) -> DataFrame:
    lines = docs.select("doc_id", text_mark(F.col("text")).alias("mark"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "mark", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_key_chars)
    return keyed.select("doc_id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _salted(lines: DataFrame) -> DataFrame:
    """With `salts`, the number of parts that a key's rows are dealt into by document, and `salt`, the row's own.

    No part of a key in many documents has much over 1/HOT_PARTS of all lines, or over HOT_ROWS.
    """
    count = lines.count()
    least = max(1_000, min(HOT_ROWS, -(-count // HOT_PARTS)))
    hot = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    hot = hot.select("h1", "h2", F.ceil(F.col("n") / least).cast("int").alias("salts"))
    # lines / least rows at most: HOT_PARTS, or one for HOT_ROWS lines
    joined = lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    return joined.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))


def key_figures(lines: DataFrame) -> DataFrame:
    """Per key and part of it in total: documents, first document and position, parts; one row per key."""
    ranged = lines.repartitionByRange("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", "doc_id", "mark", "pos")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "mark", "pos")
    marked = ranged.select(
        "h1", "h2", "salt", "salts", "doc_id", "mark", "pos",
        ((F.row_number().over(stream) == 1) | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))).alias("new_doc"),
    )
    parts = marked.where("new_doc").groupBy("h1", "h2", "salt").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc_id", "mark", "pos")).alias("first"), F.max("salts").alias("salts")
    )
    return parts.groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("n_docs"), F.min("first").alias("first"), F.max("salts").alias("salts")
    )


def _bitmaps(dropped: DataFrame) -> DataFrame:
    """Per document: `n_dropped` and `keep`, from the positions it loses."""
    by_doc = dropped.repartition("doc_id", "mark").groupBy("doc_id", "mark", F.floor(F.col("pos") / CONTAINER).cast("int").alias("container"))
    drop_hex = F.regexp_replace(F.hex(F.col("bits")), "(00)+$", "")
    containers = by_doc.agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("pos") + 1)).alias("bits"), F.countDistinct("pos").alias("n")
    )
    keep = F.unhex(F.translate(drop_hex, HEX, HEX_NOT))
    return containers.groupBy("doc_id", "mark").agg(
        F.sum("n").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("container", keep.alias("bits")))).alias("keep"),
    )


def keep_bitmaps(
    docs: DataFrame, *, min_docs: int, min_key_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep bitmaps of the documents that lose a line: doc_id, mark, n_dropped, keep.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least
    `min_key_chars` code points in at least `min_docs` documents lose all their lines, or with
    `keep_first` all but the first by document and position (of rows that share an id, by `mark` first). Documents count by id: rows that repeat
    an id count once, rows without an id are one document. `mark` (a hash of the text) separates rows
    that share an id but not the text; equal rows share a bitmap. A null text is one empty line.
    No documents, or none that loses a line: no rows.
    """
    lines = materialise(_hashed_lines(id_and_text(docs, id_col, text_col), min_key_chars), "line-hashes")
    lines = _salted(lines)
    doomed = key_figures(lines).where(F.col("n_docs") >= min_docs)
    doomed = doomed.select("h1", "h2", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dropped = lines.drop("salts").join(doomed, ["h1", "h2", "salt"])
    if keep_first:
        own = F.struct("doc_id", "mark", "pos")
        dropped = dropped.where(~own.eqNullSafe(F.col("first")))
    return _bitmaps(dropped.select("doc_id", "mark", "pos"))


def _nibbles(keep: Column) -> Column:
    return F.transform_values(keep, lambda _, bits: F.split(F.hex(bits), ""))


def _kept(nibbles: Column, i: Column) -> Column:
    at = F.pmod(i, F.lit(CONTAINER))
    digits = F.try_element_at(nibbles, F.floor(i / CONTAINER).cast("int"))
    # hex puts a byte's upper four bits first
    digit = F.get(digits, (F.floor(at / 8) * 2 + F.when(at % 8 < 4, 1).otherwise(0)).cast("int"))
    value = F.instr(F.lit(HEX), F.coalesce(digit, F.lit("F"))) - 1
    return F.floor(value / F.pow(F.lit(2), at % 4)).cast("int") % 2 == 1


def kept_text(text: Column, keep: Column) -> Column:
    """`text` without the lines whose bit in `keep` is not set; the whole text where `keep` is null."""
    whole = F.coalesce(text, F.lit(""))
    rest = bind(_nibbles(keep), lambda nibbles: F.array_join(F.filter(split_lines(text), lambda _, i: _kept(nibbles, i)), "\n"))
    return F.when(keep.isNull(), whole).otherwise(rest)


def dedup_lines(docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the text that its bitmaps keep, and `n_lines`, `n_dropped` (both in place of columns of that name).

    A null text becomes empty. A document that loses all its lines stays, with an empty text.
    """
    # the row as one column, so that its names cannot clash
    own = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = bitmaps.select(F.col("doc_id").alias("marked"), "mark", "keep", F.col("n_dropped").alias("gone"))
    joined = own.join(marks, F.col("id").eqNullSafe(F.col("marked")) & (text_mark(F.col("text")) == F.col("mark")), "left")
    made = {
        text_col.lower(): kept_text(F.col("text"), F.col("keep")),
        "n_lines": F.size(split_lines(F.col("text"))).cast("long"),
        "n_dropped": F.coalesce("gone", F.lit(0)).cast("long"),
    }
    names = docs.columns + [name for name in made if name not in {c.lower() for c in docs.columns}]
    return joined.select(*[made[n.lower()].alias(n) if n.lower() in made else F.col("row")[n].alias(n) for n in names])


def drop_repeated_lines(docs: DataFrame, *, min_docs: int, min_key_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with only the first of lines that `min_docs` documents hold.

    Documents of which no word is left go; those that lose nothing stay, empty ones too.
    """
    names = docs.columns
    bitmaps = keep_bitmaps(docs, min_docs=min_docs, min_key_chars=min_key_chars, keep_first=True, id_col=id_col, text_col=text_col)
    kept = dedup_lines(docs.select(id_col, text_col, F.struct(*names).alias("_row")), bitmaps, id_col=id_col, text_col=text_col)
    kept = kept.where((F.col("n_dropped") == 0) | (F.btrim(F.col(text_col), F.lit(WHITE)) != ""))
    return kept.select(*[F.col(text_col) if n == text_col else F.col("_row")[n].alias(n) for n in names])
