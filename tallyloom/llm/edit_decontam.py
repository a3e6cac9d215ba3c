"""Benchmark decontamination: pieces by pigeonhole, exact hits, verified by Myers' bit-parallel distance.

A test item that occurs with at most k edits contains one of its k + 1 pieces unedited. All pieces of a block of
items go into one automaton, which every text is run through; each hit says where the item would lie, and the
bit-parallel distance of the item to that stretch decides. Item and text are lower-cased, runs of white space
being one blank. Short items count as whole words only: their occurrences neither begin nor end inside a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import id_and_text
from tallyloom.llm.files import in_arrow
from tallyloom.session import materialise


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """`errors` + 1 pieces that cover the item, with their offsets; lengths differ by one at most."""
    cuts = [i * len(item) // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, anchored: bool = False) -> list[int]:
    """Per position of `text`: the least edit distance of `item` to a stretch that ends there.

    The stretch begins anywhere, or with `anchored` where the text begins.
    """
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << len(item) - 1
    plus, minus, distance, out = full, 0, len(item), []
    for c in text:
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        distance += bool(up & top) - bool(down & top)
        up = up << 1 | anchored
        plus = (down << 1 | ~(vertical | up)) & full
        minus = up & vertical & full
        out.append(distance)
    return out


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether the stretch neither begins nor ends inside a word."""
    word = lambda at: 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")
    return not (word(start - 1) and word(start)) and not (word(end - 1) and word(end))


class Finder:
    """A block of items, ready to be looked for; those under `whole_chars` characters as whole words."""

    def __init__(self, items: list[tuple[int, str]], error_share: float, whole_chars: int):
        import ahocorasick

        self.items, self.automaton, self.short = [], ahocorasick.Automaton(), set()
        where: dict[str, list[tuple[int, int]]] = {}
        for number, (item_id, text) in enumerate(items):
            errors = int(error_share * len(text))
            if len(text) < whole_chars:
                self.short.add(number)
            self.items.append((item_id, text, errors))
            for offset, piece in pieces(text, errors):
                where.setdefault(piece, []).append((number, offset))
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def stretches(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per item hit: the merged stretches it may lie in."""
        starts: dict[int, set[int]] = {}
        if len(self.automaton):
            for last, (length, at) in self.automaton.iter(text):
                for number, offset in at:
                    starts.setdefault(number, set()).add(last + 1 - length - offset)
        out = {}
        for number, found in starts.items():
            _, item, errors = self.items[number]
            merged: list[list[int]] = []
            for start in sorted(found):
                low, high = max(0, start - errors), min(len(text), start + len(item) + errors)
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            out[number] = [(a, b) for a, b in merged]
        return out

    def find(self, text: str | None, first_only: bool = False) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of each item's best occurrence, the leftmost by its end among equals."""
        plain, out = normalised(text), []
        for number, stretches in self.stretches(plain).items():
            item_id, item, errors = self.items[number]
            if number in self.short:
                best = self._whole(plain, item, errors, stretches)
            else:
                best = self._anywhere(plain, item, errors, stretches)
            if best is not None:
                out.append((item_id, *best))
                if first_only:
                    break
        return out

    @staticmethod
    def _lengths(plain: str, item: str, errors: int, end: int, distance: int) -> list[int]:
        """Lengths, ascending, of the stretches that end at `end` and have this distance."""
        back = plain[max(0, end - len(item) - errors) : end][::-1]
        return [i + 1 for i, d in enumerate(myers(item[::-1], back, anchored=True)) if d == distance]

    def _anywhere(self, plain: str, item: str, errors: int, stretches: list[tuple[int, int]]) -> tuple[int, int, int] | None:
        best = (errors + 1, 0)
        for low, high in stretches:
            distances = myers(item, plain[low:high])
            least = min(distances, default=errors + 1)
            if least < best[0]:
                best = (least, low + distances.index(least) + 1)
        distance, end = best
        if distance > errors:
            return None
        lengths = self._lengths(plain, item, errors, end, distance)
        return distance, end - (lengths[0] if lengths else 0), end

    def _whole(self, plain: str, item: str, errors: int, stretches: list[tuple[int, int]]) -> tuple[int, int, int] | None:
        """As `_anywhere`, among the occurrences that are whole words."""
        ends = [(d, low + i + 1) for low, high in stretches for i, d in enumerate(myers(item, plain[low:high])) if d <= errors]
        for distance, end in sorted(ends):
            for length in self._lengths(plain, item, errors, end, distance):
                if whole_words(plain, end - length, end):
                    return distance, end - length, end
        return None


def item_blocks(items: DataFrame, *, block_chars: int, min_chars: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The test items, normalised, in blocks of about `block_chars`; shorter ones than `min_chars`, and empty ones, are left out."""
    block: list[tuple[int, str]] = []
    held = 0
    for row in items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).orderBy("id").toLocalIterator():
        if len(text := normalised(row["text"])) >= max(1, min_chars):
            block.append((row["id"], text))
            held += len(text)
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


HITS = pa.schema({"doc_id": pa.int64(), "item_id": pa.int64(), "distance": pa.int32(), "start": pa.int64(), "end": pa.int64()})


def find_leaks(
    docs: DataFrame, items: DataFrame, *, error_share: float = 0.05, whole_chars: int = 40, block_chars: int = 4_000_000,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance, start, end: items found with at most `error_share` of their characters edited.

    Occurrences of items under `whole_chars` characters are whole words. One row per input row and item, its best occurrence, in
    characters of the normalised text. The items are the query set: each block of them is broadcast, bounded by
    `block_chars`, and run over all texts; several blocks are written one by one. Null texts hold nothing; repeated documents
    and items are reported each.
    """
    spark, own = docs.sparkSession, id_and_text(docs, id_col, text_col)
    own = own.withColumn("doc_id", own["doc_id"].cast("long"))
    schema = "doc_id long, item_id long, distance int, start long, end long"
    found: DataFrame | None = None
    for block in item_blocks(items, block_chars=block_chars, min_chars=1, id_col=item_id_col, text_col=item_text_col):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value, error_share, whole_chars)
            for batch in batches:
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in finder.find(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), HITS)], schema=HITS)

        part = materialise(in_arrow(own, search, schema), "leaks")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def drop_leaks(
    docs: DataFrame, items: DataFrame, *, error_share: float = 0.05, whole_chars: int = 40, min_chars: int = 20, block_chars: int = 4_000_000,
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, all columns, in which no item of `min_chars` characters or more is found.

    Shorter items are phrases that any text may hold: `find_leaks` reports them, no document goes for them.
    """
    for block in item_blocks(items, block_chars=block_chars, min_chars=min_chars, id_col=item_id_col, text_col=item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def sift(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value, error_share, whole_chars)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                yield batch.filter(pa.array([not finder.find(t, first_only=True) for t in texts], pa.bool_()))

        docs = in_arrow(docs, sift, docs.schema)
    return docs
