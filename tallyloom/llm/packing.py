"""Best-fit packing of token pieces into fixed-length sequences, improved by swap-based local search.

Pieces are dealt by hash over groups of bounded size. In each group, best-fit decreasing fills bins;
then all underfull bins trade: a move, a one-for-one or a two-for-one exchange is made whenever it raises
the sum of squared fills, so that full bins get fuller and the emptiest run dry, until none is left or the
group has as few bins as its total length allows. What still lies in underfull bins is dealt out anew over
fewer groups for a second round, so that few bins in all stay underfull.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import id_and_text
from tallyloom.llm.files import in_arrow, in_pandas
from tallyloom.llm.tokens import ID, WORDS, encoder
from tallyloom.session import materialise

GROUP_PIECES = 20_000


def token_pieces(
    docs: DataFrame, vocabulary: str, *, capacity: int, end_id: int, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids binary]: each text's ids and `end_id`, cut at `capacity`.

    A null or empty text is the end id alone. Ids are little-endian unsigned 32-bit integers.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end, width = ID.type(end_id).tobytes(), capacity * ID.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // ID.itemsize, len(part) // ID.itemsize, zlib.crc32(part), part)[: 5 + with_ids])
            columns = list(zip(*rows)) or [()] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)])

    return in_arrow(id_and_text(docs, id_col, text_col), cut, schema, uses=WORDS)


class Bins:
    """Bins of one capacity; the pieces in them by number, with their lengths."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths.tolist(), capacity
        self.held: list[list[int]] = []
        self.free: list[int] = []

    def fill(self) -> None:
        """Best-fit decreasing: each piece into the open bin with the least room that takes it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0  # bit r: some bin has room r
        for piece in sorted(range(len(self.lengths)), key=lambda p: -self.lengths[p]):
            n = self.lengths[piece]
            if fitting := rooms >> n:
                room = n + (fitting & -fitting).bit_length() - 1
                at = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
                self.held[at].append(piece)
            else:
                room, at = self.capacity, len(self.held)
                self.held.append([piece])
                self.free.append(0)
            self.free[at] = room - n
            if self.free[at]:
                by_room[self.free[at]].append(at)
                rooms |= 1 << self.free[at]

    def _give(self, source: int, out: list[int], target: int, back: list[int]) -> None:
        for piece in out:
            self.held[source].remove(piece)
            self.held[target].append(piece)
        for piece in back:
            self.held[target].remove(piece)
            self.held[source].append(piece)
        gain = sum(self.lengths[p] for p in out) - sum(self.lengths[p] for p in back)
        self.free[source] += gain
        self.free[target] -= gain

    def _trade(self, source: int, target: int) -> bool:
        """The exchange that leaves least room in `target`, the fuller of the two; true if one was made."""
        room = self.free[target]
        own = sorted((self.lengths[p], p) for p in self.held[source])
        sizes = [n for n, _ in own]
        best: tuple[int, list[int], list[int]] = (0, [], [])
        if (at := bisect.bisect_right(sizes, room)) and sizes[at - 1] > best[0]:
            best = (sizes[at - 1], [own[at - 1][1]], [])
        for other in self.held[target]:
            n = self.lengths[other]
            if (at := bisect.bisect_right(sizes, n + room)) and sizes[at - 1] - n > best[0]:
                best = (sizes[at - 1] - n, [own[at - 1][1]], [other])
            low, high = 0, len(own) - 1
            while low < high:  # two of the source for one of the target
                gain = sizes[low] + sizes[high] - n
                if gain > room:
                    high -= 1
                    continue
                if gain > best[0]:
                    best = (gain, [own[low][1], own[high][1]], [other])
                low += 1
            if best[0] == room:
                break
        if best[0] > 0:
            self._give(source, best[1], target, best[2])
        return best[0] > 0

    def search(self) -> None:
        """Trade between all underfull bins, pass after pass, until a pass gains nothing or no bin can be saved.

        Each trade takes length from the emptier bin to the fuller one, so the sum of squared fills rises
        and the search ends.
        """
        piece_of = [p for at, room in enumerate(self.free) if room for p in self.held[at]]
        own = {at: n for n, at in enumerate(at for at, room in enumerate(self.free) if room)}
        # the pieces of these bins and, for moves, a piece of length 0 in each
        sizes = np.array([self.lengths[p] for p in piece_of] + [0] * len(own), np.int64)
        bin_of = np.array([at for at in own for _ in self.held[at]] + list(own), np.int64)
        place = {p: n for n, p in enumerate(piece_of)}
        free = np.array(self.free, np.int64)
        gained = True
        while gained:
            gained = False
            under = sorted((at for at in own if self.held[at] and self.free[at]), key=lambda at: -self.free[at])
            if len(under) < 2 or sum(self.free[at] for at in under) < self.capacity:
                return  # too little room in all to save a bin
            for source in under:
                while self.held[source] and (target := self._target(source, sizes, bin_of, free)) is not None:
                    before = {*self.held[source]}, {*self.held[target]}
                    gained = self._trade(source, target) or gained
                    for at, was in zip((source, target), before):
                        free[at] = self.free[at]
                        for piece in was.symmetric_difference(self.held[at]).intersection(self.held[at]):
                            bin_of[place[piece]] = at

    def _target(self, source: int, sizes: np.ndarray, bin_of: np.ndarray, free: np.ndarray) -> int | None:
        """The fullest bin to which `source`, the emptier one, can give length by a trade."""
        own, copies = np.unique([self.lengths[p] for p in self.held[source]], return_counts=True)
        given = np.zeros(self.capacity + 1, bool)
        given[own] = True
        given[np.add.outer(own, own)[np.triu_indices(len(own), 1)]] = True
        given[2 * own[copies > 1]] = True
        upto = np.cumsum(given)
        room = free[bin_of]
        gains = (upto[sizes + room] > upto[sizes]) & (room > 0) & (room <= free[source]) & (free[source] < self.capacity) & (bin_of != source)
        found = np.flatnonzero(gains)
        return int(bin_of[found[np.argmin(room[found])]]) if len(found) else None

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per piece: its bin (renumbered without empty ones), its offset there, the bin's room."""
        bin_of, offset, room = (np.zeros(len(self.lengths), np.int64) for _ in range(3))
        number = 0
        for at, pieces in enumerate(self.held):
            filled = 0
            for p in pieces:
                bin_of[p], offset[p], room[p] = number, filled, self.free[at]
                filled += self.lengths[p]
            number += bool(pieces)
        return bin_of, offset, room


def _free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from those taken."""
    used = {n.lower() for n in taken}
    out = []
    for name in names:
        while name in used:
            name = f"_{name}"
        out.append(name)
    return out


def _packed(pieces: DataFrame, capacity: int, groups: int, salt: int, number: str, room: str, group: str) -> DataFrame:
    dealt = pieces.withColumn(group, F.pmod(F.xxhash64(F.lit(salt), number), F.lit(groups)))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(number, ignore_index=True)
        bins = Bins(frame["length"].to_numpy(), capacity)
        bins.fill()
        bins.search()
        place, offset, left = bins.rows()
        return frame.drop(columns=group).assign(sequence_id=2 * ((int(key[0]) << 32) + place) + salt, offset=offset, **{room: left})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return in_pandas(dealt.groupBy(group), pieces.sparkSession, pack, f"{fields}, sequence_id long, offset long, `{room}` long")


def pack(pieces: DataFrame, *, capacity: int, group_pieces: int = GROUP_PIECES, near_full: float = 0.998) -> DataFrame:
    """`pieces` (any columns, with doc_id, piece and length) and their sequence_id and offset, in place of columns of that name.

    Lengths lie in 1..capacity; a sequence holds at most `capacity`; offsets are gapless from 0.
    Full pieces are sequences of their own. Repeated rows are packed each for itself. No pieces: no rows.
    """
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    own = number, room, _ = _free_names(names, "_piece_id", "_room", "_group")
    numbered = materialise(pieces.select(names).withColumn(number, F.monotonically_increasing_id()), "pieces")
    whole = numbered.where(F.col("length") >= capacity)
    part = numbered.where(F.col("length") < capacity)
    count = part.count()
    first = materialise(_packed(part, capacity, max(1, -(-count // group_pieces)), 0, *own), "packed")
    loose = (1 - near_full) * capacity
    rest = first.where(F.col(room) > loose).drop("sequence_id", "offset", room)
    again = _packed(rest, capacity, max(1, -(-rest.count() // group_pieces)), 1, *own)
    # ids of full pieces are negative
    full = whole.withColumns({"sequence_id": -1 - F.col(number), "offset": F.lit(0).cast("long")})
    kept = first.where(F.col(room) <= loose)
    columns = [*names, "sequence_id", "offset"]
    return full.select(columns).unionByName(kept.select(columns)).unionByName(again.select(columns))
