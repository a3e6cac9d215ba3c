"""Quality rules on repetition, from the suffix array of each text's words.

A run of texts is sorted as one: the first rank of a suffix holds its text's number, so suffixes of
different texts never share a prefix. Ranks double in length until all suffixes differ; only suffixes that
are still tied are sorted again. The stored ranks then give the longest common prefix of neighbours (of long texts, whose
ranks would not fit, one pass over the words in their order does), and with it, for each suffix, its deepest longest-common-prefix interval: the longest substring from there that occurs
twice. The union of these spans is that of all maximal repeated substrings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import bytes_of, id_and_text, runs
from tallyloom.llm.files import in_arrow

WHITE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
KEPT_RANKS = 1 << 20  # words sorted at once of which all ranks are kept
WINDOW = 3  # words of a window that counts as repeated


@dataclass(frozen=True)
class Rules:
    """Limits. A text fails the base rules below `min_words` words or above `max_window_share` per cent of its words
    in repeated windows. It fails the repeat rules when maximal repeats of `min_repeat` words or more cover over
    `max_covered` of its words, or one has over `max_repeat` words."""

    min_words: int = 50
    max_window_share: int = 50
    min_repeat: int = 10
    max_covered: float = 0.3
    max_repeat: int = 200


def suffix_order(words: np.ndarray, text_of: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of words (ids below 2**31), text by text, and the ranks by prefix length 1, 2, 4, ..., the last only without `keep`."""
    n = len(words)
    key = (text_of.astype(np.int64) << 32) | words
    order = np.argsort(key, kind="stable")
    tied = key[order]
    head = np.append(True, tied[1:] != tied[:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    levels, length = [(1, rank)], 1
    ends = np.searchsorted(text_of, text_of, side="right")
    slots = np.flatnonzero(~head | ~np.append(head[1:], True))  # places whose suffix is tied
    while len(slots):
        at = order[slots]
        after = at + length
        inside = after < ends[at]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        first = rank[at]
        new = np.lexsort((second, first))
        at, first, second = at[new], first[new], second[new]
        order[slots] = at
        head = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank = rank.copy() if keep else rank
        rank[at] = slots[np.flatnonzero(head)[np.cumsum(head) - 1]]
        length *= 2
        levels = [*levels, (length, rank)] if keep else [(length, rank)]
        slots = slots[~head | ~np.append(head[1:], True)]
    return order, levels


def longest_repeats(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Per word: the length of the longest substring from there that occurs twice or more in its text."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    order, levels = suffix_order(words, text_of, keep=n <= KEPT_RANKS)
    common = _common_by_ranks(order, levels, text_of) if n <= KEPT_RANKS else _common_in_order(words, order, text_of)
    longest = np.empty(n, np.int64)
    longest[order] = np.maximum(common[:-1], common[1:])
    return longest


def _common_by_ranks(order: np.ndarray, levels: list[tuple[int, np.ndarray]], text_of: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix and the one before it in the array, 0 at both ends, from the longest ranks down."""
    n = len(order)
    ends = np.searchsorted(text_of, text_of, side="right")
    near = np.flatnonzero(levels[0][1][order[1:]] == levels[0][1][order[:-1]])  # neighbours that share a word
    a, b = order[near].copy(), order[near + 1].copy()
    end_a, end_b = ends[a], ends[b]
    shared = np.zeros(len(near), np.int64)
    for length, rank in reversed(levels):
        inside = (a < end_a) & (b < end_b)
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        step = np.where(same, length, 0)
        a += step
        b += step
        shared += step
    common = np.zeros(n + 1, np.int64)
    common[near + 1] = shared
    return common


def _common_in_order(words: np.ndarray, order: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """The same, suffix by suffix in the order of the text: the next one shares all but one word of what this one shares."""
    n = len(order)
    common = np.zeros(n + 1, np.int32)
    before = np.full(n, -1, np.int32)  # the suffix before it in the array
    before[order[1:]] = order[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.arange(n)
    apart = np.flatnonzero(before >= 0)
    before[apart[text_of[apart] != text_of[before[apart]]]] = -1
    ends = np.searchsorted(text_of, text_of, side="right").astype(np.int32)
    word, previous, place, end, out = (memoryview(np.ascontiguousarray(x)) for x in (words.astype(np.int32), before, rank, ends, common))
    shared = 0
    for i in range(n):
        j = previous[i]
        if j < 0:
            shared = 0
            continue
        most = min(end[i] - i, end[j] - j)
        shared = min(shared, most)
        while shared < most and word[i + shared] == word[j + shared]:
            shared += 1
        out[place[i]] = shared
        shared -= shared > 0
    return common


def covered(longest: np.ndarray, text_of: np.ndarray, n_texts: int, least: int) -> np.ndarray:
    """Per text: words in the union of the repeats of `least` words or more."""
    starts = np.flatnonzero(longest >= least)
    delta = np.zeros(len(longest) + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + longest[starts], -1)
    return np.bincount(text_of[np.cumsum(delta[:-1]) > 0], minlength=n_texts)


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    seen.update(lines)
    return len(lines) - len(seen)


COLUMNS = pa.schema({
    "doc_id": pa.int64(), "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "n_covered_words": pa.int64(), "longest_repeat": pa.int64(),
})


def _figures(texts: list[bytes], least: int) -> list[np.ndarray]:
    numbers: dict[bytes, int] = {}
    split = [text.split() for text in texts]  # bytes split at ASCII white space only
    counts = np.array([len(words) for words in split], np.int64)
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in split for w in words), np.int64, int(counts.sum()))
    text_of = np.repeat(np.arange(len(texts)), counts)
    longest = longest_repeats(ids, text_of)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, text_of, longest)
    return [
        counts,
        np.array([len(t.translate(None, WHITE + CONTINUATION)) for t in texts]),
        np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts]),
        np.array([dup_lines(t) for t in texts]),
        covered(longest, text_of, len(texts), WINDOW),
        covered(longest, text_of, len(texts), least),
        most,
    ]


def repetition_figures(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures, base_failed and kept per input row; a null text has no words and fails the base rules."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch)
            for rows in runs(texts):
                columns = _figures([texts[r] for r in rows], rules.min_repeat)
                ids = batch.column(0).slice(rows.start, len(rows))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], schema=COLUMNS)

    own = id_and_text(docs, id_col, text_col)
    own = own.withColumn("doc_id", own["doc_id"].cast("long"))
    got = in_arrow(own, measure, ", ".join(f"{name} long" for name in COLUMNS.names))
    base = f"n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_window_share} * n_words"
    repeats = f"n_covered_words <= {rules.max_covered}D * n_words and longest_repeat <= {rules.max_repeat}"
    return got.selectExpr("*", f"({base}) as base_failed").selectExpr("*", f"(not base_failed and {repeats}) as kept")
