"""Alignment of two tokenizers over the same bytes: common token ends by galloping intersection.

A text's tokens under either tokenizer end at ascending byte offsets. The shorter list of ends drives a search into the
longer: from the place of the last find in steps that double, then by halves within the last step. The common ends cut both
token lists into groups, a group's tokens being the difference of their ranks; tokens that end together link.

Texts are encoded once, word by word where neither tokenizer can join characters across the blank before a word. What they link goes as (A id, B id, how often) per text to Spark, which counts pairs over all
texts and joins the counts back.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import id_and_text
from tallyloom.llm.files import held, in_arrow
from tallyloom.llm.tokens import LATIN_LETTERS
from tallyloom.session import materialise

SPACE_PIECE = "▁"
ID = np.dtype("<u4")
CACHED_WORDS, LONGEST_WORD, TEXTS = 800_000, 64, 256
# blanks of which tokenizers make different things; texts that have them are encoded whole
ODD_BLANKS = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# a word: from a blank after other than white space up to the next such blank
WORD_START = re.compile(r"(?<=[^ \t\n\r])(?= )")
BLANKS_IN_WORDS = ("  ", "\t ", "\n ", "\r ")


class ByteLevel:
    """A byte-level tokenizer file of the tokenizers library; encodes a blank and the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        signs = set(pre_tokenizers.ByteLevel.alphabet())
        # a byte stands for itself where that is printable; the others follow in order beyond one byte
        others = iter(sorted(c for c in signs if ord(c) > 255))
        byte_of = {chr(b) if chr(b) in signs else next(others): b for b in range(256)}
        self.bytes = [b""] * self.model.get_vocab_size()
        for entry, i in self.model.get_vocab().items():
            self.bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()

        # its pattern starts a token at every such blank
        self.by_word = type(self.model.pre_tokenizer).__name__ == "ByteLevel" and self.model.normalizer is None
        sign_of = {b: c for c, b in byte_of.items()}
        self.signs = [sign_of[b] for b in range(256)]
        self.marks = {mark: self.model.token_to_id(mark) for mark in ".,"}
        self.merges = self.model.model

    def encode(self, text: str) -> list[int]:
        return self.model.encode(" " + text, add_special_tokens=False).ids

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word: of letters, and a mark after them, straight from the merges, of others as texts."""
        out: list[list[int] | None] = []
        others = []
        for word in words:
            letters = word[:-1] if word[-1:] in self.marks else word
            if LATIN_LETTERS(letters):
                signs = letters if letters.isascii() else "".join(map(self.signs.__getitem__, letters.encode()))
                ids = [t.id for t in self.merges.tokenize(self.signs[0x20] + signs)]
                out.append(ids if letters is word else ids + [self.marks[word[-1]]])
            else:
                out.append(None)
                others.append(" " + word)
        texts = iter(self.model.encode_batch_fast(others, add_special_tokens=False))
        return [next(texts).ids if ids is None else ids for ids in out]


class Pieces:
    """A sentencepiece model with byte fallback; adds a blank by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        # no piece reaches from a word into the next, and blanks are kept
        within = all(SPACE_PIECE not in self.model.id_to_piece(i).lstrip(SPACE_PIECE) for i in range(len(self.bytes)))
        self.by_word = within and self.model.decode(self.encode(" a  b ")) == " a  b "

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(SPACE_PIECE, " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text) if text else [self.model.piece_to_id(SPACE_PIECE)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [ids or self.encode(word) for word, ids in zip(words, self.model.encode(words, num_threads=1))]


class Words(dict):
    """Ids of a blank and a word as bytes, None where they do not give its bytes back; cleared at CACHED_WORDS words."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes | None:
        return self._exact(word, self.tokenizer.encode(word))

    def _exact(self, word: str, ids: list[int]) -> bytes | None:
        if b"".join(map(self.tokenizer.bytes.__getitem__, ids)) != b" " + word.encode():
            return None
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, words: set[str]) -> None:
        """Hold the ids of these words, encoded together; words that are long, or too many, are left to be encoded when met."""
        new = [word for word in words if word not in self and len(word) <= LONGEST_WORD]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = [word for word in words if len(word) <= LONGEST_WORD][:CACHED_WORDS]
        for word, ids in zip(new, self.tokenizer.encode_words(new)):
            self[word] = self._exact(word, ids)


def words_of(text: str) -> list[str]:
    """The words of a blank and the text, each without its first blank."""
    whole = " " + text
    if any(blanks in whole for blanks in BLANKS_IN_WORDS):
        return [word[1:] for word in WORD_START.split(whole)]
    return text.split(" ")


def common_ends(shorter: Sequence[int], longer: Sequence[int]) -> tuple[list[int], list[int]]:
    """Places in both ascending lists of the values they share, the shorter galloping through the longer."""
    mine, other, at, size = [], [], 0, len(longer)
    for i, end in enumerate(shorter):
        if at == size:
            break
        if longer[at] < end:
            step = 1
            while at + step < size and longer[at + step] < end:
                at += step
                step *= 2
            at = bisect_left(longer, end, at + 1, min(at + step, size))
            if at == size:
                break
        if longer[at] == end:
            mine.append(i)
            other.append(at)
            at += 1
    return mine, other


class Aligner:
    """Both tokenizers, with the bytes, byte counts and decimal forms of their ids."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.words = Words(self.a), Words(self.b)
        self.by_word = self.a.by_word and self.b.by_word
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        # an id and what follows it: another of its group's side, the other side, the next group, nothing
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.forms = [str(i).encode() + mark for i in range(most) for mark in (b",", b"|", b";", b"")]

    def _split(self, text: str) -> list[str]:
        whole = not self.by_word or any(blank in text for blank in ODD_BLANKS)
        return [text] if whole else words_of(text)

    def learn(self, texts: list[str | None]) -> None:
        """Encode the words of these texts that are not held yet, each once."""
        words = {word for text in texts if text for word in self._split(text)}
        for table in self.words:
            table.learn(words)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both; none where the text is null or empty, or either's bytes are not those of a blank and the text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        words = self._split(text)
        try:
            a, b = (b"".join(map(table.__getitem__, words)) for table in self.words)
        except TypeError:  # a word that is not given back
            return none
        return np.frombuffer(a, ID).astype(np.int64), np.frombuffer(b, ID).astype(np.int64)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the tokens of A and of B that end together."""
        ends_a, ends_b = (size[ids].cumsum().tolist() for size, ids in zip(self.sizes, (a, b)))
        if len(ends_a) <= len(ends_b):
            at_a, at_b = common_ends(ends_a, ends_b)
        else:
            at_b, at_a = common_ends(ends_b, ends_a)
        return np.array(at_a, np.int64), np.array(at_b, np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> bytes:
        """`a1,a2|b1;a3|b2,b3`: the ids of A and of B in each group."""
        if not len(at_a):
            return b""
        marks_a, marks_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        marks_a[at_a], marks_b[at_b] = 1, 2
        marks_b[-1] = 3
        count = np.arange(len(at_a))
        side_a = np.repeat(2 * count, np.diff(at_a, prepend=-1))
        side_b = np.repeat(2 * count + 1, np.diff(at_b, prepend=-1))
        order = np.argsort(np.concatenate([side_a, side_b]), kind="stable")
        forms = np.concatenate([4 * a + marks_a, 4 * b + marks_b])[order]
        return b"".join(map(self.forms.__getitem__, forms.tolist()))


ALIGNERS = "aligners"  # the table that workers hold


def aligner(a: str, b: str) -> Aligner:
    """One per worker process."""
    aligners = held(ALIGNERS)
    if (a, b) not in aligners:
        aligners[a, b] = Aligner(a, b)
    return aligners[a, b]


def align(docs: DataFrame, a: str, b: str, *, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, pairs per input row; with `with_groups` also groups.

    `a` and `b` are paths of a byte-level file of the tokenizers library and of a sentencepiece model. groups has the ids as
    `a1,a2|b1;a3|b2,b3`; pairs has (a, b, n) for each pair of ids whose tokens end together n times in the text. A text that is null
    or empty, or that a tokenizer does not give back byte for byte, has no tokens: zeros, '' and no pairs.
    """
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"] + ["groups"] * with_groups
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        for batch in batches:
            sizes, digests, shown, found, cuts = [], [], [], [], [0]
            texts = batch.column(1).to_pylist()
            for row, text in enumerate(texts):
                if row % TEXTS == 0:
                    both.learn(texts[row : row + TEXTS])
                ids_a, ids_b = both.tokens(text)
                at_a, at_b = both.align(ids_a, ids_b)
                groups = both.groups(ids_a, ids_b, at_a, at_b)
                sizes.append((len(ids_a), len(ids_b), len(at_a)))
                digests.append(hashlib.sha256(groups).hexdigest() if groups else "")
                if with_groups:
                    shown.append(groups.decode())
                keys, counts = np.unique(ids_a[at_a] << 32 | ids_b[at_b], return_counts=True)
                found.append(np.stack([keys >> 32, keys & 0xFFFFFFFF, counts]).astype(np.int32))
                cuts.append(cuts[-1] + len(keys))
            flat = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int32)
            pairs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(list(map(pa.array, flat)), fields=list(pair)))
            numbers = [pa.array(n, pa.int64()) for n in (zip(*sizes) if sizes else ([], [], []))]
            columns = [batch.column(0), *numbers, pa.array(digests, pa.string()), pairs] + [pa.array(shown, pa.large_string())] * with_groups
            yield pa.RecordBatch.from_arrays(columns, names)

    own = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<a:int,b:int,n:int>>"
    return in_arrow(own.withColumn("doc_id", F.col("doc_id").cast("long")), run, schema + ", groups string" * with_groups, uses=ALIGNERS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, count (links of the pair over all texts), best (no other A id links with the B id more often)."""
    counts = aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = materialise(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def score(docs: DataFrame, a: str, b: str, *, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`align` without pairs, plus n_links, n_best, count_sum per input row.

    n_links are the token pairs that end together, one a group; n_best those whose pair is its B id's most frequent in all texts,
    ties included; count_sum adds their pairs' counts in all texts. Rows that repeat an id count each.
    """
    aligned = align(docs, a, b, with_groups=with_groups, id_col=id_col, text_col=text_col)
    aligned = materialise(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialise(pair_counts(aligned), "pair-scores")
    links = aligned.select("row", F.inline("pairs")).join(counts, ["a", "b"])
    sums = links.groupBy("row").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    figures = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    last = ["groups_sha256"] + ["groups"] * with_groups
    return aligned.drop("pairs").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", *figures, *last)
