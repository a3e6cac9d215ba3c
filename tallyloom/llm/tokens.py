"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import re
import struct
import unicodedata

import numpy as np

from tallyloom.llm.files import held

ID = np.dtype("<u4")
CACHED_WORDS = 600_000
# whole words of letters whose lower case is one letter each
LATIN_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def vocabulary(name: str) -> str:
    """The path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# texts by which a tokenizer shows that it drops white space and lower-cases
PROBES = ("Ab cD", "  a\t\nB  c ", "É ü.X, y", "it's 12 A's", "a <b> -C")


class WordEncoder(dict):
    """Ids of texts, word by word under a tokenizer that drops white space and lower-cases, else of whole texts.

    Such a tokenizer never joins characters across a blank, so a text's ids are those of its words
    in turn, and words recur. Each distinct word is encoded once by the tokenizers library; the
    table is cleared at `most` words. `encode` gives little-endian 32-bit ids as bytes.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.most = Tokenizer.from_file(path), most
        self.model = self.whole.model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        ids = lambda text: self.whole.encode(text, add_special_tokens=False).ids
        self.by_word = all(ids(text) == [i for word in text.lower().split() for i in ids(word)] for text in PROBES)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if word[-1:] in (".", ",") and LATIN_LETTERS(word[:-1]):
            ids = self[word[:-1]] + self[word[-1]]
        elif word.islower() and LATIN_LETTERS(word):  # one run of letters, normal already: straight to the model
            ids = packed([t.id for t in self.model.tokenize(word if word.isascii() else self.as_bytes(word)[0][0])])
        else:
            ids = packed(self.whole.encode(word, add_special_tokens=False).ids) if word else b""
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return packed(self.whole.encode(text, add_special_tokens=False).ids)
        # lower case first, to meet fewer words; not where that may depend on neighbours or composition
        if "Σ" not in text and "İ" not in text and "<|" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


WORDS = "words"  # the table of encoders that workers hold


def encoder(path: str) -> WordEncoder:
    """One per worker process: a worker that takes further tasks of this kind keeps its words."""
    encoders = held(WORDS)
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]
