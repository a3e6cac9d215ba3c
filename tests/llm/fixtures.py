"""Documents with every odd case, and plain rules to compare with."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_lines long, line string, pos int, mark string, "
    "node long, key string, piece string, length string, start double, score int, kept int, path string"
)
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["the", "an", "ou", "tion", "É", "re", "sh", "ß", "le", "o"]
    out = []
    for i in range(words):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))))
        if i % 17 == 16:
            out[-1] += "."
    text = " ".join(out)
    return text.replace(". ", ".\n")


def texts() -> list[tuple[int | None, str | None]]:
    long = prose(1, 20_000)
    near = prose(2, 400)
    words = near.split(" ")
    return [
        (1, None), (2, ""), (3, "a\nb\na"), (None, "x y z"), (None, None), (4, long), (5, long), (5, long),
        (6, near), (7, " ".join(words[:200] + ["changed"] + words[201:])), (8, " \t\x0b\n \n"), (9, "A b\nshared line\n\n  SHARED line "),
        (10, "shared LINE\t\nother"), (11, "shared line"), (-12, near + "\nshared line"), (13, "one"), (14, "One"), (15, "one two   \x85"),
        (16, "a b c d e"), (17, "a b c d"), (18, "a b c d e f"), (19, "\U0001d518 😀 é ﬁ <|endoftext|> it's 12"), (20, "word " * 3_000), (20, "other text of one id"),
    ]


def odd_documents(spark, rows=None):
    rows = texts() if rows is None else rows
    extra = (7, "line", 3, "mark", 1, "key", "piece", "length", 0.5, 1, 0, "path")
    return spark.createDataFrame([(i, t, None if i and i % 2 else "en", None, len(t or ""), *extra) for i, t in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def split_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_key(line: str) -> str:
    return line.strip(WHITE).translate(LOWER)
