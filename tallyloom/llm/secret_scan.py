"""Secret scans: fixed patterns, and character Markov models of random strings against identifiers.

Native: DataFrame functions only. Two first-order character models, of random strings and of ordinary
identifiers, are counted from labelled samples; a run of key characters is a secret when the logarithm
of their likelihood ratio is high enough in all and by the character.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bind, id_and_text, running

# kind, pattern, group that must be long enough, its least length; the order settles ties of start
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
# finds the same matches as the pattern where a maximal run decides, without visiting the short ones
LONG = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1  # 0: any other character
KEY_RUN = "[A-Za-z0-9+/_=-]{%d,}"
KEY_PART = "[A-Za-z0-9+_]{%d,}"
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]{3,}"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of character pairs, random over ordinary, row by row."""

    ratios: tuple[float, ...]

    def score(self, value: Column) -> Column:
        """The log-likelihood ratio of a string; 0 below two characters."""
        table = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")
        places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        pairs = lambda at: F.aggregate(
            F.sequence(F.lit(0), F.length(value) - 2),
            F.lit(0.0),
            lambda total, i: total + F.get(table, F.get(at, i) * SYMBOLS + F.get(at, i + 1)),
        )
        return F.when(F.length(value) < 2, 0.0).otherwise(bind(places, pairs))


def train(samples: DataFrame) -> Model:
    """Count both models from `value` string, `random` boolean; add-one smoothed. Null values are left out.

    The model has a fixed size, whatever the samples; without samples every ratio is 0.
    """
    places = F.transform(F.split("value", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.transform(F.sequence(F.lit(0), F.size("at") - 2), lambda i: F.get("at", i) * SYMBOLS + F.get("at", i + 1))
    rows = samples.where(F.length("value") >= 2).select("random", places.alias("at")).select("random", F.explode(pairs).alias("pair"))
    counts = rows.groupBy("pair").agg(F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o"))
    by_pair = F.struct((F.col("r") + 1.0).alias("r"), (F.col("o") + 1.0).alias("o"))
    firsts = counts.groupBy(F.floor(F.col("pair") / SYMBOLS).alias("first")).agg(
        F.sum("r").alias("rs"), F.sum("o").alias("os"), F.collect_list(F.struct("pair", by_pair.alias("n"))).alias("seen")
    )
    ratio = F.log(F.col("n.r") / (F.col("rs") + SYMBOLS)) - F.log(F.col("n.o") / (F.col("os") + SYMBOLS))
    unseen = F.log(F.lit(1.0) / (F.col("rs") + SYMBOLS)) - F.log(F.lit(1.0) / (F.col("os") + SYMBOLS))
    seen = firsts.select("first", unseen.alias("unseen"), "rs", "os", F.explode("seen").alias("s")).select("first", "unseen", "s.pair", "s.n", "rs", "os")
    ratios = [0.0] * (SYMBOLS * SYMBOLS)
    got = seen.select("first", "unseen", "pair", ratio.alias("ratio")).collect()  # SYMBOLS**2 rows at most
    for row in got:
        ratios[row["first"] * SYMBOLS : (row["first"] + 1) * SYMBOLS] = [row["unseen"]] * SYMBOLS
    for row in got:
        ratios[row["pair"]] = row["ratio"]
    return Model(tuple(round(r, 6) for r in ratios))


def samples_from(docs: DataFrame, *, sample_docs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled samples from a bounded sample of texts, those with the smallest hash of their id.

    Ordinary: their identifiers. Random: digests of those texts, as hexadecimal, base 64 and upper case.
    """
    own = id_and_text(docs, id_col, text_col).where(F.col("text").isNotNull())
    chosen = own.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = own.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")  # sample_docs rows at most
    digest = F.sha2(F.col("text").cast("binary"), 256)
    forms = [digest, F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""), F.upper(F.base64(F.unhex(digest)))]
    words = F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))
    labelled = lambda values, random: F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(random).alias("random")))
    return texts.select(F.inline(F.concat(labelled(words, False), labelled(F.array(*forms), True))))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """gaps, hits, parts: what lies around the pattern's non-overlapping matches, the matches, and one group of each."""
    whole, part = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    return F.struct(F.split(text, pattern, -1).alias("gaps"), whole.alias("hits"), part.alias("parts"))


def located(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans (code points, end exclusive) of the pattern's non-overlapping matches whose group is long enough."""

    def spans(m: Column) -> Column:
        def span(end: Column, i: Column) -> Column:
            value = F.get(m["parts"], i)
            return F.struct((end - F.length(F.get(m["hits"], i))).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"))

        sizes = F.transform(m["hits"], lambda hit, i: F.length(F.get(m["gaps"], i)) + F.length(hit))
        found = F.transform(running(sizes, lambda a, b: a + b), span)
        return F.filter(found, lambda s: F.length(s["value"]) >= least) if least else found

    return F.when(F.rlike(text, F.lit(pattern)), bind(_matches(text, pattern, group), spans).cast(SPAN)).otherwise(F.array().cast(SPAN))


def blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """`text` with a blank for every character of the matches that `located` reports."""

    def clear(m: Column) -> Column:
        blank = lambda i: F.when(F.length(F.get(m["parts"], i)) >= least, F.repeat(F.lit(" "), F.length(F.get(m["hits"], i)))).otherwise(F.get(m["hits"], i))
        return F.array_join(F.transform(m["gaps"], lambda gap, i: F.concat(gap, F.coalesce(blank(i), F.lit("")))), "")

    return F.when(F.rlike(text, F.lit(pattern)), bind(_matches(text, pattern, group), clear)).otherwise(text)


def apart_from(spans: Column, base: Column) -> Column:
    """The `spans` that overlap none of `base`, both sorted: one pass over both in order of start."""

    def clear(merged: Column) -> Column:
        def judge(ends: Column) -> Column:
            def rest(starts: Column) -> Column:
                free = lambda s, i: s["own"] & (F.get(ends, i) <= s["span"]["start"]) & (F.get(starts, F.size(starts) - 1 - i) >= s["span"]["end"])
                return F.transform(F.filter(merged, free), lambda s: s["span"])

            later = F.transform(F.reverse(merged), lambda s: F.when(s["own"], (1 << 31) - 1).otherwise(s["start"]))
            return bind(running(later, F.least), rest)

        return bind(running(F.transform(merged, lambda s: F.when(s["own"], 0).otherwise(s["span"]["end"])), F.greatest), judge)

    marked = lambda array, own: F.transform(array, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s.alias("span")))
    both = F.array_sort(F.concat(marked(base, False), marked(spans, True)))
    return F.when((F.size(spans) > 0) & (F.size(base) > 0), bind(both, clear)).otherwise(spans)


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of `spans`."""
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit("markov"))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(
    docs: DataFrame, model: Model, *, min_chars: int = 12, min_ratio: float = 15.0, min_per_char: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, base, added: spans by the fixed patterns and those the model adds, each sorted by start and kind.

    The model judges what the base spans leave of the text: runs of `min_chars` or more key characters, and where such a run
    is no secret, its parts of that length between `/`, `=` and `-`. A secret has a letter, a log-likelihood ratio of at
    least `min_ratio`, and of `min_per_char` by the character. Shorter random strings are not found. Time grows with the
    length of a text and hardly more (n log n in its matches). One row per input row; a null text is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [(LONG.get(kind, pattern), i, group, least) for i, (kind, pattern, group, least) in enumerate(KINDS)]
    rest = text
    for pattern, _, group, least in kinds:
        rest = blanked(rest, pattern, group, least)
    added = len(KINDS)
    found = id_and_text(docs, id_col, text_col).select("doc_id", F.array_sort(F.concat(*[located(text, *kind) for kind in kinds])).alias("base"), rest.alias("rest"))
    found = found.select("doc_id", "base", located(F.col("rest"), KEY_RUN % min_chars, added).alias("runs"))

    def random(value: Column) -> Column:
        return F.rlike(value, F.lit("[A-Za-z]")) & bind(model.score(value), lambda s: (s >= min_ratio) & (s >= min_per_char * F.length(value)))

    def parts(run: Column) -> Column:
        within = F.filter(located(run["value"], KEY_PART % min_chars, added), lambda part: random(part["value"]))
        moved = lambda s: F.struct((s["start"] + run["start"]).alias("start"), s["kind"].alias("kind"), (s["end"] + run["start"]).alias("end"), s["value"].alias("value"))
        return F.when(F.rlike(run["value"], F.lit("[/=-]")), F.transform(within, moved)).otherwise(F.array().cast(SPAN))

    secrets = F.flatten(F.transform("runs", lambda run: F.when(random(run["value"]), F.array(run)).otherwise(parts(run))))
    # a base span may have been cut by one of another kind
    return found.select("doc_id", "base", secrets.alias("found")).select("doc_id", "base", apart_from(F.col("found"), F.col("base")).alias("added"))


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
