"""Text functions against the stated rules, on hand-made rows and generated ones."""

import html
import random
import re
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.plans import rules


def apply(spark, column, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.x for r in rows.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def expect(spark, column, pairs):
    assert apply(spark, column, [a for a, _ in pairs]) == [b for _, b in pairs]


def test_title_case(spark):
    expect(
        spark,
        text.title_case,
        [
            ("rio de janeiro", "Rio de Janeiro"),
            ("DE DA do", "De da do"),
            ("  são\tjosé   DOS campos ", "São José dos Campos"),
            ("a e i", "A e I"),
            ("eden da eva", "Eden da Eva"),
            ("dado de das", "Dado de das"),
            ("santa bárbara d'oeste", "Santa Bárbara D'oeste"),
            ("guaratinguetá-açu", "Guaratinguetá-açu"),
            ("ño é", "Ño É"),
            ("ßa x", "Ssa X"),
            ("one\xa0two de　three", "One Two de Three"),
            ("", None),
            ("   ", ""),
            (None, None),
        ],
    )


def test_title_case_agrees_with_word_by_word_rule(spark):
    def rule(value):
        small = {"de", "da", "do", "das", "dos", "e"}
        words = value.split()
        return " ".join(w.lower() if i and w.lower() in small else w.capitalize() for i, w in enumerate(words))

    draw = random.Random(3)
    pieces = ["de", "Da", "DO", "dos", "das", "e", "E", "é", "ação", "x-y", "o'b", "ed", "dado", "ß", "1a", "_e", "\x1c"]
    gaps = [" ", "  ", "\n", "\t", "\xa0", " "]
    values = ["".join(draw.choice(pieces) + draw.choice(gaps) for _ in range(draw.randint(1, 8))) for _ in range(300)]
    assert apply(spark, text.title_case, values) == [rule(v) for v in values]


def test_fold_place(spark):
    expect(
        spark,
        text.fold_place,
        [
            ("São Paulo", "sao paulo"),
            (" SP ", "sao paulo"),
            ("'sp", "sp"),
            ("campinas-sp", "campinas"),
            ("santa bárbara d'oeste", "santa barbara d oeste"),
            ("mogi-guaçu", "mogi guacu"),
            ("pau d'alho'", "pau d alho"),
            ("itú", "itu"),
            (None, None),
            ("", ""),
        ],
    )


def test_alias_then_title(spark):
    expect(
        spark,
        lambda c: text.alias_then_title(c, rules.CITY_ALIASES, rules.CITY_MARKERS),
        [
            ("bh", "Belo Horizonte"),
            (" RJ ", "Rio de Janeiro"),
            ("vila do quilometro 14 do mutum", "Mutum"),
            ("km 14", "Mutum"),
            ("MOGI das CRUZES", "Mogi das Cruzes"),
            ("das dores", "Das Dores"),
            ("", None),
            (None, None),
        ],
    )


def test_delimited_name(spark):
    expect(
        spark,
        lambda c: text.delimited_name(c, rules.SELLER_ABBREVIATIONS),
        [
            ("são paulo", "Sao Paulo"),
            ("BH", "Bh"),
            ("RiO dE jAnEiRo/RJ", "Rio De Janeiro"),
            ("sp@", None),
            ("sao paulo-capital", "Sao Paulo"),
            ("a, b/c", "A, B".replace(",", "")),
            ("ribeirao, sp - x", "Ribeirao"),
            ("santa barbara d´oeste", "Santa Barbara Doeste"),
            ("sp", "Sao Paulo"),
            ("sp / sp", "Sao Paulo"),
            ("maringá", "Maring"),
            ("loja 04482255", None),
            (None, None),
        ],
    )


def test_place_or_unknown(spark):
    expect(
        spark,
        lambda c: text.place_or_unknown(c, rules.DEFAULT_ABBREVIATIONS),
        [
            (None, "Unknown"),
            ("", "Unknown"),
            ("  ", "Unknown"),
            ("SP", "Sao Paulo"),
            ("são paulo", "Sao Paulo"),
            ("mogi-guaçu", "Mogi Guacu"),
            ("santa bárbara d'oeste", "Santa Barbara d Oeste"),
            ("itú", "Itu"),
        ],
    )


def test_dictionary(spark):
    assert len(rules.CITY_CORRECTIONS) == 41
    correct = lambda c: text.correct_from(c, rules.CITY_CORRECTIONS)
    pairs = [("embu", "Embu das Artes"), ("SAO PAULO", "Sao Paulo"), ("sao jose do rio preto", "Sao Jose do Rio Preto")]
    expect(spark, correct, [*pairs, ("elsewhere", "elsewhere"), (None, None)])
    # order does not matter: a correction is never corrected again
    assert apply(spark, correct, list(rules.CITY_CORRECTIONS.values())) == list(rules.CITY_CORRECTIONS.values())


def test_clean_lowered(spark):
    expect(
        spark,
        text.clean_lowered,
        [
            ("Hello   WORLD. how are\nyou?", "Hello world. How are you"),
            ("it&#39;s &amp; good. ótimo", "It's  good. Timo"),
            (". x. y", ". X. Y"),
            ("!!!", None),
            ("", None),
            (None, None),
        ],
    )


def test_clean_cased(spark):
    expect(
        spark,
        text.clean_cased,
        [
            ("> > hello  World. next one", "Hello World. Next one"),
            ("&gt;&nbsp;a > b", "A b"),
            ("x&amp;amp;y. it&amp;#39;s", "X&y. It's"),
            ("a. . b", "A. B"),
            ("", ""),
            (">", ""),
            (None, None),
        ],
    )


def test_unescape_equals_the_standard_library(spark):
    values = [f"&{name} z" for name in html5] + [
        "a &amp; b", "&amp;lt;", "&ampfoo &notit; &notin; &lt &LT; x", "&#65;&#x41;&#X41 &#128; &#0; &#xD800;",
        "&#1114112; &#99999999999; &#xFFFFFFFFFFFFF; &#11;", "&", "&&", "&;", "&#;", "&#x;", "&bogus;", "&copy=1&reg&euro;",
        "&#x1F600;", "&#xFFFE;|&#xFDD0;|&#x1FFFF;", "&#13;x", "a&b;c", "&#00000000065;", "&#x0000000041;", "", "no",
    ]
    assert apply(spark, text.unescape_html, values) == [html.unescape(v) for v in values]


def test_corrections_are_literal(spark):
    words = {"usd": "US$", "slash": "a\\1b", "a.b": "dot"}
    cases = [("10 USD, slash", "10 US$, a\\1b"), ("a.b axb", "dot axb"), ("none", "none"), (None, None)]
    expect(spark, lambda c: text.correct_words(c, words), cases)
    expect(spark, lambda c: text.correct_words(c, {}), [("usd", "usd")])


def plain_corrected(value, words):
    for wrong, right in words.items():
        value = re.sub(rf"(?i)(?<!\w){re.escape(wrong)}(?!\w)", lambda _: right, value)
    return value


def test_corrections_are_as_one_after_the_other(spark):
    words = {
        "one": "two three", "two": "2", "THREE": "a b", "a b": "phrase", "four": "one", "x": "", "five": "Five", "été": "summer", "c.d": "one",
        "one_": "keeps", "phrase": "last", "One": "never",
    }
    assert len(text._correction_passes(words)) == 6
    rng = random.Random(5)
    signs = [*words, "One", "FOUR", "x1", "oné", "_", "-", " ", ". ", "ÉTÉ", "a", "b", "c", "d", "\n"]
    values = ["".join(rng.choice(signs) + rng.choice(["", " ", " ", ","]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    expect(spark, lambda c: text.correct_words(c, words), [(v, plain_corrected(v, words)) for v in values])
    few = dict(list(words.items())[: text.FEW_WORDS])
    expect(spark, lambda c: text.correct_words(c, few), [(v, plain_corrected(v, few)) for v in values])


def test_many_corrections_take_one_pass(spark):
    words = {f"wrong{i}": f"right{i}" for i in range(100)}
    assert len(text._correction_passes(words)) == 1
    expect(spark, lambda c: text.correct_words(c, words), [("Wrong7, wrong99 wrong100", "right7, right99 wrong100"), ("", ""), (None, None)])


def test_correct_words(spark):
    expect(
        spark,
        lambda c: text.correct_words(c, rules.WORD_CORRECTIONS),
        [
            ("Timo produto, RPIDO", "great produto, fast"),
            ("otimo timos", "otimo timos"),
            ("étimo timoé timo", "étimo timoé great"),
            ("timo timo timo", "great great great"),
            ("j t chegou jt", "already chegou already"),
            (None, None),
        ],
    )


def test_review_text(spark):
    expect(spark, text.plain_review, [("Ótimo, RÁPIDO! 10", "otimo rapido 10"), (None, None)])
    expect(spark, lambda c: text.plain_review(c, "delete"), [("Ótimo, RÁPIDO!", "timo rpido")])
    expect(spark, lambda c: text.plain_review(c, "delete", " "), [("a,b", "a b"), ("é", " ")])
    with pytest.raises(ValueError):
        text.plain_review(F.lit("x"), "other")


def test_labels_codes_slugs(spark):
    expect(spark, text.tidy_label, [("credit_card", "Credit Card"), ("boleto", "Boleto"), (None, None)])
    expect(spark, text.pad_code, [("89", "00089"), ("1234", "01234"), ("123456", "12345"), (None, None)])
    expect(spark, text.slug, [(" Casa & Café ", "casa___caf_")])
    expect(spark, text.slug_title, [("health_beauty", "Health Beauty")])
    expect(spark, text.capitalise_words, [("bED  bath\ttable", "Bed Bath Table"), ("", None)])
    expect(spark, text.has_text, [("x", True), ("  ", False), ("", False), (None, False)])


def test_plurals(spark):
    lists = (rules.PLURAL_ENDINGS, rules.SINGULAR_WORDS, rules.PLURAL_WORDS)
    expect(
        spark,
        lambda c: text.looks_plural(c, *lists),
        [("tools", True), ("press", False), ("BUSINESS", False), ("bebes", True), ("baby", False), ("fashion_is", True),
         ("glass", False), ("supplies", True), ("alimentos", True), (None, False)],
    )


def test_quality_scores(spark):
    values = ["recomendo", "curto", "um texto bem mais longo", None]
    scores = lambda c: text.response_quality(c, rules.GENERIC_RESPONSES)["quality_score"]
    flags = lambda c: text.response_quality(c, rules.GENERIC_RESPONSES)["is_generic_response"]
    assert apply(spark, scores, values) == [0.5, 0.7, 1.0, 1.0]
    assert apply(spark, flags, values) == [True, False, False, False]


@pytest.mark.parametrize(
    "clean",
    [
        text.fold_place,
        text.title_case,
        text.capitalise_words,
        text.clean_lowered,
        text.tidy_label,
        text.pad_code,
        lambda c: text.correct_from(text.fold_place(c), rules.CITY_CORRECTIONS),
    ],
)
def test_cleaners_are_idempotent(spark, clean):
    values = ["São  josé DOS campos-sp", "d'oeste", "embu", "a. b. c", "x", "", None, "12"]
    once = apply(spark, clean, values)
    assert apply(spark, clean, once) == once
