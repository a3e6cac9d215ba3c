"""Text column helpers. All are native expressions: no Python worker is involved."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.ladders import first_match, mapped

# White space of every kind: the Unicode property and the four separator controls. The flag is
# several times faster than listing the characters.
SPACE = "(?U)[\\s\\x1C-\\x1F]"
SPACE_CHARACTERS = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())

# Accented letters and the plain letters they fold to.
ACCENTED = "ãâáàäíîìúûùüéêèëóõôòöç"
FOLDED = "aaaaaiiiuuuueeeeoooooc"

# The wider fold of the "Unknown" default variant.
ACCENTED_WIDE = "áâãàäéêëèíîïìóôõòöúûüùçñ"
FOLDED_WIDE = "aaaaaeeeeiiiiooooouuuucn"

# Words that stay lower case inside a place name.
CONNECTIVES = ("de", "da", "do", "das", "dos", "e")
CONNECTIVES_WIDE = (*CONNECTIVES, "d")


# ---------------------------------------------------------------- general


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body mentions it.

    Expressions such as `when(x != "", f(x))` would otherwise compute a long `x` twice.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def collapse_space(text: Column) -> Column:
    """One space for every run of white space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def keep_only(text: Column, kept: str) -> Column:
    """The characters of a class, such as `[a-z ]`, and nothing else.

    Taking out the runs to keep is about twice as fast as replacing the rest.
    """
    return F.array_join(F.regexp_extract_all(text, F.lit(f"{kept}+"), F.lit(0)), "")


def fold_accents(text: Column, accented: str = ACCENTED, folded: str = FOLDED) -> Column:
    """Exchange letters one by one; plain ASCII text has none and is passed through."""
    return bind(
        text,
        lambda value: F.when(F.octet_length(value) == F.char_length(value), value).otherwise(
            F.translate(value, accented, folded)
        ),
    )


def first_upper(text: Column) -> Column:
    """Upper-case the first letter and leave the rest alone."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def pad_code(code: Column, width: int = 5) -> Column:
    """A code as fixed-width text with leading zeros; longer codes are cut to the width."""
    return F.lpad(code.cast("string"), width, "0")


def tidy_label(label: Column) -> Column:
    """`credit_card` → `Credit Card`."""
    return F.initcap(F.regexp_replace(label, "_", " "))


def has_text(text: Column) -> Column:
    """True for text with something besides spaces; null gives false."""
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))


# ---------------------------------------------------------------- case


def title_case(text: Column, connectives: Sequence[str] = CONNECTIVES) -> Column:
    """Capitalise each word but connectives that are not first; empty or null gives null.

    Whole-text functions only: every word is capitalised at once, then the connectives' initials
    are lowered again, one pattern per initial.
    """
    by_initial: dict[str, list[str]] = {}
    for word in connectives:
        by_initial.setdefault(word[0], []).append(re.escape(word[1:]))

    def styled(value: Column) -> Column:
        titled = F.initcap(F.btrim(collapse_space(value), F.lit(" ")))
        for initial, rests in by_initial.items():
            inside = f" {initial.upper()}(?=(?:{'|'.join(rests)})(?: |$))"
            titled = F.regexp_replace(titled, inside, f" {initial}")
        return F.when(value != "", titled)

    return bind(text, styled)


def capitalise_words(text: Column) -> Column:
    """Capitalise every word and collapse the space between them."""
    return title_case(text, connectives=())


# ---------------------------------------------------------------- place names


def fold_place(text: Column) -> Column:
    """Lower case, no accents, no state suffix, no hyphens or apostrophes."""

    def folded(lowered: Column) -> Column:
        plain = fold_accents(lowered)
        for found, replacement in (("d'", "d "), ("-", " "), ("'", "")):
            plain = F.replace(plain, F.lit(found), F.lit(replacement))
        return F.when(lowered == "sp", F.lit("sao paulo")).otherwise(plain)

    return bind(F.replace(strip(F.lower(text)), F.lit("-sp"), F.lit("")), folded)


def alias_then_title(
    text: Column,
    aliases: Mapping[str, str],
    contains: Mapping[str, str],
    connectives: Sequence[str] = CONNECTIVES,
) -> Column:
    """Whole-value aliases first, then names that contain a marker, then title case."""

    def named(lowered: Column) -> Column:
        cases = [(lowered == alias, F.lit(name)) for alias, name in aliases.items()]
        cases += [(lowered.contains(marker), F.lit(name)) for marker, name in contains.items()]
        titled = F.coalesce(title_case(lowered, connectives), F.lit(""))
        return first_match(cases, default=titled)

    return F.when(text != "", bind(strip(F.lower(text)), named))


def correct_from(text: Column, corrections: Mapping[str, str]) -> Column:
    """The correction listed for the lower-cased value, else the value itself."""
    return bind(text, lambda value: F.coalesce(mapped(F.lower(value), corrections), value))


def delimited_name(text: Column, abbreviations: Mapping[str, str]) -> Column:
    """A name out of a messy field.

    Values with digits or `@` are dropped; else the part before the first `/`, `,` or `-`
    (in that order of priority) is lower-cased, reduced to plain letters and capitalised.
    """
    cases = [(text.rlike("[0-9@]"), F.lit(None))]
    cases += [(text.contains(mark), F.substring_index(text, mark, 1)) for mark in ("/", ",", "-")]
    name = F.replace(F.lower(F.trim(first_match(cases, default=text))), F.lit("são"), F.lit("sao"))
    for pattern, replacement in (("d['´`]", "d"), (r"\s+", " ")):
        name = F.regexp_replace(name, pattern, replacement)
    name = keep_only(name, "[a-z ]")
    return F.initcap(bind(name, lambda value: F.coalesce(mapped(value, abbreviations), value)))


def place_or_unknown(text: Column, abbreviations: Mapping[str, str], unknown: str = "Unknown") -> Column:
    """Title-cased, accent-free name without hyphens and apostrophes; blank or null is `unknown`."""
    plain = F.translate(fold_accents(F.lower(text), ACCENTED_WIDE, FOLDED_WIDE), "-'", "  ")
    cases = [(F.lower(text) == short, F.lit(full)) for short, full in abbreviations.items()]
    cases.append((text.isNull() | (F.length(F.trim(text)) < 1), F.lit(unknown)))
    return first_match(cases, default=title_case(plain, CONNECTIVES_WIDE))


# ---------------------------------------------------------------- free text


def plain_review(text: Column, accents: str = "fold", gap: str = "") -> Column:
    """Lower-case letters, digits and white space only.

    `accents="fold"` keeps the letter under an accent, `"delete"` drops it like any other sign.
    `gap` takes the place of each dropped sign.
    """
    if accents == "fold":
        upper = FOLDED_WIDE.upper()
        text = fold_accents(text, ACCENTED_WIDE + ACCENTED_WIDE.upper(), FOLDED_WIDE + upper)
    elif accents != "delete":
        raise ValueError(f"accents must be 'fold' or 'delete', not {accents!r}")
    if gap:
        return F.lower(F.regexp_replace(text, r"[^a-zA-Z0-9\s]", gap))
    return F.lower(keep_only(text, r"[a-zA-Z0-9\s]"))


def unescape_html(text: Column) -> Column:
    """Decode named, decimal and hexadecimal character references in one pass.

    The text is cut at each `&`; the head of every later piece is decoded from a table that
    the standard library's own reference list fills, and the rest is put back unchanged.
    """
    named = _constant_map({name: value for name, value in html5.items() if name.endswith(";")})
    bare = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
    bare_values = _constant_map({name: html5[name] for name in bare})
    bare_pattern = "^(" + "|".join(bare) + ")"
    # met first, so that the usual references skip the long table
    usual = _constant_map({name: html5[name] for name in ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;")})
    # low code points that do not stand for themselves: controls and the 0x80 block
    odd = {str(n): html.unescape(f"&#{n};") for n in range(160) if html.unescape(f"&#{n};") != chr(n)}
    odd_points = _constant_map(odd)

    def from_point(point: Column) -> Column:
        surrogate = point.between(0xD800, 0xDFFF)
        noncharacter = point.between(0xFDD0, 0xFDEF) | ((point >= 0xFFFE) & (point % 0x10000 >= 0xFFFE))
        decoded = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return first_match(
            [
                (point.isNull() | (point > 0x10FFFF) | surrogate, F.lit("�")),
                (odd_points[point.cast("string")].isNotNull(), odd_points[point.cast("string")]),
                (noncharacter, F.lit("")),
            ],
            default=decoded,
        )

    def decoded_piece(piece: Column) -> Column:
        plain = ~piece.rlike("^[#a-zA-Z]")
        decimal = F.regexp_extract(piece, "^#([0-9]+);?", 0)
        hexadecimal = F.regexp_extract(piece, "^#[xX]([0-9a-fA-F]+);?", 0)
        name = F.regexp_extract(piece, "^[A-Za-z][A-Za-z0-9]{0,40};", 0)
        legacy = F.regexp_extract(piece, bare_pattern, 0)

        def after(head: Column) -> Column:
            return F.substr(piece, F.length(head) + 1)

        # digits beyond any code point would overflow: they are out of range all the same
        digits = F.regexp_extract(decimal, "([0-9]+)", 1)
        significant = F.regexp_replace(digits, "^0+(?=.)", "")
        point = F.when(F.length(significant) <= 8, significant.try_cast("bigint"))
        hex_digits = F.regexp_replace(F.regexp_extract(hexadecimal, "[xX]([0-9a-fA-F]+)", 1), "^0+(?=.)", "")
        hex_point = F.when(F.length(hex_digits) <= 7, F.conv(hex_digits, 16, 10).try_cast("bigint"))
        return first_match(
            [
                (plain, F.concat(F.lit("&"), piece)),
                (decimal != "", F.concat(from_point(point), after(decimal))),
                (hexadecimal != "", F.concat(from_point(hex_point), after(hexadecimal))),
                ((name != "") & usual[name].isNotNull(), F.concat(usual[name], after(name))),
                ((name != "") & named[name].isNotNull(), F.concat(named[name], after(name))),
                (legacy != "", F.concat(bare_values[legacy], after(legacy))),
            ],
            default=F.concat(F.lit("&"), piece),
        )

    def decoded(pieces: Column) -> Column:
        return F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decoded_piece), ""))

    return F.when(text.contains("&"), bind(F.split(text, "&"), decoded)).otherwise(text)


def _constant_map(table: Mapping[str, str]) -> Column:
    """A map constant that travels to the JVM as one string, however many entries it has."""
    entries = "\x02".join(f"{key}\x01{value}" for key, value in table.items())
    return F.str_to_map(F.lit(entries), F.lit("\x02"), F.lit("\x01"))


def clean_lowered(text: Column, decode: bool = True) -> Column:
    """Lower-case text of letters, digits, `'` and `.`, with each sentence capitalised."""
    text = unescape_html(text) if decode else text
    kept = keep_only(collapse_space(F.lower(text)), r"[a-z0-9\s'.]")
    sentences = F.array_join(F.transform(F.split(kept, r"\. "), first_upper), ". ")
    return bind(sentences, lambda value: F.when(value != "", value))


def clean_cased(text: Column) -> Column:
    """Text without `>` marks and extra space; sentences start upper case, the rest keeps its case."""
    decoded = F.regexp_replace(unescape_html(text), f"^(?:>|{SPACE})+", "")
    # the last two are references that were escaped twice
    for found, replacement in ((">", ""), ("&amp;", "&"), ("&#39;", "'")):
        decoded = F.replace(decoded, F.lit(found), F.lit(replacement))
    joined = F.btrim(collapse_space(decoded), F.lit(" "))
    sentences = F.filter(F.split(joined, r"\. "), lambda s: s != "")
    return F.array_join(F.transform(sentences, first_upper), ". ")


def correct_words(text: Column, corrections: Mapping[str, str]) -> Column:
    """Replace whole words, in any case. Letters with accents are part of a word.

    As if the corrections were made one after the other, which is how up to FEW_WORDS are made, in texts that
    hold any of them. More are made together: a text is taken apart once into words and what lies between them,
    each word is looked up, and the text is put together again. A correction that an earlier one may have written
    takes another pass then; so does a phrase, as a pattern of its own.
    """
    if not corrections:
        return text
    if len(corrections) <= FEW_WORDS:
        anywhere = "(?iu)" + "|".join(re.escape(word) for word in corrections)
        return bind(text, lambda t: F.when(t.rlike(anywhere), _corrected_in_turn(t, corrections)).otherwise(t))
    for words in _correction_passes(corrections):
        text = _looked_up(text, words) if isinstance(words, dict) else _phrase_corrected(text, *words)
    return text


# a pass for each word costs less than taking texts apart up to about this many
FEW_WORDS = 8
_WORD = "[\\p{L}\\p{N}_]"


def _correction_passes(corrections: Mapping[str, str]) -> list[dict[str, str] | tuple[str, str]]:
    """Words that can be looked up together, and phrases alone, in an order that gives what one after the other gives."""
    passes: list[dict[str, str] | tuple[str, str]] = []
    written: set[str] = set()
    for wrong, right in corrections.items():
        key = wrong.lower()
        if not re.fullmatch(r"\w+", wrong):
            passes.append((wrong, right))
            continue
        if not passes or isinstance(passes[-1], tuple) or key in written:
            passes.append({})
            written = set()
        passes[-1].setdefault(key, right)
        written.update(w.lower() for w in re.findall(r"\w+", right))
    return passes


def _looked_up(text: Column, words: Mapping[str, str]) -> Column:
    """Each word of the text that the table has, in lower case, replaced by its entry."""
    table, known = _constant_map(words), list(words)

    def corrected(piece: Column) -> Column:
        return F.when(F.lower(piece).isin(known), table[F.lower(piece)]).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(f"{_WORD}+|[^{_WORD[1:]}+"), F.lit(0))
    return F.array_join(F.transform(pieces, corrected), "")


def _corrected_in_turn(text: Column, corrections: Mapping[str, str]) -> Column:
    for wrong, right in corrections.items():
        text = _phrase_corrected(text, wrong, right)
    return text


def _phrase_corrected(text: Column, phrase: str, correction: str) -> Column:
    """The pattern looks for the phrase before it looks at what surrounds it."""
    before = rf"(?<!{_WORD}.{{{len(phrase)}}})"
    pattern = rf"(?ius){re.escape(phrase)}{before}(?!{_WORD})"
    return F.regexp_replace(text, pattern, correction.replace("\\", "\\\\").replace("$", "\\$"))


def change_metrics(before: Column, after: Column) -> dict[str, Column]:
    """Whether cleaning changed a text and how many characters it took away.

    Pass columns that exist already: both figures look at both texts.
    """
    return {
        "was_cleaned": F.coalesce(after != before, F.lit(False)),
        "chars_removed": F.length(before) - F.length(after),
    }


def response_quality(text: Column, generic: Sequence[str], short: int = 10) -> dict[str, Column]:
    """Flag stock phrases and score the text; null text is neither stock nor short."""
    stock = F.coalesce(text.isin(*generic), F.lit(False))
    score = first_match([(stock, F.lit(0.5)), (F.length(text) < short, F.lit(0.7))], default=F.lit(1.0))
    return {"is_generic_response": stock, "quality_score": score}


# ---------------------------------------------------------------- category names


def slug(text: Column) -> Column:
    """Lower-case letters, digits and `_`."""
    return F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9_]", "_")


def slug_title(text: Column) -> Column:
    """The slug written as a title: `health_beauty` → `Health Beauty`."""
    return F.initcap(F.regexp_replace(slug(text), "_", " "))


def looks_plural(
    text: Column,
    endings: Sequence[str],
    singular: Sequence[str],
    plural: Sequence[str],
) -> Column:
    """Plural by ending or by list. `singular` exempts words from the bare `s` ending only."""
    word = F.lower(text)
    bare_s = word.endswith("s") & ~word.endswith("ss") & ~word.isin(*singular)
    special = first_match([(word.endswith(e), F.lit(True)) for e in endings], default=F.lit(False))
    return F.coalesce(bare_s | special | word.isin(*plural), F.lit(False))
