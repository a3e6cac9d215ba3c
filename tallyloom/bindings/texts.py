"""Scalar functions and text cleaners over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import (
    bound,
    sql_collapse,
    sql_initcap,
    sql_list,
    sql_strip,
    sql_title,
    sql_upper_first,
    table,
)
from tallyloom.functions import dates, text
from tallyloom.functions.numbers import safe_ratio
from tallyloom.operators import classify
from tallyloom.plans import rules

# ---------------------------------------------------------------- built-in scalar functions


@bound(
    "scalar_strings",
    f"""select p_partkey, lower(p_name) as lowered, upper(p_name) as uppered, trim('  ' || p_name || ' ') as trimmed,
        {sql_initcap("p_name")} as capped, lpad(p_partkey::varchar, 3, '0') as padded,
        regexp_replace(regexp_replace(p_brand, '#', ' ', 'g'), '[0-9]+$', 'n', 'g') as replaced,
        translate(p_name, 'aeiou', 'áéíóú') as translated, string_split(p_name, ' ')[1] as first_word,
        length(p_name)::int as name_length, levenshtein(p_name, p_brand)::int as distance,
        coalesce(nullif(p_type, 'PROMO'), p_brand) as filled from part""",
)
def scalar_strings(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.lower(name).alias("lowered"),
        F.upper(name).alias("uppered"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.initcap(name).alias("capped"),
        text.pad_code(F.col("p_partkey"), 3).alias("padded"),
        F.regexp_replace(F.regexp_replace("p_brand", "#", " "), "[0-9]+$", "n").alias("replaced"),
        F.translate(name, "aeiou", "áéíóú").alias("translated"),
        F.split(name, " ")[0].alias("first_word"),
        F.length(name).alias("name_length"),
        F.levenshtein(name, F.col("p_brand")).alias("distance"),
        F.coalesce(F.nullif(F.col("p_type"), F.lit("PROMO")), F.col("p_brand")).alias("filled"),
    )


@bound(
    "scalar_numbers",
    """select l_orderkey, l_linenumber, round(l_extendedprice::decimal(12,2) * (1 - l_discount::decimal(12,2)), 2)::double as net,
       format('{:,.2f}', l_extendedprice) as price_text, abs(l_discount - 0.05) as off_rate,
       case when l_tax = 0 then null else l_extendedprice / l_tax end as per_tax,
       l_quantity * l_extendedprice + l_tax - l_discount as mixed from lineitem""",
)
def scalar_numbers(spark: SparkSession, folder: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    # money is rounded as decimals: binary fractions have no exact halves
    exact = price.cast("decimal(12,2)") * (1 - discount.cast("decimal(12,2)"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(exact, 2).cast("double").alias("net"),
        F.format_number(price, 2).alias("price_text"),
        F.abs(discount - 0.05).alias("off_rate"),
        F.try_divide(price, tax).alias("per_tax"),
        (F.col("l_quantity") * price + tax - discount).alias("mixed"),
    )


@bound(
    "scalar_dates",
    """select o_orderkey, year(o_orderdate)::int as order_year, month(o_orderdate)::int as order_month,
       (dayofweek(o_orderdate) + 1)::int as order_dayofweek,
       date_diff('day', timestamp '1998-01-01', o_orderdate)::int as days_since,
       try_cast(case when o_orderstatus = 'P' then 'soon' else o_orderdate::varchar end as timestamp) as parsed
       from orders""",
)
def scalar_dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    written = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(day.cast("string"))
    parts = dates.calendar_parts(day, "order")
    start = F.lit("1998-01-01").cast("timestamp_ntz")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        *[column.alias(name) for name, column in parts.items()],
        dates.days_between(start, day).alias("days_since"),
        dates.parse_timestamp(written).alias("parsed"),
    )


# the references that occur in the pages, the ampersand last and also without its semicolon
_ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'))


def _sql_unescape(column: str) -> str:
    for reference, value in _ENTITIES:
        column = f"replace({column}, '{reference}', '{value}')"
    return f"regexp_replace({column}, '&amp;?', '&', 'g')"


@bound("html_unescape", f"select page_id, {_sql_unescape('html')} as html from pages")
def html_unescape(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.unescape_html(F.col("html")).alias("html"))


# ---------------------------------------------------------------- names

_LOWERED = "regexp_replace(" + sql_strip("lower(text)") + ", '-sp', '', 'g')"
_FOLDED = (
    f"replace(replace(replace(translate({_LOWERED}, '{text.ACCENTED}', '{text.FOLDED}'), "
    "'d''', 'd '), '-', ' '), '''', '')"
)


@bound(
    "fold_text",
    f"select doc_id, case when {_LOWERED} = 'sp' then 'sao paulo' else {_FOLDED} end as folded from documents",
)
def fold_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.fold_place(F.col("text")).alias("folded"))


@bound(
    "title_case_connectives",
    f"select doc_id, {sql_title('text', text.CONNECTIVES)} as titled from documents",
)
def title_case_connectives(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.title_case(F.col("text")).alias("titled"))


_ALIASES = {"building": "Bricks and Mortar", "household": "Home"}
_MARKERS = {"mobil": "Wheels"}


@bound(
    "alias_then_title",
    f"""select c_custkey, case when lower(c_mktsegment) = 'building' then 'Bricks and Mortar'
        when lower(c_mktsegment) = 'household' then 'Home' when lower(c_mktsegment) like '%mobil%' then 'Wheels'
        else {sql_title("lower(c_mktsegment)", text.CONNECTIVES)} end as segment from customer""",
)
def alias_then_title(spark: SparkSession, folder: str) -> DataFrame:
    segment = text.alias_then_title(F.col("c_mktsegment"), _ALIASES, _MARKERS)
    return table(spark, folder, "customer").select("c_custkey", segment.alias("segment"))


@bound("capitalise_words", f"select p_partkey, {sql_title('p_name', ())} as p_name from part")
def capitalise_words(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", text.capitalise_words(F.col("p_name")).alias("p_name"))


@bound(
    "pad_code",
    "select c_custkey, lpad(c_custkey::varchar, 5, '0') as code, lpad(c_name, 5, '0') as cut from customer",
)
def pad_code(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", text.pad_code(F.col("c_custkey")).alias("code"), text.pad_code(F.col("c_name")).alias("cut")
    )


_CORRECTIONS = {"building": "Building Trade", "machinery": "Machine Works", "trade": "Never Used"}


@bound(
    "dictionary_standardise",
    """select c_custkey, case lower(c_mktsegment) when 'building' then 'Building Trade'
       when 'machinery' then 'Machine Works' else lower(c_mktsegment) end as segment from customer""",
)
def dictionary_standardise(spark: SparkSession, folder: str) -> DataFrame:
    folded = text.fold_place(F.col("c_mktsegment"))
    return table(spark, folder, "customer").select(
        "c_custkey", text.correct_from(folded, _CORRECTIONS).alias("segment")
    )


def _sql_delimited(column: str) -> str:
    cut = (
        f"case when regexp_matches({column}, '[0-9]') or {column} like '%@%' then null "
        f"when {column} like '%/%' then string_split({column}, '/')[1] "
        f"when {column} like '%,%' then string_split({column}, ',')[1] "
        f"when {column} like '%-%' then string_split({column}, '-')[1] else {column} end"
    )
    name = f"lower(trim({cut}))"
    for pattern, replacement in (("são", "sao"), ("d[''´`]", "d"), (r"\s+", " "), ("[^a-z ]", ""), ("^sp$", "sao paulo")):
        name = f"regexp_replace({name}, '{pattern}', '{replacement}', 'g')"
    return sql_initcap(name)


@bound("delimited_name_clean", f"select doc_id, {_sql_delimited('text')} as name from documents")
def delimited_name_clean(spark: SparkSession, folder: str) -> DataFrame:
    name = text.delimited_name(F.col("text"), rules.SELLER_ABBREVIATIONS)
    return table(spark, folder, "documents").select("doc_id", name.alias("name"))


@bound(
    "delimited_url_clean",
    f"""select page_id, {_sql_delimited("u")} as name from
        (select page_id, case when page_id % 3 = 0 then regexp_replace(url, '[0-9]', '', 'g') else url end as u
         from pages)""",
)
def delimited_url_clean(spark: SparkSession, folder: str) -> DataFrame:
    url = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "[0-9]", "")).otherwise(F.col("url"))
    return table(spark, folder, "pages").select(
        "page_id", text.delimited_name(url, rules.SELLER_ABBREVIATIONS).alias("name")
    )


_WIDE = f"translate(lower(t), '{text.ACCENTED_WIDE}', '{text.FOLDED_WIDE}')"
_WIDE = f"regexp_replace(regexp_replace({_WIDE}, '[-'']', ' ', 'g'), '\\s+', ' ', 'g')"


@bound(
    "unknown_default",
    f"""select doc_id, case when lower(t) = 'sp' then 'Sao Paulo' when t is null or length(trim(t)) < 1
        then 'Unknown' else {sql_title(_WIDE, text.CONNECTIVES_WIDE)} end as place
        from (select doc_id, case lang when 'de' then null when 'es' then ' ' else text end as t from documents)""",
)
def unknown_default(spark: SparkSession, folder: str) -> DataFrame:
    lang = F.col("lang")
    holed = F.when(lang == "de", F.lit(None)).when(lang == "es", " ").otherwise(F.col("text"))
    place = text.place_or_unknown(holed, rules.DEFAULT_ABBREVIATIONS)
    return table(spark, folder, "documents").select("doc_id", place.alias("place"))


@bound(
    "label_tidy",
    f"""select o_orderkey, {sql_initcap("replace(replace(lower(o_orderpriority), ' ', '_'), '_', ' ')")} as priority
        from orders""",
)
def label_tidy(spark: SparkSession, folder: str) -> DataFrame:
    label = F.regexp_replace(F.lower("o_orderpriority"), " ", "_")
    return table(spark, folder, "orders").select("o_orderkey", text.tidy_label(label).alias("priority"))


# ---------------------------------------------------------------- free text

_KEPT = f"regexp_replace({sql_collapse('lower(text)')}, '[^a-z0-9\\s''.]', '', 'g')"
_SENTENCES = (
    f"array_to_string(list_transform(string_split({_KEPT}, '. '), lambda s: upper(s[1]) || s[2:]), '. ')"
)
_V1 = f"case when {_KEPT} <> '' then {sql_upper_first(_SENTENCES)} end"


@bound("normalise_text_v1", f"select doc_id, {_V1} as cleaned from documents")
def normalise_text_v1(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.clean_lowered(F.col("text")).alias("cleaned"))


_STRIPPED = f"regexp_replace({_sql_unescape('html')}, '^(>|[\\s\\x{{A0}}])+', '')"
_ONCE = f"replace(replace(replace({_STRIPPED}, '>', ''), '&amp;', '&'), '&#39;', '''')"
_JOINED = sql_strip(sql_collapse(_ONCE))
_V2 = (
    f"array_to_string(list_transform(list_filter(string_split({_JOINED}, '. '), lambda s: s <> ''), "
    f"lambda s: {sql_upper_first('s')}), '. ')"
)


@bound("normalise_text_v2", f"select page_id, {_V2} as cleaned from pages")
def normalise_text_v2(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.clean_cased(F.col("html")).alias("cleaned"))


_WORDS = {**rules.WORD_CORRECTIONS, "the": "le", "der": "the", "a la": "to the"}


def _sql_corrected(column: str) -> str:
    # the separators on both sides are consumed, so words in a row take a second pass
    for word, correction in _WORDS.items():
        for _ in range(2):
            column = (
                rf"regexp_replace({column}, '(?i)(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])', "
                rf"'\1{correction}\2', 'g')"
            )
    return column


@bound("word_corrections", f"select doc_id, {_sql_corrected('text')} as corrected from documents")
def word_corrections(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", text.correct_words(F.col("text"), _WORDS).alias("corrected")
    )


@bound(
    "has_text",
    """select conv_id, turn, coalesce(length(trim(t)) > 0, false) as has_comment from
       (select conv_id, turn, case role when 'system' then null when 'user' then '  ' else text end as t
        from conversations)""",
)
def has_text(spark: SparkSession, folder: str) -> DataFrame:
    role = F.col("role")
    holed = F.when(role == "system", F.lit(None)).when(role == "user", "  ").otherwise(F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", text.has_text(holed).alias("has_comment"))


_STOCK = (*rules.GENERIC_RESPONSES, "In nicht ü einachie.", "Und von. Üpf einge undchungch ung.")


@bound(
    "text_quality_score",
    f"""select conv_id, turn, coalesce(text in ({sql_list(_STOCK)}), false) as is_generic_response,
        case when text in ({sql_list(_STOCK)}) then 0.5 when length(text) < 60 then 0.7 else 1.0 end::double
        as quality_score from conversations""",
)
def text_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    quality = text.response_quality(F.col("text"), _STOCK, short=60)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", *[column.alias(name) for name, column in quality.items()]
    )


@bound(
    "text_change_metrics",
    f"""select doc_id, coalesce(c <> text, false) as was_cleaned, (length(text) - length(c))::int as chars_removed
        from (select doc_id, text, {_V1} as c from documents)""",
)
def text_change_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = text.change_metrics(F.col("text"), F.col("cleaned"))
    cleaned = table(spark, folder, "documents").withColumn("cleaned", text.clean_lowered(F.col("text")))
    return cleaned.select(
        "doc_id", *[column.alias(name) for name, column in metrics.items()]
    )


# ---------------------------------------------------------------- category names


def _sql_slug(column: str) -> str:
    return f"regexp_replace(lower(trim({column})), '[^a-z0-9_]', '_', 'g')"


@bound(
    "category_slug",
    f"""select p_partkey, {_sql_slug("p_brand")} as slug,
        {sql_initcap("replace(" + _sql_slug("p_name || ' & ' || p_type") + ", '_', ' ')")} as title from part""",
)
def category_slug(spark: SparkSession, folder: str) -> DataFrame:
    wide = F.concat_ws(" & ", "p_name", "p_type")
    return table(spark, folder, "part").select(
        "p_partkey", text.slug(F.col("p_brand")).alias("slug"), text.slug_title(wide).alias("title")
    )


_PLURAL_LISTS = (rules.PLURAL_ENDINGS, ("brass", "gears"), ("small ring", "promo"))


def _sql_plural(column: str) -> str:
    return (
        f"((suffix({column}, 's') and not suffix({column}, 'ss') and {column} not in ('brass', 'gears')) "
        f"or suffix({column}, 'is') or suffix({column}, 'es') or suffix({column}, 'ns') "
        f"or {column} in ('small ring', 'promo'))"
    )


# a third of the names gain an ending each, so that every branch is met
_NAMED_SQL = """(select p_partkey, lower(p_name) || case p_partkey % 6 when 0 then 's' when 1 then 'ss'
    when 2 then 'es' else '' end as n, lower(p_type) || case p_partkey % 4 when 0 then 's' else '' end as t,
    lower(p_brand) as b from part)"""


def _named(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    ending = F.when(key % 6 == 0, "s").when(key % 6 == 1, "ss").when(key % 6 == 2, "es").otherwise("")
    plural = F.when(key % 4 == 0, "s").otherwise("")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lower("p_name"), ending).alias("n"),
        F.concat(F.lower("p_type"), plural).alias("t"),
        F.lower("p_brand").alias("b"),
    )


@bound("plural_flag", f"select p_partkey, n, {_sql_plural('n')} as is_plural from {_NAMED_SQL}")
def plural_flag(spark: SparkSession, folder: str) -> DataFrame:
    flag = text.looks_plural(F.col("n"), *_PLURAL_LISTS)
    return _named(spark, folder).select("p_partkey", "n", flag.alias("is_plural"))


@bound(
    "plural_consistency",
    f"""select p_partkey, n, t, case when (n in ('old rods', 'red rings') and t in ('small', 'promo'))
          or (n like '%gear%' and t like '%standard%') or t like '%medium%' or (n like 'blue %' and t like 'econ_my%')
        then true else {_sql_plural("n")} = {_sql_plural("t")} end as is_plural_consistent from {_NAMED_SQL}""",
)
def plural_consistency(spark: SparkSession, folder: str) -> DataFrame:
    n, t = F.col("n"), F.col("t")
    agree = text.looks_plural(n, *_PLURAL_LISTS) == text.looks_plural(t, *_PLURAL_LISTS)
    names = (("old rods", "red rings"), ("small", "promo"))
    patterns = (("%gear%", "%standard%"), (None, "%medium%"), ("blue %", "econ_my%"))
    consistent = classify.plural_consistent(n, t, agree, names, patterns)
    return _named(spark, folder).select("p_partkey", "n", "t", consistent.alias("is_plural_consistent"))


_NAME_RULES = (
    ("%economy%", "brand#2", None),
    ("%small%", None, {"small": "brand", "s$": "#1"}),
    ("%standard%", None, {"standard": "brand#10"}),
)
_TYPOS = {"brand#7": "brond#7"}
_NEAR = ("medium", "mediums")


@bound(
    "name_similarity",
    f"""select p_partkey, t, b, (case when w = e then 0 when t in ('medium', 'mediums') then 5
        else levenshtein(w, e) end)::int as distance from (select *,
        case when t like '%economy%' then 'brand#2'
          when t like '%small%' then regexp_replace(replace(t, 'small', 'brand'), 's$', '#1', 'g')
          when t like '%standard%' then replace(t, 'standard', 'brand#10') else t end as w,
        replace(b, 'brand#7', 'brond#7') as e from {_NAMED_SQL})""",
)
def name_similarity(spark: SparkSession, folder: str) -> DataFrame:
    distance = classify.name_distance(F.col("t"), F.col("b"), _NAME_RULES, _TYPOS, _NEAR, 5)
    return _named(spark, folder).select("p_partkey", "t", "b", distance.alias("distance"))


# ---------------------------------------------------------------- measures

DIMENSIONS_SQL = """(select p_partkey, p_type, p_retailprice, p_size::bigint as len,
    (p_partkey % 50 + 1)::bigint as hei, (p_partkey % 30 + 1)::bigint as wid, floor(p_retailprice)::bigint as wt,
    (p_partkey % 997 + 1)::bigint as dsc, (p_partkey % 5)::bigint as pho from part)"""


def dimensions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        "p_retailprice",
        F.col("p_size").cast("bigint").alias("len"),
        (key % 50 + 1).alias("hei"),
        (key % 30 + 1).alias("wid"),
        F.floor("p_retailprice").alias("wt"),
        (key % 997 + 1).alias("dsc"),
        (key % 5).alias("pho"),
    )


@bound(
    "volume_density",
    f"""select p_partkey, len * hei * wid as volume,
        ((wt * 2000 + len * hei * wid) // (2 * len * hei * wid) / 1000.0)::double as density from {DIMENSIONS_SQL}""",
)
def volume_density(spark: SparkSession, folder: str) -> DataFrame:
    volume = F.col("len") * F.col("hei") * F.col("wid")
    sized = dimensions(spark, folder).withColumn("volume", volume)
    return sized.select("p_partkey", "volume", safe_ratio(F.col("wt"), F.col("volume"), 3).alias("density"))
