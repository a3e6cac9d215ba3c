"""The end-to-end cleaners on retail tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import bound, sql_list, sql_pct, sql_title, table
from tallyloom.bindings.texts import _V1, _sql_delimited
from tallyloom.functions import text
from tallyloom.functions.ladders import mapped
from tallyloom.operators import validate
from tallyloom.plans import places, products, reviews, rules

# ---------------------------------------------------------------- reviews

# ids and dates follow the text length, so that copies of a text are copies of a review
REVIEWS_SQL = """(select n_chars::varchar as review_id, nullif(lang, 'es') as order_id, (n_chars % 7)::int as score,
    lang || '!' as title, text as message, timestamp '2018-01-01' + to_days((n_chars % 1000)::int) as created,
    timestamp '2018-01-01' + to_days((n_chars % 1000 + n_chars % 5 - 1)::int) as answered from documents)"""


def retail_reviews(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_chars")
    start = F.lit("2018-01-01").cast("timestamp_ntz")
    created = start + F.make_dt_interval(days=(n % 1000).cast("int"))
    answered = start + F.make_dt_interval(days=(n % 1000 + n % 5 - 1).cast("int"))
    return table(spark, folder, "documents").select(
        n.cast("string").alias("review_id"),
        F.nullif(F.col("lang"), F.lit("es")).alias("order_id"),
        (n % 7).alias("review_score"),
        F.concat("lang", F.lit("!")).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        created.cast("string").alias("review_creation_date"),
        answered.cast("string").alias("review_answer_timestamp"),
    )


_ACCENTS = text.ACCENTED_WIDE + text.ACCENTED_WIDE.upper()
_PLAIN = text.FOLDED_WIDE + text.FOLDED_WIDE.upper()


def _sql_plain(column: str) -> str:
    folded = f"translate(trim({column}), '{_ACCENTS}', '{_PLAIN}')"
    return f"lower(regexp_replace({folded}, '[^a-zA-Z0-9\\s]', '', 'g'))"


def _sql_clean(source: str) -> str:
    return f"""(select distinct review_id, order_id, score as review_score, {_sql_plain("title")} as title,
        {_sql_plain("message")} as message, created, answered,
        coalesce(length(trim({_sql_plain("message")})) > 0, false) as has_comment
        from {source} where order_id is not null and score between 1 and 5)"""


def _sql_review_clean(source: str) -> str:
    return f"""with t as {_sql_clean(source)}, s as (select avg(review_score) as m, stddev_samp(review_score) as sd from t)
        select review_id, order_id, review_score, title as review_comment_title, message as review_comment_message,
          created as review_creation_date, answered as review_answer_timestamp, has_comment,
          round(abs((review_score - m) / sd)::decimal(38,12), 6)::double as review_score_zscore,
          abs((review_score - m) / sd) > 3 as is_outlier
        from t, s where created::date <= date '2020-01-01' and answered >= created"""


_CLEAN_SQL = _sql_clean(REVIEWS_SQL)


@bound("review_clean", _sql_review_clean(REVIEWS_SQL))
def review_clean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = reviews.clean_reviews(retail_reviews(spark, folder), as_of="2020-01-01")
    return cleaned.withColumn("review_score_zscore", F.round("review_score_zscore", 6))


# short reviews, one per order, with ids of the usual length
SHORT_REVIEWS_SQL = """(select md5(o_orderkey::varchar) as review_id, md5(o_custkey::varchar) as order_id,
    (o_orderkey % 6)::int as score, o_orderpriority as title,
    'Produto ' || o_orderpriority || ' nº ' || o_custkey::varchar || ', chegou rápido! ' as message,
    o_orderdate as created, o_orderdate + to_days((o_orderkey % 9 - 1)::int) as answered from orders)"""


@bound("review_clean_short", _sql_review_clean(SHORT_REVIEWS_SQL))
def review_clean_short(spark: SparkSession, folder: str) -> DataFrame:
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    answered = F.col("o_orderdate") + F.make_dt_interval(days=(key % 9 - 1).cast("int"))
    customer = F.col("o_custkey").cast("string")
    raw = table(spark, folder, "orders").select(
        F.md5(key.cast("string")).alias("review_id"),
        F.md5(customer).alias("order_id"),
        (key % 6).alias("review_score"),
        priority.alias("review_comment_title"),
        F.concat(F.lit("Produto "), priority, F.lit(" nº "), customer, F.lit(", chegou rápido! ")).alias(
            "review_comment_message"
        ),
        F.col("o_orderdate").cast("string").alias("review_creation_date"),
        answered.cast("string").alias("review_answer_timestamp"),
    )
    cleaned = reviews.clean_reviews(raw, as_of="2020-01-01")
    return cleaned.withColumn("review_score_zscore", F.round("review_score_zscore", 6))


@bound(
    "reviews_rated",
    f"""select review_id, order_id, m as review_comment_message,
        m in ({sql_list(rules.GENERIC_RESPONSES)}) as is_generic_response,
        case when m in ({sql_list(rules.GENERIC_RESPONSES)}) then 0.5 when length(m) < 10 then 0.7
          else 1.0 end::double as review_quality_score
        from (select *, lower(trim(regexp_replace(message, '[^a-zA-Z0-9\\s]', ' ', 'g'))) as m from {REVIEWS_SQL})
        where order_id is not null and score between 1 and 5 and answered >= created""",
)
def reviews_rated(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.rate_reviews(retail_reviews(spark, folder)).select(
        "review_id", "order_id", "review_comment_message", "is_generic_response", "review_quality_score"
    )


@bound(
    "review_problems",
    f"""with t as {_CLEAN_SQL} select review_id, order_id, (length(review_id) <> 32)::int +
          (length(order_id) <> 32)::int + (answered < created)::int as broken_rules from t""",
)
def review_problems(spark: SparkSession, folder: str) -> DataFrame:
    # before the date checks of the full cleaner, so that early answers are still there
    raw = retail_reviews(spark, folder)
    cleaned = reviews.clean_reviews(raw, as_of="2020-12-31", check_order=False)
    return validate.flag_rules(cleaned, reviews.PROBLEM_RULES).select("review_id", "order_id", "broken_rules")


@bound(
    "reviews_translated",
    f"""with t as (select * from {_CLEAN_SQL} where created::date <= date '2020-01-01' and answered >= created),
          u as (select *, case title when 'fr' then 'french &lt;b&gt; text. yes' when 'de' then 'german' else title end
            as tt, message as text from t)
        select review_id, order_id, review_score, case title when 'fr' then 'French <b text. Yes' when 'de'
            then 'German' else upper(title[1]) || title[2:] end as final_translated_title,
          (length(message) - length({_V1}))::int as chars_removed from u""",
)
def reviews_translated(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = reviews.clean_reviews(retail_reviews(spark, folder), as_of="2020-01-01")
    # a dictionary that covers two of the titles and none of the messages
    known = {"fr": "french &lt;b&gt; text. yes", "de": "german"}
    titles = cleaned.select(F.col("review_comment_title").alias("source_text")).distinct()
    dictionary = titles.withColumn("translated_text", mapped(F.col("source_text"), known))
    dictionary = dictionary.filter(F.col("translated_text").isNotNull())
    return reviews.translate_reviews(cleaned, dictionary).select(
        "review_id", "order_id", "review_score", "final_translated_title", "chars_removed"
    )


# a translation with words to correct, a reference and a mark; what becomes of it is spelled out
_ENGLISH = "It was timo. rpido &amp; OTIMA > j t jt"
_ENGLISH_CLEANED = "It was great. fast  excellent  already already"
_ENGLISH_FINAL = "It was timo. Rpido & OTIMA j t jt"


@bound(
    "review_messages",
    f"""with t as (select * from {_CLEAN_SQL} where created::date <= date '2020-01-01' and answered >= created),
          u as (select *, message as text, message in (select message from t where title = 'en'
            and length(trim(message)) > 0) as known from t)
        select review_id, order_id, review_score, known, case when known then '{_ENGLISH_CLEANED}' else {_V1} end
            as cleaned_message, case when known then true else coalesce({_V1} <> message, false) end as was_cleaned,
          (case when known then {len(_ENGLISH) - len(_ENGLISH_CLEANED)} else length(message) - length({_V1}) end)::int
            as chars_removed, case when known then '{_ENGLISH_FINAL}' else
            coalesce(upper(m[1]) || m[2:], '') end as final_translated_message
        from (select *, trim(regexp_replace(text, '\\s+', ' ', 'g')) as m from u)""",
)
def review_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way of a message: dictionary, correction, change figures, published form."""
    cleaned = reviews.clean_reviews(retail_reviews(spark, folder), as_of="2020-01-01")
    message = F.col("review_comment_message")
    english = cleaned.filter((F.col("review_comment_title") == "en") & text.has_text(message))
    dictionary = english.select(message.alias("source_text"), F.lit(_ENGLISH).alias("translated_text"))
    return reviews.translate_reviews(cleaned, dictionary).select(
        "review_id", "order_id", "review_score", (F.col("translated_message") == _ENGLISH).alias("known"),
        "cleaned_message", "was_cleaned", "chars_removed", "final_translated_message",
    )


def _sql_without_accents(column: str) -> str:
    return f"lower(regexp_replace(trim({column}), '[^a-zA-Z0-9\\s]', '', 'g'))"


@bound(
    "review_accents_deleted",
    f"""select distinct review_id, order_id, score as review_score, {_sql_without_accents("title")}
          as review_comment_title, {_sql_without_accents("message")} as review_comment_message,
          coalesce(length(trim({_sql_without_accents("message")})) > 0, false) as has_comment from {REVIEWS_SQL}
        where order_id is not null and score between 1 and 5 and created::date <= date '2020-01-01'
          and answered >= created""",
)
def review_accents_deleted(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = reviews.clean_reviews(retail_reviews(spark, folder), as_of="2020-01-01", accents="delete")
    return cleaned.select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "has_comment"
    )


# ---------------------------------------------------------------- categories and products

CATEGORY_NAMES = {
    "ECONOMY": ("beleza_saude", "health_beauty"),
    "LARGE": ("construcao_ferramentas_seguranca", "costruction_tools_safety"),
    "MEDIUM": ("moveis_decoracao", "furniture_decor"),
    "PROMO": ("utilidades_domesticas", "housewares"),
    "SMALL": (" Livros Tecnicos ", "books technical"),
    "STANDARD": ("bebes", "baby"),
}


def retail_categories(spark: SparkSession, folder: str) -> DataFrame:
    kinds = table(spark, folder, "part").select("p_type").distinct()
    return kinds.select(
        mapped(F.col("p_type"), {k: v[0] for k, v in CATEGORY_NAMES.items()}).alias("product_category_name"),
        mapped(F.col("p_type"), {k: v[1] for k, v in CATEGORY_NAMES.items()}).alias("product_category_name_english"),
    )


@bound(
    "categories_cleaned",
    """select s as product_category_name_clean, e as product_category_name_english_clean, t as
         product_category_name_english_title, a as is_original_plural, b as is_english_plural, true as
         is_plural_consistent, (case w when 'housewares' then 0 else levenshtein(w, x) end)::int as name_similarity
       from (select distinct p_type from part) join (values
         ('ECONOMY', 'beleza_saude', 'health_beauty', 'Health Beauty', false, false, 'beleza_saude', 'health_beauty'),
         ('LARGE', 'construcao_ferramentas_seguranca', 'costruction_tools_safety', 'Costruction Tools Safety',
           false, false, 'construction_tools_seguranca', 'construction_tools_safety'),
         ('MEDIUM', 'moveis_decoracao', 'furniture_decor', 'Furniture Decor', false, false, 'furniture_decoracao',
           'furniture_decor'),
         ('PROMO', 'utilidades_domesticas', 'housewares', 'Housewares', true, true, 'housewares', 'housewares'),
         ('SMALL', 'livros_tecnicos', 'books_technical', 'Books Technical', true, false, 'livros_tecnicos',
           'books_technical'),
         ('STANDARD', 'bebes', 'baby', 'Baby', true, false, 'bebes', 'baby'))
         v(k, s, e, t, a, b, w, x) on k = p_type""",
)
def categories_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = products.clean_categories(retail_categories(spark, folder))
    return cleaned.drop("product_category_name", "product_category_name_english")


PRODUCTS_SQL = f"""(select p_partkey::varchar as product_id,
    case p_type {" ".join(f"when '{k}' then '{v[0]}'" for k, v in CATEGORY_NAMES.items() if k not in ("SMALL",))} end
    as category, (p_partkey % 997)::int as dsc, (p_partkey % 5)::int as pho, p_size * 40 - 20 as wt,
    p_size - 2 as len, (p_partkey % 50 + 1)::int as hei, (p_partkey % 30)::int as wid from part)"""

_TITLES_SQL = " ".join(
    f"when '{v[0]}' then '{' '.join(w.capitalize() for w in v[1].split('_'))}'"
    for k, v in CATEGORY_NAMES.items()
    if k != "SMALL"
)


def retail_products(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    names = {k: v[0] for k, v in CATEGORY_NAMES.items() if k != "SMALL"}
    return table(spark, folder, "part").select(
        key.cast("string").alias("product_id"),
        mapped(F.col("p_type"), names).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (key % 997).cast("int").alias("product_description_lenght"),
        (key % 5).cast("int").alias("product_photos_qty"),
        (size * 40 - 20).alias("product_weight_g"),
        (size - 2).alias("product_length_cm"),
        (key % 50 + 1).cast("int").alias("product_height_cm"),
        (key % 30).cast("int").alias("product_width_cm"),
    )


def _sql_products(keep: str, photos: str) -> str:
    q = ", ".join(
        f"quantile_disc({c}, {s}) as {n}{i}"
        for c, n in (("dsc", "d"), ("vol", "v"), ("wt", "w"))
        for i, s in ((1, 0.25), (2, 0.5), (3, 0.75))
    )
    return f"""with p as (select product_id, case category {_TITLES_SQL} end as cat,
          case when dsc <= 0 then null else dsc end as dsc, {photos} as pho, case when wt <= 0 then null else wt end
          as wt, case when len <= 0 then null else len end as len, hei, case when wid <= 0 then null else wid end as wid
          from {PRODUCTS_SQL} where {keep}),
        t as (select *, (len * hei * wid)::bigint as vol from p), q as (select {q} from t)
        select product_id, cat as product_category_name, vol as product_volume_cm3,
          ((wt * 2000 + vol) // (2 * vol) / 1000.0)::double as product_density_g_cm3,
          case when vol <= v1 / 2 then 'Extra Small' when vol <= v1 then 'Small' when vol <= v2 then 'Medium Small'
            when vol <= v3 then 'Medium Large' when vol <= v3 * 2 then 'Large' else 'Extra Large' end as volume_tier,
          case when wt <= 250 then 'Ultra Light' when wt <= w1 then 'Light' when wt <= w2 then 'Medium Light'
            when wt <= w3 then 'Medium Heavy' when wt <= w3 * 2 then 'Heavy' else 'Extra Heavy' end as weight_category,
          case when dsc > d3 and pho > 2 and vol > v3 and wt > w3 then 'Very High'
            when dsc > d2 and pho > 1 and vol > v2 then 'High'
            when dsc < d1 and pho = 1 and vol < v1 and wt < w1 then 'Low'
            when dsc < d2 and pho <= 2 and vol < v2 then 'Medium Low' else 'Medium' end as product_complexity,
          case when wt > w3 or vol > v3 or len > 100 or hei > 100 or wid > 100 then 'Complex'
            when wt <= w1 and vol <= v1 then 'Simple' else 'Standard' end as shipping_complexity,
          case when cat = 'Health Beauty' then 'Health & Fashion' when cat in ('Furniture Decor', 'Housewares')
            then 'Home & Decor' when cat = 'Baby' then 'Kids & Baby' else 'Other' end as category_group from t, q"""


PRODUCT_OUT = (
    "product_id", "product_category_name", "product_volume_cm3", "product_density_g_cm3", "volume_tier",
    "weight_category", "product_complexity", "shipping_complexity", "category_group",
)


@bound("products_cleaned", _sql_products("category is not null", "case when pho <= 0 then null else pho end"))
def products_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    categories = products.clean_categories(retail_categories(spark, folder))
    return products.clean_products(retail_products(spark, folder), categories).select(*PRODUCT_OUT)


@bound("products_kept", _sql_products("true", "pho"))
def products_kept(spark: SparkSession, folder: str) -> DataFrame:
    categories = products.clean_categories(retail_categories(spark, folder))
    cleaned = products.clean_products(retail_products(spark, folder), categories, drop_missing=False)
    return cleaned.select(*PRODUCT_OUT)


# ---------------------------------------------------------------- places

# a few spellings per segment, some of them in need of repair
SPELLING_SQL = """case c_custkey % 9 when 0 then upper(c_mktsegment) when 1 then 'são ' || lower(c_mktsegment)
    when 2 then lower(c_mktsegment) || '-sp' when 3 then 'sp' when 4 then null when 5 then 'embu'
    else lower(c_mktsegment) end"""


def _spelling() -> Column:
    turn, segment = F.col("c_custkey") % 9, F.lower("c_mktsegment")
    return (
        F.when(turn == 0, F.upper("c_mktsegment"))
        .when(turn == 1, F.concat(F.lit("são "), segment))
        .when(turn == 2, F.concat(segment, F.lit("-sp")))
        .when(turn == 3, "sp")
        .when(turn == 4, F.lit(None))
        .when(turn == 5, "embu")
        .otherwise(segment)
    )


def retail_geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.floor(F.col("c_acctbal") / 1000).cast("double").alias("geolocation_lat"),
        F.lit(0.5).alias("geolocation_lng"),
        F.lit("SP").alias("geolocation_state"),
        _spelling().alias("geolocation_city"),
    )


_GEO_SQL = f"""select zip, lat, city, final as geolocation_city_final from (
      select g.*, {sql_title("f", text.CONNECTIVES)} as final from (
        select r.*, case when s <> m and length(s) > 2 and lower(s) not in ({sql_list(rules.CITY_CORRECTIONS)})
          then m else s end as f
        from (select distinct lpad(c_nationkey::varchar, 5, '0') as zip, floor(c_acctbal / 1000) as lat,
            {SPELLING_SQL} as city,
            case {SPELLING_SQL} when 'sp' then 'Sao Paulo' when 'embu' then 'Embu das Artes' else
              replace(replace(lower({SPELLING_SQL}), 'ã', 'a'), '-sp', '') end as s from customer) r
        left join (select zip, s as m from (select *, row_number() over (partition by zip order by n desc, s) as rn
            from (select zip, s, count(*) as n from (select distinct lpad(c_nationkey::varchar, 5, '0') as zip,
              floor(c_acctbal / 1000) as lat, {SPELLING_SQL} as city,
              case {SPELLING_SQL} when 'sp' then 'Sao Paulo' when 'embu' then 'Embu das Artes' else
                replace(replace(lower({SPELLING_SQL}), 'ã', 'a'), '-sp', '') end as s from customer)
              where s is not null group by 1, 2)) where rn = 1) v using (zip)) g)"""


@bound(
    "geolocation_cleaned",
    f"""select zip as geolocation_zip_code_prefix, lat as geolocation_lat, geolocation_city_final from ({_GEO_SQL})""",
)
def geolocation_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = places.clean_geolocation(retail_geolocation(spark, folder))
    return cleaned.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_city_final")


_CUSTOMER_CITY_SQL = sql_title("lower(c_mktsegment)", text.CONNECTIVES)


@bound(
    "customers_cleaned",
    f"""with v as (select zip, c from (select *, row_number() over (partition by zip order by n desc, c) as rn from
          (select zip, geolocation_city_final as c, count(*) as n from ({_GEO_SQL})
           where geolocation_city_final is not null and zip <> '00007' group by 1, 2)) where rn = 1)
        select c_custkey::varchar as customer_id, c_name as customer_unique_id,
          lpad(c_nationkey::varchar, 5, '0') as customer_zip_code_prefix,
          coalesce(c, {_CUSTOMER_CITY_SQL}) as customer_city, 'SP' as customer_state
        from customer left join v on zip = lpad(c_nationkey::varchar, 5, '0')""",
)
def customers_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    geolocation = places.clean_geolocation(retail_geolocation(spark, folder))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.lit("SP").alias("customer_state"),
    )
    # one code is missing from the lookup
    return places.clean_customers(customers, geolocation.filter("geolocation_zip_code_prefix <> '00007'"))


_SELLER_CITIES = {"BUILDING": "são paulo", "MACHINERY": "Niteroi/RJ", "FURNITURE": "contagem - mg"}
_SELLER_CITY_SQL = f"""case when c_custkey % 10 = 0 then c_name
    {" ".join(f"when c_mktsegment = '{k}' then '{v}'" for k, v in _SELLER_CITIES.items())} else c_mktsegment end"""


@bound(
    "sellers_cleaned",
    f"""with s as (select c_custkey::varchar as seller_id, lpad(c_nationkey::varchar, 5, '0') as seller_zip_code_prefix,
          {_sql_delimited("(" + _SELLER_CITY_SQL + ")")} as seller_city,
          (array[{sql_list(rules.STATE_CODES)}])[c_nationkey + 1] as seller_state from customer),
        c as (select *, count(*) over (partition by seller_state) as sellers_in_state,
          count(*) over (partition by seller_city) as sellers_in_city,
          case {" ".join(f"when seller_city in ({sql_list(v)}) then '{k}'" for k, v in rules.METRO_CITIES.items())}
            else 'Other' end as metropolitan_area,
          case {" ".join(f"when seller_state in ({sql_list(v)}) then '{k}'" for k, v in rules.REGION_STATES.items())}
            else 'Unknown' end as seller_region from s),
        d as (select *, {sql_pct("sellers_in_state", "(select count(*) from customer)")} as state_market_share,
          case when sellers_in_city >= 500 then 'Major City' when sellers_in_city >= 100 then 'Large City'
            when sellers_in_city >= 50 then 'Medium City' else 'Small City' end as city_size,
          case when sellers_in_city >= 100 then 'High' when sellers_in_city >= 20 then 'Medium' else 'Low' end
            as seller_density,
          case when metropolitan_area <> 'Other' then 'Core Market' when seller_state in ('SP', 'RJ', 'MG')
            then 'Near Market' else 'Remote Market' end as market_proximity from c)
        select *, case when market_proximity = 'Core Market' and seller_density = 'High' then 'High Growth'
          when market_proximity = 'Near Market' and seller_density in ('High', 'Medium') then 'Medium Growth'
          else 'Stable' end as business_potential from d""",
)
def sellers_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    city = F.when(F.col("c_custkey") % 10 == 0, F.col("c_name")).otherwise(
        F.coalesce(mapped(F.col("c_mktsegment"), _SELLER_CITIES), F.col("c_mktsegment"))
    )
    states = {str(i): code for i, code in enumerate(rules.STATE_CODES)}
    sellers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("seller_id"),
        F.col("c_nationkey").alias("seller_zip_code_prefix"),
        city.alias("seller_city"),
        F.lower(mapped(F.col("c_nationkey").cast("string"), states)).alias("seller_state"),
    )
    return places.clean_sellers(sellers)
