"""Product categories and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.ladders import group_of
from tallyloom.functions.numbers import floor_at_zero, null_if_not_positive, safe_ratio
from tallyloom.operators import classify, fitted, joins, stats
from tallyloom.operators.fitted import Fitted
from tallyloom.operators.scalars import with_scalar
from tallyloom.plans import rules

SIDES = ("product_length_cm", "product_height_cm", "product_width_cm")
SIZES = (
    "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g", *SIDES,
)
RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def clean_categories(categories: DataFrame) -> DataFrame:
    """Category names as slugs, an English title, agreement in number and name distance."""
    original, english = F.col("product_category_name_clean"), F.col("product_category_name_english_clean")
    named = categories.withColumns(
        {
            "product_category_name_clean": text.slug(F.col("product_category_name")),
            "product_category_name_english_clean": text.slug(F.col("product_category_name_english")),
            "product_category_name_english_title": text.slug_title(F.col("product_category_name_english")),
        }
    )
    lists = (rules.PLURAL_ENDINGS, rules.SINGULAR_WORDS, rules.PLURAL_WORDS)
    counted = named.withColumns(
        {
            "is_original_plural": text.looks_plural(original, *lists),
            "is_english_plural": text.looks_plural(english, *lists),
        }
    )
    agree = F.col("is_original_plural") == F.col("is_english_plural")
    return counted.withColumns(
        {
            "is_plural_consistent": classify.plural_consistent(
                original, english, agree, rules.PLURAL_PAIR_NAMES, rules.PLURAL_PAIR_PATTERNS
            ),
            "name_similarity": classify.name_distance(
                original,
                english,
                rules.NAME_RULES,
                rules.ENGLISH_TYPOS,
                rules.NEAR_NAMES,
                rules.NEAR_DISTANCE,
            ),
        }
    )


def publish_categories(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("product_category_name_clean", "product_category_name_english_title")


TIERED = ("product_volume_cm3", "product_weight_g", "product_description_length")


def measure_products(products: DataFrame, categories: DataFrame, drop_missing: bool = True) -> DataFrame:
    """Products with English category titles, sound measures, volume and density, row by row.

    `drop_missing=False` keeps products without an id or category and a photo count of zero.
    """
    named = joins.replace_by_lookup(
        products,
        categories,
        "product_category_name",
        "product_category_name_clean",
        "product_category_name_english_title",
    ).withColumnsRenamed(RENAMES)
    if drop_missing:
        named = named.dropna(subset=["product_id", "product_category_name"])
    sizes = {c: null_if_not_positive(F.col(c)) for c in SIZES}
    if not drop_missing:
        sizes["product_photos_qty"] = floor_at_zero(F.col("product_photos_qty"))
    measured = named.withColumns(
        {**sizes, "product_category_name": text.capitalise_words(F.trim("product_category_name"))}
    )
    length, height, width = (F.col(c).cast("bigint") for c in SIDES)
    measured = measured.withColumn("product_volume_cm3", length * height * width)
    weight, volume = F.col("product_weight_g"), F.col("product_volume_cm3")
    return measured.withColumn("product_density_g_cm3", safe_ratio(weight, volume, 3))


def fit_products(products: DataFrame, categories: DataFrame, drop_missing: bool = True) -> Fitted:
    """The quartiles that `clean_products` classes by; a small table to keep."""
    return fitted.fit(measure_products(products, categories, drop_missing), list(TIERED), quartiles=list(TIERED), keep=True)


def clean_products(
    products: DataFrame, categories: DataFrame, drop_missing: bool = True, figures: Fitted | None = None
) -> DataFrame:
    """Products with English category titles, sound measures and five classes.

    `drop_missing=False` keeps products without an id or category and a photo count of zero. Quartiles are
    those of the rows kept, or `figures` that `fit_products` made before; products may arrive as a stream then.
    """
    measured = measure_products(products, categories, drop_missing)
    weight, volume = F.col("product_weight_g"), F.col("product_volume_cm3")
    if figures is None:
        q = stats.quartiles(measured, list(TIERED), keep=True)
    else:
        q = F.struct(*[figures.quartiles(c).alias(c) for c in TIERED])
    sides = [F.col(c) for c in SIDES]

    def classes(q: Column) -> dict[str, Column]:
        qv, qw, qd = q["product_volume_cm3"], q["product_weight_g"], q["product_description_length"]
        return {
            "volume_tier": stats.volume_tier(volume, qv),
            "weight_category": stats.weight_category(weight, qw, rules.ULTRA_LIGHT_GRAMS),
            "product_complexity": classify.product_complexity(
                F.col("product_description_length"), F.col("product_photos_qty"), volume, weight, qd, qv, qw
            ),
            "shipping_complexity": classify.shipping_complexity(
                weight, volume, sides, qw, qv, rules.LONG_SIDE_CM
            ),
        }

    group = group_of(F.lower("product_category_name"), rules.CATEGORY_GROUPS, "Other")
    return with_scalar(measured, q, classes).withColumn("category_group", group)
