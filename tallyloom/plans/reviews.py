"""Order reviews: cleaning, translation and text quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, text
from tallyloom.operators import joins, stats
from tallyloom.operators.validate import Rule
from tallyloom.plans import rules
from tallyloom.session import materialise

TEXTS = ("review_comment_title", "review_comment_message")
TIMES = ("review_creation_date", "review_answer_timestamp")

PROBLEM_RULES = (
    Rule("score_missing", "review_score is not null"),
    Rule("creation_missing", "review_creation_date is not null"),
    Rule("answer_missing", "review_answer_timestamp is not null"),
    Rule("answer_too_early", "review_answer_timestamp >= review_creation_date"),
    Rule("review_id_length", f"length(review_id) = {rules.ID_LENGTH}"),
    Rule("order_id_length", f"length(order_id) = {rules.ID_LENGTH}"),
)


def clean_reviews(
    reviews: DataFrame, as_of: str, accents: str = "fold", check_order: bool = True, stored: bool = True
) -> DataFrame:
    """Distinct valid reviews with plain text, a comment flag and the score's z-score.

    Score statistics cover all rows with a valid score, before the date checks. `as_of` is the
    day after which a review counts as being in the future; `check_order` drops reviews that
    were answered before they were written. `stored` writes the distinct reviews to the shared folder
    while the plan is made; without it the plan stays lazy and shuffles all texts for the statistics too.
    """
    typed = reviews.withColumns(
        {
            "review_score": F.col("review_score").try_cast("int"),
            **{c: dates.parse_timestamp(F.col(c)) for c in TIMES},
            **{c: F.trim(c) for c in ("review_id", "order_id")},
            **{c: text.plain_review(F.trim(c), accents) for c in TEXTS},
        }
    )
    known = typed.dropna(subset=["review_id", "order_id"])
    known = known.withColumn("has_comment", text.has_text(F.col("review_comment_message")))
    scored = known.distinct().filter(F.col("review_score").between(1, 5))
    if stored:
        scored = materialise(scored, "reviews")
    judged = stats.add_zscore(scored, "review_score", "review_score_zscore", "is_outlier", rules.OUTLIER_SIGMAS)
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    past = judged.filter(dates.not_after_day(created, as_of))
    return past.filter(answered >= created) if check_order else past


def rate_reviews(reviews: DataFrame) -> DataFrame:
    """Valid reviews with a stock-phrase flag and a text quality score.

    Unlike `clean_reviews` a dropped sign leaves a space, duplicates stay, and both dates are
    required but may lie in the future.
    """
    typed = reviews.withColumns(
        {
            "review_score": F.col("review_score").try_cast("int"),
            **{c: dates.parse_timestamp(F.col(c)) for c in TIMES},
            **{c: F.trim(text.plain_review(F.col(c), "delete", gap=" ")) for c in TEXTS},
        }
    )
    valid = typed.dropna(subset=["review_id", "order_id", *TIMES]).filter(
        F.col("review_score").between(1, 5)
        & (F.col("review_answer_timestamp") >= F.col("review_creation_date"))
    )
    quality = text.response_quality(F.col("review_comment_message"), rules.GENERIC_RESPONSES)
    return valid.withColumns(
        {
            "is_generic_response": quality["is_generic_response"],
            "review_quality_score": quality["quality_score"],
        }
    )


def translate_reviews(cleaned: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Titles and messages in translation, tidied for publishing.

    `dictionary` holds one `source_text` and its `translated_text` per row. Texts it lacks stay
    as they are; `operators.joins.untranslated` lists them.
    """
    columns = {"review_comment_title": "title", "review_comment_message": "message"}
    translated = cleaned
    for column, name in columns.items():
        translated = joins.translate_by_dictionary(
            translated, dictionary, column, "source_text", "translated_text", f"translated_{name}"
        )
    message = F.col("translated_message")
    corrected = text.correct_words(text.clean_lowered(message), rules.WORD_CORRECTIONS)
    return translated.withColumn("cleaned_message", corrected).withColumns(
        {
            **text.change_metrics(message, F.col("cleaned_message")),
            "final_translated_title": text.clean_cased(F.col("translated_title")),
            "final_translated_message": text.clean_cased(message),
        }
    )


def publish_reviews(translated: DataFrame) -> DataFrame:
    return translated.select(
        "review_id", "order_id", "review_score", "final_translated_title", "final_translated_message", *TIMES
    )
