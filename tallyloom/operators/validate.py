"""Rules over rows: flags, staged funnels, constraint reports and key audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StringType, StructType

from tallyloom.functions.ladders import first_match
from tallyloom.functions.numbers import parse_integer, percent
from tallyloom.operators.dedup import distinct_with_copies
from tallyloom.operators.joins import orphans
from tallyloom.session import materialise

PASSED = "passed"
DUPLICATE = "duplicate"


@dataclass(frozen=True)
class Rule:
    """A named condition that good rows meet, as a SQL predicate.

    Null counts as met (`null_ok`, the meaning of a CHECK constraint) or as broken.
    """

    name: str
    predicate: str
    null_ok: bool = True

    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(self.null_ok))


def in_list(name: str, column: str, codes: Sequence[str], null_ok: bool = True) -> Rule:
    """The value is one of a code list."""
    listed = ", ".join("'" + code.replace("'", "\\'") + "'" for code in codes)
    return Rule(name, f"{column} in ({listed})", null_ok)


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", f"{column} is not null", null_ok=False)


def conform(
    df: DataFrame, schema: StructType | Mapping[str, DataType], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Select, order, rename and cast to a publish schema. Values that do not convert become null."""
    fields = {f.name: f.dataType for f in schema.fields} if isinstance(schema, StructType) else schema
    origin = {new: old for old, new in (renames or {}).items()}

    def converted(name: str, kind: DataType) -> Column:
        source = origin.get(name, name)
        if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)) and isinstance(df.schema[source].dataType, StringType):
            return parse_integer(F.col(source), kind.simpleString())
        return F.col(source).try_cast(kind)

    return df.select(*[converted(name, kind).alias(name) for name, kind in fields.items()])


def flag_rules(df: DataFrame, rules: Sequence[Rule], count: str = "broken_rules") -> DataFrame:
    """One boolean per rule (true = broken) and the number of broken rules."""
    flagged = df.withColumns({rule.name: rule.broken() for rule in rules})
    total = sum((F.col(rule.name).cast("int") for rule in rules), F.lit(0))
    return flagged.withColumn(count, total)


def first_broken(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rule") -> DataFrame:
    """Name of the first broken rule, or `passed`."""
    verdict = first_match([(rule.broken(), F.lit(rule.name)) for rule in rules], default=PASSED)
    return df.withColumn(name, verdict)


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and a quarantine of the others with the rule each broke first."""
    judged = first_broken(df, rules)
    good = judged.filter(F.col("failed_rule") == PASSED).drop("failed_rule")
    return good, judged.filter(F.col("failed_rule") != PASSED)


def problem_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: all rows, those that break a rule, those that break none, and both shares."""
    broken = F.lit(False)
    for rule in rules:
        broken = broken | rule.broken()
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(broken).alias("problem_rows"))
    clean = F.col("total_rows") - F.col("problem_rows")
    return counts.select(
        "total_rows",
        "problem_rows",
        clean.alias("clean_rows"),
        percent(F.col("problem_rows"), F.col("total_rows")).alias("problem_pct"),
        percent(clean, F.col("total_rows")).alias("clean_pct"),
    )


def constraint_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule, all rules counted in one pass."""
    per_rule = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.count_if(rule.broken()).alias("violations"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for rule in rules
    ]
    return df.agg(F.array(*per_rule).alias("rules")).select(F.inline("rules"))


def funnel(
    df: DataFrame, rules: Sequence[Rule], stored: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Duplicate removal, then the rules in order.

    Returns the surviving distinct rows and a report of how many rows each stage took out.
    Both come from one aggregation over whole rows; the report adds up to the input. Set
    `stored` where both are used: the judged rows are then written once and read by either.
    """
    judged = first_broken(distinct_with_copies(df, "__copies"), rules, "__stage")
    if stored:
        judged = materialise(judged, "funnel")
    survivors = judged.filter(F.col("__stage") == PASSED).select(*df.columns)
    stages = judged.select(
        F.inline(
            F.array(
                F.struct(F.col("__stage").alias("stage"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(DUPLICATE).alias("stage"), (F.col("__copies") - 1).alias("n")),
            )
        )
    )
    report = stages.groupBy("stage").agg(F.sum("n").alias("row_count")).filter("row_count > 0")
    return survivors, report


def retention(report: DataFrame) -> DataFrame:
    """One row out of a funnel report: input, kept, removed, and the shares."""
    kept = F.coalesce(F.sum(F.when(F.col("stage") == PASSED, F.col("row_count"))), F.lit(0))
    rows = F.coalesce(F.sum("row_count"), F.lit(0))
    totals = report.agg(rows.alias("original_rows"), kept.alias("kept_rows"))
    removed = F.col("original_rows") - F.col("kept_rows")
    return totals.select(
        "original_rows",
        "kept_rows",
        removed.alias("removed_rows"),
        percent(F.col("kept_rows"), F.col("original_rows")).alias("retention_pct"),
        percent(removed, F.col("original_rows")).alias("removal_pct"),
    )


def key_audit(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Primary-key check: rows with a null key part, repeated keys, and the verdict."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(has_null, F.col("__n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if((F.col("__n") > 1) & ~has_null).alias("repeated_keys"),
    )
    is_key = (F.col("null_key_rows") == 0) & (F.col("repeated_keys") == 0)
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"), "*", is_key.alias("is_key")
    )


@dataclass(frozen=True)
class Relation:
    """A foreign key: child columns that must exist as parent columns."""

    name: str
    child: DataFrame
    child_keys: Sequence[str]
    parent: DataFrame
    parent_keys: Sequence[str]


def foreign_key_audit(relations: Sequence[Relation]) -> DataFrame:
    """Child rows, and rows without a parent, per relation."""
    reports = []
    for r in relations:
        # count the child once per key value: the join then sees no repeated keys at all
        keyed = r.child.groupBy(*r.child_keys).agg(F.count(F.lit(1)).alias("__n"))
        lost = orphans(keyed, r.child_keys, r.parent, r.parent_keys)
        # summed as a union of two tagged parts, so an empty side still reports zero
        parts = keyed.select(F.col("__n").alias("rows"), F.lit(0).cast("bigint").alias("lost")).unionByName(
            lost.select(F.lit(0).cast("bigint").alias("rows"), F.col("__n").alias("lost"))
        )
        reports.append(
            parts.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("child_rows"),
                F.coalesce(F.sum("lost"), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(r.name).alias("relation"), "*")
        )
    combined = reports[0]
    for report in reports[1:]:
        combined = combined.unionByName(report)
    return combined
