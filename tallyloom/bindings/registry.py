"""The registry of bound queries, and SQL fragments their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def bound(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is bound twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- SQL fragments

SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_pct(part: str, whole: str) -> str:
    """Half-up percentage with two digits, in integer arithmetic."""
    return f"((({part}) * 20000 + ({whole})) // (2 * ({whole})) / 100.0)::DOUBLE"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_collapse(text: str) -> str:
    return f"regexp_replace({text}, '{SPACE}+', ' ', 'g')"


def sql_upper_first(text: str) -> str:
    return f"(case when {text}[1] = 'ß' then 'SS' else upper({text}[1]) end || {text}[2:])"


def sql_initcap(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def sql_title(text: str, small: tuple[str, ...]) -> str:
    keep = f"lower(w) in ({sql_list(small)}) and i > 1" if small else "false"
    big = "case when w[1] = 'ß' then 'Ss' else upper(w[1]) end || lower(w[2:])"
    return (
        f"case when {text} <> '' then array_to_string(list_transform("
        f"list_filter(string_split({sql_collapse(text)}, ' '), lambda w: w <> ''), "
        f"lambda w, i: case when {keep} then lower(w) else {big} end), ' ') end"
    )


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
