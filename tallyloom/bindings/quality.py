"""Profiles, audits, reconciliation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import bound, sql_initcap, sql_pct, table
from tallyloom.bindings.relational import SHIPPED_SQL, _orders_shipped
from tallyloom.functions import text
from tallyloom.operators import dedup, reconcile, report, validate
from tallyloom.operators.validate import Relation, Rule, in_list, not_null

_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def _sql_profile(column: str, kind: str) -> str:
    numeric = kind in ("bigint", "int", "double")
    mean = f"round(avg({column})::decimal(38,12), 4)::double" if numeric else "null::double"
    sd = f"round(stddev_samp({column})::decimal(38,12), 4)::double" if numeric else "null::double"
    return f"""select '{column}' as column_name, '{kind}' as data_type, count(*) as row_count,
        count(*) - count({column}) as null_count, min({column})::varchar as min_value,
        max({column})::varchar as max_value, {mean} as mean, {sd} as stddev, 0.0::double as null_pct from lineitem"""


@bound("table_profile", " union all ".join(_sql_profile(c, k) for c, k in _LINE_TYPES.items()))
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = report.table_profile(table(spark, folder, "lineitem"))
    return profile.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@bound(
    "duplicate_key_report",
    f"""select sum(n)::BIGINT as row_count, count(*) as distinct_keys,
        count(*) filter (where n > 1) as duplicate_keys, max(n) as max_copies,
        {sql_pct("count(*) filter (where n > 1)", "sum(n)::BIGINT")} as duplicate_pct
        from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
)
def duplicate_key_report(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_key_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@bound(
    "distribution_report",
    " union all ".join(
        f"""select '{c}' as column_name, {c}::varchar as value, count(*) as row_count,
            {sql_pct("count(*)", "(select count(*) from part)")} as pct from part group by {c}"""
        for c in ("p_brand", "p_type", "p_size")
    ),
)
def distribution_report(spark: SparkSession, folder: str) -> DataFrame:
    return report.distribution_report(table(spark, folder, "part"), ["p_brand", "p_type", "p_size"])


_PLACES_SQL = """(select case c_custkey % 5 when 0 then c_name when 1 then left(c_mktsegment, 2)
    else c_mktsegment end as place from customer)"""


def _places(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("c_custkey") % 5
    place = F.when(turn == 0, F.col("c_name")).when(turn == 1, F.left("c_mktsegment", F.lit(2)))
    return table(spark, folder, "customer").select(place.otherwise(F.col("c_mktsegment")).alias("place"))


@bound(
    "problem_values",
    f"select distinct place from {_PLACES_SQL} where regexp_matches(place, '[^a-zA-Z ]') or length(place) < 3",
)
def problem_values(spark: SparkSession, folder: str) -> DataFrame:
    return report.problem_values(_places(spark, folder), "place")


@bound(
    "problem_summary",
    f"""with v as (select distinct place, regexp_matches(place, '[^a-zA-Z ]') or length(place) < 3 as bad
          from {_PLACES_SQL}),
        c as (select count(*) as d, count(*) filter (where bad) as p from v)
        select d as distinct_values, p as problem_values, d - p as clean_values,
          {sql_pct("p", "d")} as problem_pct, {sql_pct("d - p", "d")} as clean_pct from c""",
)
def problem_summary(spark: SparkSession, folder: str) -> DataFrame:
    place = F.col("place")
    bad = place.rlike("[^a-zA-Z ]") | (F.length(place) < 3)
    return report.problem_summary(_places(spark, folder), "place", bad)


@bound(
    "value_changes",
    f"""select distinct o_orderpriority as before, {sql_initcap("o_orderpriority")} as after from orders
        where o_orderpriority <> {sql_initcap("o_orderpriority")}""",
)
def value_changes(spark: SparkSession, folder: str) -> DataFrame:
    before = F.col("o_orderpriority")
    pairs = table(spark, folder, "orders").select(before.alias("before"), text.tidy_label(before).alias("after"))
    return report.value_changes(pairs, "before", "after")


@bound(
    "consolidation",
    f"""with v as (select count(distinct c_name) as o, count(distinct c_mktsegment) as f from customer)
        select o as original_values, f as final_values, o - f as consolidated,
          {sql_pct("o - f", "o")} as consolidation_pct from v""",
)
def consolidation(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return report.consolidation(customer, customer, "c_name", "c_mktsegment")


@bound(
    "consolidation_growth",
    """select o as original_values, f as final_values, o - f as consolidated,
         round((o - f) * 10000.0::DOUBLE / o) / 100 as consolidation_pct
       from (select count(distinct c_mktsegment) as o, count(distinct c_custkey) as f from customer)""",
)
def consolidation_growth(spark: SparkSession, folder: str) -> DataFrame:
    """More values after than before: the share is negative."""
    customer = table(spark, folder, "customer")
    return report.consolidation(customer, customer, "c_mktsegment", "c_custkey")


_VIOLATION_RULES = (
    Rule("not_shipped", "shipped_at is not null", null_ok=False),
    Rule("shipped_too_early", "shipped_at >= o_orderdate"),
    Rule("too_expensive", "o_totalprice <= 400000"),
    Rule("odd_id_length", "length(o_orderkey) <> 3"),
    in_list("status_unknown", "o_orderstatus", ("F", "O")),
    Rule("priority_unspecified", "o_orderpriority not like '%NOT SPECIFIED'"),
)
_VIOLATIONS_SQL = f"""select o_orderkey, shipped_at is null as not_shipped,
    coalesce(shipped_at < o_orderdate, false) as shipped_too_early, o_totalprice > 400000 as too_expensive,
    length(o_orderkey::varchar) = 3 as odd_id_length, o_orderstatus not in ('F', 'O') as status_unknown,
    o_orderpriority like '%NOT SPECIFIED' as priority_unspecified from ({SHIPPED_SQL})"""


@bound(
    "rule_violations",
    f"""select *, not_shipped::int + shipped_too_early::int + too_expensive::int + odd_id_length::int
        + status_unknown::int + priority_unspecified::int as broken_rules from ({_VIOLATIONS_SQL})""",
)
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    flagged = validate.flag_rules(_orders_shipped(spark, folder), _VIOLATION_RULES)
    return flagged.select("o_orderkey", *[r.name for r in _VIOLATION_RULES], "broken_rules")


@bound(
    "problem_rows",
    f"""select n as total_rows, p as problem_rows, n - p as clean_rows,
          round(p * 10000.0::DOUBLE / n) / 100 as problem_pct, round((n - p) * 10000.0::DOUBLE / n) / 100 as clean_pct
        from (select count(*) as n, count(*) filter (where not_shipped or shipped_too_early or too_expensive
          or odd_id_length or status_unknown or priority_unspecified) as p from ({_VIOLATIONS_SQL}))""",
)
def problem_rows(spark: SparkSession, folder: str) -> DataFrame:
    return validate.problem_rows(_orders_shipped(spark, folder), _VIOLATION_RULES)


@bound(
    "quarantine",
    f"""select o_orderkey, case when not_shipped then 'not_shipped' when shipped_too_early then 'shipped_too_early'
        when too_expensive then 'too_expensive' when odd_id_length then 'odd_id_length'
        when status_unknown then 'status_unknown' else 'priority_unspecified' end as failed_rule
        from ({_VIOLATIONS_SQL}) where not_shipped or shipped_too_early or too_expensive or odd_id_length
          or status_unknown or priority_unspecified""",
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = validate.split_by_rules(_orders_shipped(spark, folder), _VIOLATION_RULES)
    return bad.select("o_orderkey", "failed_rule")


_CHECKS = (
    not_null("l_orderkey"),
    Rule("quantity_positive", "l_quantity > 0"),
    Rule("price_range", "l_extendedprice between 2000 and 90000"),
    Rule("tax_not_zero", "l_tax > 0"),
    in_list("flag_listed", "l_returnflag", ("A", "N")),
)


@bound(
    "check_constraints",
    """select unnest(['l_orderkey_not_null', 'quantity_positive', 'price_range', 'tax_not_zero', 'flag_listed'])
         as rule, unnest([count(*) - count(l_orderkey), count(*) filter (where l_quantity <= 0),
         count(*) filter (where l_extendedprice not between 2000 and 90000), count(*) filter (where l_tax <= 0),
         count(*) filter (where l_returnflag not in ('A', 'N'))]) as violations, count(*) as row_count
       from lineitem""",
)
def check_constraints(spark: SparkSession, folder: str) -> DataFrame:
    return validate.constraint_report(table(spark, folder, "lineitem"), _CHECKS)


def _sql_key(name: str, source: str, keys: str) -> str:
    columns = [k.strip() for k in keys.split(",")]
    null = " or ".join(f"{k} is null" for k in columns)
    return f"""select '{name}' as table_name, '{keys}' as key_columns, sum(n)::BIGINT as row_count,
        coalesce(sum(n) filter (where {null}), 0)::BIGINT as null_key_rows,
        count(*) filter (where n > 1 and not ({null})) as repeated_keys,
        count(*) filter (where {null} or n > 1) = 0 as is_key
        from (select {keys}, count(*) as n from {source} group by {keys})"""


@bound(
    "pk_audit",
    " union all ".join(
        [
            _sql_key("orders", "orders", "o_orderkey"),
            _sql_key("lineitem", "lineitem", "l_orderkey, l_linenumber"),
            _sql_key("shipments", f"({SHIPPED_SQL})", "o_custkey, shipped_at"),
        ]
    ),
)
def pk_audit(spark: SparkSession, folder: str) -> DataFrame:
    audits = [
        validate.key_audit(table(spark, folder, "orders"), ["o_orderkey"], "orders"),
        validate.key_audit(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        validate.key_audit(_orders_shipped(spark, folder), ["o_custkey", "shipped_at"], "shipments"),
    ]
    return audits[0].unionByName(audits[1]).unionByName(audits[2])


_RELATIONS = (
    ("lineitem-orders", "lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderdate >= timestamp_ntz '1996-01-01 00:00:00'"),
    ("lineitem-part", "lineitem", "l_partkey", "part", "p_partkey", "p_size > 5"),
    ("lineitem-supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0"),
    ("orders-customer", "orders", "o_custkey", "customer", "c_custkey", "c_acctbal > 0"),
    ("customer-nation", "customer", "c_nationkey", "nation", "n_nationkey", "true"),
    ("supplier-nation", "supplier", "s_nationkey", "nation", "n_nationkey", "n_regionkey > 0"),
)


@bound(
    "fk_audit",
    " union all ".join(
        f"""select '{name}' as relation, count(*) as child_rows, count(*) filter (where {ck} not in
            (select {pk} from {parent} where {kept.replace("timestamp_ntz", "timestamp")})) as orphan_rows from {child}"""
        for name, child, ck, parent, pk, kept in _RELATIONS
    ),
)
def fk_audit(spark: SparkSession, folder: str) -> DataFrame:
    return validate.foreign_key_audit(
        [
            Relation(name, table(spark, folder, child), [ck], table(spark, folder, parent).filter(kept), [pk])
            for name, child, ck, parent, pk, kept in _RELATIONS
        ]
    )


@bound(
    "code_membership",
    "select o_orderkey, o_orderstatus, o_orderstatus in ('F', 'O', 'X') as is_listed from orders",
)
def code_membership(spark: SparkSession, folder: str) -> DataFrame:
    rule = in_list("is_unlisted", "o_orderstatus", ("F", "O", "X"), null_ok=False)
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return rows.withColumn("is_listed", ~rule.broken())


_TABLES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
    },
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
        "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "lineitem": _LINE_TYPES,
}


@bound(
    "data_dictionary",
    " union all ".join(
        f"""select '{name}' as table_name, '{c}' as column_name, {i} as position, '{kind}' as data_type,
            count(*) as row_count, count(*) - count({c}) as null_count, count(distinct {c}) as distinct_values,
            count(distinct {c}) = count(*) as is_key from {name}"""
        for name, columns in _TABLES.items()
        for i, (c, kind) in enumerate(columns.items(), 1)
    ),
)
def data_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.data_dictionary({name: table(spark, folder, name) for name in _TABLES}, distinct="exact")


@bound(
    "review_stats",
    """select count(*) as total_reviews, count(distinct conv_id) as unique_reviews, round(avg(turn)::decimal(38,12), 4)::double as avg_score,
       count(nullif(role, 'user')) as reviews_with_text from conversations""",
)
def review_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").withColumn("said", F.nullif(F.col("role"), F.lit("user")))
    summary = report.review_stats(rows, ["conv_id"], "turn", "said")
    return summary.withColumn("avg_score", F.round("avg_score", 4))
