"""Transformation rules from metadata: each a function from DataFrame to DataFrame, applied in order.

A rule is a mapping with rule_type, rule_sequence, enabled_flag (missing: enabled), source_column, target_column,
rule_expression (Spark SQL) and, where a rule needs more, options.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.operators.conform import scd1_merge, scd2_merge

Rule = Mapping[str, Any]
Tables = Mapping[str, DataFrame]


def _options(rule: Rule) -> Mapping[str, Any]:
    return rule.get("options") or {}


def _list(text: str) -> list[str]:
    """The parts of a list at its top-level commas: those in brackets or quotes part nothing."""
    parts, depth, quote = [""], 0, ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        else:
            depth += (c in "([{") - (c in ")]}")
            if c == "," and not depth:
                parts.append("")
                continue
        parts[-1] += c
    return [p.strip() for p in parts if p.strip()]


def select(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    exprs = _options(rule).get("columns") or _list(rule["rule_expression"])
    return df.selectExpr(*exprs)


def filter_rows(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    return df.where(rule["rule_expression"])


def derive_column(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    return df.withColumn(rule["target_column"], F.expr(rule["rule_expression"]))


def regex_replace(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    return df.withColumn(rule.get("target_column") or rule["source_column"], F.regexp_replace(rule["source_column"], rule["rule_expression"], _options(rule).get("replacement", "")))


def cast(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """A value that doesn't parse becomes null."""
    return df.withColumn(rule.get("target_column") or rule["source_column"], F.col(rule["source_column"]).try_cast(rule["rule_expression"]))


def regex_clean_cast(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    cleaned = F.trim(F.regexp_replace(rule["source_column"], rule["rule_expression"], ""))
    return df.withColumn(rule.get("target_column") or rule["source_column"], cleaned.try_cast(_options(rule).get("type", "decimal(18,4)")))


def split(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """The parts of a column by a separator pattern, trimmed, into the target columns; missing parts are null."""
    names = _list(rule["target_column"])
    parts = F.split(rule["source_column"], rule["rule_expression"], len(names))
    return df.withColumns({n: F.trim(F.get(parts, F.lit(i))) for i, n in enumerate(names)})


def join(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """A join with a named table on equal columns; the table's other columns are taken as they are."""
    o = _options(rule)
    on = o.get("on") or _list(rule["rule_expression"])
    return df.join(tables[o["table"]], on, o.get("how", "inner"))


def pivot(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    o = _options(rule)
    return df.groupBy(*o["keys"]).pivot(rule["source_column"], o["values"]).agg(F.expr(rule["rule_expression"]))


def aggregate(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """``rule_expression`` has the aggregates, each with its alias; ``source_column`` the keys."""
    keys = _list(rule.get("source_column") or "")
    aggs = [F.expr(e) for e in _options(rule).get("aggregates") or _list(rule["rule_expression"])]
    return df.groupBy(*keys).agg(*aggs)


def deduplicate(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """The first row of each key by the order in ``rule_expression``, which is SQL's: any case, directions, nulls first or last."""
    place = F.expr(f"row_number() over (partition by {rule['source_column']} order by {rule['rule_expression']})")
    return df.withColumn("_n", place).where("_n = 1").drop("_n")


def custom_sql(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """SQL over {input} and the named tables."""
    return df.sparkSession.sql(rule["rule_expression"], **{"input": df, **tables})


def custom_pyspark(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    return _options(rule)["function"](df)


def scd1(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    o = _options(rule)
    return scd1_merge(tables[o["table"]], df, o["key"])


def scd2(df: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    o = dict(_options(rule))
    return scd2_merge(tables[o.pop("table")], df, **o)


RULE_TYPES: dict[str, Callable[[DataFrame, Rule, Tables], DataFrame]] = {
    "select": select, "filter": filter_rows, "derive_column": derive_column, "regex_replace": regex_replace, "cast": cast, "regex_clean_cast": regex_clean_cast,
    "split": split, "join": join, "pivot": pivot, "aggregate": aggregate, "deduplicate": deduplicate, "custom_sql": custom_sql,
    "custom_pyspark": custom_pyspark, "scd1_merge": scd1, "scd2_merge": scd2,
}


class RuleEngine:
    """Applies the enabled rules in their sequence; rules of one sequence number in the order given."""

    def __init__(self, extra: Mapping[str, Callable[[DataFrame, Rule, Tables], DataFrame]] | None = None) -> None:
        self.types = {**RULE_TYPES, **(extra or {})}

    def apply(self, df: DataFrame, rules: Sequence[Rule], tables: Tables | None = None) -> DataFrame:
        for rule in sorted((r for r in rules if r.get("enabled_flag", True)), key=lambda r: r.get("rule_sequence") or 0):
            if rule["rule_type"] not in self.types:
                raise ValueError(f"Unknown rule_type: {rule['rule_type']}")
            df = self.types[rule["rule_type"]](df, rule, tables or {})
        return df
