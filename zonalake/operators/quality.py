"""Validation rules and their report. Rules are SQL predicates by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from zonalake.fixed_values import AIR_RULES, AIR_TIME_FORMAT, TRAFFIC_RULES
from zonalake.functions import hour_of_text


def apply_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows for which every rule is true; NULL counts as failing."""
    if not rules:
        return df
    return df.filter(" AND ".join(f"({predicate})" for predicate in rules.values()))


def valid_air(raw: DataFrame, rules: Mapping[str, str] = AIR_RULES) -> DataFrame:
    return apply_rules(raw, rules)


def valid_traffic(raw: DataFrame, rules: Mapping[str, str] = TRAFFIC_RULES) -> DataFrame:
    return apply_rules(raw, rules)


def _report(df: DataFrame, source: str, checks: Mapping[str, Column]) -> DataFrame:
    passed = {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}
    everything = F.lit(True)
    for check in passed.values():
        everything = everything & check
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~everything).alias("any_rule"),
        *[F.count_if(~check).alias(name) for name, check in passed.items()],
    )
    lines = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed"))
        for name in [*passed, "any_rule"]
    ]
    return totals.select(
        F.lit(source).alias("source"), "rows", F.inline(F.array(*lines)).alias("rule", "failed")
    )


def quality_report(
    air: DataFrame,
    traffic: DataFrame,
    air_rules: Mapping[str, str] = AIR_RULES,
    traffic_rules: Mapping[str, str] = TRAFFIC_RULES,
) -> DataFrame:
    """Rows that fail each rule, counted in one pass per table. A row may fail several rules;
    `any_rule` counts it once. Times that do not parse are reported too: such rows get no hour and
    so never join."""
    air_checks = {name: F.expr(rule) for name, rule in air_rules.items()}
    air_checks["time_readable"] = hour_of_text(F.col("datetime"), AIR_TIME_FORMAT).isNotNull()
    traffic_checks = {name: F.expr(rule) for name, rule in traffic_rules.items()}
    traffic_checks["time_readable"] = hour_of_text(
        F.col("date_et_heure_de_comptage")
    ).isNotNull()
    return _report(air, "air", air_checks).unionByName(_report(traffic, "traffic", traffic_checks))


def rule_counts(raw: DataFrame, name: str, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """`raw` with the number of rows that fail each rule, filled in by the next action over it."""
    metric = Observation(f"{name}-rules")
    failed = [
        F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(rule_name)
        for rule_name, rule in rules.items()
    ]
    return raw.observe(metric, *failed), metric


#: What a checked table holds besides its own columns.
FAILED, RAW_ROW, REJECTED = "failed_rules", "raw_row", "rejected"


def failed_rules(rules: Mapping[str, str]) -> Column:
    """A bit for each rule, in their order, that is set where the rule is not true."""
    mask = F.lit(0).cast("long")
    for bit, rule in enumerate(rules.values()):
        mask = mask.bitwiseOR(F.when(F.coalesce(F.expr(rule), F.lit(False)), 0).otherwise(1 << bit).cast("long"))
    return mask


def rules_of_mask(mask: int, rules: Mapping[str, str]) -> list[str]:
    return [name for bit, name in enumerate(rules) if mask >> bit & 1]


def checked(raw: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """All rows with the mask of rules they fail; rejected ones carry themselves as they were."""
    rejected = F.col(FAILED) != 0
    return raw.withColumn(FAILED, failed_rules(rules)).withColumns(
        {REJECTED: rejected, RAW_ROW: F.when(rejected, F.struct(*raw.columns))}
    )
