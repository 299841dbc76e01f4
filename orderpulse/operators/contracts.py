"""Declarative data-quality contracts.

A contract is a query for failing rows; none means it passes. `dq_report` runs a set of
contracts with one scan of each table: unique, accepted-values, foreign-key and row-level
ones of a table share one counted explode.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from orderpulse import vocabulary as v

STAGE_TIMES = ("placed_at", "confirmed_at", "prepared_at", "picked_up_at", "delivered_at")
# No stage before the one ahead of it.
LIFECYCLE_ORDER = " AND ".join(f"{a} <= {b}" for a, b in zip(STAGE_TIMES, STAGE_TIMES[1:]))


# ---- failing rows --------------------------------------------------------------------


def unique_failures(rows: DataFrame, column: str) -> DataFrame:
    """Non-null values seen more than once."""
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def not_null_failures(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def accepted_values_failures(
    rows: DataFrame, column: str, values: tuple[str, ...], time: str | None = None
) -> DataFrame:
    """Values outside the list, one row each, with their count and first and last time seen."""
    seen = [F.count(F.lit(1)).alias("rows")]
    if time:
        seen += [F.min(time).alias("first_seen"), F.max(time).alias("last_seen")]
    return rows.filter(~F.col(column).isin(*values)).groupBy(column).agg(*seen)


def outside_range(column: str, low=None, high=None) -> Column:
    """True where the value is known and out of range."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return bad


def accepted_range_failures(rows: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return rows.filter(outside_range(column, low, high))


def expression_failures(rows: DataFrame, expression: str) -> DataFrame:
    """Rows where the expression is false; an unknown result passes."""
    return rows.filter(~F.expr(expression))


def relationship_failures(
    child: DataFrame, keys: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Key values without a parent: key_name, key_value, rows.

    `keys` maps child column -> (parent, parent column). The child is read once for all
    keys and reduced to distinct values before the anti join, so a hot orphan key is one
    row there. NULL keys pass.
    """
    pairs = F.array(*[_key_pair(name, F.col(name)) for name in keys])
    known = reduce(
        DataFrame.unionByName,
        [
            parent.select(_key_pair(name, F.col(column)).alias("key"))
            for name, (parent, column) in keys.items()
        ],
    ).select("key.*")
    used = (
        child.select(F.explode(pairs).alias("key"))
        .select("key.*")
        .filter(F.col("key_value").isNotNull())
        .groupBy("key_name", "key_value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return used.join(known, ["key_name", "key_value"], "left_anti")


def _key_pair(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key_name"), value.cast("string").alias("key_value"))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is known but has no parent, counted per key."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


# ---- one report over many contracts --------------------------------------------------


@dataclass(frozen=True)
class Unique:
    table: str
    column: str
    name: str = field(default="unique", init=False)


@dataclass(frozen=True)
class AcceptedValues:
    table: str
    column: str
    values: tuple[str, ...]
    name: str = field(default="accepted_values", init=False)


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    parent_column: str
    name: str = field(default="relationships", init=False)


@dataclass(frozen=True)
class RowRule:
    """A contract decided by each row alone; `failing` is true for a failing row."""

    name: str
    table: str
    column: str
    failing: Column


def not_null(table: str, column: str) -> RowRule:
    return RowRule("not_null", table, column, F.col(column).isNull())


def accepted_range(table: str, column: str, low=None, high=None) -> RowRule:
    return RowRule("accepted_range", table, column, outside_range(column, low, high))


def expression_is_true(table: str, label: str, expression: str) -> RowRule:
    return RowRule("expression_is_true", table, label, ~F.expr(expression))


def standard_contracts() -> list:
    """The contracts of the clean event table and the gold layer."""
    return [
        Unique("silver", "event_id"),
        not_null("silver", "event_id"),
        AcceptedValues("fct_order_events", "event_type", v.EVENT_TYPES),
        accepted_range("fct_orders", "gmv", low=0),
        expression_is_true("fct_orders", "lifecycle_order", LIFECYCLE_ORDER),
        Relationship("fct_orders", "vendor_id", "dim_vendor", "vendor_id"),
        Relationship("fct_orders", "customer_id", "dim_customer", "customer_id"),
        Relationship("fct_orders", "driver_id", "dim_driver", "driver_id"),
    ]


def contracts_of(table: str) -> list:
    return [rule for rule in standard_contracts() if rule.table == table]


def severity_for(target: str) -> str:
    """Failures block in CI and are only reported elsewhere."""
    return "error" if target == "ci" else "warn"


def dq_report(tables: dict[str, DataFrame], contracts: list, severity: str) -> DataFrame:
    """contract, table_name, column_name, failures, severity, status — one row per contract.

    Each table is read once for all of its contracts."""
    names = dict.fromkeys(rule.table for rule in contracts)
    parts = [_counts(tables, name, [rule for rule in contracts if rule.table == name]) for name in names]
    failed = F.col("failures") > 0
    status = F.when(~failed, "pass").otherwise("fail" if severity == "error" else "warn")
    return reduce(DataFrame.unionByName, parts).withColumns(
        {"severity": F.lit(severity), "status": status}
    )


def _line(rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("contract"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    )


def _entry(rule) -> tuple[Column, Column]:
    """Which rows a contract looks at, and the value that it looks at."""
    if isinstance(rule, RowRule):
        return rule.failing, F.lit(None).cast("string")
    value = F.col(rule.column)
    wanted = ~value.isin(*rule.values) if isinstance(rule, AcceptedValues) else value.isNotNull()
    return wanted, value.cast("string")


def _failures(tag: int, rule) -> Column:
    """Failures of a contract from the counted (tag, value): repeated, unlisted or unknown values, or failing rows."""
    own = F.col("tag") == tag
    if isinstance(rule, Unique):
        return F.count_if(own & (F.col("copies") > 1))
    if isinstance(rule, AcceptedValues):
        return F.count_if(own)
    failing = own & F.col("known").isNull() if isinstance(rule, Relationship) else own
    return F.coalesce(F.sum(F.when(failing, F.col("copies"))), F.lit(0))


def _counts(tables: dict[str, DataFrame], name: str, rules: list) -> DataFrame:
    """Every row becomes (tag, value) for each contract that looks at it; these are counted before and after one shuffle."""
    entries = []
    for tag, rule in enumerate(rules):
        wanted, value = _entry(rule)
        entries.append(F.when(wanted, F.struct(F.lit(tag).alias("tag"), value.alias("value"))))
    tagged = tables[name].select(F.inline(F.filter(F.array(*entries), lambda entry: entry.isNotNull())))
    counted = tagged.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("copies"))
    parents = [
        tables[rule.parent].select(F.lit(tag).alias("tag"), F.col(rule.parent_column).cast("string").alias("value")).distinct()
        for tag, rule in enumerate(rules)
        if isinstance(rule, Relationship)
    ]
    if parents:
        known = reduce(DataFrame.union, parents).withColumn("known", F.lit(True))
        counted = counted.join(known, ["tag", "value"], "left")
    sums = counted.agg(*[_failures(tag, rule).alias(f"n{tag}") for tag, rule in enumerate(rules)])
    lines = F.array(*[_line(rule, F.col(f"n{tag}")) for tag, rule in enumerate(rules)])
    return sums.select(F.inline(lines))


class ContractViolation(Exception):
    """Raised when a contract of severity error has failing rows."""


def enforce(report: DataFrame) -> list[Row]:
    """Run a report and stop on failed contracts. It has one row per contract."""
    lines = report.collect()
    failed = [line for line in lines if line.status == "fail"]
    if failed:
        raise ContractViolation(
            ", ".join(f"{r.contract}({r.table_name}.{r.column_name}): {r.failures}" for r in failed)
        )
    return lines
