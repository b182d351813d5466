"""Expectations, key checks and coverage measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.operators.joins import keys_of


class ExpectationFailed(Exception):
    """Rows broke a rule that must hold."""


class DuplicateKeys(Exception):
    """A key that must be unique is repeated."""


@dataclass(frozen=True)
class Rule:
    """A named row condition; ``action`` is fail, drop or warn."""

    name: str
    condition: str
    action: str = "warn"

    def holds(self) -> Column:
        """True where the row satisfies the rule; an unknown result does not."""
        return F.coalesce(F.expr(self.condition), F.lit(False))


def expect_or_fail(name: str, condition: str) -> Rule:
    return Rule(name, condition, "fail")


def expect_or_drop(name: str, condition: str) -> Rule:
    return Rule(name, condition, "drop")


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every drop rule."""
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.holds())
    return df


def _rule_counts(rules: Sequence[Rule]) -> list[Column]:
    counts = []
    for i, rule in enumerate(rules):
        counts += [F.count_if(rule.holds()).alias(f"p{i}"), F.count_if(~rule.holds()).alias(f"f{i}")]
    return counts


def rule_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: dataset, rule, action, passed, failed. A single pass over the data."""
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col(f"p{i}").alias("passed"),
            F.col(f"f{i}").alias("failed"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*_rule_counts(rules)).select(F.inline(F.array(*entries)))


class RuleWatch:
    """Counts how rows fare under the rules while they are being written, without another pass."""

    SCHEMA = "dataset string, rule string, action string, passed bigint, failed bigint"

    def __init__(self, rules: Sequence[Rule], dataset: str):
        self.rules, self.dataset = list(rules), dataset
        self._observation = Observation(dataset)

    def watched(self, df: DataFrame) -> DataFrame:
        """``df`` without the rows that drop rules reject; counting happens before the rejection."""
        return keep_valid(df.observe(self._observation, *_rule_counts(self.rules)), self.rules)

    def counts(self) -> list[tuple]:
        seen = self._observation.get
        return [
            (self.dataset, rule.name, rule.action, seen.get(f"p{i}", 0), seen.get(f"f{i}", 0))
            for i, rule in enumerate(self.rules)
        ]

    def enforce(self) -> None:
        """Raise if a fail rule was broken."""
        broken = [f"{rule} ({failed} rows)" for _, rule, action, _, failed in self.counts() if action == "fail" and failed]
        if broken:
            raise ExpectationFailed(f"{self.dataset}: {', '.join(broken)}")

    def metrics(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.counts(), self.SCHEMA)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def unique_vs_total(df: DataFrame, key: str) -> DataFrame:
    """One row: all rows and distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("unique_keys"))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if some key is repeated, with one of them."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise DuplicateKeys(f"repeated key {[found[0][k] for k in keys]} in {list(keys)}")


def primary_key_check(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row: rows with a null key part, and keys that occur more than once."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~missing & (F.col("n") > 1)).alias("duplicate_keys"),
    ).select(F.lit(table).alias("table_name"), "null_keys", "duplicate_keys")


def foreign_key_check(child: DataFrame, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """One row: rows whose key has no parent. Null keys are allowed.

    The child shrinks to one row per key before the join.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(parent_key))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = used.join(keys_of(parent, parent_key), parent_key, "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")
    ).select(F.lit(name).alias("constraint_name"), "orphan_rows", "orphan_keys")


@dataclass(frozen=True)
class ForeignKey:
    """A column of a child table whose values must be among a parent table's key."""

    child: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


def foreign_keys_check(tables: Mapping[str, DataFrame], constraints: Sequence[ForeignKey]) -> DataFrame:
    """One row per constraint: rows whose key has no parent, and such keys. Null keys are allowed.

    Every child is read once for all its constraints, every parent once for
    all of them: each row is stacked to its keys under the numbers of the
    constraints. Uses of a key and the key itself then meet in one grouping,
    counted before they move and held as two counters per key; a used key
    without a parent is an orphan. Whole numbers are compared as such.
    Otherwise keys are compared as text, so a child's column and its
    parent's key must be of one type.
    """
    if not constraints:
        raise ValueError("no foreign keys to check")
    names = list(dict.fromkeys((c.name, c.parent, c.key) for c in constraints))
    uses: dict[str, list[tuple[int, str]]] = {}
    known: dict[str, list[tuple[int, str]]] = {}
    for c in constraints:
        uses.setdefault(c.child, []).append((names.index((c.name, c.parent, c.key)), c.column))
    for i, (_, parent, key) in enumerate(names):
        known.setdefault(parent, []).append((i, key))
    kinds = [tables[t].schema[column].dataType for side in (uses, known) for t, entries in side.items() for _, column in entries]
    kind = "bigint" if all(isinstance(k, IntegralType) for k in kinds) else "string"

    def stacked(table: str, entries: Sequence[tuple[int, str]], is_use: bool) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("number"), F.col(column).cast(kind).alias("key")) for i, column in entries]
        rows = tables[table].select(F.inline(F.array(*keys))).where("key is not null")
        return rows.withColumn("is_use", F.lit(is_use))

    sides = [stacked(t, entries, True) for t, entries in uses.items()] + [stacked(t, entries, False) for t, entries in known.items()]
    met = reduce(DataFrame.unionByName, sides).groupBy("number", "key").agg(
        F.count_if("is_use").alias("n"), F.max(~F.col("is_use")).alias("is_known")
    )
    orphans = met.where(~F.col("is_known")).groupBy("number").agg(F.sum("n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    # two parents of one column share its name and row
    label = F.array(*[F.lit(name) for name, _, _ in names])[F.col("number")]
    per_constraint = orphans.groupBy(label.alias("name")).agg(F.sum("orphan_rows").alias("orphan_rows"), F.sum("orphan_keys").alias("orphan_keys"))
    every = tables[constraints[0].child].sparkSession.createDataFrame([(c.name,) for c in constraints], "constraint_name string")
    zero = F.lit(0).cast("bigint")
    return every.join(per_constraint, F.col("constraint_name") == F.col("name"), "left").select(
        "constraint_name", F.coalesce("orphan_rows", zero).alias("orphan_rows"), F.coalesce("orphan_keys", zero).alias("orphan_keys")
    )


def partial_unique_check(df: DataFrame, condition: str, keys: Sequence[str]) -> DataFrame:
    """Keys repeated among the rows that satisfy the condition."""
    return duplicate_keys(df.filter(F.expr(condition)), keys)


def check_constraint(df: DataFrame, condition: str, name: str) -> DataFrame:
    """One row: rows that break a CHECK condition; an unknown result passes."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.coalesce(F.expr(condition), F.lit(True))).alias("violations"),
    ).select(F.lit(name).alias("constraint_name"), "total_rows", "violations")


def coverage(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """One row: share of rows where each named column is filled."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.avg(F.col(column).isNotNull().cast("int")).alias(out) for out, column in measures.items()],
    )
