"""Data-quality rules as Spark aggregations.

Every check is a table ``rule, column, observed, expected, passed``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from publicspend.sources.tables import Facts

CHECK_FIELDS = "rule: string, column: string, observed: bigint, expected: bigint, passed: boolean"


class QualityError(RuntimeError):
    """Raised when a table breaks its contract; the message lists the broken rules."""


@dataclass(frozen=True)
class Contract:
    """What a table must hold. ``at_least`` maps an SQL condition to a minimum row count;
    ``max_age`` maps a date column to the most days its latest value may lie back."""

    required_columns: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    min_rows: int | None = None
    primary_key: tuple[str, ...] = ()
    at_least: dict[str, int] = field(default_factory=dict)
    max_age: dict[str, int] = field(default_factory=dict)


def check(df: DataFrame, contract: Contract, as_of: dt.date | None = None) -> DataFrame:
    """One pass over ``df`` for counts and NULLs, one shuffle more for the primary key.

    A column that a rule names and the table lacks fails as a required one. Where the table is
    being written, a ``Watch`` does without both.
    """
    rules = contract_rules(df.columns, contract, as_of)
    result = df.agg(_rules([rule.row() for rule in rules])).select(F.inline("rules"))
    if contract.primary_key and set(df.columns).issuperset(contract.primary_key):
        result = result.unionAll(primary_key_check(df, contract.primary_key))
    return result


@dataclass(frozen=True)
class Rule:
    """One figure over all rows of a table and its limit."""

    name: str
    column: str
    figure: Column
    expected: int
    at_least: bool = False

    def row(self) -> Column:
        return _rule(self.name, self.column, self.figure, self.expected, self.at_least)

    def judged(self, observed: int | None) -> Row:
        passed = observed is not None and (
            observed >= self.expected if self.at_least else observed <= self.expected
        )
        return Row(
            rule=self.name,
            column=self.column,
            observed=observed,
            expected=self.expected,
            passed=passed,
        )


def contract_rules(
    columns: list[str], contract: Contract, as_of: dt.date | None = None
) -> list[Rule]:
    """The rules of a contract but for the primary key."""
    present = set(columns)
    used = (*contract.not_null, *contract.primary_key, *contract.max_age)
    absent = [c for c in dict.fromkeys(used) if c not in present]
    required = dict.fromkeys([*contract.required_columns, *absent])
    rules = [Rule("required_column", c, F.lit(int(c in present)), 1, True) for c in required]
    rules += [
        Rule("not_null", c, F.count_if(F.col(c).isNull()), 0)
        for c in contract.not_null
        if c in present
    ]
    if contract.min_rows is not None:
        rules.append(Rule("min_rows", "*", F.count("*"), contract.min_rows, True))
    rules += [
        Rule("at_least", condition, F.count_if(F.expr(condition)), floor, True)
        for condition, floor in contract.at_least.items()
    ]
    today = F.lit(as_of) if as_of else F.current_date()
    rules += [
        Rule("max_age", c, F.date_diff(today, F.max(c)), days)
        for c, days in contract.max_age.items()
        if c in present
    ]
    return rules


class Watch:
    """Contracts measured while a table is written, without another scan of it.

    A primary key is held by counting the rows of each key beside them, which needs neither shuffle
    nor sort where the rows lie by the key already, as after a join on it or in buckets. Spark takes
    the figures of each writing task once, also when it had to be repeated. ``key`` names the columns whose
    fingerprint is taken, to tell whether another table holds the same keys.
    """

    def __init__(
        self, *contracts: Contract, key: tuple[str, ...] = (), as_of: dt.date | None = None
    ):
        self.contracts, self.key, self.as_of = contracts, key, as_of
        self.observation = Observation()
        self.rules: list[Rule] = []

    def over(self, df: DataFrame) -> DataFrame:
        """The same rows; once they are written, the figures are known."""
        columns = df.columns
        self.rules = [r for c in self.contracts for r in contract_rules(columns, c, self.as_of)]
        numbers = {}
        for key in dict.fromkeys(c.primary_key for c in self.contracts):
            if key and set(columns).issuperset(key):
                name = f"_of_key_{len(numbers)}"
                numbers[name] = F.count("*").over(Window.partitionBy(*key))
                share = F.when(F.col(name) > 1, 1 / F.col(name))
                repeated = F.round(F.coalesce(F.sum(share), F.lit(0.0)))
                self.rules.append(Rule("primary_key", ",".join(key), repeated, 0))
        figures = {f"rule_{i}": rule.figure.cast("bigint") for i, rule in enumerate(self.rules)}
        figures["rows"] = F.count("*")
        if self.key:
            figures["keys"] = fingerprint(self.key)
        watched = df.withColumns(numbers) if numbers else df
        named = [figure.alias(name) for name, figure in figures.items()]
        return watched.observe(self.observation, *named).select(*map(_quoted, columns))

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    @property
    def keys(self) -> int | None:
        return self.observation.get.get("keys") if self.key else None

    def checks(self) -> list[Row]:
        found = self.observation.get
        return [rule.judged(found[f"rule_{i}"]) for i, rule in enumerate(self.rules)]


def fingerprint(key: tuple[str, ...]) -> Column:
    """A sum over all rows that changes if a key is lost, added or replaced by another.

    It does not depend on the order of rows. Each key gives 60 bits of a hash, and the sum is taken
    modulo 2^62, so that two tables with other keys agree only by a chance of about 1 in 2^60.
    """
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in key]
    digits = F.substring(F.md5(F.concat_ws("\0", *marked)), 1, 15)
    hashed = F.conv(digits, 16, 10).cast("bigint")
    # summed in three parts of 20 bits, as whole numbers are added up faster than decimals
    total = F.lit(0).cast("decimal(38,0)")
    for shift in (40, 20, 0):
        part = F.sum(F.shiftright(hashed, shift).bitwiseAND(F.lit(0xFFFFF)))
        total = total + part.cast("decimal(20,0)") * F.lit(1 << shift).cast("decimal(13,0)")
    return F.coalesce(total % F.lit(1 << 62), F.lit(0)).cast("bigint")


def primary_key_check(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    rule = _rule("primary_key", ",".join(key), F.count("*"), 0)
    return repeated.agg(_rules([rule])).select(F.inline("rules"))


def same_rows_check(
    before: DataFrame, after: DataFrame, key: tuple[str, ...] = ()
) -> DataFrame:
    """A join that must keep every row and add none.

    With a ``key`` the keys must be the same too: a row lost and another doubled leave the number
    of rows as it was, but not the fingerprint of their keys.
    """
    keys = fingerprint(key) if key else F.lit(0).cast("bigint")
    both = [df.agg(F.count("*").alias("n"), keys.alias("keys")) for df in (before, after)]
    counts = both[0].select(F.lit(1).alias("one"), F.col("n").alias("n0"), F.col("keys").alias("k0"))
    counts = counts.unionByName(
        both[1].select(F.lit(1).alias("one"), F.col("n").alias("n1"), F.col("keys").alias("k1")),
        allowMissingColumns=True,
    ).groupBy("one").agg(*[F.max(c).alias(c) for c in ("n0", "n1", "k0", "k1")])
    rules = [("same_rows", "*", "n0", "n1")]
    if key:
        rules.append(("same_keys", ",".join(key), "k0", "k1"))
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.lit(column).alias("column"),
            F.col(observed).alias("observed"),
            F.col(expected).alias("expected"),
            (F.col(observed) == F.col(expected)).alias("passed"),
        )
        for name, column, expected, observed in rules
    ]
    return counts.select(_rules(rows)).select(F.inline("rules"))


def same_rows(before: Facts, after: Watch) -> list[Row]:
    """The same, from what was counted when the two tables were written."""
    pairs = [("same_rows", "*", before.rows, after.rows)]
    if before.keys is not None and after.keys is not None:
        pairs.append(("same_keys", ",".join(after.key), before.keys, after.keys))
    return [
        Row(rule=rule, column=column, observed=new, expected=old, passed=old == new)
        for rule, column, old, new in pairs
    ]


def missing_tables(present: list[str], required: list[str]) -> list[str]:
    return sorted(set(required) - set(present))


def tables_check(present: list[str], required: list[str]) -> DataFrame:
    """One row per required table: whether it is there."""
    spark = SparkSession.active()
    rules = [
        _rule("required_table", name, F.lit(int(name in present)), 1, at_least=True)
        for name in required
    ]
    return spark.range(1).select(_rules(rules)).select(F.inline("rules"))


def enforce(*checks: DataFrame) -> None:
    """Raise if any rule failed. Checks hold one row per rule, so few rows come back."""
    enforce_rows(reduce(DataFrame.unionAll, checks).collect())


def enforce_rows(checks: list[Row]) -> None:
    failed = [check for check in checks if not check.passed]
    if failed:
        lines = [f"{r.rule}({r.column}): {r.observed}, expected {r.expected}" for r in failed]
        raise QualityError("; ".join(lines))


def as_table(spark: SparkSession, checks: list[Row]) -> DataFrame:
    return spark.createDataFrame(checks, CHECK_FIELDS.replace(":", ""))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _rules(rules: list[Column]) -> Column:
    return F.array(*rules).cast(f"array<struct<{CHECK_FIELDS}>>").alias("rules")


def _rule(
    name: str, column: str, observed: Column, expected: int, at_least: bool = False
) -> Column:
    observed = observed.cast("bigint")
    passed = observed >= expected if at_least else observed <= expected
    return F.struct(
        F.lit(name).alias("rule"),
        F.lit(column).alias("column"),
        observed.alias("observed"),
        F.lit(expected).cast("bigint").alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )
