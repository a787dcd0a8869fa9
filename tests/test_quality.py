import datetime as dt

import pytest

from publicspend.operators import quality
from publicspend.operators.quality import Contract, QualityError


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", 1, dt.date(2024, 1, 10)), ("b", None, dt.date(2024, 1, 1)), ("b", 3, None),
            (None, 4, None)]
    return spark.createDataFrame(data, "k string, v int, d date")


def results(checks):
    return {(r.rule, r.column): (r.observed, r.expected, r.passed) for r in checks.collect()}


def test_all_rules(rows):
    contract = Contract(
        required_columns=("k", "gone"),
        not_null=("k", "v"),
        min_rows=5,
        primary_key=("k",),
        at_least={"v > 1": 2},
        max_age={"d": 30},
    )
    assert results(quality.check(rows, contract, as_of=dt.date(2024, 2, 10))) == {
        ("required_column", "k"): (1, 1, True),
        ("required_column", "gone"): (0, 1, False),
        ("not_null", "k"): (1, 0, False),
        ("not_null", "v"): (1, 0, False),
        ("min_rows", "*"): (4, 5, False),
        ("at_least", "v > 1"): (2, 2, True),
        ("max_age", "d"): (31, 30, False),
        ("primary_key", "k"): (1, 0, False),
    }


def test_enforce(rows):
    quality.enforce(quality.check(rows, Contract(min_rows=4)))
    with pytest.raises(QualityError, match=r"min_rows\(\*\): 4, expected 5"):
        quality.enforce(
            quality.check(rows, Contract(min_rows=5)), quality.check(rows, Contract(min_rows=1))
        )


def test_empty_table_has_no_fresh_date(spark, rows):
    empty = rows.where("false")
    found = results(quality.check(empty, Contract(max_age={"d": 30}, min_rows=1, not_null=("k",))))
    assert found[("max_age", "d")][2] is False
    assert found[("min_rows", "*")] == (0, 1, False)


def test_absent_column_fails_whatever_rule_names_it(rows):
    contract = Contract(not_null=("x", "k"), primary_key=("y",), max_age={"z": 1})
    found = results(quality.check(rows, contract))
    assert {c for (rule, c), (_, _, passed) in found.items() if not passed} == {"x", "y", "z", "k"}
    assert set(found) == {("required_column", c) for c in "xyz"} | {("not_null", "k")}


def test_contract_without_rules(rows):
    assert quality.check(rows, Contract()).count() == 0


def test_same_rows_and_missing_tables(rows):
    assert results(quality.same_rows_check(rows, rows)) == {("same_rows", "*"): (4, 4, True)}
    assert results(quality.same_rows_check(rows, rows.limit(3)))[("same_rows", "*")][2] is False
    assert quality.missing_tables(["a"], ["a", "b"]) == ["b"]
