"""Random inputs against plain Python."""

import random
import re

from pyspark.sql import functions as F

from publicspend.functions import text
from publicspend.operators import rollups
from tables import by_key, table

NUMBER = re.compile(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", re.ASCII)


def number(value):
    return float(value) if NUMBER.fullmatch(value) else None


def test_amounts(spark):
    rng = random.Random(1)
    values = ["".join(rng.choices("0123456789.,.,eE+- dfxn", k=rng.randrange(9))) for _ in range(5000)]
    values += [f"{rng.randrange(10**6)},{rng.randrange(100):02}" for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(
        "v",
        text.comma_decimal(F.col("v")).alias("comma"),
        text.italian_number(F.col("v")).alias("italian"),
    ).collect()
    assert len(rows) == 6000
    for row in rows:
        assert row.comma == number(row.v.replace(",", ".")), row.v
        assert row.italian == number(row.v.replace(".", "").replace(",", ".")), row.v
    assert sum(r.comma is not None for r in rows) > 1500


def test_one_location_per_project(spark):
    rng = random.Random(2)
    rows = [
        (
            str(rng.randrange(200)),
            *(rng.choice([None, "A", "B", "a", "À", ""]) for _ in range(4)),
            rng.choice(["ITALIA", "FRANCIA", None]),
        )
        for _ in range(3000)
    ]

    def order(row):
        _, region, province, town, code, state = row
        return [state != "ITALIA"] + [
            (v is None, (v or "").encode()) for v in (town, province, region, code)
        ]

    best = {}
    for row in rows:
        if row[0] not in best or order(row) < order(best[row[0]]):
            best[row[0]] = row
    found = by_key(rollups.preferred_location(table(spark, "locations", rows)))
    assert {k: tuple(r) for k, r in found.items()} == {k: tuple(r[:5]) for k, r in best.items()}


def test_one_recovery_row_per_project(spark):
    rng = random.Random(3)
    rows = [
        (str(rng.randrange(100)), rng.choice("MN"), rng.choice([None, "x", "y"]),
         rng.choice([None, 0.0, 1.5, -2.0, 9.0]), rng.choice([None, 1.0, 2.0]))
        for _ in range(1000)
    ]

    def order(row):
        return [(v is not None, v if v is not None else 0) for v in (row[3], *row[1:3], row[4])]

    best = {}
    for row in rows:
        key = row[0]
        if key not in best or _above(order(row), order(best[key])):
            best[key] = row
    found = by_key(rollups.recovery_project(table(spark, "recovery_projects", rows)))
    assert {k: r.pnrr_fin_pnrr for k, r in found.items()} == {k: r[3] for k, r in best.items()}
    assert {k: tuple(r) for k, r in found.items()} == {k: (r[0], r[1], r[2], r[3], r[4]) for k, r in best.items()}


def _above(one, other):
    for a, b in zip(one, other):
        if a[0] != b[0]:
            return a[0]
        if a[0] and a[1] != b[1]:
            return a[1] > b[1]
    return False
