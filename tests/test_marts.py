import random
import statistics

import pytest
from pyspark.sql import functions as F

from publicspend.operators.median import group_medians
from publicspend.plans import marts, reports
from publicspend.plans.compose import wide_register
from publicspend.sources.proxy import Proxy
from tables import SCHEMAS, support


def register_of(spark, groups):
    """A register with the given number of rows per (sector, cost)."""
    rows = []
    for (sector, cost), n in groups.items():
        for _ in range(n):
            rows.append((f"C{len(rows)}", 2020, "ATTIVO", cost, None, cost, "S", sector, "d", False, False))
    return wide_register(spark.createDataFrame(rows, SCHEMAS["projects"]), support(spark))


def test_group_floor_and_unknown_labels(spark):
    wide = register_of(spark, {("A", 1e9): 9, ("B", 5e8): 10, (None, None): 10})
    rows = marts.territory_mart(wide).collect()
    assert [(r.regione, r.settore_intervento, r.n_cup, r.costo_mld) for r in rows] == [
        ("SCONOSCIUTA", "B", 10, 5.0),
        ("SCONOSCIUTA", "SCONOSCIUTO", 10, 0.0),
    ]
    assert [r.settore_intervento for r in marts.funding_mart(wide).collect()] == ["B", "SCONOSCIUTO"]
    assert marts.funding_mart(wide, min_group=1).count() == 3
    assert marts.cost_mart(wide).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 500, 501])
def test_median_against_brute_force(spark, size):
    rng = random.Random(size)
    groups = {
        "spread": [round(rng.uniform(-100, 5000), 2) for _ in range(size)],
        "ties": [round(rng.choice([-1.5, 0.0, -0.0, 3.25]), 2) for _ in range(size)],
        "tail": [rng.choice([1, -1]) * 10 ** rng.uniform(-3, 70) for _ in range(size)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("none", None), ("ties", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r["median"] for r in group_medians(df, ["g"], "v").collect()}
    expected = {g: statistics.median(v) for g, v in groups.items()}
    assert set(found) == set(expected)
    assert all(found[g] == pytest.approx(expected[g], rel=1e-12) for g in expected)


def test_median_of_one_hot_value(spark):
    df = spark.range(3000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 10).alias("v")
    )
    values = [7.0 if i % 3 == 0 else i / 10 for i in range(3000)]
    assert group_medians(df, ["g"], "v").first()["median"] == statistics.median(values)


def test_report_arguments(spark, tiny):
    wide = Proxy(spark, tiny).wide().cache()
    odd = "x' OR '1'='1"
    assert reports.region_overview(wide, odd).first().n_cup == 0
    assert reports.project_card(wide, " 7 ").first().cup == "7"
    assert reports.project_card(wide, odd).count() == 0
    assert reports.cost_by_region(wide, 2).count() == 2
    names = [r[0] for r in reports.region_names(wide).collect()]
    known = [n for n in names if n is not None]
    assert names[: len(known)] == sorted(known)
    counts = [r.n_cup for r in reports.top_regions(wide).collect()]
    assert counts == sorted(counts, reverse=True) and len(counts) <= 5
    total = wide.count()
    assert sum(r.n_cup for r in marts.territory_mart(wide).collect()) <= total
    assert sum(r.n for r in reports.status_counts(wide).collect()) == total


def test_works_reports_on_no_works(spark):
    wide = register_of(spark, {("A", 1.0): 2})
    assert reports.works_overview(wide).first().n == 0
    assert reports.top_works(wide).count() == 0
