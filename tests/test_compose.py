import pytest
from pyspark.sql import functions as F

from publicspend.operators import rollups
from publicspend.operators.joins import hot_keys, is_hot, left_join_all
from publicspend.plans.compose import area_of, register_with_support, wide_register
from publicspend.rules import CENTRE, NORTH
from publicspend.sources.proxy import PROXY_RULES, Proxy
from tables import by_key, projects, support, table


def test_preferred_location(spark):
    home, abroad = "ITALIA", "FRANCIA"
    rows = [
        ("TWO", "R", "P", "ROMA", "2", home), ("TWO", "R", "P", "BARI", "1", home),
        ("MIX", "R", "P", "PARIGI", "1", abroad), ("MIX", "R", "P", "ROMA", "2", home),
        ("AWAY", "R", "P", "PARIGI", "1", abroad),
        ("NULLTOWN", "R", "P", None, "1", home), ("NULLTOWN", "R", "P", "ZARA", "2", home),
        ("SAME", "R", "Q", "CASTRO", "1", home), ("SAME", "R", "P", "CASTRO", "2", home),
        ("NOSTATE", "R", "P", "A", "1", None), ("NOSTATE", "R", "P", "Z", "2", home),
    ]
    found = by_key(rollups.preferred_location(table(spark, "locations", rows)))
    assert {k: (r.comune, r.provincia) for k, r in found.items()} == {
        "TWO": ("BARI", "P"),
        "MIX": ("ROMA", "P"),
        "AWAY": ("PARIGI", "P"),
        "NULLTOWN": ("ZARA", "P"),
        "SAME": ("CASTRO", "P"),
        "NOSTATE": ("Z", "P"),
    }


def test_funding_flags(spark):
    rows = [("A", "STATALE"), ("A", "STATALE"), ("A", "PRIVATA"), ("B", None), ("C", "COMUNITARIA")]
    found = by_key(rollups.funding_flags(table(spark, "funding", rows)))
    flags = ("n_fonti", "ha_fonte_statale", "ha_fonte_ue", "ha_fonte_regionale", "ha_fonte_privata")
    assert {k: tuple(r[f] for f in flags) for k, r in found.items()} == {
        "A": (3, True, False, False, True),
        "B": (1, False, False, False, False),
        "C": (1, False, True, False, False),
    }


def test_recovery_rows(spark):
    rows = [
        ("A", "M1", "x", 5.0, 9.0), ("A", "M2", "y", 7.0, 8.0), ("A", "M3", "z", None, 99.0),
        ("B", "M1", "x", 1.0, 1.0), ("B", "M2", "x", 1.0, 1.0),
        (" ", "M1", "x", 1.0, 1.0), (None, "M1", "x", 1.0, 1.0), (" A", "M9", "x", 50.0, 1.0),
    ]
    found = by_key(rollups.recovery_project(table(spark, "recovery_projects", rows)))
    assert {k: r.pnrr_missione for k, r in found.items()} == {"A": "M2", "B": "M2", " A": "M9"}
    wide = wide_register(projects(spark, "A"), support(spark, recovery_projects=rows)).first()
    assert (wide.pnrr_missione, wide.pnrr_fin_pnrr) == ("M2", 7.0)


def test_recovery_and_cohesion_sums(spark):
    extra = {
        "recovery_tenders": [("A", 1.0), ("A", None), ("", 5.0)],
        "recovery_payments": [("A", 2.0, None), ("A", None, 3.0)],
        "cohesion_projects": [("A", None), ("A", 4.0), (None, 1.0)],
    }
    row = wide_register(projects(spark, "A", "B"), support(spark, **extra)).where("cup='A'").first()
    assert (row.pnrr_n_gare, row.pnrr_importo_aggiudicato) == (2, 1.0)
    assert (row.pag_pagato_pnrr, row.pag_pagato_totale) == (2.0, 3.0)
    assert (row.coe_n_progetti, row.coe_finanz_tot_pubblico, row.n_fonti_lab) == (2, 4.0, 1)


def test_plan_amount_missing_or_zero_is_no_source(spark):
    extra = {"recovery_projects": [("A", "M", "x", None, 1.0), ("B", "M", "x", 0.0, 1.0)]}
    rows = by_key(wide_register(projects(spark, "A", "B"), support(spark, **extra)))
    assert [(r.con_almeno_una_fonte_lab, r.n_fonti_lab) for r in rows.values()] == [(False, 0)] * 2
    assert rows["A"].pnrr_fin_pnrr == 0.0


def test_strategic_row(spark):
    rows = [
        ("A", "none", "S", "s", "m", None, 1.0, None), ("A", "low", "S", "s", "m", 1.0, 1.0, 0.0),
        ("A", "high", "S", "s", "m", 9.0, 1.0, 8.0), ("B", "only", "S", "s", "m", None, 1.0, None),
        (None, "x", "S", "s", "m", 99.0, 1.0, 1.0),
    ]
    found = by_key(rollups.strategic_project(table(spark, "works", rows)))
    assert {k: r.silos_denominazione for k, r in found.items()} == {"A": "high", "B": "only"}


def test_nothing_known_about_a_project(spark):
    row = wide_register(projects(spark, "A"), support(spark)).first()
    zero = [c for c in ("n_fonti", "anac_n_cig", "pnrr_n_gare", "coe_n_progetti") if row[c] != 0]
    assert zero == []
    unknown = ("anac_importo_base", "anac_importo_consuntivo", "anac_importo_base_appaiata",
               "anac_importo_consuntivo_appaiato", "anac_scostamento_pct", "anac_data_ultima_agg",
               "regione", "silos_costi_mln")
    assert all(row[c] is None for c in unknown)
    assert row.area == "SUD+ISOLE" and row.anac_base_sospetta is False


@pytest.mark.parametrize(
    "regions, area",
    [
        (NORTH, "NORD"),
        (CENTRE, "CENTRO"),
        (("SICILIA", "PUGLIA", "lombardia", "EMILIA ROMAGNA", "BAVIERA", None), "SUD+ISOLE"),
    ],
)
def test_area(spark, regions, area):
    df = spark.createDataFrame([(r,) for r in regions], "regione string")
    assert {r[0] for r in df.select(area_of(F.col("regione"))).collect()} == {area}


def test_hot_keys_are_bounded_and_include_null(spark):
    rows = [(None,)] * 40 + [("H",)] * 30 + [(f"k{i}",) for i in range(30)]
    found = hot_keys(spark.createDataFrame(rows, "cup string"), "cup", share=0.1)
    assert set(found) == {None, "H"}
    unique = spark.createDataFrame([("a",), ("b",)], "cup string")
    assert hot_keys(unique, "cup") == []


def test_many_hot_keys_among_many_others(spark):
    """100 keys of 0.5 % each and 50,000 others."""
    i = F.col("id")
    keys = F.when(i % 2 == 0, F.concat(F.lit("h"), i / 2 % 100)).otherwise(F.concat(F.lit("k"), i))
    found = hot_keys(spark.range(100_000).select(keys.alias("cup")), "cup")
    assert set(found) == {f"h{float(n)}" for n in range(100)}


def test_no_job_runs_while_the_register_is_composed(spark, tiny):
    proxy = Proxy(spark, tiny)
    for name in "region nation customer supplier part orders lineitem events documents".split():
        proxy.table(name)
    spark.sparkContext.setJobGroup("composing", "")
    try:
        proxy.wide()
        proxy.register_with_support()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("composing")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_is_hot_splits_in_two(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")

    def picked(hot):
        return [r.h for r in df.select(is_hot(F.col("k"), hot).alias("h")).collect()]

    assert picked(["a"]) == [True, False, False]
    assert picked([None]) == [False, False, True]
    assert picked(["a", None]) == [True, False, True]


def test_split_join_equals_plain_join(spark):
    base = spark.createDataFrame(
        [(None, 0)] * 30 + [("H", i) for i in range(30)] + [(f"k{i}", i) for i in range(30)],
        "cup string, v int",
    )
    left = spark.createDataFrame([(f"k{i}", i) for i in range(0, 30, 2)] + [("H", -1)], "cup string, a int")
    right = spark.createDataFrame([("H", "x"), ("k1", "y"), ("other", "z")], "cup string, b string")
    sides = [df.groupBy("cup").agg(F.max(df.columns[1]).alias(df.columns[1])) for df in (left, right)]
    plain = left_join_all(base, sides, "cup")
    for hot in ([None, "H"], ["H"], [None], ["absent"]):
        split = left_join_all(base, sides, "cup", hot)
        assert split.columns == plain.columns and split.count() == base.count()
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_wide_register_with_a_hot_key(spark, tiny):
    proxy = Proxy(spark, tiny)
    repeated = proxy.projects().where("cup = '7'").crossJoin(spark.range(700)).drop("id")
    unknown = repeated.withColumn("cup", F.lit(None).cast("string"))
    base = proxy.projects().unionByName(repeated).unionByName(unknown)
    hot = hot_keys(base, "cup", share=0.1)
    assert set(hot) == {None, "7"}
    plain = wide_register(base, proxy.support(), PROXY_RULES)
    split = wide_register(base, proxy.support(), PROXY_RULES, hot)
    same = ["cup", "regione", "n_fonti", "anac_n_cig", "n_fonti_lab", "silos_denominazione"]
    assert split.count() == base.count()
    assert plain.select(same).exceptAll(split.select(same)).count() == 0
    assert split.select(same).exceptAll(plain.select(same)).count() == 0


def test_register_with_support(spark, tiny):
    proxy = Proxy(spark, tiny)
    full = register_with_support(proxy.projects(), proxy.locations(), proxy.funding(), PROXY_RULES)
    assert len(full.columns) == 29
    assert full.count() == proxy.projects().count()


def test_register_with_support_saves_two_sides(spark, tiny):
    proxy = Proxy(spark, tiny)
    short = wide_register(proxy.register_with_support(), proxy.support(), PROXY_RULES)
    full = proxy.wide()
    same = [c for c, t in full.dtypes if t != "double"]
    assert short.columns == full.columns
    assert short.select(same).exceptAll(full.select(same)).count() == 0
    assert short.count() == full.count()


def test_unused_sides_are_not_joined(spark, tiny):
    slim = Proxy(spark, tiny).wide().groupBy("stato_progetto").agg(F.sum("costo_progetto"))
    plan = slim._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lineitem" not in plan


def test_one_exchange_per_input(spark, tiny):
    """No side is shuffled again between the joins, and nothing is expanded."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Proxy(spark, tiny).wide()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Expand" not in plan
    on_project = [ln for ln in plan.split("\n") if "Exchange hashpartitioning(cup#" in ln.replace("CUP", "cup")]
    assert len(on_project) == 9  # the register and eight sides
