import pytest
from pyspark.sql import functions as F

from publicspend.operators import procurement
from publicspend.plans.compose import WIDE_COLUMNS, procurement_of, wide_register
from publicspend.plans.marts import cost_mart
from publicspend.sources.proxy import PROXY_RULES, Proxy
from tables import PROCUREMENT, PROCUREMENT_CUPS, by_key, day, projects, support, table


@pytest.fixture(scope="module")
def wide(spark):
    df = wide_register(projects(spark, *PROCUREMENT_CUPS), support(spark, **PROCUREMENT))
    return df.cache()


@pytest.fixture(scope="module")
def rows(wide):
    return by_key(wide)


def test_one_row_per_project_and_all_columns(wide, rows):
    assert set(rows) == set(PROCUREMENT_CUPS)
    assert wide.count() == 5
    assert tuple(wide.columns) == tuple(WIDE_COLUMNS) and len(WIDE_COLUMNS) == 60


def test_real_project(rows):
    real = rows["CUP_REAL"]
    assert (real.anac_n_cig, real.anac_n_gare, real.anac_importo_aggiudicato) == (3, 1, 100.0)
    assert (real.anac_n_sal, real.anac_importo_sal, real.anac_sal_in_ritardo) == (2, 50.0, 1)
    assert (real.anac_importo_base, real.anac_importo_consuntivo) == (150.0, 150.0)
    assert (real.anac_n_cig_con_base, real.anac_n_cig_con_consuntivo) == (2, 2)
    assert (real.anac_n_cig_appaiati, real.anac_importo_base_appaiata) == (1, 100.0)
    assert (real.anac_scostamento_pct, real.anac_n_varianti_qe) == (20.0, 1)
    assert real.anac_data_ultima_agg == day(2024, 1, 1)


def test_missing_final_cost_stays_unknown(rows):
    row = rows["CUP_SENTINEL_CIG"]
    assert (row.anac_n_cig, row.anac_n_gare, row.anac_importo_base) == (1, 1, 10.0)
    assert row.anac_importo_consuntivo is None and row.anac_scostamento_pct is None


def test_suspect_base_is_flagged_and_left_out(rows):
    row = rows["CUP_SOSPETTO"]
    assert row.anac_base_sospetta is True and row.anac_importo_base is None
    assert (row.anac_n_cig, row.anac_n_cig_base_sospetta, row.anac_n_cig_base_grande) == (1, 1, 1)


def test_shared_tender_goes_to_lowest_code(rows):
    low, high = rows["CUP_MULTI_AA"], rows["CUP_MULTI_ZZ"]
    assert (low.anac_n_cig, low.anac_n_gare, low.anac_importo_aggiudicato) == (1, 1, 200.0)
    assert (low.anac_n_sal, low.anac_importo_sal) == (1, 5.0)
    assert high.anac_n_cig == 0 and high.con_almeno_una_fonte_lab is False
    assert all(r.con_almeno_una_fonte_lab for c, r in rows.items() if c != "CUP_MULTI_ZZ")
    assert not any(r.flag_ombrello for r in rows.values())


def test_cost_mart_populations(wide):
    group = cost_mart(wide, min_group=1).first()
    assert (group.regione, group.area, group.settore_intervento) == (
        "SCONOSCIUTA",
        "SUD+ISOLE",
        "LAVORI",
    )
    assert (group.n_cup_con_base, group.n_cup_con_scostamento, group.n_cup_parziali) == (2, 1, 0)
    assert group.scostamento_pct_mediano == 20.0


def test_map_drops_placeholders_and_blank_keys(spark):
    pairs = [
        ("A", "ND"), ("A", "ZZ"), ("B", "000000000000000"), ("C", None), ("D", "  "),
        ("", "X"), (None, "X"), ("E", " X"),
    ]
    found = by_key(procurement.tender_map(table(spark, "tender_pairs", pairs)), "cig")
    assert {k: v.cup for k, v in found.items()} == {"A": "ZZ", "E": " X"}


def test_award_range_is_open_and_ids_are_distinct(spark):
    when = day(2024, 1, 1)
    amounts = [(1, 0.0), (2, -5.0), (3, 1e11), (4, 99999999999.0), (5, None), (6, 1.0), (6, 2.0)]
    rows = [("A", i, a, when) for i, a in amounts] + [("B", 1, None, when)]
    found = by_key(procurement.tender_awards(table(spark, "awards", rows)), "cig")
    assert set(found) == {"A"}
    assert (found["A"].n_aggiudicazioni, found["A"].importo_totale_agg) == (2, 99999999999.0 + 3)


def test_late_statement_needs_no_issue_date(spark):
    extra = {"tender_pairs": [("A", "P")], "statements": [("A", "IN RITARDO", 7.0, None)]}
    row = wide_register(projects(spark, "P"), support(spark, **extra)).first()
    assert (row.anac_n_sal, row.anac_importo_sal, row.anac_sal_in_ritardo) == (0, 0.0, 1)
    statements = table(spark, "statements", extra["statements"])
    assert procurement.tender_progress(statements).count() == 0
    late = procurement.late_progress(
        procurement.tender_map(table(spark, "tender_pairs", extra["tender_pairs"])),
        procurement.tender_statements(statements),
    )
    assert [tuple(r) for r in late.collect()] == [("P", 1)]


def events(*rows):
    return [(cig, 1, None, kind, detail, *amounts) for cig, kind, detail, amounts in rows]


def test_cost_event_edges(spark):
    none, base, final, variant = (None, None, None), "BASE_ASTA", "CONSUNTIVO", "VARIANTE"
    rows = events(
        ("EMPTY", base, "b", none),
        ("TWO", base, "b", (1.0, 2.0, None)),
        ("TWO", base, "b", (4.0, None, None)),
        ("TWO", variant, "v", none),
        ("TWO", variant, "v", none),
        ("TWO", variant, "w", none),
        ("PLACE", base, "b", (5.0, None, None)),
        ("PLACE", final, "c", (0.0, None, None)),
        ("BIG", base, "b", (1e9, None, None)),
        ("HUGE", base, "b", (1e10, None, None)),
        ("ODD", base, "b", (5.0, None, None)),
        ("ODD", final, "c", (1e73, None, None)),
        ("OTHER", "ALTRO", "x", (9.0, None, None)),
    )
    found = by_key(procurement.tender_costs(table(spark, "cost_events", rows)), "cig")
    assert "OTHER" not in found
    assert found["EMPTY"].importo_base == 0.0 and found["EMPTY"].importo_consuntivo is None
    assert (found["TWO"].importo_base, found["TWO"].n_varianti_qe) == (7.0, 2)
    place = found["PLACE"]
    assert place.consuntivo_zero and place.base_appaiata is None and place.cons_appaiato is None
    assert found["BIG"].base_grande and not found["BIG"].base_sospetta
    assert found["HUGE"].base_grande and found["HUGE"].base_sospetta
    assert found["ODD"].cons_appaiato == 1e73 and not found["ODD"].base_sospetta


def test_suspect_tender_leaves_the_others_of_its_project(spark):
    rows = events(
        ("OK", "BASE_ASTA", "b", (10.0, None, None)),
        ("BAD", "BASE_ASTA", "b", (2e10, None, None)),
        ("BAD", "CONSUNTIVO", "c", (3.0, None, None)),
    )
    extra = {"tender_pairs": [("OK", "P"), ("BAD", "P")], "cost_events": rows}
    row = wide_register(projects(spark, "P"), support(spark, **extra)).first()
    assert row.anac_importo_base == 10.0 and row.anac_importo_consuntivo is None
    assert row.anac_base_sospetta and row.anac_n_cig_con_base == 1


def test_absurd_final_cost_passes_without_overflow(spark):
    rows = events(
        ("A", "BASE_ASTA", "b", (10.0, None, None)), ("A", "CONSUNTIVO", "c", (1e73, None, None))
    )
    extra = {"tender_pairs": [("A", "P")], "cost_events": rows}
    wide = wide_register(projects(spark, "P"), support(spark, **extra))
    assert wide.first().anac_scostamento_pct == pytest.approx(1e74)
    assert cost_mart(wide, 1).first().scostamento_pct_mediano == pytest.approx(1e74)


def test_partial_project_has_no_deviation_but_is_counted(spark):
    rows = events(
        ("A", "BASE_ASTA", "b", (10.0, None, None)), ("B", "CONSUNTIVO", "c", (4.0, None, None))
    )
    extra = {"tender_pairs": [("A", "P"), ("B", "P")], "cost_events": rows}
    wide = wide_register(projects(spark, "P"), support(spark, **extra))
    assert wide.first().anac_scostamento_pct is None
    group = cost_mart(wide, 1).first()
    assert (group.n_cup_con_base, group.n_cup_parziali, group.n_cup_con_scostamento) == (1, 1, 0)
    assert group.scostamento_pct_mediano is None


def test_umbrella_threshold(spark):
    pairs = [(f"A{i}", "P49") for i in range(49)] + [(f"B{i}", "P50") for i in range(50)]
    wide = wide_register(projects(spark, "P49", "P50"), support(spark, tender_pairs=pairs))
    assert {r.cup: r.flag_ombrello for r in wide.collect()} == {"P49": False, "P50": True}


def test_tender_unique_so_plain_counts_equal_distinct(spark, tiny):
    proxy = Proxy(spark, tiny)
    tenders = procurement.tender_map(proxy.tender_pairs(), PROXY_RULES)
    costs = procurement.tender_costs(proxy.cost_events(), PROXY_RULES)
    joined = tenders.join(costs, "cig", "left").groupBy("cup")
    distinct = joined.agg(
        F.count_distinct("cig").alias("n"),
        F.count_distinct(F.when(F.col("base_appaiata").isNotNull() & ~F.col("base_sospetta"),
                                F.col("cig"))).alias("pairs"),
    )
    plain = procurement_of(proxy.support(), PROXY_RULES).select(
        "cup", F.col("anac_n_cig").alias("n"), F.col("anac_n_cig_appaiati").alias("pairs")
    )
    assert distinct.exceptAll(plain).count() == 0 and plain.exceptAll(distinct).count() == 0


def test_invariants(spark, tiny):
    proxy = Proxy(spark, tiny)
    wide = proxy.wide().cache()
    assert wide.count() == proxy.projects().count() == wide.select("cup").distinct().count()
    assert wide.where("anac_n_cig_appaiati > anac_n_cig_con_base").count() == 0
    assert wide.where("con_almeno_una_fonte_lab <> (n_fonti_lab > 0)").count() == 0
