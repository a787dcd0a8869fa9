"""The wide register: one row per project code with everything known about it."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import or_false, or_zero, stable_round
from publicspend.operators import procurement, rollups
from publicspend.operators.joins import left_join_all
from publicspend.rules import AREA_NAMES, Rules


@dataclass(frozen=True)
class Support:
    """Clean tables the register is enriched with, in their published schemas."""

    locations: DataFrame
    funding: DataFrame
    recovery_projects: DataFrame
    recovery_tenders: DataFrame
    recovery_payments: DataFrame
    tender_pairs: DataFrame
    awards: DataFrame
    statements: DataFrame
    cost_events: DataFrame
    cohesion_projects: DataFrame
    works: DataFrame


# Columns of the wide register, in order. A column in none of the
# three lists below is passed on as it is: a missing cost means unknown, never zero.
WIDE_COLUMNS = (
    "cup anno_decisione stato_progetto costo_progetto costo_mld finanziamento_progetto "
    "soggetto_titolare settore_intervento descrizione_intervento flag_chiuso flag_sub_progetto "
    "regione provincia comune "
    "n_fonti ha_fonte_statale ha_fonte_ue ha_fonte_regionale ha_fonte_privata "
    "pnrr_missione pnrr_stato_avanzamento pnrr_fin_pnrr pnrr_fin_totale pnrr_n_gare "
    "pnrr_importo_aggiudicato pag_pagato_pnrr pag_pagato_totale "
    "anac_n_cig anac_n_gare anac_importo_aggiudicato anac_n_sal anac_importo_sal "
    "anac_importo_base anac_importo_consuntivo anac_importo_base_appaiata "
    "anac_importo_consuntivo_appaiato anac_n_cig_con_base anac_n_cig_con_consuntivo "
    "anac_n_cig_appaiati anac_n_cig_base_sospetta anac_n_cig_consuntivo_zero "
    "anac_n_cig_base_grande anac_base_sospetta anac_scostamento_pct anac_n_varianti_qe "
    "anac_data_ultima_agg anac_sal_in_ritardo flag_ombrello "
    "coe_n_progetti coe_finanz_tot_pubblico "
    "silos_denominazione silos_sistema silos_stato silos_macro_stato "
    "silos_costi_mln silos_disponibilita_mln silos_gap_mln "
    "area con_almeno_una_fonte_lab n_fonti_lab"
).split()
ZERO_IF_MISSING = frozenset(
    "n_fonti pnrr_fin_pnrr pnrr_fin_totale pnrr_n_gare pnrr_importo_aggiudicato "
    "pag_pagato_pnrr pag_pagato_totale anac_n_cig anac_n_gare anac_importo_aggiudicato "
    "anac_n_sal anac_importo_sal anac_n_cig_con_base anac_n_cig_con_consuntivo "
    "anac_n_cig_appaiati anac_n_cig_base_sospetta anac_n_cig_consuntivo_zero "
    "anac_n_cig_base_grande anac_n_varianti_qe anac_sal_in_ritardo "
    "coe_n_progetti coe_finanz_tot_pubblico".split()
)
FALSE_IF_MISSING = frozenset(
    "ha_fonte_statale ha_fonte_ue ha_fonte_regionale ha_fonte_privata".split()
)

# Conditions on the wide register that marts and reports count by.
WITH_TENDERS = "anac_n_cig > 0"
WITH_RECOVERY = "pnrr_fin_pnrr > 0"
WITH_COHESION = "coe_n_progetti > 0"
WITH_ANY = "con_almeno_una_fonte_lab"
WITH_WORKS = "silos_costi_mln IS NOT NULL"


def procurement_of(support: Support, rules: Rules = Rules()) -> DataFrame:
    return procurement.procurement_rollup(
        procurement.tender_map(support.tender_pairs, rules),
        procurement.tender_awards(support.awards, rules),
        procurement.tender_statements(support.statements, rules),
        procurement.tender_costs(support.cost_events, rules),
    )


def wide_register(
    projects: DataFrame, support: Support, rules: Rules = Rules(), hot: list | None = None
) -> DataFrame:
    """Enrich every register row; ``hot`` names project codes repeated very often in it.

    A register that already carries place and funding flags, as ``register_with_support``
    gives them, keeps its own instead of having them worked out again.
    """
    sides = support_sides(support, rules, known=projects.columns)
    return wide_from_sides(projects, list(sides.values()), rules, hot)


def support_sides(
    support: Support, rules: Rules = Rules(), known: Collection[str] = ()
) -> dict[str, DataFrame]:
    """What the register is joined to: tables with one row per project code.

    A refresh stores them dealt by the code, as it does the register, so that the joins need no
    shuffle. Sides whose columns are ``known`` are left out.
    """
    sides = {}
    if "regione" not in known:
        sides["luogo"] = rollups.preferred_location(support.locations, rules).drop("codice_comune")
    if "n_fonti" not in known:
        sides["finanziatori"] = rollups.funding_flags(support.funding, rules)
    return sides | {
        "pnrr_progetti": rollups.recovery_project(support.recovery_projects),
        "pnrr_gare": rollups.recovery_tenders(support.recovery_tenders),
        "pnrr_pagamenti": rollups.recovery_payments(support.recovery_payments),
        "appalti": procurement_of(support, rules),
        "coesione": rollups.cohesion(support.cohesion_projects),
        "opere": rollups.strategic_project(support.works),
    }


def wide_from_sides(
    projects: DataFrame, sides: list[DataFrame], rules: Rules = Rules(), hot: list | None = None
) -> DataFrame:
    """The wide register from a register and all its sides."""
    own = [c for c in WIDE_COLUMNS if c in projects.columns]
    joined = left_join_all(projects.select(*own), sides, "cup", hot)
    derived = _derived(rules)
    return joined.select(*[_final(name, derived).alias(name) for name in WIDE_COLUMNS])


def _final(name: str, derived: dict[str, Column]) -> Column:
    if name in derived:
        return derived[name]
    if name in ZERO_IF_MISSING:
        return or_zero(F.col(name))
    if name in FALSE_IF_MISSING:
        return or_false(F.col(name))
    return F.col(name)


def area_of(region: Column, rules: Rules = Rules()) -> Column:
    """Macro area; everything outside the two lists, a missing region too, is the third."""
    north, centre, rest = AREA_NAMES
    return (
        F.when(region.isin(*rules.north), north)
        .when(region.isin(*rules.centre), centre)
        .otherwise(rest)
    )


def _derived(rules: Rules) -> dict[str, Column]:
    base, final = F.col("anac_importo_base_appaiata"), F.col("anac_importo_consuntivo_appaiato")
    tenders = or_zero(F.col("anac_n_cig"))
    sources = [
        or_false(F.col(c) > 0) for c in ("anac_n_cig", "pnrr_fin_pnrr", "coe_n_progetti")
    ]
    return {
        "anac_base_sospetta": or_zero(F.col("anac_n_cig_base_sospetta")) > 0,
        "anac_scostamento_pct": F.when(base > 0, stable_round((final - base) * 100 / base, 2)),
        "flag_ombrello": tenders >= rules.umbrella_tenders,
        "area": area_of(F.col("regione"), rules),
        "con_almeno_una_fonte_lab": sources[0] | sources[1] | sources[2],
        "n_fonti_lab": sources[0].cast("int") + sources[1].cast("int") + sources[2].cast("int"),
    }


def register_with_support(
    projects: DataFrame,
    locations: DataFrame,
    funding: DataFrame,
    rules: Rules = Rules(),
    hot: list | None = None,
) -> DataFrame:
    """The full register with place and funding flags only."""
    sides = place_and_funding(locations, funding, rules)
    return register_from_sides(projects, list(sides.values()), rules, hot)


def place_and_funding(
    locations: DataFrame, funding: DataFrame, rules: Rules = Rules()
) -> dict[str, DataFrame]:
    """The two sides of the full register, one row per project code."""
    return {
        "luogo": rollups.preferred_location(locations, rules),
        "finanziatori": rollups.funding_flags(funding, rules),
    }


def register_from_sides(
    projects: DataFrame, sides: list[DataFrame], rules: Rules = Rules(), hot: list | None = None
) -> DataFrame:
    joined = left_join_all(projects, sides, "cup", hot)
    return joined.select(
        *projects.columns,
        "regione",
        "provincia",
        "comune",
        "codice_comune",
        or_zero(F.col("n_fonti")).alias("n_fonti"),
        *[or_false(F.col(flag)).alias(flag) for flag in rules.funding_labels],
    )
