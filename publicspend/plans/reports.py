"""Named reports over the wide register. Each takes the register and returns a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import count_where, percent_where
from publicspend.functions.text import clipped
from publicspend.plans.compose import (
    WITH_ANY,
    WITH_COHESION,
    WITH_RECOVERY,
    WITH_TENDERS,
    WITH_WORKS,
)


def _top(df: DataFrame, measure: str, ties: list[str], limit: int | None = None) -> DataFrame:
    """Highest measure first, NULLs last; ties by the other columns so a cut is repeatable."""
    ordered = df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in ties])
    return ordered if limit is None else ordered.limit(limit)


# Overview


def overview(wide: DataFrame) -> DataFrame:
    return wide.agg(
        F.count("*").alias("n_cup"),
        F.sum("costo_progetto").alias("costo"),
        count_where(WITH_ANY).alias("con_lab"),
        count_where(WITH_TENDERS).alias("con_anac"),
        count_where(WITH_WORKS).alias("con_silos"),
    )


def coverage_by_area(wide: DataFrame) -> DataFrame:
    groups = wide.groupBy("area").agg(
        F.count("*").alias("n_cup"),
        F.sum("costo_progetto").alias("costo"),
        count_where(WITH_ANY).alias("con_fonte"),
        percent_where(WITH_ANY).alias("pct"),
    )
    return _top(groups, "costo", ["area"])


def status_counts(wide: DataFrame) -> DataFrame:
    groups = wide.groupBy("stato_progetto").agg(F.count("*").alias("n"))
    return _top(groups, "n", ["stato_progetto"])


def top_sectors(wide: DataFrame, limit: int = 10) -> DataFrame:
    groups = wide.groupBy("settore_intervento").agg(
        F.count("*").alias("n_cup"),
        F.sum("costo_progetto").alias("costo"),
        count_where(WITH_TENDERS).alias("con_anac"),
        percent_where(WITH_TENDERS).alias("pct_anac"),
    )
    return _top(groups, "costo", ["settore_intervento"], limit)


def funding_totals(wide: DataFrame) -> DataFrame:
    return wide.agg(
        F.count_if("ha_fonte_statale").alias("statale"),
        F.count_if("ha_fonte_ue").alias("ue"),
        F.count_if("ha_fonte_regionale").alias("regionale"),
        F.count_if("ha_fonte_privata").alias("privata"),
    )


# Territory


def cost_by_region(wide: DataFrame, limit: int | None = None) -> DataFrame:
    groups = wide.groupBy("regione").agg(
        F.count("*").alias("n_cup"),
        F.sum("costo_progetto").alias("costo"),
        count_where(WITH_ANY).alias("con_lab"),
    )
    return _top(groups, "costo", ["regione"], limit)


def region_names(wide: DataFrame) -> DataFrame:
    return wide.select("regione").distinct().orderBy(F.asc_nulls_last("regione"))


def region_overview(wide: DataFrame, region: str) -> DataFrame:
    return wide.where(F.col("regione") == F.lit(region)).agg(
        F.count("*").alias("n_cup"),
        F.sum("costo_progetto").alias("costo"),
        count_where(WITH_ANY).alias("con_lab"),
        count_where(WITH_TENDERS).alias("con_anac"),
    )


def region_sectors(wide: DataFrame, region: str, limit: int = 8) -> DataFrame:
    groups = (
        wide.where(F.col("regione") == F.lit(region))
        .groupBy("settore_intervento")
        .agg(F.count("*").alias("n_cup"), F.sum("costo_progetto").alias("costo"))
    )
    return _top(groups, "costo", ["settore_intervento"], limit)


def top_regions(wide: DataFrame, limit: int = 5) -> DataFrame:
    groups = wide.groupBy("regione").agg(F.count("*").alias("n_cup"))
    return _top(groups, "n_cup", ["regione"], limit)


# Sources


def source_totals(wide: DataFrame) -> DataFrame:
    return wide.agg(
        count_where(WITH_TENDERS).alias("anac"),
        count_where(WITH_RECOVERY).alias("pnrr"),
        count_where(WITH_COHESION).alias("coesione"),
        count_where(WITH_ANY).alias("totale"),
    )


def sector_coverage(wide: DataFrame, limit: int = 10) -> DataFrame:
    groups = wide.groupBy("settore_intervento").agg(
        F.count("*").alias("n_cup"),
        count_where(WITH_TENDERS).alias("con_anac"),
        percent_where(WITH_TENDERS).alias("pct"),
    )
    return _top(groups.where(F.col("con_anac") > 0), "pct", ["settore_intervento"], limit)


def recovery_share(wide: DataFrame, by: str) -> DataFrame:
    """Recovery-plan money as a share of all cost, by area or by sector."""
    plan, cost = F.sum("pnrr_fin_pnrr"), F.sum("costo_progetto")
    groups = wide.groupBy(by).agg(
        plan.alias("pnrr_fin"),
        cost.alias("costo"),
        F.when(cost > 0, plan / cost * 100).alias("pct_pnrr"),
    )
    return _top(groups, "pct_pnrr", [by])


# Execution


def execution_funnel(wide: DataFrame) -> DataFrame:
    return wide.where(WITH_TENDERS).agg(
        F.count("*").alias("n_cup"),
        F.sum("anac_n_gare").alias("n_gare"),
        F.sum("anac_importo_aggiudicato").alias("importo"),
        F.sum("anac_n_sal").alias("sal"),
        F.sum("anac_importo_sal").alias("importo_sal"),
        F.sum("anac_sal_in_ritardo").alias("sal_ritardo"),
    )


def umbrella_count(wide: DataFrame) -> DataFrame:
    return wide.where("flag_ombrello").agg(F.count("*").alias("n"))


def top_umbrellas(wide: DataFrame, limit: int = 20) -> DataFrame:
    rows = wide.where("flag_ombrello").select(
        "cup", "soggetto_titolare", "regione", "anac_n_cig", "costo_progetto"
    )
    return _top(rows, "anac_n_cig", ["cup"], limit)


# Strategic works


def works_overview(wide: DataFrame) -> DataFrame:
    """Works and their money; the source counts in millions, ``*_eur`` in euros."""
    totals = wide.where(WITH_WORKS).agg(
        F.count("*").alias("n"),
        F.sum("silos_costi_mln").alias("costo"),
        F.sum("silos_disponibilita_mln").alias("disp"),
        F.sum("silos_gap_mln").alias("gap"),
    )
    return totals.withColumns({f"{c}_eur": F.col(c) * 1e6 for c in ("costo", "disp", "gap")})


def top_works(wide: DataFrame, limit: int = 30) -> DataFrame:
    rows = wide.where(WITH_WORKS).select(
        "cup",
        "silos_denominazione",
        "silos_sistema",
        "silos_stato",
        "silos_costi_mln",
        "silos_disponibilita_mln",
        "silos_gap_mln",
        "regione",
        "anac_n_cig",
        "pnrr_fin_pnrr",
    )
    return _top(rows, "silos_costi_mln", ["cup"], limit)


def top_gaps(wide: DataFrame, limit: int = 15, width: int = 50) -> DataFrame:
    rows = wide.where("silos_gap_mln > 0").select(
        F.col("silos_denominazione").alias("denominazione"),
        "silos_gap_mln",
        "cup",
        "silos_sistema",
        "silos_costi_mln",
        clipped(F.col("silos_denominazione"), width).alias("opera"),
    )
    return _top(rows, "silos_gap_mln", ["cup"], limit)


def works_by_state(wide: DataFrame) -> DataFrame:
    groups = (
        wide.where(WITH_WORKS)
        .groupBy(F.col("silos_macro_stato").alias("stato"))
        .agg(F.count("*").alias("n"))
    )
    return _top(groups, "n", ["stato"])


def works_by_system(wide: DataFrame) -> DataFrame:
    groups = (
        wide.where(WITH_WORKS)
        .groupBy("silos_sistema")
        .agg(
            F.count("*").alias("n_opere"),
            F.sum("silos_costi_mln").alias("costo"),
            F.sum("silos_gap_mln").alias("gap"),
        )
    )
    return _top(groups, "costo", ["silos_sistema"])


# One project


def project_card(wide: DataFrame, cup: str) -> DataFrame:
    return wide.where(F.col("cup") == F.lit(cup.strip())).limit(1)
