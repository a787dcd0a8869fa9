"""Aggregate tables over the wide register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import (
    billions,
    count_where,
    null_safe_sum,
    percent_where,
    stable_round,
)
from publicspend.operators.median import group_medians
from publicspend.plans.compose import WITH_ANY, WITH_COHESION, WITH_RECOVERY, WITH_TENDERS
from publicspend.rules import MIN_GROUP, UNKNOWN_REGION, UNKNOWN_SECTOR


def _known(name: str, label: str) -> Column:
    return F.coalesce(F.col(name), F.lit(label)).alias(name)


def _sorted_by(df: DataFrame, measure: str, keys: list[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(k) for k in keys])


def territory_mart(wide: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Cost, coverage and freshness by region, area, sector and year."""
    keys = ["regione", "area", "settore_intervento", "anno_decisione"]
    groups = wide.groupBy(
        _known("regione", UNKNOWN_REGION),
        "area",
        _known("settore_intervento", UNKNOWN_SECTOR),
        "anno_decisione",
    ).agg(
        F.count("*").alias("n_cup"),
        billions(null_safe_sum(F.col("costo_progetto"))).alias("costo_mld"),
        billions(null_safe_sum(F.col("finanziamento_progetto"))).alias("finanziamento_mld"),
        count_where(WITH_ANY).alias("n_con_fonte_lab"),
        percent_where(WITH_ANY).alias("pct_con_fonte_lab"),
        count_where(WITH_TENDERS).alias("n_con_anac"),
        count_where(WITH_RECOVERY).alias("n_con_pnrr"),
        count_where(WITH_COHESION).alias("n_con_coesione"),
        billions(F.sum("pnrr_fin_pnrr")).alias("pnrr_fin_mld"),
        billions(F.sum("anac_importo_aggiudicato")).alias("anac_importo_mld"),
        count_where("flag_ombrello").alias("n_ombrello"),
        F.max("anac_data_ultima_agg").alias("anac_data_ultima_agg"),
    )
    return _sorted_by(groups.where(F.col("n_cup") >= min_group), "costo_mld", keys)


def funding_mart(wide: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Which sources cover which share of the projects, by sector and area."""
    counts = {
        "n_fonte_statale": "ha_fonte_statale",
        "n_fonte_ue": "ha_fonte_ue",
        "n_fonte_regionale": "ha_fonte_regionale",
        "n_fonte_privata": "ha_fonte_privata",
        "n_anac": WITH_TENDERS,
        "n_pnrr": WITH_RECOVERY,
        "n_coesione": WITH_COHESION,
        "n_con_fonte_lab": WITH_ANY,
    }
    shares = {
        "pct_statale": "ha_fonte_statale",
        "pct_ue": "ha_fonte_ue",
        "pct_anac": WITH_TENDERS,
        "pct_pnrr": WITH_RECOVERY,
        "pct_con_fonte_lab": WITH_ANY,
    }
    amounts = {
        "pnrr_fin_mld": "pnrr_fin_pnrr",
        "anac_importo_mld": "anac_importo_aggiudicato",
        "coesione_fin_mld": "coe_finanz_tot_pubblico",
    }
    groups = wide.groupBy(_known("settore_intervento", UNKNOWN_SECTOR), "area").agg(
        F.count("*").alias("n_cup"),
        billions(null_safe_sum(F.col("costo_progetto"))).alias("costo_mld"),
        *[count_where(c).alias(name) for name, c in counts.items()],
        *[percent_where(c).alias(name) for name, c in shares.items()],
        *[billions(F.sum(c)).alias(name) for name, c in amounts.items()],
    )
    return _sorted_by(
        groups.where(F.col("n_cup") >= min_group), "costo_mld", ["settore_intervento", "area"]
    )


def cost_mart(wide: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Tender base against final cost by region, area and sector.

    Two populations: projects with a base, and those with base and final cost on the same
    tender, on which alone the deviation is measured.
    """
    keys = ["regione", "area", "settore_intervento"]
    final, pct = F.col("anac_n_cig_con_consuntivo"), F.col("anac_scostamento_pct")
    base_sum = F.sum("anac_importo_base_appaiata")
    final_sum = F.sum("anac_importo_consuntivo_appaiato")
    with_base = wide.where("anac_importo_base > 0").withColumns(
        {
            "regione": F.coalesce("regione", F.lit(UNKNOWN_REGION)),
            "settore_intervento": F.coalesce("settore_intervento", F.lit(UNKNOWN_SECTOR)),
        }
    )
    totals = (
        with_base.groupBy(*keys)
        .agg(
            F.count("*").alias("n_cup_con_base"),
            billions(F.sum("anac_importo_base")).alias("importo_base_mld"),
            F.count(pct).alias("n_cup_con_scostamento"),
            F.count_if((final > 0) & pct.isNull()).alias("n_cup_parziali"),
            billions(base_sum).alias("importo_base_appaiata_mld"),
            billions(final_sum).alias("importo_consuntivo_appaiato_mld"),
            billions(final_sum - base_sum).alias("scostamento_mld"),
            F.count_if(pct > 10).alias("n_oltre_10pct"),
            F.sum("anac_n_varianti_qe").alias("n_varianti_qe"),
        )
        .where(F.col("n_cup_con_base") >= min_group)
    )
    medians = group_medians(with_base, keys, "anac_scostamento_pct")
    result = totals.join(medians, keys, "left").select(
        *keys,
        "n_cup_con_base",
        "importo_base_mld",
        "n_cup_con_scostamento",
        "n_cup_parziali",
        "importo_base_appaiata_mld",
        "importo_consuntivo_appaiato_mld",
        "scostamento_mld",
        stable_round(F.col("median"), 1).alias("scostamento_pct_mediano"),
        "n_oltre_10pct",
        "n_varianti_qe",
    )
    return _sorted_by(result, "importo_base_mld", keys)
