"""Support tables reduced to one row per project code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import null_safe_sum, or_false
from publicspend.functions.text import usable_key
from publicspend.operators.dedupe import highest_row, lowest_row
from publicspend.rules import Rules


def preferred_location(locations: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A place at home before one abroad, then the first municipality in order."""
    abroad = F.when(F.col("stato") == rules.home_country, 0).otherwise(1)
    picked = lowest_row(
        locations, "cup", [abroad], ["comune", "provincia", "regione", "codice_comune"]
    )
    return picked.select("cup", "regione", "provincia", "comune", "codice_comune")


def funding_flags(funding: DataFrame, rules: Rules = Rules()) -> DataFrame:
    label = F.col("copertura_finanziaria")
    flags = [
        or_false(F.bool_or(label == value)).alias(flag)
        for flag, value in rules.funding_labels.items()
    ]
    return funding.groupBy("cup").agg(F.count("*").alias("n_fonti"), *flags)


def recovery_project(projects: DataFrame) -> DataFrame:
    """The recovery-plan row with the largest plan amount."""
    names = {
        "missione": "pnrr_missione",
        "stato_avanzamento": "pnrr_stato_avanzamento",
        "fin_pnrr": "pnrr_fin_pnrr",
        "fin_totale": "pnrr_fin_totale",
    }
    picked = highest_row(
        projects.where(usable_key(F.col("cup"))), "cup", "fin_pnrr", list(names)
    )
    return picked.withColumnsRenamed(names)


def recovery_tenders(tenders: DataFrame) -> DataFrame:
    return (
        tenders.where(usable_key(F.col("cup")))
        .groupBy("cup")
        .agg(
            F.count("*").alias("pnrr_n_gare"),
            null_safe_sum(F.col("importo_aggiudicazione")).alias("pnrr_importo_aggiudicato"),
        )
    )


def recovery_payments(payments: DataFrame) -> DataFrame:
    return (
        payments.where(usable_key(F.col("cup")))
        .groupBy("cup")
        .agg(
            null_safe_sum(F.col("pagamento_pnrr")).alias("pag_pagato_pnrr"),
            null_safe_sum(F.col("pagamento_totale")).alias("pag_pagato_totale"),
        )
    )


def cohesion(projects: DataFrame) -> DataFrame:
    return (
        projects.where(usable_key(F.col("CUP")))
        .groupBy(F.col("CUP").alias("cup"))
        .agg(
            F.count("*").alias("coe_n_progetti"),
            null_safe_sum(F.col("FINANZ_TOTALE_PUBBLICO")).alias("coe_finanz_tot_pubblico"),
        )
    )


def strategic_project(works: DataFrame) -> DataFrame:
    """The strategic-works row with the largest cost."""
    names = {
        "denominazione": "silos_denominazione",
        "sistema_infrastrutturale": "silos_sistema",
        "stato_attuazione": "silos_stato",
        "macro_stato": "silos_macro_stato",
        "costi_mln_euro": "silos_costi_mln",
        "disponibilita_mln_euro": "silos_disponibilita_mln",
        "gap_finanziario_mln_euro": "silos_gap_mln",
    }
    picked = highest_row(
        works.where(usable_key(F.col("cup"))), "cup", "costi_mln_euro", list(names)
    )
    return picked.withColumnsRenamed(names)
