"""Tender-level facts and their roll-up to the project code.

Every table is reduced to one row per tender before anything is joined, so no raw
row takes part in a join and a tender or project of any size is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import null_safe_sum, or_false, or_zero
from publicspend.functions.text import usable_key
from publicspend.rules import Rules


def tender_map(pairs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One project per tender: the lowest real code. Placeholders go before the minimum,
    as they would otherwise win it."""
    cig, cup = F.col("cig"), F.col("cup")
    real = usable_key(cup) & ~cup.isin(*rules.sentinel_keys) & usable_key(cig)
    return pairs.where(real).groupBy("cig").agg(F.min("cup").alias("cup"))


def tender_awards(awards: DataFrame, rules: Rules = Rules()) -> DataFrame:
    amount = F.col("importo_aggiudicazione")
    return (
        awards.where((amount > rules.award_above) & (amount < rules.award_below))
        .groupBy("cig")
        .agg(
            F.count_distinct("id_aggiudicazione").alias("n_aggiudicazioni"),
            F.sum(amount).alias("importo_totale_agg"),
            F.max("data_aggiudicazione_definitiva").alias("data_ultima_agg"),
        )
    )


def tender_statements(statements: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Progress statements per tender in one pass over the table.

    Counts and amounts take issued statements only; the late count takes them all.
    """
    issued = F.col("data_emissione_sal").isNotNull()
    late = F.col("flag_ritardo") == rules.late_label
    return (
        statements.where(issued | late)
        .groupBy("cig")
        .agg(
            F.count_if(issued).alias("n_sal"),
            F.sum(F.when(issued, F.col("importo_quota"))).alias("importo_totale_sal"),
            F.count_if(late).alias("n_ritardo"),
        )
    )


def tender_progress(statements: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Tenders with at least one issued statement."""
    return (
        tender_statements(statements, rules)
        .where(F.col("n_sal") > 0)
        .select("cig", "n_sal", "importo_totale_sal")
    )


def tender_costs(events: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Base, final cost and variants per tender; NULL where the tender has no such event.

    An event whose components are all missing weighs 0, not NULL. The paired columns
    hold a value only where base and final cost are both positive on the same tender.
    """
    kind = F.col("descrizione_evento")
    amount = (
        or_zero(F.col("importo_lavori"))
        + or_zero(F.col("importo_servizi"))
        + or_zero(F.col("importo_forniture"))
    )
    # DISTINCT over a CASE, not with a FILTER clause: the latter makes Spark expand the rows.
    per_tender = (
        events.where(kind.isin(rules.base_event, rules.final_event, rules.variant_event))
        .groupBy("cig")
        .agg(
            F.sum(F.when(kind == rules.base_event, amount)).alias("importo_base"),
            F.sum(F.when(kind == rules.final_event, amount)).alias("importo_consuntivo"),
            F.count_distinct(
                F.when(kind == rules.variant_event, F.col("dettaglio_evento"))
            ).alias("n_varianti_qe"),
        )
    )
    base, final = F.col("importo_base"), F.col("importo_consuntivo")
    paired = (base > 0) & (final > 0)
    return per_tender.withColumns(
        {
            "consuntivo_zero": or_false(final == 0),
            "base_appaiata": F.when(paired, base),
            "cons_appaiato": F.when(paired, final),
            "base_sospetta": or_false(base >= rules.suspect_base),
            "base_grande": or_false(base >= rules.large_base),
        }
    )


def procurement_rollup(
    tenders: DataFrame, awards: DataFrame, statements: DataFrame, costs: DataFrame
) -> DataFrame:
    """Per-tender tables on the tender map, summed to the project.

    All four inputs are unique on ``cig``, so plain counts equal distinct ones. A tender
    without awards still counts; one with a suspect base counts but adds no cost.
    """
    trusted = ~or_false(F.col("base_sospetta"))

    def trusted_sum(name: str):
        return F.sum(F.when(trusted, F.col(name)))

    return (
        tenders.join(awards, "cig", "left")
        .join(statements, "cig", "left")
        .join(costs, "cig", "left")
        .groupBy("cup")
        .agg(
            F.count("*").alias("anac_n_cig"),
            null_safe_sum(F.col("n_aggiudicazioni")).alias("anac_n_gare"),
            null_safe_sum(F.col("importo_totale_agg")).alias("anac_importo_aggiudicato"),
            null_safe_sum(F.col("n_sal")).alias("anac_n_sal"),
            null_safe_sum(F.col("importo_totale_sal")).alias("anac_importo_sal"),
            F.max("data_ultima_agg").alias("anac_data_ultima_agg"),
            F.count_if((F.col("importo_base") > 0) & trusted).alias("anac_n_cig_con_base"),
            F.count_if(F.col("importo_consuntivo").isNotNull() & trusted).alias(
                "anac_n_cig_con_consuntivo"
            ),
            F.count_if(F.col("base_appaiata").isNotNull() & trusted).alias("anac_n_cig_appaiati"),
            F.count_if("base_sospetta").alias("anac_n_cig_base_sospetta"),
            F.count_if("base_grande").alias("anac_n_cig_base_grande"),
            F.count_if("consuntivo_zero").alias("anac_n_cig_consuntivo_zero"),
            trusted_sum("importo_base").alias("anac_importo_base"),
            trusted_sum("importo_consuntivo").alias("anac_importo_consuntivo"),
            trusted_sum("base_appaiata").alias("anac_importo_base_appaiata"),
            trusted_sum("cons_appaiato").alias("anac_importo_consuntivo_appaiato"),
            F.sum(
                F.when(F.col("importo_base").isNotNull() & trusted, F.col("n_varianti_qe"))
            ).alias("anac_n_varianti_qe"),
            null_safe_sum(F.col("n_ritardo")).alias("anac_sal_in_ritardo"),
        )
    )


def late_progress(tenders: DataFrame, statements: DataFrame) -> DataFrame:
    """Late statements per project, from the per-tender counts."""
    late = statements.where(F.col("n_ritardo") > 0).select("cig", "n_ritardo")
    return tenders.join(late, "cig").groupBy("cup").agg(F.sum("n_ritardo").alias("n_ritardo"))
