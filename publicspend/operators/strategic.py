"""Strategic works: the yearly report as typed rows, with gap, coverage and macro state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import stable_round
from publicspend.functions.text import cleaned_text, italian_number, lenient_int
from publicspend.rules import MACRO_STATES, OTHER_MACRO_STATE

# Headers of the 2024 report. Other years name them differently, so the
# mapping is an argument of clean_works.
WORKS_TEXT = {
    "link_scheda": "Link alla scheda",
    "flag_commissariato_pnrr": "Commissariate o PNRR-PNC",
    "sistema_infrastrutturale": "Sistema infrastrutturale",
    "cup": "Cup",
    "denominazione": "Denominazione",
    "soggetto_competente": "Soggetto competente",
    "luogo_lavori": "Luogo lavori",
    "stato_attuazione": "Stato di attuazione",
}
WORKS_INTEGERS = {
    "progressivo": "Progressivo",
    "livello": "Livello",
    "anno_ultimazione_previsto": "Ultimazione lavori al 31/08/2024",
}
WORKS_AMOUNTS = {
    "costi_mln_euro": "Costi al 31/08/2024",
    "disponibilita_mln_euro": "Disponibilità al 31/08/2024",
    "fabbisogno_mln_euro": "Fabbisogno al 31/08/2024",
}
WORKS_ORDER = (
    "anno",
    "link_scheda",
    "progressivo",
    "livello",
    "flag_commissariato_pnrr",
    "sistema_infrastrutturale",
    "cup",
    "denominazione",
    "soggetto_competente",
    "luogo_lavori",
    "stato_attuazione",
    "anno_ultimazione_previsto",
    "costi_mln_euro",
    "disponibilita_mln_euro",
    "fabbisogno_mln_euro",
)


def clean_works(
    raw: DataFrame,
    year: int,
    text: dict[str, str] = WORKS_TEXT,
    integers: dict[str, str] = WORKS_INTEGERS,
    amounts: dict[str, str] = WORKS_AMOUNTS,
) -> DataFrame:
    typed = {"anno": F.lit(year).cast("int")}
    for mapping, convert in (
        (text, cleaned_text),
        (integers, lenient_int),
        (amounts, italian_number),
    ):
        typed |= {name: convert(F.col(f"`{header}`")) for name, header in mapping.items()}
    return raw.select(*[typed[name].alias(name) for name in WORKS_ORDER])


def macro_state(state: Column) -> Column:
    result = F
    for name, labels in MACRO_STATES.items():
        result = result.when(state.isin(*labels), name)
    return result.otherwise(OTHER_MACRO_STATE)


def works_mart(works: DataFrame) -> DataFrame:
    cost, available = F.col("costi_mln_euro"), F.col("disponibilita_mln_euro")
    return works.withColumns(
        {
            "gap_finanziario_mln_euro": cost - available,
            "pct_copertura": F.when(cost > 0, stable_round(available / cost * 100, 1)),
            "macro_stato": macro_state(F.col("stato_attuazione")),
        }
    )
