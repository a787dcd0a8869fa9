"""The project register and the narrow support tables, from raw text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.functions.measures import billions, or_false
from publicspend.functions.text import comma_decimal, usable_key
from publicspend.rules import Rules

# Column names of the published files and of the tables made from them.
PROJECT_COLUMNS = {
    "CUP": "cup",
    "ANNO_DECISIONE": "anno_decisione",
    "STATO_PROGETTO": "stato_progetto",
    "COSTO_PROGETTO": "costo_progetto",
    "FINANZIAMENTO_PROGETTO": "finanziamento_progetto",
    "SOGGETTO_TITOLARE": "soggetto_titolare",
    "PIVA_CODFISCALE_SOG_TITOLARE": "piva_soggetto_titolare",
    "NATURA_INTERVENTO": "natura_intervento",
    "TIPOLOGIA_INTERVENTO": "tipologia_intervento",
    "SETTORE_INTERVENTO": "settore_intervento",
    "CATEGORIA_INTERVENTO": "categoria_intervento",
    "CODICE_SETTORE_INTERVENTO": "codice_settore",
    "CODICE_CATEGORIA_INTERVENTO": "codice_categoria",
    "DESCRIZIONE_INTERVENTO": "descrizione_intervento",
    "CODICE_LOCALE_PROGETTO": "codice_locale_progetto",
    "DATA_GENERAZIONE_CUP": "data_generazione_cup",
    "CUP_MASTER": "cup_master",
}
PROJECT_AMOUNTS = ("COSTO_PROGETTO", "FINANZIAMENTO_PROGETTO")
LOCATION_COLUMNS = (
    "CUP",
    "CODICE_STATO",
    "STATO",
    "CODICE_REGIONE",
    "REGIONE",
    "CODICE_PROVINCIA",
    "SIGLA_PROVINCIA",
    "PROVINCIA",
    "CODICE_COMUNE",
    "COMUNE",
)
FUNDING_COLUMNS = {
    "CUP": "cup",
    "CODICE_COPERTURA_FINANZIARIA": "codice_copertura",
    "COPERTURA_FINANZIARIA": "copertura_finanziaria",
}
HOLDER_COLUMNS = (
    "SOGGETTO_TITOLARE",
    "PIVA_CODFISCALE_SOG_TITOLARE",
    "INDIRIZZO_SOG_TITOLARE",
    "COMUNE_SOGGETTO_TITOLARE",
    "CODICE_COMUNE_SOGG_TITOLARE",
    "CODICE_CATEGORIA_SOGGETTO",
    "CATEGORIA_SOGGETTO",
    "CODICE_AREA_SOGGETTO",
    "AREA_SOGGETTO",
    "SOGGETTO_RICHIEDENTE",
)


def clean_projects(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[
            (comma_decimal(F.col(source)) if source in PROJECT_AMOUNTS else F.col(source)).alias(
                name
            )
            for source, name in PROJECT_COLUMNS.items()
        ]
    )


def clean_locations(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(c).alias(c.lower()) for c in LOCATION_COLUMNS])


def clean_funding(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(source).alias(name) for source, name in FUNDING_COLUMNS.items()])


def clean_holders(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(c).alias(c.lower()) for c in HOLDER_COLUMNS])


def project_mart(projects: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The clean register with the cost in billions beside it and two flags."""
    columns = []
    for name in projects.columns:
        columns.append(F.col(name))
        if name == "costo_progetto":
            columns.append(billions(F.col(name)).alias("costo_mld"))
    closed = or_false(F.col("stato_progetto").isin(*rules.closed_states))
    return projects.select(
        *columns,
        closed.alias("flag_chiuso"),
        usable_key(F.col("cup_master")).alias("flag_sub_progetto"),
    )


def location_mart(locations: DataFrame) -> DataFrame:
    return locations.select("cup", "regione", "provincia", "comune", "codice_comune")


def funding_source_mart(funding: DataFrame) -> DataFrame:
    return funding.select("cup", "copertura_finanziaria")
