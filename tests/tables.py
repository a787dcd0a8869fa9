"""Small hand-made tables in the schemas of the real sources."""

import datetime as dt

from publicspend.plans.compose import Support

SCHEMAS = {
    "projects": "cup string, anno_decisione int, stato_progetto string, costo_progetto double, "
    "costo_mld double, finanziamento_progetto double, soggetto_titolare string, "
    "settore_intervento string, descrizione_intervento string, flag_chiuso boolean, "
    "flag_sub_progetto boolean",
    "locations": "cup string, regione string, provincia string, comune string, "
    "codice_comune string, stato string",
    "funding": "cup string, copertura_finanziaria string",
    "recovery_projects": "cup string, missione string, stato_avanzamento string, "
    "fin_pnrr double, fin_totale double",
    "recovery_tenders": "cup string, importo_aggiudicazione double",
    "recovery_payments": "cup string, pagamento_pnrr double, pagamento_totale double",
    "tender_pairs": "cig string, cup string",
    "awards": "cig string, id_aggiudicazione int, importo_aggiudicazione double, "
    "data_aggiudicazione_definitiva date",
    "statements": "cig string, flag_ritardo string, importo_quota double, data_emissione_sal date",
    "cost_events": "cig string, id_aggiudicazione int, data date, descrizione_evento string, "
    "dettaglio_evento string, importo_lavori double, importo_servizi double, "
    "importo_forniture double",
    "cohesion_projects": "CUP string, FINANZ_TOTALE_PUBBLICO double",
    "works": "cup string, denominazione string, sistema_infrastrutturale string, "
    "stato_attuazione string, macro_stato string, costi_mln_euro double, "
    "disponibilita_mln_euro double, gap_finanziario_mln_euro double",
}


def day(year, month, date):
    return dt.date(year, month, date)


def table(spark, name, rows=()):
    return spark.createDataFrame(list(rows), SCHEMAS[name])


def projects(spark, *cups, sector="LAVORI"):
    return table(
        spark,
        "projects",
        [(c, 2020, "ATTIVO", 1.0, 0.001, 1.0, "SA", sector, "d", False, False) for c in cups],
    )


def support(spark, **rows):
    names = [n for n in SCHEMAS if n != "projects"]
    return Support(**{n: table(spark, n, rows.get(n, ())) for n in names})


def by_key(df, key="cup"):
    return {row[key]: row for row in df.collect()}


# Rows and expected figures of the published example.
PROCUREMENT = {
    "tender_pairs": [
        ("CIG_A", "CUP_REAL"),
        ("CIG_NOAGG", "CUP_REAL"),
        ("CIG_ZERO", "CUP_REAL"),
        ("CIG_SENT", "000000000000000"),
        ("CIG_SENT", "CUP_SENTINEL_CIG"),
        ("CIG_MULTI", "CUP_MULTI_ZZ"),
        ("CIG_MULTI", "CUP_MULTI_AA"),
        ("CIG_ABS", "CUP_SOSPETTO"),
    ],
    "awards": [
        ("CIG_A", 1, 100.0, day(2024, 1, 1)),
        ("CIG_SENT", 2, 50.0, day(2024, 2, 1)),
        ("CIG_MULTI", 3, 200.0, day(2024, 3, 1)),
    ],
    "statements": [
        ("CIG_A", "IN RITARDO", 40.0, day(2024, 5, 1)),
        ("CIG_A", "IN LINEA", 10.0, day(2024, 6, 1)),
        ("CIG_MULTI", "IN LINEA", 5.0, day(2024, 7, 1)),
    ],
    "cost_events": [
        ("CIG_A", 1, None, "BASE_ASTA", "B1", 100.0, 0.0, 0.0),
        ("CIG_A", 1, day(2024, 2, 1), "VARIANTE", "V1", 110.0, 0.0, 0.0),
        ("CIG_A", 1, None, "CONSUNTIVO", "C1", 120.0, 0.0, 0.0),
        ("CIG_NOAGG", 9, None, "BASE_ASTA", "B9", 50.0, 0.0, 0.0),
        ("CIG_ZERO", 8, None, "BASE_ASTA", "B8", 0.0, 0.0, 0.0),
        ("CIG_ZERO", 8, None, "CONSUNTIVO", "C8", 30.0, 0.0, 0.0),
        ("CIG_SENT", 2, None, "BASE_ASTA", "B2", 10.0, 0.0, 0.0),
        ("CIG_ABS", 7, None, "BASE_ASTA", "B7", 2e10, 0.0, 0.0),
    ],
}
PROCUREMENT_CUPS = ("CUP_REAL", "CUP_SENTINEL_CIG", "CUP_MULTI_AA", "CUP_MULTI_ZZ", "CUP_SOSPETTO")
