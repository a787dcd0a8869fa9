"""What each produced table must hold."""

from publicspend.operators.quality import Contract

# Required columns and row floors of a full national run.
PROJECTS = Contract(
    required_columns=(
        "cup",
        "anno_decisione",
        "stato_progetto",
        "costo_progetto",
        "finanziamento_progetto",
        "soggetto_titolare",
        "settore_intervento",
    ),
    not_null=("cup",),
    min_rows=10_000_000,
)
PROJECT_MART = Contract(not_null=("cup",), primary_key=("cup",))
LOCATIONS = Contract(
    required_columns=("cup", "regione", "provincia", "comune", "codice_comune"),
    not_null=("cup",),
    min_rows=10_000_000,
)
FUNDING = Contract(
    required_columns=("cup", "copertura_finanziaria"), not_null=("cup",), min_rows=10_000_000
)
KEYED_MART = Contract(not_null=("cup",))
HOLDERS = Contract(
    required_columns=("soggetto_titolare", "piva_codfiscale_sog_titolare"),
    not_null=("soggetto_titolare",),
    min_rows=1_000,
)
HOLDER_MART = Contract(not_null=("soggetto_titolare",))
WORKS = Contract(
    required_columns=("sistema_infrastrutturale", "denominazione"),
    not_null=("denominazione",),
    min_rows=1_000,
)
WORKS_MART = Contract(not_null=("denominazione",), min_rows=1_000)
WIDE = Contract(
    required_columns=("cup", "costo_progetto", "settore_intervento"),
    not_null=("cup",),
    min_rows=10_000_000,
)
WIDE_SMOKE = Contract(
    required_columns=(
        "cup",
        "regione",
        "comune",
        "soggetto_titolare",
        "stato_progetto",
        "costo_progetto",
        "settore_intervento",
        "area",
        "anac_n_cig",
        "anac_n_gare",
        "anac_importo_aggiudicato",
        "pnrr_fin_pnrr",
        "pnrr_missione",
        "coe_n_progetti",
        "flag_ombrello",
        "con_almeno_una_fonte_lab",
        "n_fonti_lab",
        "silos_costi_mln",
        "silos_macro_stato",
    ),
    min_rows=11_000_000,
    at_least={
        "con_almeno_una_fonte_lab": 1_500_000,
        "silos_costi_mln IS NOT NULL": 1_000,
    },
)
TERRITORY_MART = Contract(min_rows=100)
FUNDING_MART = Contract(min_rows=10)
COST_MART = Contract(min_rows=10)

REQUIRED_TABLES = (
    "mart_progetti",
    "mart_registro",
    "mart_opere",
    "mart_soggetti",
    "mart_localizzazione",
    "mart_fonti_per_progetto",
    "mart_territorio",
    "mart_fonti",
    "mart_costi",
)

# By table name, as the pipeline looks them up.
CONTRACTS = {
    "progetti": PROJECTS,
    "mart_progetti": PROJECT_MART,
    "mart_registro": PROJECT_MART,
    "localizzazione": LOCATIONS,
    "mart_localizzazione": KEYED_MART,
    "fonti": FUNDING,
    "mart_fonti_per_progetto": KEYED_MART,
    "soggetti": HOLDERS,
    "mart_soggetti": HOLDER_MART,
    "opere": WORKS,
    "mart_opere": WORKS_MART,
    "registro_ampio": WIDE,
    "registro_ampio_smoke": WIDE_SMOKE,
    "mart_territorio": TERRITORY_MART,
    "mart_fonti": FUNDING_MART,
    "mart_costi": COST_MART,
}
