"""Values the results depend on, and the bundle of them that a run uses."""

from __future__ import annotations

from dataclasses import dataclass, field

# Labels, lists and limits of the source data. Results change if these do.
CLOSED_STATES = ("CHIUSO", "ANNULLATO", "REVOCATO")
HOME_COUNTRY = "ITALIA"
FUNDING_LABELS = {
    "ha_fonte_statale": "STATALE",
    "ha_fonte_ue": "COMUNITARIA",
    "ha_fonte_regionale": "REGIONALE",
    "ha_fonte_privata": "PRIVATA",
}
SENTINEL_KEYS = ("ND", "000000000000000")
AWARD_ABOVE = 0.0
AWARD_BELOW = 1e11
LATE_LABEL = "IN RITARDO"
BASE_EVENT = "BASE_ASTA"
FINAL_EVENT = "CONSUNTIVO"
VARIANT_EVENT = "VARIANTE"
LARGE_BASE = 1e9
SUSPECT_BASE = 1e10
UMBRELLA_TENDERS = 50
MIN_GROUP = 10
NORTH = (
    "LOMBARDIA",
    "PIEMONTE",
    "VENETO",
    "EMILIA-ROMAGNA",
    "TOSCANA",
    "LIGURIA",
    "FRIULI VENEZIA GIULIA",
    "TRENTINO-ALTO ADIGE",
    "VALLE D'AOSTA",
)
CENTRE = ("LAZIO", "MARCHE", "UMBRIA", "ABRUZZO", "MOLISE")
AREA_NAMES = ("NORD", "CENTRO", "SUD+ISOLE")
UNKNOWN_REGION = "SCONOSCIUTA"
UNKNOWN_SECTOR = "SCONOSCIUTO"
MACRO_STATES = {
    "concluso": ("Lavori conclusi",),
    "in corso": (
        "Lavori in corso",
        "Opere con esecutore individuato",
        "Gara aggiudicata",
        "Gara non aggiudicata",
        "Opere con bando di gara per la realizzazione pubblicato",
    ),
    "progettazione": (
        "Progettazione preliminare",
        "Progettazione definitiva",
        "Progettazione esecutiva",
        "Studio di fattibilità",
    ),
    "bloccato": ("Contratto rescisso", "Lavori sospesi", "Procedimento interrotto"),
}
OTHER_MACRO_STATE = "non indicato"


@dataclass(frozen=True)
class Rules:
    """The values above as arguments, so that other registers can bring their own."""

    closed_states: tuple[str, ...] = CLOSED_STATES
    home_country: str = HOME_COUNTRY
    funding_labels: dict[str, str] = field(default_factory=lambda: dict(FUNDING_LABELS))
    sentinel_keys: tuple[str, ...] = SENTINEL_KEYS
    award_above: float = AWARD_ABOVE
    award_below: float = AWARD_BELOW
    late_label: str = LATE_LABEL
    base_event: str = BASE_EVENT
    final_event: str = FINAL_EVENT
    variant_event: str = VARIANT_EVENT
    large_base: float = LARGE_BASE
    suspect_base: float = SUSPECT_BASE
    umbrella_tenders: int = UMBRELLA_TENDERS
    min_group: int = MIN_GROUP
    north: tuple[str, ...] = NORTH
    centre: tuple[str, ...] = CENTRE
