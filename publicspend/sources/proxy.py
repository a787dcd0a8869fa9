"""The TPC-H-like test tables in the shapes of the real sources.

Only the shapes are mimicked: raw register rows with amounts as text, many places and
funding rows per project, many projects per tender, and so on. ``PROXY_RULES`` holds the
labels and limits that fit these values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from publicspend.operators import register, strategic
from publicspend.plans.compose import Support, register_with_support, wide_register
from publicspend.rules import MACRO_STATES, Rules

PROXY_RULES = Rules(
    closed_states=("F",),
    funding_labels={
        "ha_fonte_statale": "AF",
        "ha_fonte_ue": "NO",
        "ha_fonte_regionale": "RF",
        "ha_fonte_privata": "RO",
    },
    sentinel_keys=("ND", "0"),
    award_above=5_000.0,
    award_below=104_000.0,
    large_base=150_000.0,
    suspect_base=250_000.0,
    umbrella_tenders=5,
    north=("EUROPE", "ASIA"),
    centre=("AMERICA",),
)
WORKS_YEAR = 2024
WORKS_PROJECTS = 500
WORKS_STATES = [state for states in MACRO_STATES.values() for state in states]


def comma_text(amount: Column) -> Column:
    """1234.56 as ``1234,56``."""
    return F.replace(amount.cast("string"), F.lit("."), F.lit(","))


def italian_text(amount: Column) -> Column:
    """1234.56 as ``1.234,56``."""
    return F.translate(F.format_number(amount, 2), ".,", ",.")


def _with_gaps(key: str) -> Column:
    """The key as text; blank in one of eleven events, NULL in one of thirteen others."""
    number = F.col("event_id")
    return F.when(number % 11 == 0, "  ").when(number % 13 != 0, F.col(key).cast("string"))


class Proxy:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def projects_raw(self) -> DataFrame:
        """Amounts as text; low-priority budgets carry a thousands point, which does not parse."""
        holder, sector = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
        budget = F.col("o_totalprice")
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("CUP"),
            F.year("o_orderdate").cast("string").alias("ANNO_DECISIONE"),
            F.col("o_orderstatus").alias("STATO_PROGETTO"),
            comma_text(budget).alias("COSTO_PROGETTO"),
            F.when(sector == "5-LOW", italian_text(budget))
            .otherwise(comma_text(budget))
            .alias("FINANZIAMENTO_PROGETTO"),
            holder.alias("SOGGETTO_TITOLARE"),
            F.lpad(holder, 11, "0").alias("PIVA_CODFISCALE_SOG_TITOLARE"),
            F.col("o_orderstatus").alias("NATURA_INTERVENTO"),
            sector.alias("TIPOLOGIA_INTERVENTO"),
            sector.alias("SETTORE_INTERVENTO"),
            F.col("o_orderstatus").alias("CATEGORIA_INTERVENTO"),
            F.substring(sector, 1, 1).alias("CODICE_SETTORE_INTERVENTO"),
            F.col("o_orderstatus").alias("CODICE_CATEGORIA_INTERVENTO"),
            F.concat_ws(" ", sector, holder).alias("DESCRIZIONE_INTERVENTO"),
            holder.alias("CODICE_LOCALE_PROGETTO"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATA_GENERAZIONE_CUP"),
            F.when(F.col("o_orderstatus") == "O", holder)
            .when(F.col("o_orderstatus") == "F", "  ")
            .alias("CUP_MASTER"),
        )

    def projects(self) -> DataFrame:
        return register.project_mart(register.clean_projects(self.projects_raw()), PROXY_RULES)

    def locations_raw(self) -> DataFrame:
        at_home = F.col("n_nationkey") < 12
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        # 25 nations whatever the scale; suppliers grow, so Spark checks their size
        return (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("l_orderkey").cast("string").alias("CUP"),
                F.when(at_home, "1").otherwise("2").alias("CODICE_STATO"),
                F.when(at_home, PROXY_RULES.home_country).otherwise("ESTERO").alias("STATO"),
                F.col("r_regionkey").cast("string").alias("CODICE_REGIONE"),
                F.col("r_name").alias("REGIONE"),
                F.col("s_suppkey").cast("string").alias("CODICE_PROVINCIA"),
                F.substring("s_name", -2, 2).alias("SIGLA_PROVINCIA"),
                F.col("s_name").alias("PROVINCIA"),
                F.col("n_nationkey").cast("string").alias("CODICE_COMUNE"),
                F.col("n_name").alias("COMUNE"),
            )
        )

    def locations(self) -> DataFrame:
        return register.clean_locations(self.locations_raw())

    def funding_raw(self) -> DataFrame:
        label = F.concat("l_returnflag", "l_linestatus")
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("CUP"),
            F.ascii(F.col("l_returnflag")).cast("string").alias("CODICE_COPERTURA_FINANZIARIA"),
            label.alias("COPERTURA_FINANZIARIA"),
        )

    def funding(self) -> DataFrame:
        return register.clean_funding(self.funding_raw())

    def holders_raw(self) -> DataFrame:
        customers = self.table("customer").join(
            F.broadcast(self.table("nation")), F.col("c_nationkey") == F.col("n_nationkey")
        )
        nation = F.col("n_nationkey").cast("string")
        return customers.select(
            F.col("c_name").alias("SOGGETTO_TITOLARE"),
            F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias(
                "PIVA_CODFISCALE_SOG_TITOLARE"
            ),
            F.concat_ws(" ", F.lit("VIA"), "n_name").alias("INDIRIZZO_SOG_TITOLARE"),
            F.col("n_name").alias("COMUNE_SOGGETTO_TITOLARE"),
            nation.alias("CODICE_COMUNE_SOGG_TITOLARE"),
            F.substring("c_mktsegment", 1, 2).alias("CODICE_CATEGORIA_SOGGETTO"),
            F.col("c_mktsegment").alias("CATEGORIA_SOGGETTO"),
            F.col("n_regionkey").cast("string").alias("CODICE_AREA_SOGGETTO"),
            F.col("n_name").alias("AREA_SOGGETTO"),
            F.col("c_name").alias("SOGGETTO_RICHIEDENTE"),
        )

    def works_raw(self) -> DataFrame:
        """Yearly report rows; two in sixteen have no state, one in fifty no cost."""
        cost, size = F.col("p_retailprice"), F.col("p_size")
        state = F.get(F.array(*[F.lit(s) for s in WORKS_STATES]), F.pmod(size, F.lit(16)))
        texts = {
            "link_scheda": F.concat(F.lit("scheda/"), F.col("p_partkey").cast("string")),
            "flag_commissariato_pnrr": F.when(size < 10, " SI ").otherwise(" "),
            "sistema_infrastrutturale": F.col("p_brand"),
            "cup": (F.col("p_partkey") % WORKS_PROJECTS).cast("string"),
            "denominazione": F.concat_ws(" ", F.lit("opera di interesse strategico"), "p_name", "p_type"),
            "soggetto_competente": F.col("p_brand"),
            "luogo_lavori": F.concat(F.lit(" "), F.col("p_type")),
            "stato_attuazione": state,
        }
        integers = {
            "progressivo": F.col("p_partkey").cast("string"),
            "livello": F.pmod(size, F.lit(6)).cast("string"),
            "anno_ultimazione_previsto": F.concat(
                (F.lit(2000) + size).cast("string"), F.lit(".0")
            ),
        }
        amounts = {
            "costi_mln_euro": F.when(size == 50, "n.d.").otherwise(italian_text(cost)),
            "disponibilita_mln_euro": italian_text(size * F.lit(30.0)),
            "fabbisogno_mln_euro": italian_text(cost - size),
        }
        headers = strategic.WORKS_TEXT | strategic.WORKS_INTEGERS | strategic.WORKS_AMOUNTS
        values = texts | integers | amounts
        return self.table("part").select(*[values[n].alias(h) for n, h in headers.items()])

    def works(self) -> DataFrame:
        return strategic.works_mart(strategic.clean_works(self.works_raw(), WORKS_YEAR))

    def tender_pairs(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("cig"),
            F.col("l_orderkey").cast("string").alias("cup"),
        )

    def awards(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("cig"),
            F.col("l_suppkey").alias("id_aggiudicazione"),
            F.col("l_extendedprice").alias("importo_aggiudicazione"),
            F.col("l_shipdate").alias("data_aggiudicazione_definitiva"),
        )

    def statements(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("cig"),
            F.when(F.col("l_returnflag") == "R", PROXY_RULES.late_label).alias("flag_ritardo"),
            F.col("l_quantity").alias("importo_quota"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("data_emissione_sal"),
        )

    def cost_events(self) -> DataFrame:
        """Final costs of a third of the suppliers are zero."""
        line = F.col("l_linenumber")
        kind = (
            F.when((line == 1) & (F.col("l_returnflag") == "A"), PROXY_RULES.base_event)
            .when((line == 3) & (F.col("l_linestatus") == "F"), PROXY_RULES.final_event)
            .when(line == 4, PROXY_RULES.variant_event)
        )
        zero = (kind == PROXY_RULES.final_event) & (F.col("l_suppkey") % 3 == 0)
        no_cost = F.coalesce(zero, F.lit(False))
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("cig"),
            F.col("l_suppkey").alias("id_aggiudicazione"),
            F.col("l_shipdate").alias("data"),
            kind.alias("descrizione_evento"),
            F.col("l_suppkey").cast("string").alias("dettaglio_evento"),
            F.when(no_cost, 0.0).otherwise(F.col("l_extendedprice")).alias("importo_lavori"),
            F.when(~no_cost, F.nullif("l_tax", F.lit(0.0))).alias("importo_servizi"),
            F.when(~no_cost, F.nullif("l_discount", F.lit(0.0))).alias("importo_forniture"),
        )

    def recovery_projects(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").cast("string").alias("cup"),
            F.col("event_type").alias("missione"),
            F.col("event_id").cast("string").alias("stato_avanzamento"),
            F.col("value").alias("fin_pnrr"),
            (F.col("value") * 2).alias("fin_totale"),
        )

    def recovery_tenders(self) -> DataFrame:
        return self.table("events").select(
            _with_gaps("user_id").alias("cup"), F.col("value").alias("importo_aggiudicazione")
        )

    def recovery_payments(self) -> DataFrame:
        return self.table("events").select(
            _with_gaps("user_id").alias("cup"),
            F.when(F.col("event_type") != "view", F.col("value")).alias("pagamento_pnrr"),
            F.col("value").alias("pagamento_totale"),
        )

    def cohesion_projects(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("CUP"),
            F.col("n_chars").cast("double").alias("FINANZ_TOTALE_PUBBLICO"),
        )

    def support(self) -> Support:
        return Support(
            locations=self.locations(),
            funding=self.funding(),
            recovery_projects=self.recovery_projects(),
            recovery_tenders=self.recovery_tenders(),
            recovery_payments=self.recovery_payments(),
            tender_pairs=self.tender_pairs(),
            awards=self.awards(),
            statements=self.statements(),
            cost_events=self.cost_events(),
            cohesion_projects=self.cohesion_projects(),
            works=self.works(),
        )

    def wide(self) -> DataFrame:
        """The wide register; order numbers are unique, so it has no hot keys to look for."""
        return wide_register(self.projects(), self.support(), PROXY_RULES)

    def register_with_support(self) -> DataFrame:
        return register_with_support(
            self.projects(), self.locations(), self.funding(), PROXY_RULES
        )
