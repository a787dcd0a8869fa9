"""DuckDB SQL with the same results as the queries in ``__spark_entry__.py``.

Every text is built from the named steps below, each written for DuckDB on its own.
"""

from __future__ import annotations


def rnd(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28, 6)), {digits}) AS DOUBLE)"


def n(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def count_if(condition: str) -> str:
    return n(f"count(*) FILTER (WHERE {condition})")


def pct_if(condition: str) -> str:
    return rnd(f"avg(CASE WHEN {condition} THEN 100e0 ELSE 0e0 END)", 1)


def billions(total: str) -> str:
    return rnd(f"{total} / 1e9", 3)


HAS_WORKS = "silos_costi_mln IS NOT NULL"

STEPS = {
    "projects": f"""
        SELECT o_orderkey::VARCHAR AS cup, year(o_orderdate)::VARCHAR AS anno_decisione,
            o_orderstatus AS stato_progetto, o_totalprice AS costo_progetto,
            {rnd("o_totalprice / 1e9", 3)} AS costo_mld,
            if(o_orderpriority = '5-LOW' AND abs(o_totalprice) >= 1000, NULL, o_totalprice)
                AS finanziamento_progetto,
            o_custkey::VARCHAR AS soggetto_titolare,
            lpad(o_custkey::VARCHAR, 11, '0') AS piva_soggetto_titolare,
            o_orderstatus AS natura_intervento, o_orderpriority AS tipologia_intervento,
            o_orderpriority AS settore_intervento, o_orderstatus AS categoria_intervento,
            o_orderpriority[1] AS codice_settore, o_orderstatus AS codice_categoria,
            o_orderpriority || ' ' || o_custkey AS descrizione_intervento,
            o_custkey::VARCHAR AS codice_locale_progetto,
            strftime(o_orderdate, '%Y-%m-%d') AS data_generazione_cup,
            CASE o_orderstatus WHEN 'O' THEN o_custkey::VARCHAR WHEN 'F' THEN '  ' END
                AS cup_master,
            o_orderstatus = 'F' AS flag_chiuso, o_orderstatus = 'O' AS flag_sub_progetto
        FROM orders""",
    "locations": """
        SELECT l_orderkey::VARCHAR AS cup, if(n_nationkey < 12, '1', '2') AS codice_stato,
            if(n_nationkey < 12, 'ITALIA', 'ESTERO') AS stato,
            r_regionkey::VARCHAR AS codice_regione, r_name AS regione,
            s_suppkey::VARCHAR AS codice_provincia, right(s_name, 2) AS sigla_provincia,
            s_name AS provincia, n_nationkey::VARCHAR AS codice_comune, n_name AS comune
        FROM lineitem, supplier, nation, region
        WHERE s_suppkey = l_suppkey AND n_nationkey = s_nationkey AND r_regionkey = n_regionkey""",
    "place": """
        SELECT DISTINCT ON (cup) cup, regione, provincia, comune, codice_comune FROM locations
        ORDER BY cup, stato DESC, comune, provincia, regione, codice_comune""",
    "fund": """
        SELECT l_orderkey::VARCHAR AS cup, count(*) AS n_fonti,
            bool_or(l_returnflag = 'A' AND l_linestatus = 'F') AS ha_fonte_statale,
            bool_or(l_returnflag = 'N' AND l_linestatus = 'O') AS ha_fonte_ue,
            bool_or(l_returnflag = 'R' AND l_linestatus = 'F') AS ha_fonte_regionale,
            bool_or(l_returnflag = 'R' AND l_linestatus = 'O') AS ha_fonte_privata
        FROM lineitem GROUP BY l_orderkey""",
    "plan_top": """
        SELECT DISTINCT ON (user_id) user_id::VARCHAR AS cup, event_type AS pnrr_missione,
            event_id::VARCHAR AS pnrr_stato_avanzamento, value AS pnrr_fin_pnrr,
            value * 2 AS pnrr_fin_totale
        FROM events ORDER BY user_id, value DESC, event_type DESC, event_id::VARCHAR DESC""",
    "plan_tenders": """
        SELECT user_id::VARCHAR AS cup, count(*) AS pnrr_n_gare,
            sum(value) AS pnrr_importo_aggiudicato
        FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 GROUP BY user_id""",
    "plan_paid": """
        SELECT user_id::VARCHAR AS cup,
            sum(if(event_type = 'view', 0, value)) AS pag_pagato_pnrr,
            sum(value) AS pag_pagato_totale
        FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 GROUP BY user_id""",
    "coh": """
        SELECT doc_id::VARCHAR AS cup, count(*) AS coe_n_progetti,
            sum(n_chars)::DOUBLE AS coe_finanz_tot_pubblico
        FROM documents GROUP BY doc_id""",
    "works": f"""
        SELECT 2024 AS anno, 'scheda/' || p_partkey AS link_scheda,
            p_partkey::INTEGER AS progressivo, p_size % 6 AS livello,
            if(p_size < 10, 'SI', NULL) AS flag_commissariato_pnrr,
            p_brand AS sistema_infrastrutturale, (p_partkey % 500)::VARCHAR AS cup,
            'opera di interesse strategico ' || p_name || ' ' || p_type AS denominazione,
            p_brand AS soggetto_competente, p_type AS luogo_lavori,
            ['Lavori conclusi', 'Lavori in corso', 'Opere con esecutore individuato',
             'Gara aggiudicata', 'Gara non aggiudicata',
             'Opere con bando di gara per la realizzazione pubblicato',
             'Progettazione preliminare', 'Progettazione definitiva',
             'Progettazione esecutiva', 'Studio di fattibilità', 'Contratto rescisso',
             'Lavori sospesi', 'Procedimento interrotto'][p_size % 16 + 1] AS stato_attuazione,
            2000 + p_size AS anno_ultimazione_previsto,
            if(p_size = 50, NULL, {rnd("p_retailprice", 2)}) AS costi_mln_euro,
            p_size * 30e0 AS disponibilita_mln_euro,
            {rnd("p_retailprice - p_size", 2)} AS fabbisogno_mln_euro,
            if(p_size = 50, NULL, p_retailprice - p_size * 30) AS gap_finanziario_mln_euro,
            if(p_size = 50 OR p_retailprice <= 0, NULL,
               {rnd("100 * p_size * 30 / p_retailprice", 1)}) AS pct_copertura,
            CASE WHEN p_size % 16 = 0 THEN 'concluso' WHEN p_size % 16 < 6 THEN 'in corso'
                 WHEN p_size % 16 < 10 THEN 'progettazione' WHEN p_size % 16 < 13 THEN 'bloccato'
                 ELSE 'non indicato' END AS macro_stato
        FROM part""",
    "works_top": """
        SELECT DISTINCT ON (cup) cup, denominazione AS silos_denominazione,
            sistema_infrastrutturale AS silos_sistema, stato_attuazione AS silos_stato,
            macro_stato AS silos_macro_stato, costi_mln_euro AS silos_costi_mln,
            disponibilita_mln_euro AS silos_disponibilita_mln,
            gap_finanziario_mln_euro AS silos_gap_mln
        FROM works ORDER BY cup, costi_mln_euro DESC NULLS LAST, denominazione DESC,
            sistema_infrastrutturale DESC, stato_attuazione DESC NULLS LAST, macro_stato DESC,
            disponibilita_mln_euro DESC""",
    "owner": """
        SELECT l_partkey AS tender, min(l_orderkey::VARCHAR) AS cup FROM lineitem
        WHERE l_orderkey <> 0 GROUP BY l_partkey""",
    "won": """
        SELECT l_partkey AS tender, count(DISTINCT l_suppkey) AS n_won,
            sum(l_extendedprice) AS won, max(l_shipdate) AS last_won
        FROM lineitem WHERE l_extendedprice > 5000 AND l_extendedprice < 104000
        GROUP BY l_partkey""",
    "done": """
        SELECT l_partkey AS tender, count(*) AS n_sal, sum(l_quantity) AS sal FROM lineitem
        WHERE l_linestatus = 'F' GROUP BY l_partkey""",
    "late": """
        SELECT cup, count(*) AS n_ritardo FROM lineitem JOIN owner ON tender = l_partkey
        WHERE l_returnflag = 'R' GROUP BY cup""",
    "spent": """
        SELECT l_partkey AS tender,
            sum(l_extendedprice + l_tax + l_discount)
                FILTER (WHERE l_linenumber = 1 AND l_returnflag = 'A') AS base,
            sum(if(l_suppkey % 3 = 0, 0, l_extendedprice + l_tax + l_discount))
                FILTER (WHERE l_linenumber = 3 AND l_linestatus = 'F') AS final,
            count(DISTINCT CASE l_linenumber WHEN 4 THEN l_suppkey END) AS variants,
            bool_or(l_linenumber = 4 OR (l_linenumber = 1 AND l_returnflag = 'A')
                OR (l_linenumber = 3 AND l_linestatus = 'F')) AS any_event
        FROM lineitem GROUP BY l_partkey HAVING any_event""",
    "facts": """
        SELECT owner.cup, n_won, won, last_won, n_sal, sal, base, final, variants,
            coalesce(base, 0) < 250000 AS ok, base > 0 AND final > 0 AS pair
        FROM owner LEFT JOIN won USING (tender) LEFT JOIN done USING (tender)
            LEFT JOIN spent USING (tender)""",
    "proc": """
        SELECT cup, count(*) AS anac_n_cig, coalesce(sum(n_won), 0) AS anac_n_gare,
            coalesce(sum(won), 0) AS anac_importo_aggiudicato,
            coalesce(sum(n_sal), 0) AS anac_n_sal, coalesce(sum(sal), 0) AS anac_importo_sal,
            max(last_won) AS anac_data_ultima_agg,
            count(*) FILTER (WHERE ok AND base > 0) AS anac_n_cig_con_base,
            count(final) FILTER (WHERE ok) AS anac_n_cig_con_consuntivo,
            count(*) FILTER (WHERE ok AND pair) AS anac_n_cig_appaiati,
            count(*) FILTER (WHERE NOT ok) AS anac_n_cig_base_sospetta,
            count(*) FILTER (WHERE base >= 150000) AS anac_n_cig_base_grande,
            count(*) FILTER (WHERE final = 0) AS anac_n_cig_consuntivo_zero,
            sum(base) FILTER (WHERE ok) AS anac_importo_base,
            sum(final) FILTER (WHERE ok) AS anac_importo_consuntivo,
            sum(base) FILTER (WHERE ok AND pair) AS anac_importo_base_appaiata,
            sum(final) FILTER (WHERE ok AND pair) AS anac_importo_consuntivo_appaiato,
            sum(variants) FILTER (WHERE ok AND base IS NOT NULL) AS anac_n_varianti_qe
        FROM facts GROUP BY cup""",
    "wide": f"""
        SELECT p.cup, anno_decisione, stato_progetto, costo_progetto, costo_mld,
            finanziamento_progetto, soggetto_titolare, settore_intervento,
            descrizione_intervento, flag_chiuso, flag_sub_progetto,
            regione, provincia, comune, {n("ifnull(n_fonti, 0)")} AS n_fonti,
            ifnull(ha_fonte_statale, false) AS ha_fonte_statale,
            ifnull(ha_fonte_ue, false) AS ha_fonte_ue,
            ifnull(ha_fonte_regionale, false) AS ha_fonte_regionale,
            ifnull(ha_fonte_privata, false) AS ha_fonte_privata,
            pnrr_missione, pnrr_stato_avanzamento, ifnull(pnrr_fin_pnrr, 0) AS pnrr_fin_pnrr,
            ifnull(pnrr_fin_totale, 0) AS pnrr_fin_totale,
            {n("ifnull(pnrr_n_gare, 0)")} AS pnrr_n_gare,
            ifnull(pnrr_importo_aggiudicato, 0) AS pnrr_importo_aggiudicato,
            ifnull(pag_pagato_pnrr, 0) AS pag_pagato_pnrr,
            ifnull(pag_pagato_totale, 0) AS pag_pagato_totale,
            {n("ifnull(anac_n_cig, 0)")} AS anac_n_cig,
            {n("ifnull(anac_n_gare, 0)")} AS anac_n_gare,
            ifnull(anac_importo_aggiudicato, 0) AS anac_importo_aggiudicato,
            {n("ifnull(anac_n_sal, 0)")} AS anac_n_sal,
            ifnull(anac_importo_sal, 0) AS anac_importo_sal,
            anac_importo_base, anac_importo_consuntivo, anac_importo_base_appaiata,
            anac_importo_consuntivo_appaiato,
            {n("ifnull(anac_n_cig_con_base, 0)")} AS anac_n_cig_con_base,
            {n("ifnull(anac_n_cig_con_consuntivo, 0)")} AS anac_n_cig_con_consuntivo,
            {n("ifnull(anac_n_cig_appaiati, 0)")} AS anac_n_cig_appaiati,
            {n("ifnull(anac_n_cig_base_sospetta, 0)")} AS anac_n_cig_base_sospetta,
            {n("ifnull(anac_n_cig_consuntivo_zero, 0)")} AS anac_n_cig_consuntivo_zero,
            {n("ifnull(anac_n_cig_base_grande, 0)")} AS anac_n_cig_base_grande,
            ifnull(anac_n_cig_base_sospetta, 0) > 0 AS anac_base_sospetta,
            if(anac_importo_base_appaiata > 0,
               {rnd('''100e0 * (anac_importo_consuntivo_appaiato - anac_importo_base_appaiata)
                    / anac_importo_base_appaiata''', 2)}, NULL) AS anac_scostamento_pct,
            {n("ifnull(anac_n_varianti_qe, 0)")} AS anac_n_varianti_qe,
            anac_data_ultima_agg, {n("ifnull(n_ritardo, 0)")} AS anac_sal_in_ritardo,
            ifnull(anac_n_cig, 0) >= 5 AS flag_ombrello,
            {n("ifnull(coe_n_progetti, 0)")} AS coe_n_progetti,
            ifnull(coe_finanz_tot_pubblico, 0) AS coe_finanz_tot_pubblico,
            silos_denominazione, silos_sistema, silos_stato, silos_macro_stato,
            silos_costi_mln, silos_disponibilita_mln, silos_gap_mln,
            CASE WHEN regione IN ('EUROPE', 'ASIA') THEN 'NORD' WHEN regione = 'AMERICA'
                THEN 'CENTRO' ELSE 'SUD+ISOLE' END AS area,
            ifnull(anac_n_cig > 0, false)::INTEGER + ifnull(pnrr_fin_pnrr > 0, false)::INTEGER
                + ifnull(coe_n_progetti > 0, false)::INTEGER AS n_fonti_lab,
            n_fonti_lab > 0 AS con_almeno_una_fonte_lab
        FROM projects p LEFT JOIN place USING (cup) LEFT JOIN fund USING (cup)
            LEFT JOIN plan_top USING (cup) LEFT JOIN plan_tenders USING (cup)
            LEFT JOIN plan_paid USING (cup) LEFT JOIN proc USING (cup)
            LEFT JOIN late USING (cup) LEFT JOIN coh USING (cup)
            LEFT JOIN works_top USING (cup)""",
}
WIDE = list(STEPS)


def text(select: str, steps: list[str]) -> str:
    head = ",\n".join(f"{name} AS ({STEPS[name]})" for name in steps)
    return f"WITH {head}\n{select}" if steps else select


def keys(table: str, cup: str = "cup") -> str:
    """The fingerprint of the codes in a table: 60 bits of a hash each, added up modulo 2^62."""
    bits = f"('0x' || md5('=' || {cup})[1:15])::BIGINT"
    return f"(SELECT (coalesce(sum({bits}), 0) % 4611686018427387904)::BIGINT FROM {table})"


def over_wide(select: str) -> str:
    return text(select, WIDE)


def rounded(names: str, digits: int = 2) -> str:
    return ", ".join(f"{rnd(name, digits)} AS {name}" for name in names.split())


WIDE_MONEY = (
    "costo_progetto finanziamento_progetto pnrr_fin_pnrr pnrr_fin_totale "
    "pnrr_importo_aggiudicato pag_pagato_pnrr pag_pagato_totale anac_importo_aggiudicato "
    "anac_importo_sal anac_importo_base anac_importo_consuntivo anac_importo_base_appaiata "
    "anac_importo_consuntivo_appaiato coe_finanz_tot_pubblico silos_costi_mln "
    "silos_disponibilita_mln silos_gap_mln"
)
PROC_MONEY = (
    "anac_importo_aggiudicato anac_importo_sal anac_importo_base anac_importo_consuntivo "
    "anac_importo_base_appaiata anac_importo_consuntivo_appaiato"
)
PROC_COUNTS = (
    "anac_n_cig anac_n_gare anac_n_sal anac_n_cig_con_base anac_n_cig_con_consuntivo "
    "anac_n_cig_appaiati anac_n_cig_base_sospetta anac_n_cig_base_grande "
    "anac_n_cig_consuntivo_zero anac_n_varianti_qe"
)
PROC = ["owner", "won", "done", "late", "spent", "facts", "proc"]


def _counts(names: str) -> str:
    return ", ".join(f"{n(name)} AS {name}" for name in names.split())


#: Columns and floors of the smoke contract; fixed values.
SMOKE_COLUMNS = (
    "cup regione comune soggetto_titolare stato_progetto costo_progetto settore_intervento area "
    "anac_n_cig anac_n_gare anac_importo_aggiudicato pnrr_fin_pnrr pnrr_missione coe_n_progetti "
    "flag_ombrello con_almeno_una_fonte_lab n_fonti_lab silos_costi_mln silos_macro_stato"
)
SMOKE_ROWS = 11_000_000
SMOKE_FLOORS = {
    "con_almeno_una_fonte_lab": 1_500_000,
    "silos_costi_mln IS NOT NULL": 1_000,
}


def contract_text(over_wide) -> str:
    """Rows of contracts that break, and how many broken rules stop a run."""
    present = [
        f"SELECT 'required_column', '{name}', 1::BIGINT, 1::BIGINT, true"
        for name in SMOKE_COLUMNS.split()
    ]
    floors = [
        f"SELECT 'at_least', '{condition}', {count_if(condition)}, {floor}, true FROM wide"
        for condition, floor in SMOKE_FLOORS.items()
    ]
    tables = [
        f"SELECT 'required_table', '{name}', {int(name != 'supplier_register')}, 1, true"
        for name in ("orders", "lineitem", "part", "supplier_register")
    ]
    rows = " UNION ALL ".join(
        [
            *present,
            "SELECT 'required_column', 'cup', 1, 1, true",
            "SELECT 'required_column', 'cig', 0, 1, true",
            "SELECT 'min_rows', '*', count(*), 1000000000, true FROM orders",
            f"SELECT 'min_rows', '*', count(*), {SMOKE_ROWS}, true FROM wide",
            *floors,
            *tables,
        ]
    )
    return over_wide(f"""
        , seen(rule, "column", observed, expected, floor) AS ({rows}),
        judged AS (SELECT rule, "column", observed, expected, observed >= expected AS passed
            FROM seen)
        SELECT * FROM judged
        UNION ALL SELECT 'enforced', '*', count(*) FILTER (WHERE NOT passed),
            count(*) FILTER (WHERE NOT passed), true FROM judged""")


def oracle_sql() -> dict[str, str]:
    project_columns = "* REPLACE (" + rounded("costo_progetto finanziamento_progetto") + ")"
    works_money = rounded(
        "costi_mln_euro disponibilita_mln_euro fabbisogno_mln_euro gap_finanziario_mln_euro"
    )
    top_money = rounded("silos_costi_mln silos_disponibilita_mln silos_gap_mln")
    anac, plan, coh, lab = (
        "anac_n_cig > 0",
        "pnrr_fin_pnrr > 0",
        "coe_n_progetti > 0",
        "con_almeno_una_fonte_lab",
    )
    cost_sum = rnd("sum(costo_progetto)", 2) + " AS costo"
    region = "coalesce(regione, 'SCONOSCIUTA') AS regione"
    sector = "coalesce(settore_intervento, 'SCONOSCIUTO') AS settore_intervento"
    share = f"""
        SELECT %s, {rnd("sum(pnrr_fin_pnrr)", 2)} AS pnrr_fin, {cost_sum},
            {rnd("100 * sum(pnrr_fin_pnrr) / sum(costo_progetto)", 4)} AS pct_pnrr
        FROM wide GROUP BY 1"""
    texts = {
        "register_flags": text(f"SELECT {project_columns} FROM projects", ["projects"]),
        "italian_amount_cast": f"""
            SELECT l_orderkey, l_linenumber, l_shipdate, {rnd("l_extendedprice", 2)} AS comma_value,
                if(l_extendedprice >= 1000, NULL, {rnd("l_extendedprice", 2)}) AS thousands_value,
                {rnd("l_extendedprice", 2)} AS italian_value,
                round(l_quantity)::INTEGER AS whole_value, l_suppkey
            FROM lineitem""",
        "location_clean": text("SELECT * FROM locations", ["locations"]),
        "holder_register": """
            SELECT c_name AS soggetto_titolare,
                lpad(c_custkey::VARCHAR, 11, '0') AS piva_codfiscale_sog_titolare,
                'VIA ' || n_name AS indirizzo_sog_titolare,
                n_name AS comune_soggetto_titolare,
                n_nationkey::VARCHAR AS codice_comune_sogg_titolare,
                left(c_mktsegment, 2) AS codice_categoria_soggetto,
                c_mktsegment AS categoria_soggetto,
                n_regionkey::VARCHAR AS codice_area_soggetto, n_name AS area_soggetto,
                c_name AS soggetto_richiedente
            FROM customer JOIN nation ON n_nationkey = c_nationkey""",
        "funding_clean": """
            SELECT l_orderkey::VARCHAR AS cup, ascii(l_returnflag)::VARCHAR AS codice_copertura,
                l_returnflag || l_linestatus AS copertura_finanziaria FROM lineitem""",
        "location_mart": text(
            "SELECT cup, regione, provincia, comune, codice_comune FROM locations", ["locations"]
        ),
        "funding_source_mart": """
            SELECT l_orderkey::VARCHAR AS cup, l_returnflag || l_linestatus
                AS copertura_finanziaria FROM lineitem""",
        "location_first": text("SELECT * FROM place", ["locations", "place"]),
        "recovery_top_row": text(
            "SELECT * REPLACE (" + rounded("pnrr_fin_pnrr pnrr_fin_totale") + ") FROM plan_top",
            ["plan_top"],
        ),
        "strategic_status": text(f"SELECT * REPLACE ({works_money}) FROM works", ["works"]),
        "strategic_top_row": text(
            f"SELECT * REPLACE ({top_money}) FROM works_top", ["works", "works_top"]
        ),
        "funding_flags": text("SELECT * FROM fund", ["fund"]),
        "recovery_tenders": text(
            "SELECT * REPLACE (" + rounded("pnrr_importo_aggiudicato") + ") FROM plan_tenders",
            ["plan_tenders"],
        ),
        "recovery_payments": text(
            "SELECT * REPLACE ("
            + rounded("pag_pagato_pnrr pag_pagato_totale")
            + ") FROM plan_paid",
            ["plan_paid"],
        ),
        "cohesion": text("SELECT * FROM coh", ["coh"]),
        "tender_map": text("SELECT tender::VARCHAR AS cig, cup FROM owner", ["owner"]),
        "tender_awards": text(
            f"""SELECT tender::VARCHAR AS cig, n_won AS n_aggiudicazioni,
                {rnd("won", 2)} AS importo_totale_agg, last_won AS data_ultima_agg FROM won""",
            ["won"],
        ),
        "tender_progress": text(
            f"""SELECT tender::VARCHAR AS cig, n_sal, {rnd("sal", 2)} AS importo_totale_sal
                FROM done""",
            ["done"],
        ),
        "tender_costs": text(
            f"""SELECT tender::VARCHAR AS cig, {rnd("base", 2)} AS importo_base,
                {rnd("final", 2)} AS importo_consuntivo, variants AS n_varianti_qe,
                ifnull(final = 0, false) AS consuntivo_zero,
                if(base > 0 AND final > 0, {rnd("base", 2)}, NULL) AS base_appaiata,
                if(base > 0 AND final > 0, {rnd("final", 2)}, NULL) AS cons_appaiato,
                ifnull(base >= 250000, false) AS base_sospetta,
                ifnull(base >= 150000, false) AS base_grande FROM spent""",
            ["spent"],
        ),
        "procurement_rollup": text(
            f"""SELECT cup, {_counts(PROC_COUNTS)}, {rounded(PROC_MONEY)}, anac_data_ultima_agg,
                {n("ifnull(n_ritardo, 0)")} AS anac_sal_in_ritardo
                FROM proc LEFT JOIN late USING (cup)""",
            PROC,
        ),
        "late_progress": text("SELECT * FROM late", ["owner", "late"]),
        "wide_register": over_wide(f"SELECT * REPLACE ({rounded(WIDE_MONEY)}) FROM wide"),
        "register_with_support": text(
            f"""SELECT p.{project_columns}, regione, provincia, comune, codice_comune,
                {n("ifnull(n_fonti, 0)")} AS n_fonti,
                ifnull(ha_fonte_statale, false) AS ha_fonte_statale,
                ifnull(ha_fonte_ue, false) AS ha_fonte_ue,
                ifnull(ha_fonte_regionale, false) AS ha_fonte_regionale,
                ifnull(ha_fonte_privata, false) AS ha_fonte_privata
            FROM projects p LEFT JOIN place USING (cup) LEFT JOIN fund USING (cup)""",
            ["projects", "locations", "place", "fund"],
        ),
        "territory_mart": over_wide(f"""
            SELECT {region}, area, {sector}, anno_decisione, count(*) AS n_cup,
                {billions("sum(ifnull(costo_progetto, 0))")} AS costo_mld,
                {billions("sum(ifnull(finanziamento_progetto, 0))")} AS finanziamento_mld,
                {count_if(lab)} AS n_con_fonte_lab, {pct_if(lab)} AS pct_con_fonte_lab,
                {count_if(anac)} AS n_con_anac, {count_if(plan)} AS n_con_pnrr,
                {count_if(coh)} AS n_con_coesione,
                {billions("sum(pnrr_fin_pnrr)")} AS pnrr_fin_mld,
                {billions("sum(anac_importo_aggiudicato)")} AS anac_importo_mld,
                {count_if("flag_ombrello")} AS n_ombrello,
                max(anac_data_ultima_agg) AS anac_data_ultima_agg
            FROM wide GROUP BY ALL HAVING n_cup > 9"""),
        "funding_mart": over_wide(f"""
            SELECT {sector}, area, count(*) AS n_cup,
                {billions("sum(ifnull(costo_progetto, 0))")} AS costo_mld,
                {count_if("ha_fonte_statale")} AS n_fonte_statale,
                {count_if("ha_fonte_ue")} AS n_fonte_ue,
                {count_if("ha_fonte_regionale")} AS n_fonte_regionale,
                {count_if("ha_fonte_privata")} AS n_fonte_privata,
                {count_if(anac)} AS n_anac, {count_if(plan)} AS n_pnrr,
                {count_if(coh)} AS n_coesione, {count_if(lab)} AS n_con_fonte_lab,
                {pct_if("ha_fonte_statale")} AS pct_statale, {pct_if("ha_fonte_ue")} AS pct_ue,
                {pct_if(anac)} AS pct_anac, {pct_if(plan)} AS pct_pnrr,
                {pct_if(lab)} AS pct_con_fonte_lab,
                {billions("sum(pnrr_fin_pnrr)")} AS pnrr_fin_mld,
                {billions("sum(anac_importo_aggiudicato)")} AS anac_importo_mld,
                {billions("sum(coe_finanz_tot_pubblico)")} AS coesione_fin_mld
            FROM wide GROUP BY ALL HAVING n_cup > 9"""),
        "cost_mart": over_wide(f"""
            SELECT {region}, area, {sector}, count(*) AS n_cup_con_base,
                {billions("sum(anac_importo_base)")} AS importo_base_mld,
                count(anac_scostamento_pct) AS n_cup_con_scostamento,
                {count_if("anac_n_cig_con_consuntivo > 0 AND anac_scostamento_pct IS NULL")}
                    AS n_cup_parziali,
                {billions("sum(anac_importo_base_appaiata)")} AS importo_base_appaiata_mld,
                {billions("sum(anac_importo_consuntivo_appaiato)")}
                    AS importo_consuntivo_appaiato_mld,
                {billions('''(sum(anac_importo_consuntivo_appaiato)
                    - sum(anac_importo_base_appaiata))''')} AS scostamento_mld,
                {rnd("median(anac_scostamento_pct)", 1)} AS scostamento_pct_mediano,
                {count_if("anac_scostamento_pct > 10")} AS n_oltre_10pct,
                {n("sum(anac_n_varianti_qe)")} AS n_varianti_qe
            FROM wide WHERE anac_importo_base > 0 GROUP BY ALL HAVING n_cup_con_base > 9"""),
        "report_overview": over_wide(f"""
            SELECT count(*) AS n_cup, {cost_sum}, {count_if(lab)} AS con_lab,
                {count_if(anac)} AS con_anac, {count_if(HAS_WORKS)} AS con_silos FROM wide"""),
        "report_area": over_wide(f"""
            SELECT area, count(*) AS n_cup, {cost_sum}, {count_if(lab)} AS con_fonte,
                {pct_if(lab)} AS pct FROM wide GROUP BY area"""),
        "report_status": text(
            "SELECT stato_progetto, count(*) AS n FROM projects GROUP BY 1", ["projects"]
        ),
        "report_sectors": over_wide(f"""
            SELECT settore_intervento, count(*) AS n_cup, {cost_sum},
                {count_if(anac)} AS con_anac, {pct_if(anac)} AS pct_anac
            FROM wide GROUP BY 1 ORDER BY sum(costo_progetto) DESC, 1 LIMIT 10"""),
        "report_funding_totals": over_wide(f"""
            SELECT {count_if("ha_fonte_statale")} AS statale, {count_if("ha_fonte_ue")} AS ue,
                {count_if("ha_fonte_regionale")} AS regionale,
                {count_if("ha_fonte_privata")} AS privata FROM wide"""),
        "report_region_cost": over_wide(f"""
            SELECT regione, count(*) AS n_cup, {cost_sum}, {count_if(lab)} AS con_lab
            FROM wide GROUP BY regione"""),
        "report_region_top15": over_wide(f"""
            SELECT regione, count(*) AS n_cup, {cost_sum}, {count_if(lab)} AS con_lab
            FROM wide GROUP BY regione ORDER BY sum(costo_progetto) DESC LIMIT 15"""),
        "report_region_names": text(
            "SELECT DISTINCT regione FROM projects LEFT JOIN place USING (cup)",
            ["projects", "locations", "place"],
        ),
        "report_region_kpi": over_wide(f"""
            SELECT count(*) AS n_cup, {cost_sum}, {count_if(lab)} AS con_lab,
                {count_if(anac)} AS con_anac FROM wide WHERE regione = 'EUROPE'"""),
        "report_region_sectors": over_wide(f"""
            SELECT settore_intervento, count(*) AS n_cup, {cost_sum} FROM wide
            WHERE regione = 'EUROPE' GROUP BY 1 ORDER BY sum(costo_progetto) DESC, 1 LIMIT 8"""),
        "report_lab_totals": over_wide(f"""
            SELECT {count_if(anac)} AS anac, {count_if(plan)} AS pnrr, {count_if(coh)} AS coesione,
                {count_if(lab)} AS totale FROM wide"""),
        "report_sector_coverage": over_wide(f"""
            SELECT settore_intervento, count(*) AS n_cup, {count_if(anac)} AS con_anac,
                {pct_if(anac)} AS pct FROM wide GROUP BY 1 HAVING con_anac > 0
            ORDER BY pct DESC, 1 LIMIT 10"""),
        "report_recovery_share_area": over_wide(share % "area"),
        "report_recovery_share_sector": over_wide(share % "settore_intervento"),
        "report_execution": over_wide(f"""
            SELECT count(*) AS n_cup, {n("sum(anac_n_gare)")} AS n_gare,
                {rnd("sum(anac_importo_aggiudicato)", 2)} AS importo,
                {n("sum(anac_n_sal)")} AS sal, {rnd("sum(anac_importo_sal)", 2)} AS importo_sal,
                {n("sum(anac_sal_in_ritardo)")} AS sal_ritardo FROM wide WHERE {anac}"""),
        "report_umbrella": over_wide("SELECT count(*) AS n FROM wide WHERE flag_ombrello"),
        "report_umbrella_top": over_wide(f"""
            SELECT cup, soggetto_titolare, regione, anac_n_cig, {rounded("costo_progetto")}
            FROM wide WHERE flag_ombrello ORDER BY anac_n_cig DESC, cup LIMIT 20"""),
        "report_works_kpi": over_wide(f"""
            SELECT count(*) AS n, {rnd("sum(silos_costi_mln)", 2)} AS costo,
                {rnd("sum(silos_disponibilita_mln)", 2)} AS disp,
                {rnd("sum(silos_gap_mln)", 2)} AS gap,
                {rnd("sum(silos_costi_mln) * 1e6", 0)} AS costo_eur,
                {rnd("sum(silos_disponibilita_mln) * 1e6", 0)} AS disp_eur,
                {rnd("sum(silos_gap_mln) * 1e6", 0)} AS gap_eur
            FROM wide WHERE {HAS_WORKS}"""),
        "report_works_top": over_wide(f"""
            SELECT cup, silos_denominazione, silos_sistema, silos_stato, {top_money}, regione,
                anac_n_cig, {rounded("pnrr_fin_pnrr")}
            FROM wide WHERE {HAS_WORKS} ORDER BY wide.silos_costi_mln DESC, cup LIMIT 30"""),
        "report_gap_top": over_wide(f"""
            SELECT silos_denominazione AS denominazione, {rounded("silos_gap_mln")}, cup,
                silos_sistema, {rounded("silos_costi_mln")},
                if(length(silos_denominazione) > 50, silos_denominazione[:50] || '...',
                   silos_denominazione) AS opera
            FROM wide WHERE wide.silos_gap_mln > 0
            ORDER BY wide.silos_gap_mln DESC, cup LIMIT 15"""),
        "report_works_state": over_wide(f"""
            SELECT silos_macro_stato AS stato, count(*) AS n FROM wide WHERE {HAS_WORKS}
            GROUP BY 1"""),
        "report_works_system": over_wide(f"""
            SELECT silos_sistema, count(*) AS n_opere, {rnd("sum(silos_costi_mln)", 2)} AS costo,
                {rnd("sum(silos_gap_mln)", 2)} AS gap FROM wide WHERE {HAS_WORKS} GROUP BY 1"""),
        "report_project_card": over_wide(
            f"SELECT * REPLACE ({rounded(WIDE_MONEY)}) FROM wide WHERE cup = '7'"
        ),
        "report_region_top5": over_wide("""
            SELECT regione, count(*) AS n_cup FROM wide GROUP BY 1
            ORDER BY n_cup DESC, 1 LIMIT 5"""),
        "adhoc_sql": over_wide(f"""
            SELECT area, flag_chiuso, count(*) AS n_cup,
                {rnd("sum(anac_importo_sal)", 2)} AS importo_sal
            FROM wide WHERE n_fonti_lab > 0 GROUP BY ALL"""),
        "layer_years": text(
            f"""SELECT anno_decisione, count(*) AS n_cup, {cost_sum} FROM projects
                GROUP BY 1""",
            ["projects"],
        ),
        "csv_ingest": text(
            f"""SELECT cup, anno_decisione, {rounded("costo_progetto finanziamento_progetto")},
                settore_intervento || ' "' || stato_progetto || '"' || chr(10)
                    || soggetto_titolare AS descrizione_intervento,
                if(cup_master = '  ', NULL, cup_master) IS NOT NULL AS flag_sub_progetto
            FROM projects""",
            ["projects"],
        ),
        "quality_metrics": over_wide(f"""
            , seen(rule, "column", observed, expected, floor) AS (
                SELECT 'required_column', 'cup', 1::BIGINT, 1::BIGINT, true
                UNION ALL SELECT 'not_null', 'cup', {count_if("cup IS NULL")}, 0, false FROM wide
                UNION ALL SELECT 'not_null', 'anac_importo_base',
                    {count_if("anac_importo_base IS NULL")}, 0, false FROM wide
                UNION ALL SELECT 'min_rows', '*', count(*), 100, true FROM wide
                UNION ALL SELECT 'at_least', '{HAS_WORKS}', {count_if(HAS_WORKS)}, 10, true
                    FROM wide
                UNION ALL SELECT 'max_age', 'anac_data_ultima_agg', date_diff('day',
                    max(anac_data_ultima_agg)::DATE, DATE '2030-01-01'), 30, false FROM wide
                UNION ALL SELECT 'primary_key', 'cup', count(*) - count(DISTINCT cup), 0, false
                    FROM wide
                UNION ALL SELECT 'same_rows', '*', (SELECT count(*) FROM wide), count(*), true
                    FROM orders
                UNION ALL SELECT 'same_keys', 'cup', {keys("wide")}, {keys("projects")}, true)
            SELECT rule, "column", observed, expected,
                if(floor, observed >= expected, observed <= expected) AS passed
            FROM seen"""),
    }
    def in_place(name: str, order: str, limit: int | None = None) -> str:
        numbered = f"""
            SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({texts[name]})"""
        return numbered if limit is None else f"{numbered} QUALIFY place <= {limit}"

    by_cost = "costo DESC NULLS LAST, {} NULLS LAST"
    sectors, regions = by_cost.format("settore_intervento"), by_cost.format("regione")
    by_place = "regione NULLS LAST, area NULLS LAST, settore_intervento NULLS LAST"
    no_tenders = "if(settore_intervento = '1-URGENT', 0, anac_n_cig)"
    pairs = {
        "same": "projects",
        "lost": "(FROM projects WHERE cup <> (SELECT min(cup) FROM projects))",
        "doubled": "(FROM projects UNION ALL FROM projects WHERE cup = (SELECT max(cup) FROM projects))",
        "swapped": """(FROM projects WHERE cup <> (SELECT min(cup) FROM projects)
            UNION ALL FROM projects WHERE cup = (SELECT max(cup) FROM projects))""",
    }
    compared = " UNION ALL ".join(
        f"""SELECT '{name}' AS pair, 'same_rows' AS rule, '*' AS "column",
            (SELECT count(*) FROM {copy}) AS observed, (SELECT count(*) FROM projects) AS expected
        UNION ALL SELECT '{name}', 'same_keys', 'cup', {keys(copy)}, {keys("projects")}"""
        for name, copy in pairs.items()
    )
    code = "(l_partkey * 7 + l_orderkey) % 10"
    texts |= {
        "report_sectors_top3": in_place("report_sectors", sectors, 3),
        "report_region_sectors_top2": in_place("report_region_sectors", sectors, 2),
        "report_sector_coverage_top3": in_place(
            "report_sector_coverage", "pct DESC NULLS LAST, settore_intervento", 3
        ),
        "report_sector_coverage_cut": over_wide(f"""
            SELECT settore_intervento, count(*) AS n_cup, {count_if(no_tenders + " > 0")} AS con_anac,
                {pct_if(no_tenders + " > 0")} AS pct FROM wide GROUP BY 1 HAVING con_anac > 0
            ORDER BY pct DESC, 1 LIMIT 10"""),
        "report_region_top3": in_place("report_region_cost", regions, 3),
        "report_region_cost_order": in_place("report_region_cost", regions),
        "report_region_names_order": in_place("report_region_names", "regione NULLS LAST"),
        "report_status_order": in_place("report_status", "n DESC, stato_progetto NULLS LAST"),
        "report_area_order": in_place("report_area", by_cost.format("area")),
        "report_works_state_order": in_place("report_works_state", "n DESC, stato NULLS LAST"),
        "report_works_system_order": in_place(
            "report_works_system", by_cost.format("silos_sistema")
        ),
        "report_recovery_share_order": in_place(
            "report_recovery_share_sector", "pct_pnrr DESC NULLS LAST, settore_intervento NULLS LAST"
        ),
        "territory_mart_order": in_place(
            "territory_mart",
            f"costo_mld DESC NULLS LAST, {by_place}, anno_decisione NULLS LAST",
        ),
        "funding_mart_order": in_place(
            "funding_mart",
            "costo_mld DESC NULLS LAST, settore_intervento NULLS LAST, area NULLS LAST",
        ),
        "cost_mart_order": in_place("cost_mart", f"importo_base_mld DESC NULLS LAST, {by_place}"),
        "same_rows_pairs": text(
            f"SELECT *, observed = expected AS passed FROM ({compared})", ["projects"]
        ),
        "published_versions": text(
            """SELECT anno_decisione, count(*) AS n_cup, 2::BIGINT AS n_versions,
                sum(count(*)) OVER ()::BIGINT AS n_counted
            FROM projects WHERE anno_decisione::INTEGER < 1999 GROUP BY 1""",
            ["projects"],
        ),
        "layer_years_widened": text(
            f"""SELECT anno_decisione, 'double' AS tipo, count(*) AS n_cup,
                {rnd("sum(if(anno_decisione::INTEGER < 1998, trunc(costo_progetto), costo_progetto))", 2)}
                    AS costo
            FROM projects GROUP BY 1""",
            ["projects"],
        ),
        "tender_map_blank_codes": f"""
            SELECT l_partkey::VARCHAR AS cig, min(l_orderkey::VARCHAR) AS cup FROM lineitem
            WHERE {code} > 4 AND l_orderkey::VARCHAR NOT IN ('ND', '0') GROUP BY 1""",
        "snapshot_rows": text(
            """SELECT '1998-02-01' AS snapshot, count(*) AS n_written, count(*) AS n_read,
                max(anno_decisione) AS last_year
            FROM projects WHERE anno_decisione::INTEGER <= 1998""",
            ["projects"],
        ),
        "contract_rows": contract_text(over_wide),
    }
    return texts | {
        "report_funding_detail": texts["funding_mart"],
        "csv_ingest_cut_files": texts["csv_ingest"],
        "csv_ingest_crlf": texts["csv_ingest"].replace("chr(10)", "chr(13) || chr(10)"),
        "works_ingest": texts["strategic_status"],
        "stored_wide_register": texts["wide_register"],
        "stored_project_card": texts["report_project_card"],
    }
