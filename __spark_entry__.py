
from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_texts  # noqa: E402
from publicspend.functions.measures import stable_round  # noqa: E402
from publicspend.functions.text import comma_decimal, italian_number, lenient_int  # noqa: E402
from publicspend.operators import procurement, quality, register, rollups, strategic  # noqa: E402
from publicspend.operators.ordering import in_place  # noqa: E402
from publicspend.operators.quality import Contract, Watch  # noqa: E402
from publicspend.plans import compose, contracts, marts, reports  # noqa: E402
from publicspend.session import (  # noqa: E402
    largest_bytes,
    shared_folder,
    shuffle_width,
    shuffles_of,
)
from publicspend.sources import layers, tables  # noqa: E402
from publicspend.sources.csv_files import read_text_table  # noqa: E402
from publicspend.sources.proxy import (  # noqa: E402
    PROXY_RULES,
    WORKS_YEAR,
    Proxy,
    comma_text,
    italian_text,
)
from publicspend.sources.tables import Buckets  # noqa: E402

try:  # the corpus operators, or a library that only they use, may be absent
    import corpus_pipeline  # noqa: E402
    from publicspend.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError:
    llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Tables that grow, and how stored ones are dealt: a bucket for each BUCKET_BYTES of the largest
# one's files, so that buckets stay as small and all cores busy whatever its size.
GROWING = "orders lineitem events part".split()
LEAST_BUCKETS, BUCKET_BYTES, WRITES_AT_ONCE = 8, 8 * 1024 * 1024, 3


def entry(spark: SparkSession) -> DataFrame:
    """Cost and covered share by region, sector and year."""
    return queries()["territory_mart"](spark, "/root/testdata/sf0.001")


def _rounded(df: DataFrame, names: str, digits: int = 2) -> DataFrame:
    return df.withColumns({name: stable_round(F.col(name), digits) for name in names.split()})


def _from_proxy(build: Callable[[Proxy], DataFrame], money: str = "", digits: int = 2) -> Query:
    """A query over the proxy sources; ``money`` names the sums to round for comparison."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(build(Proxy(spark, folder)), money, digits)

    return run


def _over_wide(report: Callable[[DataFrame], DataFrame], money: str = "", digits: int = 2) -> Query:
    return _from_proxy(lambda p: report(p.wide()), money, digits)


def _scratch(spark: SparkSession, name: str) -> str:
    run = f"{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    return f"{shared_folder(spark)}/publicspend/{run}"


def italian_amount_cast(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("l_extendedprice")
    lines = Proxy(spark, folder).table("lineitem")
    parsed = lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        comma_decimal(comma_text(amount)).alias("comma_value"),
        comma_decimal(italian_text(amount)).alias("thousands_value"),
        italian_number(italian_text(amount)).alias("italian_value"),
        lenient_int(F.col("l_quantity").cast("string")).alias("whole_value"),
        "l_suppkey",
    )
    return _rounded(parsed, "comma_value thousands_value italian_value")


def _as_text(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(
        header=True, sep=";", escape='"', quoteAll=True, emptyValue="", nullValue=""
    ).csv(path)
    return path


def works_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The strategic-works report as delimited text, read back, typed and classified."""
    raw = Proxy(spark, folder).works_raw().withColumn("NOTE", F.lit("not mapped"))
    stored = read_text_table(spark, _as_text(raw, _scratch(spark, "works_ingest")))
    return strategic.works_mart(strategic.clean_works(stored, WORKS_YEAR))


def csv_ingest(
    spark: SparkSession, folder: str, line_break: str = "\n", part_bytes: int | None = None
) -> DataFrame:
    """Register shards as delimited text, with quotes and line breaks inside fields.

    ``part_bytes``: cut the files into parts of this size.
    """
    raw = (
        Proxy(spark, folder)
        .projects_raw()
        .withColumn(
            "DESCRIZIONE_INTERVENTO",
            F.format_string(
                f'%s "%s"{line_break}%s', "SETTORE_INTERVENTO", "STATO_PROGETTO", "SOGGETTO_TITOLARE"
            ),
        )
    )
    shards = _scratch(spark, "csv_ingest")
    text = _as_text(raw, f"{shards}/raw")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    if part_bytes:
        spark.conf.set(setting, str(part_bytes))
    try:
        stored = layers.write_table(read_text_table(spark, text), f"{shards}/parquet")
    finally:
        spark.conf.set(setting, before)
    projects = register.project_mart(register.clean_projects(stored), PROXY_RULES)
    columns = "cup anno_decisione costo_progetto finanziamento_progetto descrizione_intervento"
    return _rounded(
        projects.select(*columns.split(), "flag_sub_progetto"),
        "costo_progetto finanziamento_progetto",
    )


def layer_years(spark: SparkSession, folder: str) -> DataFrame:
    """The register stored by decision year, its years read back together and queried."""
    root = _scratch(spark, "layer_years")
    projects = Proxy(spark, folder).projects().withColumn("year", F.col("anno_decisione"))
    projects.write.mode("overwrite").partitionBy("year").parquet(root)
    years = [int(year) for year in layers.partition_values(spark, root, "year")]
    sql = """
        SELECT anno_decisione, count(*) AS n_cup, sum(costo_progetto) AS costo
        FROM clean_input GROUP BY anno_decisione"""
    stored = layers.read_years(spark, f"{root}/year={{year}}", years)
    return _rounded(layers.query_tables(spark, sql, clean_input=stored), "costo")


def report_funding_detail(spark: SparkSession, folder: str) -> DataFrame:
    """The funding mart as the report reads it, from the mart layer."""
    root, name, year = _scratch(spark, "report_funding_detail"), "registro_ampio", 2026
    mart = marts.funding_mart(Proxy(spark, folder).wide())
    layers.write_table(mart, layers.mart_path(root, name, year, "mart_fonti"))
    return layers.load_mart(spark, root, name, "mart_fonti", year)


def _over_wide_in_place(report: Callable[[DataFrame], DataFrame], money: str = "") -> Query:
    """A report and the place of each of its rows in it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = report(Proxy(spark, folder).wide())
        return _rounded(in_place(found, _scratch(spark, "in_place")), money)

    return run


def contract_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts that break: an absent column, a missing table, the smoke contract, old data."""
    proxy = Proxy(spark, folder)
    projects, wide = proxy.projects(), proxy.wide()
    broken = Contract(required_columns=("cup", "cig"), not_null=("cig",), min_rows=10**9)
    absent = quality.check(projects, broken)
    smoke = quality.check(wide, contracts.WIDE_SMOKE)
    given = ["orders", "lineitem", "part"]
    tables = quality.tables_check(given, [*given, "supplier_register"])
    checks = absent.unionAll(tables).unionAll(smoke)
    failing = checks.where(~F.col("passed"))
    try:
        quality.enforce(checks)
        stopped = 0
    except quality.QualityError as error:
        stopped = len(str(error).split("; "))
    enforced = failing.agg(
        F.lit("enforced").alias("rule"),
        F.lit("*").alias("column"),
        F.lit(stopped).cast("bigint").alias("observed"),
        F.count("*").alias("expected"),
        (F.count("*") == stopped).alias("passed"),
    )
    return checks.unionAll(enforced)


def snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The register written in dated folders, the newest read, its rows counted after the write."""
    base = _scratch(spark, "snapshots")
    projects = Proxy(spark, folder).projects().select("cup", "anno_decisione")
    for name, year in (("1996-06-30", 1996), ("1998-02-01", 1998), ("old", 1992)):
        part = projects.where(F.col("anno_decisione").cast("int") <= year)
        layers.write_table(part, f"{base}/{name}")
    newest = layers.latest_snapshot(spark, base)
    written = layers.row_count(spark, newest)
    return tables.read_table(spark, newest).agg(
        F.lit(newest.rsplit("/", 1)[1]).alias("snapshot"),
        F.lit(written).cast("bigint").alias("n_written"),
        F.count("*").alias("n_read"),
        F.max("anno_decisione").alias("last_year"),
    )


def adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    sql = """
        SELECT area, flag_chiuso, count(*) AS n_cup, sum(anac_importo_sal) AS importo_sal
        FROM clean_input WHERE n_fonti_lab > 0 GROUP BY area, flag_chiuso"""
    wide = Proxy(spark, folder).wide()
    return _rounded(layers.query_tables(spark, sql, clean_input=wide), "importo_sal")


def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The wide register's contract and its keys against the register's, measured in the writes."""
    proxy, root = Proxy(spark, folder), _scratch(spark, "quality_metrics")
    contract = Contract(
        required_columns=("cup",),
        not_null=("cup", "anac_importo_base"),
        min_rows=100,
        primary_key=("cup",),
        at_least={"silos_costi_mln IS NOT NULL": 10},
        max_age={"anac_data_ultima_agg": 30},
    )
    before, after = Watch(key=("cup",)), Watch(contract, key=("cup",), as_of=dt.date(2030, 1, 1))
    # the register is read back as it was written, not worked out a second time
    projects = layers.write_table(proxy.projects(), f"{root}/projects", watch=before)
    wide = compose.wide_register(projects, proxy.support(), PROXY_RULES)
    tables.stage(after.over(wide), f"{root}/wide")
    same = quality.same_rows(tables.Facts("", before.rows, before.keys), after)
    return quality.as_table(spark, [*after.checks(), *same])


def same_rows_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The register against copies: the same rows, one lost, one doubled, and one lost for another
    that is doubled, which leaves the number of rows as it was."""
    projects = Proxy(spark, folder).projects().select("cup")
    low, high = projects.agg(F.min("cup"), F.max("cup")).first()
    lost = projects.where(F.col("cup") != low)
    doubled = projects.where(F.col("cup") == high)
    copies = {
        "same": projects.repartition(5),
        "lost": lost,
        "doubled": projects.union(doubled),
        "swapped": lost.union(doubled),
    }
    checks = [
        quality.same_rows_check(projects, copy, ("cup",)).withColumn("pair", F.lit(name))
        for name, copy in copies.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def published_versions(spark: SparkSession, folder: str) -> DataFrame:
    """What a reader sees of a table that was published twice, once written but not published, and
    once refused by its contract."""
    path = f"{_scratch(spark, 'published_versions')}/registro.parquet"
    projects = Proxy(spark, folder).projects().select("cup", "anno_decisione")
    layers.write_table(projects.where("anno_decisione < 1997"), path)
    layers.write_table(projects.where("anno_decisione < 1999"), path)
    tables.stage(projects, path)
    try:
        layers.write_table(projects, path, watch=Watch(Contract(min_rows=10**12)))
    except quality.QualityError:
        pass
    seen = tables.read_table(spark, path).groupBy("anno_decisione").agg(F.count("*").alias("n_cup"))
    n = len(tables.versions(spark, path))
    return seen.withColumns(
        {
            "n_versions": F.lit(n).cast("bigint"),
            "n_counted": F.lit(layers.row_count(spark, path)).cast("bigint"),
        }
    )


def layer_years_widened(spark: SparkSession, folder: str) -> DataFrame:
    """Years whose cost was stored as a whole number at first, then with decimals, read as one."""
    root = _scratch(spark, "layer_years_widened")
    projects = Proxy(spark, folder).projects().select("cup", "anno_decisione", "costo_progetto")
    years = [row[0] for row in projects.select("anno_decisione").distinct().collect()]
    for year in years:
        kind = "int" if int(year) < 1998 else "double"
        part = projects.where(F.col("anno_decisione") == year)
        stored = part.withColumn("costo_progetto", F.col("costo_progetto").cast(kind))
        layers.write_table(stored, layers.clean_path(root, "progetti", int(year)))
    joined = layers.load_clean(spark, root, "progetti", sorted(map(int, years)))
    grouped = joined.groupBy("anno_decisione", F.typeof("costo_progetto").alias("tipo")).agg(
        F.count("*").alias("n_cup"), F.sum("costo_progetto").alias("costo")
    )
    return _rounded(grouped, "costo")


def _buckets(spark: SparkSession, folder: str) -> Buckets:
    """Buckets of the project code, more of them for larger tables."""
    size = largest_bytes(spark, [[f"{folder}/{name}.parquet"] for name in GROWING])
    wanted = shuffle_width(size, growth=1.0, partition_bytes=BUCKET_BYTES)
    return Buckets("cup", max(LEAST_BUCKETS, wanted))


def _stored_by_code(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The wide register from a register and sides that are stored in buckets of the code."""
    proxy, root = Proxy(spark, folder), _scratch(spark, name)
    by_code, single = _buckets(spark, folder), Contract(primary_key=("cup",))
    sides = compose.support_sides(proxy.support(), PROXY_RULES)

    def store(name: str, table: DataFrame) -> DataFrame:
        return layers.write_table(table, f"{root}/{name}", watch=Watch(single), buckets=by_code)

    parts = {"registro": proxy.projects(), **sides}
    with shuffles_of(spark, by_code.count):
        # some at once, as the last tasks of one leave cores free for the next
        with ThreadPoolExecutor(WRITES_AT_ONCE) as writers:
            stored = list(writers.map(store, parts.keys(), parts.values()))
        return store("wide", compose.wide_from_sides(stored[0], stored[1:], PROXY_RULES))


def stored_wide_register(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_stored_by_code(spark, folder, "stored_wide"), oracle_texts.WIDE_MONEY)


def stored_project_card(spark: SparkSession, folder: str) -> DataFrame:
    """One project, found in the one bucket that may hold its code."""
    found = reports.project_card(_stored_by_code(spark, folder, "stored_card"), "7")
    return _rounded(found, oracle_texts.WIDE_MONEY)


def tender_map_blank_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of tender and project of which some lack a code: blank, of blanks only, or NULL."""
    pairs = Proxy(spark, folder).tender_pairs()
    key = (F.col("cig").cast("bigint") * 7 + F.col("cup").cast("bigint")) % 10

    def without(name: str, places: tuple[int, int, int]) -> Column:
        empty, blank, null = places
        return (
            F.when(key == empty, "")
            .when(key == blank, "   ")
            .when(key == null, None)
            .otherwise(F.col(name))
        )

    broken = pairs.select(
        without("cig", (0, 1, 2)).alias("cig"), without("cup", (3, 4, 2)).alias("cup")
    )
    return procurement.tender_map(broken, PROXY_RULES)


def report_sector_coverage_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage by sector where one sector has no tenders, so that its group is dropped."""
    wide = Proxy(spark, folder).wide()
    none = F.when(F.col("settore_intervento") == "1-URGENT", 0).otherwise(F.col("anac_n_cig"))
    return reports.sector_coverage(wide.withColumn("anac_n_cig", none))


def queries() -> dict[str, Query]:
    """All queries; those of the text-corpus operators only where their package is present."""
    found = base_queries()
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def base_queries() -> dict[str, Query]:
    rules = PROXY_RULES
    amounts = "costo_progetto finanziamento_progetto"
    works_money = (
        "costi_mln_euro disponibilita_mln_euro fabbisogno_mln_euro gap_finanziario_mln_euro"
    )
    works_top = "silos_costi_mln silos_disponibilita_mln silos_gap_mln"

    def tenders(p: Proxy) -> DataFrame:
        return procurement.tender_map(p.tender_pairs(), rules)

    def statements(p: Proxy) -> DataFrame:
        return procurement.tender_statements(p.statements(), rules)

    return {
        # register and support tables
        "register_flags": _from_proxy(lambda p: p.projects(), amounts),
        "italian_amount_cast": italian_amount_cast,
        "location_clean": _from_proxy(lambda p: p.locations()),
        "holder_register": _from_proxy(lambda p: register.clean_holders(p.holders_raw())),
        "funding_clean": _from_proxy(lambda p: p.funding()),
        "location_mart": _from_proxy(lambda p: register.location_mart(p.locations())),
        "funding_source_mart": _from_proxy(lambda p: register.funding_source_mart(p.funding())),
        "strategic_status": _from_proxy(lambda p: p.works(), works_money),
        # one row per key
        "location_first": _from_proxy(lambda p: rollups.preferred_location(p.locations(), rules)),
        "recovery_top_row": _from_proxy(
            lambda p: rollups.recovery_project(p.recovery_projects()),
            "pnrr_fin_pnrr pnrr_fin_totale",
        ),
        "strategic_top_row": _from_proxy(lambda p: rollups.strategic_project(p.works()), works_top),
        "funding_flags": _from_proxy(lambda p: rollups.funding_flags(p.funding(), rules)),
        "recovery_tenders": _from_proxy(
            lambda p: rollups.recovery_tenders(p.recovery_tenders()), "pnrr_importo_aggiudicato"
        ),
        "recovery_payments": _from_proxy(
            lambda p: rollups.recovery_payments(p.recovery_payments()),
            "pag_pagato_pnrr pag_pagato_totale",
        ),
        "cohesion": _from_proxy(lambda p: rollups.cohesion(p.cohesion_projects())),
        # procurement
        "tender_map": _from_proxy(tenders),
        "tender_map_blank_codes": tender_map_blank_codes,
        "tender_awards": _from_proxy(
            lambda p: procurement.tender_awards(p.awards(), rules), "importo_totale_agg"
        ),
        "tender_progress": _from_proxy(
            lambda p: procurement.tender_progress(p.statements(), rules), "importo_totale_sal"
        ),
        "tender_costs": _from_proxy(
            lambda p: procurement.tender_costs(p.cost_events(), rules),
            "importo_base importo_consuntivo base_appaiata cons_appaiato",
        ),
        "procurement_rollup": _from_proxy(
            lambda p: compose.procurement_of(p.support(), rules), oracle_texts.PROC_MONEY
        ),
        "late_progress": _from_proxy(
            lambda p: procurement.late_progress(tenders(p), statements(p))
        ),
        # composed register
        "wide_register": _from_proxy(lambda p: p.wide(), oracle_texts.WIDE_MONEY),
        "register_with_support": _from_proxy(lambda p: p.register_with_support(), amounts),
        # marts
        "territory_mart": _over_wide(marts.territory_mart),
        "funding_mart": _over_wide(marts.funding_mart),
        "cost_mart": _over_wide(marts.cost_mart),
        # reports
        "report_overview": _over_wide(reports.overview, "costo"),
        "report_area": _over_wide(reports.coverage_by_area, "costo"),
        "report_status": _over_wide(reports.status_counts),
        "report_sectors": _over_wide(reports.top_sectors, "costo"),
        "report_funding_totals": _over_wide(reports.funding_totals),
        "report_region_cost": _over_wide(reports.cost_by_region, "costo"),
        "report_region_top15": _over_wide(partial(reports.cost_by_region, limit=15), "costo"),
        "report_region_names": _over_wide(reports.region_names),
        "report_region_kpi": _over_wide(partial(reports.region_overview, region="EUROPE"), "costo"),
        "report_region_sectors": _over_wide(
            partial(reports.region_sectors, region="EUROPE"), "costo"
        ),
        "report_region_top5": _over_wide(reports.top_regions),
        "report_lab_totals": _over_wide(reports.source_totals),
        "report_sector_coverage": _over_wide(reports.sector_coverage),
        "report_recovery_share_area": _from_proxy(
            lambda p: _rounded(reports.recovery_share(p.wide(), "area"), "pnrr_fin costo"),
            "pct_pnrr",
            4,
        ),
        "report_recovery_share_sector": _from_proxy(
            lambda p: _rounded(
                reports.recovery_share(p.wide(), "settore_intervento"), "pnrr_fin costo"
            ),
            "pct_pnrr",
            4,
        ),
        "report_execution": _over_wide(reports.execution_funnel, "importo importo_sal"),
        "report_umbrella": _over_wide(reports.umbrella_count),
        "report_umbrella_top": _over_wide(reports.top_umbrellas, "costo_progetto"),
        "report_works_kpi": _from_proxy(
            lambda p: _rounded(reports.works_overview(p.wide()), "costo disp gap"),
            "costo_eur disp_eur gap_eur",
            0,
        ),
        "report_works_top": _over_wide(reports.top_works, f"{works_top} pnrr_fin_pnrr"),
        "report_gap_top": _over_wide(reports.top_gaps, "silos_gap_mln silos_costi_mln"),
        "report_works_state": _over_wide(reports.works_by_state),
        "report_works_system": _over_wide(reports.works_by_system, "costo gap"),
        "report_project_card": _over_wide(
            partial(reports.project_card, cup="7"), oracle_texts.WIDE_MONEY
        ),
        # cuts that cut, and orders
        "report_sectors_top3": _over_wide_in_place(partial(reports.top_sectors, limit=3), "costo"),
        "report_region_sectors_top2": _over_wide_in_place(
            partial(reports.region_sectors, region="EUROPE", limit=2), "costo"
        ),
        "report_sector_coverage_top3": _over_wide_in_place(
            partial(reports.sector_coverage, limit=3)
        ),
        "report_sector_coverage_cut": report_sector_coverage_cut,
        "report_region_top3": _over_wide_in_place(
            partial(reports.cost_by_region, limit=3), "costo"
        ),
        "report_region_cost_order": _over_wide_in_place(reports.cost_by_region, "costo"),
        "report_region_names_order": _over_wide_in_place(reports.region_names),
        "report_status_order": _over_wide_in_place(reports.status_counts),
        "report_area_order": _over_wide_in_place(reports.coverage_by_area, "costo"),
        "report_works_state_order": _over_wide_in_place(reports.works_by_state),
        "report_works_system_order": _over_wide_in_place(reports.works_by_system, "costo gap"),
        "report_recovery_share_order": _from_proxy(
            lambda p: _rounded(
                in_place(
                    reports.recovery_share(p.wide(), "settore_intervento"),
                    _scratch(p.spark, "in_place"),
                ),
                "pnrr_fin costo",
            ),
            "pct_pnrr",
            4,
        ),
        "territory_mart_order": _over_wide_in_place(marts.territory_mart),
        "funding_mart_order": _over_wide_in_place(marts.funding_mart),
        "cost_mart_order": _over_wide_in_place(marts.cost_mart),
        # layers, ad-hoc SQL, quality
        "adhoc_sql": adhoc_sql,
        "layer_years": layer_years,
        "report_funding_detail": report_funding_detail,
        "csv_ingest": csv_ingest,
        "csv_ingest_cut_files": partial(csv_ingest, part_bytes=1 << 20),
        "csv_ingest_crlf": partial(csv_ingest, line_break="\r\n"),
        "works_ingest": lambda spark, folder: _rounded(works_ingest(spark, folder), works_money),
        "quality_metrics": quality_metrics,
        "contract_rows": contract_rows,
        "snapshot_rows": snapshot_rows,
        "same_rows_pairs": same_rows_pairs,
        "published_versions": published_versions,
        "layer_years_widened": layer_years_widened,
        "stored_wide_register": stored_wide_register,
        "stored_project_card": stored_project_card,
    }


def oracle_sql() -> dict[str, str]:
    texts = oracle_texts.oracle_sql()
    if llm_queries is not None:
        texts |= llm_queries.oracle_sql()
    return texts
