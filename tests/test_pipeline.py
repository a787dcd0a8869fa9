import dataclasses

import pytest

import refresh
from publicspend.operators.quality import Contract, QualityError
from publicspend.plans.compose import register_from_sides, wide_from_sides
from publicspend.plans.contracts import CONTRACTS
from publicspend.plans.pipeline import EXTERNAL, Inputs, Refresh
from publicspend.sources import layers, tables
from publicspend.sources.proxy import PROXY_RULES, WORKS_YEAR, Proxy

YEAR = 2026


def as_text(df, path):
    df.write.options(header=True, sep=";", escape='"', emptyValue="").csv(path)


@pytest.fixture(scope="module")
def inputs(spark, tiny, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("inputs"))
    proxy = Proxy(spark, tiny)
    external = {name: f"{base}/{name}/{{year}}.parquet" for name in EXTERNAL}
    for name, template in external.items():
        getattr(proxy, name)().write.parquet(template.format(year=YEAR))
    for name in ("projects", "locations", "funding", "holders", "works"):
        as_text(getattr(proxy, f"{name}_raw")(), f"{base}/{name}/2026-02-01")
    as_text(proxy.projects_raw().limit(1), f"{base}/projects/2026-01-31")
    return Inputs.latest(spark, base, external)


def small(contracts):
    """The same contracts with the row floors of a national run taken down."""
    return {
        name: dataclasses.replace(
            c, min_rows=c.min_rows and 1, at_least=dict.fromkeys(c.at_least, 1)
        )
        for name, c in contracts.items()
    }


def test_refresh(spark, tiny, inputs, tmp_path):
    root = str(tmp_path)
    job = Refresh(spark, root, YEAR, PROXY_RULES, small(CONTRACTS))
    out = job.run(inputs, WORKS_YEAR)
    assert {"mart_registro", "registro_ampio", "mart_territorio", "mart_fonti", "mart_costi",
            "mart_opere", "mart_soggetti"} <= set(out)
    wide = layers.load_clean(spark, root, "registro_ampio", [YEAR])
    expected = Proxy(spark, tiny).wide()
    assert job.rows["registro_ampio"] == job.rows["progetti"] == expected.count()
    assert wide.columns == expected.columns and wide.count() == expected.count()
    exact = [c for c, t in wide.dtypes if t != "double"]
    assert wide.select(exact).exceptAll(expected.select(exact)).count() == 0
    stored = layers.load_mart(spark, root, "registro_ampio", "mart_costi", YEAR)
    assert stored.count() == out["mart_costi"].count()
    sql = "SELECT count(*) AS n FROM clean_input WHERE flag_ombrello"
    assert layers.query_clean(spark, root, "registro_ampio", sql, [YEAR]).first().n > 0


def test_stored_tables_join_without_a_shuffle(spark, tiny, inputs, tmp_path):
    root = str(tmp_path)
    job = Refresh(spark, root, YEAR, PROXY_RULES, small(CONTRACTS), buckets=5)
    job.run(inputs, WORKS_YEAR)

    def read(name):
        return tables.read_table(spark, layers.support_path(root, name, YEAR))

    projects = layers.load_mart(spark, root, "progetti", "mart_progetti", YEAR)
    register = layers.load_mart(spark, root, "progetti", "mart_registro", YEAR)
    sides = [read(name) for name in ("luogo", "finanziatori")]
    more = [
        read(name)
        for name in ("pnrr_progetti", "pnrr_gare", "pnrr_pagamenti", "appalti", "coesione", "opere")
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = [
            register_from_sides(projects, sides, PROXY_RULES),
            wide_from_sides(register, more, PROXY_RULES),
        ]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in built]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [plan.count("SortMergeJoin") for plan in plans] == [2, 6]
    assert all("Exchange" not in plan for plan in plans)
    known = tables.facts(spark, layers.clean_path(root, "registro_ampio", YEAR))
    assert known.rows == job.rows["registro_ampio"] and known.buckets.count == 5
    assert known.keys == tables.facts(spark, layers.mart_path(root, "progetti", YEAR, "mart_progetti")).keys


def test_repeated_codes_are_not_dealt_to_buckets(spark, tiny, inputs, tmp_path):
    contracts = small(CONTRACTS)
    contracts |= {name: Contract() for name in ("mart_progetti", "mart_registro")}
    root = str(tmp_path)
    Refresh(spark, root, YEAR, PROXY_RULES, contracts).run(inputs, WORKS_YEAR)
    path = layers.clean_path(root, "registro_ampio", YEAR)
    assert tables.facts(spark, path).buckets is None
    assert tables.read_table(spark, path).count() == Proxy(spark, tiny).projects().count()


def test_broken_contract_stops_the_run(spark, inputs, tmp_path):
    contracts = small(CONTRACTS) | {"fonti": Contract(min_rows=10**9)}
    with pytest.raises(QualityError, match="min_rows"):
        Refresh(spark, str(tmp_path), YEAR, PROXY_RULES, contracts).run(inputs, WORKS_YEAR)
    assert not (tmp_path / "data" / "clean" / "registro_ampio").exists()
    assert not tables.versions(spark, layers.clean_path(str(tmp_path), "fonti", YEAR))


def test_broken_contract_keeps_the_table_before(spark, inputs, tmp_path):
    path = layers.clean_path(str(tmp_path), "fonti", YEAR)
    layers.write_table(spark.createDataFrame([("old",)], "cup string"), path)
    contracts = small(CONTRACTS) | {"fonti": Contract(min_rows=10**9)}
    with pytest.raises(QualityError, match="min_rows"):
        Refresh(spark, str(tmp_path), YEAR, PROXY_RULES, contracts).run(inputs, WORKS_YEAR)
    assert [row.cup for row in tables.read_table(spark, path).collect()] == ["old"]


def test_checked_table_replaces_the_one_before(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    seen = []
    for name in ("first", "second"):
        df = spark.createDataFrame([(name,)], "cup string")
        found = layers.write_table(df, path, check=lambda t: seen.append(t.first().cup))
        assert [row.cup for row in found.collect()] == [name]
    assert seen == ["first", "second"]
    assert len(tables.versions(spark, path)) == 2


def test_missing_external_table(spark, inputs, tmp_path):
    partial = dataclasses.replace(inputs, external={})
    with pytest.raises(QualityError, match="awards"):
        Refresh(spark, str(tmp_path), YEAR).run(partial, WORKS_YEAR)


def test_command_line_keeps_the_national_floors(inputs, tmp_path):
    base = inputs.projects[0].rsplit("/", 2)[0]
    external = [f"--external={name}={path}" for name, path in inputs.external.items()]
    arguments = ["--root", str(tmp_path), "--snapshots", base, "--year", str(YEAR)]
    with pytest.raises(QualityError, match="min_rows.*expected 10000000"):
        refresh.main([*arguments, "--works-year", str(WORKS_YEAR), *external])
