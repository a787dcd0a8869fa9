"""The full refresh: files in, clean layer, marts, wide register, its marts.

Each step writes a new version of its table, measures it while writing and publishes it if it holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from publicspend.operators import quality, register, strategic
from publicspend.operators.joins import hot_keys
from publicspend.operators.quality import Contract, Watch
from publicspend.plans import marts
from publicspend.plans.compose import (
    Support,
    place_and_funding,
    register_from_sides,
    support_sides,
    wide_from_sides,
)
from publicspend.plans.contracts import CONTRACTS, REQUIRED_TABLES
from publicspend.rules import Rules
from publicspend.session import size_shuffles
from publicspend.sources import tables
from publicspend.sources.csv_files import read_text_table
from publicspend.sources.layers import (
    clean_path,
    latest_snapshot,
    mart_path,
    raw_path,
    read_years,
    support_path,
    write_table,
)
from publicspend.sources.tables import Buckets, Facts

EXTERNAL = (
    "recovery_projects",
    "recovery_tenders",
    "recovery_payments",
    "tender_pairs",
    "awards",
    "statements",
    "cost_events",
    "cohesion_projects",
)


@dataclass(frozen=True)
class Inputs:
    """Delimited files of the national register, and ``{year}`` templates of the external
    Parquet tables named in ``EXTERNAL``."""

    projects: list[str]
    locations: list[str]
    funding: list[str]
    holders: list[str]
    works: list[str]
    external: dict[str, str]

    @classmethod
    def latest(cls, spark: SparkSession, base: str, external: dict[str, str]) -> Inputs:
        """The newest dated directory below ``<base>/<table>`` for each text table."""
        tables = ("projects", "locations", "funding", "holders", "works")
        return cls(
            **{table: [latest_snapshot(spark, f"{base}/{table}")] for table in tables},
            external=external,
        )


class Refresh:
    """One run for one year. Table names are the keys of ``contracts``; ``rows`` holds the
    row count of every table written.

    Registers and the sides they are joined to are stored in equal buckets of the project code,
    ``buckets`` of them or as many as a shuffle has partitions: each input is shuffled once, when
    it is first written by the code, and no join shuffles again. Contracts are measured in the
    writes themselves, and a table that breaks its own stays as it was.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        year: int,
        rules: Rules = Rules(),
        contracts: dict[str, Contract] = CONTRACTS,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.root = root
        self.year = year
        self.rules = rules
        self.contracts = contracts
        self.rows: dict[str, int] = {}
        self.buckets = buckets

    def run(self, inputs: Inputs, works_year: int) -> dict[str, DataFrame]:
        missing = quality.missing_tables(list(inputs.external), list(EXTERNAL))
        if missing:
            raise quality.QualityError(f"external tables missing: {', '.join(missing)}")
        files = [inputs.projects, inputs.locations, inputs.funding, inputs.holders, inputs.works]
        external = [[path.format(year=self.year)] for path in inputs.external.values()]
        partitions = size_shuffles(self.spark, files + external)
        by_code = Buckets("cup", self.buckets or partitions)
        locations = self._clean(
            "localizzazione", register.clean_locations(self._raw("localizzazione", inputs.locations))
        )
        funding = self._clean("fonti", register.clean_funding(self._raw("fonti", inputs.funding)))
        holders = self._clean("soggetti", register.clean_holders(self._raw("soggetti", inputs.holders)))
        raw_works = read_text_table(self.spark, inputs.works)
        works = self._clean("opere", strategic.clean_works(raw_works, works_year))
        projects = self._clean(
            "progetti", register.clean_projects(self._raw("progetti", inputs.projects))
        )
        # The contract holds the key unique; a looser one may let repeated codes pass, and these
        # must not all meet in one bucket.
        unique = "cup" in self.contracts["mart_progetti"].primary_key
        dealt = by_code if unique else None
        out = {
            "mart_localizzazione": self._mart(
                "localizzazione", "mart_localizzazione", register.location_mart(locations)
            ),
            "mart_fonti_per_progetto": self._mart(
                "fonti", "mart_fonti_per_progetto", register.funding_source_mart(funding)
            ),
            "mart_soggetti": self._mart("soggetti", "mart_soggetti", holders),
            "mart_opere": self._mart("opere", "mart_opere", strategic.works_mart(works)),
            "mart_progetti": self._mart(
                "progetti",
                "mart_progetti",
                register.project_mart(projects, self.rules),
                buckets=dealt,
                watch=self._watch("mart_progetti", key=("cup",)),
            ),
        }
        hot = None if unique else hot_keys(out["mart_progetti"], "cup")
        places = self._sides(place_and_funding(locations, funding, self.rules), by_code)
        before = tables.facts(self.spark, self._mart_path("progetti", "mart_progetti"))
        out["mart_registro"] = self._mart(
            "progetti",
            "mart_registro",
            register_from_sides(out["mart_progetti"], list(places.values()), self.rules, hot),
            buckets=dealt,
            watch=self._watch("mart_registro", key=("cup",)),
            before=before,
        )
        support = Support(
            locations=locations,
            funding=funding,
            works=out["mart_opere"],
            **{
                name: read_years(self.spark, inputs.external[name], [self.year])
                for name in EXTERNAL
            },
        )
        sides = support_sides(support, self.rules, known=out["mart_registro"].columns)
        stored = self._sides(sides, by_code)
        out["registro_ampio"] = self._write(
            "registro_ampio",
            wide_from_sides(out["mart_registro"], list(stored.values()), self.rules, hot),
            clean_path(self.root, "registro_ampio", self.year),
            buckets=dealt,
            lookup=None if dealt else "cup",
            watch=self._watch("registro_ampio", "registro_ampio_smoke", key=("cup",)),
            before=before,
        )
        out |= self._wide_marts(out["registro_ampio"])
        missing = quality.missing_tables(list(out), list(REQUIRED_TABLES))
        if missing:
            raise quality.QualityError(f"tables missing: {', '.join(missing)}")
        return out

    def _raw(self, name: str, files: list[str]) -> DataFrame:
        """The text files as one Parquet table, every column a string."""
        raw = read_text_table(self.spark, files)
        return write_table(raw, raw_path(self.root, name, self.year))

    def _clean(self, name: str, df: DataFrame) -> DataFrame:
        return self._write(name, df, clean_path(self.root, name, self.year))

    def _mart_path(self, name: str, table: str) -> str:
        return mart_path(self.root, name, self.year, table)

    def _mart(self, name: str, table: str, df: DataFrame, **options) -> DataFrame:
        return self._write(table, df, self._mart_path(name, table), **options)

    def _sides(self, sides: dict[str, DataFrame], buckets: Buckets) -> dict[str, DataFrame]:
        """Tables with one row per project code, stored in its buckets."""
        single = Contract(primary_key=(buckets.column,))
        return {
            name: write_table(
                df,
                support_path(self.root, name, self.year),
                watch=Watch(single),
                buckets=buckets,
            )
            for name, df in sides.items()
        }

    def _watch(self, *names: str, key: tuple[str, ...] = ()) -> Watch:
        return Watch(*[self.contracts[name] for name in names], key=key)

    def _write(
        self,
        table: str,
        df: DataFrame,
        path: str,
        watch: Watch | None = None,
        before: Facts | None = None,
        **options,
    ) -> DataFrame:
        """Publish a table that holds its contract and, with ``before``, the same keys as that."""
        watch = watch or self._watch(table)
        same = (lambda: quality.same_rows(before, watch)) if before else (lambda: [])
        written = write_table(df, path, watch=watch, more=same, **options)
        self.rows[table] = watch.rows
        return written

    def _wide_marts(self, wide: DataFrame) -> dict[str, DataFrame]:
        floor = self.rules.min_group
        built = {
            "mart_territorio": marts.territory_mart(wide, floor),
            "mart_fonti": marts.funding_mart(wide, floor),
            "mart_costi": marts.cost_mart(wide, floor),
        }
        return {table: self._mart("registro_ampio", table, df) for table, df in built.items()}
