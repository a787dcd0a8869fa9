"""Versioned tables: what readers see while a job writes, is killed, or another one is faster."""

import os
import subprocess
import sys
import threading
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from publicspend.operators import quality
from publicspend.operators.joins import left_join_all
from publicspend.operators.quality import Contract, QualityError, Watch
from publicspend.sources import layers, tables
from publicspend.sources.tables import Buckets, PublishError

ROOT = Path(__file__).resolve().parents[1]
JOB = """
import os, signal, sys
sys.path.insert(0, {root!r})
from publicspend.session import session
from publicspend.sources import layers, tables

def die(*_, **__):
    os.kill(os.getpid(), signal.SIGKILL)

spark = session("killed", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
path = {path!r}
if {step!r} == "writing":
    tables.note = die
elif {step!r} == "before publishing":
    tables.publish = die
elif {step!r} == "expiring":
    removed = tables._delete
    tables._delete = lambda s, p: (removed(s, p), die())
layers.write_table(spark.range(5).selectExpr("'new' AS tag", "id"), path, keep=1)
"""


def tagged(spark, tag, n=5):
    return spark.range(n).select(F.lit(tag).alias("tag"), "id")


def tags(df):
    return {(r.tag, r.n) for r in df.groupBy("tag").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize(
    ("step", "seen"), [("writing", "old"), ("before publishing", "old"), ("expiring", "new")]
)
def test_killed_job_leaves_the_old_table_or_the_new(spark, tmp_path, step, seen):
    path = f"{tmp_path}/t.parquet"
    layers.write_table(tagged(spark, "old"), path)
    job = JOB.format(root=str(ROOT), path=path, step=step)
    done = subprocess.run([sys.executable, "-c", job], capture_output=True, timeout=200)
    assert done.returncode == -9
    assert tags(tables.read_table(spark, path)) == {(seen, 5)}
    # the next job goes on, and what the killed one left goes
    layers.write_table(tagged(spark, "next"), path, keep=1)
    assert tags(tables.read_table(spark, path)) == {("next", 5)}
    assert len(os.listdir(f"{path}/_versions")) == len(tables.versions(spark, path)) == 1


def test_readers_never_see_a_mixture(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    layers.write_table(tagged(spark, "0"), path)
    stop, seen, errors = threading.Event(), [], []

    def read():
        try:
            while not stop.is_set():
                seen.append(tags(tables.read_table(spark, path)))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for tag in "12345":
        layers.write_table(tagged(spark, tag), path, keep=6)
    stop.set()
    reader.join()
    assert not errors and all(len(found) == 1 and {n for _, n in found} == {5} for found in seen)
    order = [int(next(iter(found))[0]) for found in seen]
    assert order == sorted(order)


def test_a_version_that_is_read_stays(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    before = layers.write_table(tagged(spark, "a"), path)
    layers.write_table(tagged(spark, "b"), path)
    assert tags(before) == {("a", 5)}
    first, second = tables.versions(spark, path)
    assert tags(tables.read_version(spark, path, first)) == {("a", 5)}
    layers.write_table(tagged(spark, "c"), path)
    assert tables.versions(spark, path)[0] == second


def test_slower_of_two_jobs_fails(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    schema = tagged(spark, "x").schema.json()
    slow = tables.stage(tagged(spark, "slow"), path)
    layers.write_table(tagged(spark, "fast"), path)
    tables.note(spark, path, slow, tables.Facts(schema))
    with pytest.raises(PublishError, match="was published while"):
        tables.publish(spark, path, slow)
    assert tags(tables.read_table(spark, path)) == {("fast", 5)}
    # both at once: the lower name counts
    for name in ("00000009-b", "00000009-a"):
        Path(f"{path}/_published/{name}").touch()
    assert tables.versions(spark, path)[-1] == "00000009-a"


def test_plain_files_and_a_table_from_before(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    tagged(spark, "plain", 3).write.parquet(path)
    assert tags(tables.read_table(spark, path)) == {("plain", 3)}
    assert layers.row_count(spark, path) == 3
    layers.write_table(tagged(spark, "v1"), path)
    assert tags(tables.read_table(spark, path)) == {("v1", 5)}
    layers.write_table(tagged(spark, "v2"), path)
    assert {name for name in os.listdir(path) if not name.startswith((".", "_"))} == set()
    with pytest.raises(Exception, match="(?i)schema|exist"):
        spark.read.parquet(path).collect()  # never two versions as one


def test_empty_tables(spark, tmp_path):
    for i, buckets in enumerate((None, Buckets("tag", 3))):
        path = f"{tmp_path}/{i}.parquet"
        watch = Watch(Contract(primary_key=("tag",)), key=("tag",))
        written = layers.write_table(tagged(spark, "x").where("false"), path, watch=watch, buckets=buckets)
        assert written.columns == ["tag", "id"] and written.count() == 0
        assert layers.row_count(spark, path) == 0 and tables.facts(spark, path).keys == 0


def test_odd_names_of_folders_and_columns(spark, tmp_path, monkeypatch):
    """Quotes, blanks and signs in paths and names, and a path without a root."""
    df = spark.createDataFrame([("a", 1), ("b", 2)], "`cod``e; x` string, `a.b` int")
    path = f"{tmp_path}/it's a \u00e8 folder/t.parquet"
    stored = layers.write_table(df, path, watch=Watch(key=("`cod``e; x`",)), buckets=None)
    assert sorted(map(tuple, stored.collect())) == [("a", 1), ("b", 2)]
    named = df.toDF("cup", "n")
    stored = layers.write_table(named, path, buckets=Buckets("cup", 2))
    assert sorted(map(tuple, stored.collect())) == [("a", 1), ("b", 2)]
    relative = os.path.relpath(f"{tmp_path}/relative/t.parquet")
    layers.write_table(named, relative, buckets=Buckets("cup", 2))
    assert tables.read_table(spark, relative).count() == 2
    assert tables.read_table(spark, f"{tmp_path}/relative/t.parquet").count() == 2


# ------------------------------------------------------------------------------- figures in a write


def counted_jobs(spark, name, action):
    spark.sparkContext.setJobGroup(name, "")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_contract_is_measured_in_the_write(spark, tmp_path):
    df = spark.range(100).select(
        F.when(F.col("id") != 7, F.col("id")).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
    )
    import datetime as dt

    contract = Contract(
        required_columns=("k", "gone"), not_null=("k", "d"), min_rows=101, primary_key=("k",),
        at_least={"k > 50": 49}, max_age={"d": 30},
    )
    as_of = dt.date(2024, 5, 1)
    watch = Watch(contract, key=("k",), as_of=as_of)
    with pytest.raises(QualityError) as stopped:
        layers.write_table(df, f"{tmp_path}/t", watch=watch)
    assert not tables.versions(spark, f"{tmp_path}/t")
    scanned = sorted(map(tuple, quality.check(df, contract, as_of).collect()))
    assert sorted(map(tuple, watch.checks())) == scanned
    broken = [r for r in watch.checks() if not r.passed]
    assert str(stopped.value).count(";") == len(broken) - 1 == 2
    assert quality.as_table(spark, watch.checks()).count() == 8


def test_no_second_scan_and_no_second_shuffle(spark, tmp_path):
    unique = Contract(not_null=("cup",), min_rows=1, primary_key=("cup",))
    base = spark.range(200).select(F.col("id").cast("string").alias("cup"), "id")
    buckets = Buckets("cup", 5)
    left = layers.write_table(base, f"{tmp_path}/l", watch=Watch(unique, key=("cup",)), buckets=buckets)
    right = layers.write_table(
        base.where("id % 3 = 0").withColumnRenamed("id", "v"), f"{tmp_path}/r",
        watch=Watch(unique), buckets=buckets,
    )
    watch = Watch(unique, key=("cup",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join_all(left, [right], "cup")
        plan = watch.over(joined.repartition(5, "cup"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Sort [cup#") == 2 and "Window" in plan
        watch = Watch(unique, key=("cup",))
        jobs = counted_jobs(
            spark, "write", lambda: layers.write_table(joined, f"{tmp_path}/j", watch=watch, buckets=buckets)
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert jobs <= 3  # the write, and one for each look at the small file of facts
    before = tables.facts(spark, f"{tmp_path}/l")
    assert all(r.passed for r in quality.same_rows(before, watch)) and watch.rows == 200


def test_repeated_key_fails_in_buckets(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], "cup string, v int")
    for buckets in (None, Buckets("cup", 3)):
        with pytest.raises(QualityError, match=r"primary_key\(cup\): 2, expected 0"):
            layers.write_table(
                rows, f"{tmp_path}/t", watch=Watch(Contract(primary_key=("cup",))), buckets=buckets
            )


def test_one_key_lost_and_another_doubled(spark):
    before = spark.range(50).select(F.col("id").cast("string").alias("cup"))
    swapped = before.where("cup <> '3'").union(before.where("cup = '4'"))
    found = {r.rule: r.passed for r in quality.same_rows_check(before, swapped, ("cup",)).collect()}
    assert found == {"same_rows": True, "same_keys": False}
    shuffled = before.repartition(7)
    assert all(r.passed for r in quality.same_rows_check(before, shuffled, ("cup",)).collect())
    null = before.withColumn("cup", F.when(F.col("cup") != "3", F.col("cup")))
    found = {r.rule: r.passed for r in quality.same_rows_check(before, null, ("cup",)).collect()}
    assert found == {"same_rows": True, "same_keys": False}
    assert len(quality.same_rows_check(before, before).collect()) == 1


def test_lookup_reads_one_bucket_and_one_row_group(spark, tmp_path):
    n, path = 6, f"{tmp_path}/t"
    spark.conf.set("parquet.block.size", "20000")
    spark.conf.set("parquet.page.row.count.limit", "500")
    try:
        df = spark.range(60_000).select(F.col("id").cast("string").alias("cup"), F.md5(F.col("id").cast("string")).alias("v"))
        stored = layers.write_table(df, path, buckets=Buckets("cup", n))
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.page.row.count.limit")
    place = Path(tables.version_path(path, tables.current(spark, path)))
    files = {f: pq.ParquetFile(f).metadata for f in place.glob("*.parquet")}
    assert len(files) == n and min(meta.num_row_groups for meta in files.values()) >= 5
    one = stored.where(F.col("cup") == "777")
    (bucket,) = [Path(r[0]).name for r in one.select(F.input_file_name()).collect()]
    for file, meta in files.items():
        if file.name == bucket:
            limits = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
            assert sum(s.min <= "777" <= s.max for s in limits) == 1
        else:  # a look at any other bucket would fail
            file.write_bytes(b"no Parquet")
            (place / f".{file.name}.crc").unlink()
    assert [r.cup for r in tables.read_table(spark, path).where(F.col("cup") == "777").collect()] == ["777"]
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.read_table(spark, path).count()


# ------------------------------------------------------------------------------------------- years


def test_years_widen_or_are_refused(spark, tmp_path):
    def year(number, ddl, *rows):
        spark.createDataFrame(list(rows), ddl).write.parquet(f"{tmp_path}/{number}")

    year(2023, "cup string, importo int, quota tinyint, codice decimal(5,2)", ("a", 2**31 - 1, 3, None))
    year(2024, "CUP string, importo double, quota smallint, nota string", ("b", 0.5, 300, "x"))
    year(2025, "cup string, importo float, quota int, codice bigint", ("c", 1.5, 70_000, 2**60))
    years = layers.read_years(spark, f"{tmp_path}/{{year}}", [2023, 2024, 2025])
    assert dict(years.dtypes) == {
        "cup": "string", "importo": "double", "quota": "int", "codice": "decimal(21,2)", "nota": "string",
    }
    rows = {r.cup: r for r in years.collect()}
    assert rows["a"].importo == float(2**31 - 1) and rows["b"].nota == "x" and rows["c"].codice == 2**60
    year(2026, "cup string, importo string", ("d", "1,5"))
    with pytest.raises(layers.SchemaClash, match="importo is string in 2026 and double"):
        layers.read_years(spark, f"{tmp_path}/{{year}}", [2023, 2024, 2026])


def test_years_with_and_without_versions(spark, tmp_path):
    """A table written here and one of others, with lists that may or may not hold nulls."""
    df = spark.range(3).select("id", F.array("id", F.col("id") + 1).alias("list"))
    layers.write_table(df, f"{tmp_path}/2024")
    layers.write_table(df, f"{tmp_path}/2025", buckets=Buckets("id", 2))
    df.write.parquet(f"{tmp_path}/2026")
    years = layers.read_years(spark, f"{tmp_path}/{{year}}", [2024, 2025, 2026])
    assert years.count() == 9 and dict(years.dtypes)["list"] == "array<bigint>"


@pytest.mark.parametrize(
    ("one", "other", "wide"),
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", None),
        ("int", "float", None),
        ("smallint", "float", "float"),
        ("date", "timestamp", None),
        ("decimal(38,0)", "decimal(10,2)", None),
        ("decimal(4,1)", "decimal(4,3)", "decimal(6,3)"),
        ("decimal(4,1)", "int", "decimal(11,1)"),
        ("decimal(4,1)", "double", None),
        ("boolean", "int", None),
        ("array<int>", "array<int>", "array<int>"),
        ("array<int>", "array<bigint>", None),
        ("void", "date", "date"),
    ],
)
def test_wider_type(spark, one, other, wide):
    from pyspark.sql.types import StructType

    kinds = [StructType.fromDDL(f"x {kind}")[0].dataType for kind in (one, other)]
    for pair in (kinds, kinds[::-1]):
        found = layers.wider_type(*pair)
        assert (found and found.simpleString()) == wide
