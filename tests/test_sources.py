import csv
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from publicspend.operators import register
from publicspend.session import size_shuffles
from publicspend.sources import csv_files, layers
from publicspend.sources.csv_files import read_text_table



@pytest.fixture
def parts(spark):
    """Sets whether files are cut, at every 100 bytes."""

    def cut(small):
        if small:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
        else:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


HEADER = ";".join(f'"{c}"' for c in register.PROJECT_COLUMNS)


def line(cup, cost, text):
    cells = dict.fromkeys(register.PROJECT_COLUMNS, "")
    cells |= {"CUP": cup, "COSTO_PROGETTO": cost, "DESCRIZIONE_INTERVENTO": text}
    return ";".join(cells.values())


def write(path, *lines, bom=False):
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


@pytest.fixture
def shards(tmp_path):
    plain = write(tmp_path / "a.csv", line("A", "1234,56", "plain; no"[:5]), line("B", "x", '"a;""b"""'), bom=True)
    broken = write(tmp_path / "b.csv", line("C", "7", '"first\nsecond; ""third""\n"'), line("D", "", "é"), bom=True)
    return plain, broken


@pytest.mark.parametrize("cut", [False, True])
def test_shards(spark, shards, tmp_path, cut, parts):
    parts(cut)
    raw = read_text_table(spark, list(shards))
    assert set(raw.dtypes) == {(c, "string") for c in register.PROJECT_COLUMNS}
    stored = layers.write_table(raw, f"{tmp_path}/raw.parquet")
    rows = {r.cup: r for r in register.clean_projects(stored).collect()}
    assert {k: r.costo_progetto for k, r in rows.items()} == {"A": 1234.56, "B": None, "C": 7.0, "D": None}
    assert rows["B"].descrizione_intervento == 'a;"b"'
    assert rows["C"].descrizione_intervento == 'first\nsecond; "third"\n'
    assert rows["D"].descrizione_intervento == "é" and rows["D"].cup_master is None


@pytest.mark.parametrize("cut", [False, True])
def test_blank_in_a_file_name(spark, tmp_path, cut, parts):
    parts(cut)
    write(tmp_path / "a shard è.csv", line("A", "1", '"x\ny"'))
    write(tmp_path / "b shard.csv", line("B", "1", "x"))
    rows = read_text_table(spark, str(tmp_path)).select("CUP").collect()
    assert sorted(r.CUP for r in rows) == ["A", "B"]


def raw_rows(spark, path):
    return sorted(map(tuple, read_text_table(spark, str(path)).collect()), key=repr)


def test_records_across_parts(spark, tmp_path, parts):
    """Fields of every length over lines: whole and in many small parts, the same rows."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = [rng.choice(["a;b", "\n", '"', "x" * rng.randrange(60), "\r\n", ""]) for _ in range(6)]
        rows.append((str(i), "".join(words), "z" if i % 3 else "", "é\n" * rng.randrange(9)))
    path = tmp_path / "a.csv"
    with path.open("w", encoding="utf-8", newline="") as f:
        writer = csv.writer(f, delimiter=";", lineterminator="\r\n")
        writer.writerows([("id", "text", "c", "d"), *rows])
    expected = sorted((tuple(v or None for v in row) for row in rows), key=repr)
    assert raw_rows(spark, path) == expected
    parts(True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    assert csv_files.text_index(csv_files._lines(spark, [str(path)], "UTF-8")).count() > 20
    assert raw_rows(spark, path) == expected


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('A;B\n1;"x\r\ny"\n', [("1", "x\r\ny")]),
        ('A;B\r\n1;"x"\r\n2;y\r\n', [("1", "x"), ("2", "y")]),
        ('A;B\n1;pipe 5" wide\n', "never closed"),
        ('A;B\n1;pipe 5" wide\n2;pipe 6" wide\n', "too few or too many|quote mark inside"),
        ('A;B\n1;pipes 5" and 6" wide\n', "quote mark inside"),
        ('A;B\n1; "q" \n', "quote mark inside"),
        ('A;"B\nC"\n1;2\n', [("1", "2")]),
        ("A;a\n1;2\n", "differ only in case"),
        ('A;B\n1;"open\n' + "2;y\n" * 60, "never closed"),
        ("A;B\n1\n", "too few or too many"),
        ("A;B\n1;2;3\n", "too few or too many"),
        ('A;B\n1;2;"3\n4"\n', "too few or too many"),
        ("A;B\nA;B\n1;2\n", [("1", "2"), ("A", "B")]),
    ],
)
def test_one_reading_at_every_size(spark, tmp_path, cut, parts, text, expected):
    parts(cut)
    path = tmp_path / "a.csv"
    path.write_bytes(text.encode())
    if isinstance(expected, list):
        assert raw_rows(spark, path) == expected
    else:
        with pytest.raises((PySparkException, Py4JJavaError, ValueError), match=expected):
            raw_rows(spark, path)


def test_ragged_rows_fail_whatever_is_selected(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("A;B;C\n1;2;3\n4;5\n6;7;8;9\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="too few or too many"):
        read_text_table(spark, str(path)).select("A").collect()
    with pytest.raises((PySparkException, Py4JJavaError), match="too few or too many"):
        read_text_table(spark, str(path)).count()


def test_encoding_reaches_the_search_for_open_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('A;B\n1;"x\né"\n'.encode("latin-1"))
    rows = read_text_table(spark, str(path), encoding="ISO-8859-1").collect()
    assert [tuple(r) for r in rows] == [("1", "x\né")]


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize("cell", ["x", '"x\ny"'])
def test_other_header_stops_the_read(spark, tmp_path, cut, cell, parts):
    parts(cut)
    one = write(tmp_path / "a.csv", line("A", "1", cell))
    other = tmp_path / "b.csv"
    other.write_text(HEADER.replace("CUP_MASTER", "ALTRO") + "\n" + line("B", "1", cell) + "\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="header"):
        read_text_table(spark, [one, str(other)]).collect()


@pytest.mark.parametrize("cut", [False, True])
def test_files_with_and_without_fields_over_lines(spark, tmp_path, cut, parts):
    parts(cut)
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f'A;B\n{name};"x\ny"\n' + f"{name};z\n" * 50)
    (tmp_path / "d.csv").write_text("A;B\nd;z\n")
    (tmp_path / "e.csv").write_text("A;B\n")
    (tmp_path / "f.csv").write_text('A;B\nf;"' + "\n".join("line" for _ in range(100)) + '"')
    found = raw_rows(spark, tmp_path)
    assert len(found) == 3 * 51 + 2
    assert found[-1] == ("f", "\n".join("line" for _ in range(100)))


def test_executors_need_not_have_the_package(tmp_path):
    (tmp_path / "a.csv").write_text('A;B\n1;"x\ny"\n')
    job = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from publicspend.session import session
from publicspend.sources.csv_files import read_text_table
spark = session("elsewhere", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
print(read_text_table(spark, {str(tmp_path / "a.csv")!r}).first())
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", job], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=200
    )
    assert "Row(A='1', B='x\\ny')" in done.stdout, done.stderr[-2000:]


def text_scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan text")


@pytest.mark.parametrize("cell", ["x", '"x\ny"'])
def test_text_is_scanned_twice(spark, tmp_path, monkeypatch, cell):
    """One scan for the index and one in the plan that is returned."""
    (tmp_path / "a.csv").write_text(f"A;B\n1;{cell}\n")
    scans = []
    lines = csv_files._lines
    monkeypatch.setattr(csv_files, "_lines", lambda *a: scans.append(1) or lines(*a))
    indexed = []
    index = csv_files.text_index
    monkeypatch.setattr(csv_files, "text_index", lambda *a: indexed.append(1) or index(*a))
    table = read_text_table(spark, str(tmp_path))
    assert len(scans) == len(indexed) == 1 and text_scans(table) == 1
    parts = index(lines(spark, [str(tmp_path)], "UTF-8"))
    assert text_scans(parts) == 0  # what is looked up in the index reads no text
    assert table.count() == 1


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize(
    "body",
    [
        "1;" + "y" * 400 + "\n2;z\n",
        '1;"' + "y\n" * 200 + '"\n2;z\n',
        '1;pipe 5" wide\n' + "2;y\n" * 200 + '3;pipe 6" wide\n',
        '1;"a\nb"\n' * 20 + "2;" + "y" * 400 + "\n",
    ],
)
def test_longest_record_wherever_files_are_cut(spark, tmp_path, cut, body, parts):
    parts(cut)
    (tmp_path / "a.csv").write_text("A;B\n" + body)
    with pytest.raises((PySparkException, Py4JJavaError), match="record of more than 300 characters"):
        read_text_table(spark, str(tmp_path), most_chars=300).collect()
    if "pipe" not in body:
        assert read_text_table(spark, str(tmp_path), most_chars=500).count() > 1


def test_random_files_at_random_cuts(spark, tmp_path, parts):
    """Against Python's reader: short and long lines, quotes anywhere, files that hold one part or many."""
    rng = random.Random(12)
    expected = []
    for number in range(4):
        rows = []
        for i in range(rng.randrange(1, 20)):
            words = [rng.choice(["", "a", "\n", '"', ";", "\r\n", "é" * rng.randrange(50)]) for _ in range(rng.randrange(12))]
            rows.append((f"{number}.{i}", "".join(words), rng.choice(["", "z"])))
        expected += [tuple(v or None for v in row) for row in rows]
        with (tmp_path / f"{number}.csv").open("w", encoding="utf-8", newline="") as f:
            writer = csv.writer(f, delimiter=";", lineterminator=rng.choice(["\n", "\r\n"]))
            writer.writerows([("id", "te\nxt" * 9, "c"), *rows])
    for size in ("60", "400"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        found = raw_rows(spark, tmp_path)
        assert found == sorted(expected, key=repr)
    parts(False)


def test_layer_paths_and_years(spark, tmp_path):
    root = str(tmp_path)
    assert layers.clean_path("r", "n", 2026) == "r/data/clean/n/2026/n_2026_clean.parquet"
    assert layers.mart_path("r", "n", 2026, "t") == "r/data/mart/n/2026/t.parquet"
    for year, schema in ((2025, "cup string"), (2026, "cup string, extra int")):
        row = ("A",) if year == 2025 else ("B", 1)
        path = layers.clean_path(root, "n", year)
        for _ in range(2):  # the second write replaces the first
            layers.write_table(spark.createDataFrame([row], schema), path, lookup="cup")
        assert layers.row_count(spark, path) == 1
    sql = "SELECT cup, extra FROM clean_input ORDER BY cup"
    rows = layers.query_clean(spark, root, "n", sql, [2025, 2026]).collect()
    assert [tuple(r) for r in rows] == [("A", None), ("B", 1)]


def test_mart_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    layers.write_table(df, layers.mart_path(str(tmp_path), "n", 2026, "t"))
    assert layers.load_mart(spark, str(tmp_path), "n", "t", 2026).first().v == 1
    for name in ("2026-01-31", "2026-02-01", "_temporary", "old"):
        (tmp_path / "snap" / name).mkdir(parents=True)
    assert layers.latest_snapshot(spark, str(tmp_path / "snap")).endswith("/2026-02-01")
    with pytest.raises(FileNotFoundError):
        layers.latest_snapshot(spark, str(tmp_path / "snap" / "2026-01-31"))


def test_shuffles_follow_the_input(spark, tmp_path, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name, size in (("a", 1000), ("b", 600)):
        (tmp_path / name).write_bytes(b"x" * size)
    tables = [[f"{tmp_path}/a"], [f"{tmp_path}/b"], [f"{tmp_path}/none*"]]
    try:
        assert size_shuffles(spark, tables) == int(before[names[0]])
        small = {"partition_bytes": 100}
        assert size_shuffles(spark, tables, **small) == 40
        wide = size_shuffles(spark, [[f"{tmp_path}/?"]], growth=99, most_partitions=50, **small)
        assert wide == 50
        assert spark.conf.get(names[1]) == before[names[1]]
        size_shuffles(spark, tables, most_partitions=50, most_reads=4, **small)
        assert spark.conf.get(names[1]) == "250"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
