"""Registered queries: all of them run, and those with SQL agree with it."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from publicspend.llm import queries

duckdb = pytest.importorskip("duckdb")
TEXTS = queries.oracle_sql()


def test_one_query_for_each_operator():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(TEXTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_same_rows_as_sql(spark, tiny, name):
    con = duckdb.connect()
    for path in Path(tiny).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.queries()[name](spark, tiny)
    result = con.execute(TEXTS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr) == expected
