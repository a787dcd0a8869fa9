"""Every registered query against its DuckDB equivalent on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry
import oracle_texts

duckdb = pytest.importorskip("duckdb")
QUERIES, TEXTS = entry.base_queries(), oracle_texts.oracle_sql()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for path in Path(tiny).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """NaN as NULL, negative zero as zero."""
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(TEXTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, tiny, name):
    df = QUERIES[name](spark, tiny)
    result = duck.execute(TEXTS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = [tuple(plain(v) for v in row) for row in result.fetchall()]
    found = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
