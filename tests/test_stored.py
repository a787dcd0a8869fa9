"""Stored registers and measured writes on a few orders: what they do must grow with the tables."""

import datetime as dt
import hashlib
import random
import re
import sys
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from publicspend.operators.quality import fingerprint  # noqa: E402
from publicspend.session import SHUFFLE_SETTING, shuffles_of  # noqa: E402
from publicspend.sources import tables  # noqa: E402

SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
    "documents": "doc_id bigint, n_chars bigint",
}


@pytest.fixture(scope="module")
def few_orders(spark, tmp_path_factory):
    folder, draw = tmp_path_factory.mktemp("few"), random.Random(3)
    day = dt.datetime(1997, 5, 1)
    rows = {
        "orders": [
            (k, k % 7, "FOP"[k % 3], 1000.25 + k, day + dt.timedelta(days=k), f"{k % 5 + 1}-LOW")
            for k in range(120)
        ],
        "lineitem": [
            (draw.randrange(120), draw.randrange(40), draw.randrange(6), n % 7, 2.0,
             draw.randrange(4000, 110_000) / 1.0, 0.05, 0.0, "ARN"[n % 3], "FO"[n % 2], day)
            for n in range(500)
        ],
        "supplier": [(k, f"Supplier#{k}", k % 4) for k in range(6)],
        "nation": [(k, f"N{k}", k % 2) for k in range(4)],
        "region": [(0, "EUROPE"), (1, "AFRICA")],
        "part": [(k, f"p{k}", f"b{k % 3}", "t", k + 1, 900.5 + k) for k in range(40)],
        "events": [(k, k % 30, "view" if k % 2 else "buy", k / 4) for k in range(90)],
        "documents": [(k, 10 * k) for k in range(20)],
    }
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def listed(df):
    return sorted(map(repr, df.collect()))


def test_buckets_grow_with_the_tables(spark, few_orders, monkeypatch):
    assert entry._buckets(spark, few_orders).count == entry.LEAST_BUCKETS
    monkeypatch.setattr(entry, "BUCKET_BYTES", 512)
    wanted = entry._buckets(spark, few_orders).count
    assert wanted > entry.LEAST_BUCKETS
    places, scratch = [], entry._scratch
    monkeypatch.setattr(entry, "_scratch", lambda *a: places.append(scratch(*a)) or places[-1])
    before = spark.conf.get(SHUFFLE_SETTING)
    stored = entry.queries()["stored_wide_register"](spark, few_orders)
    assert listed(stored) == listed(entry.queries()["wide_register"](spark, few_orders))
    assert spark.conf.get(SHUFFLE_SETTING) == before
    for name in ("registro", "luogo", "appalti", "opere", "wide"):
        assert tables.facts(spark, f"{places[0]}/{name}").buckets.count == wanted
    card = entry.queries()["stored_project_card"](spark, few_orders)
    assert listed(card) == listed(entry.queries()["report_project_card"](spark, few_orders))


def test_groups_are_dealt_to_buckets_in_one_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 9).cast("string").alias("cup"), "id")
    with pytest.raises(ZeroDivisionError), shuffles_of(spark, 11):
        dealt = rows.groupBy("cup").agg(F.max("id")).repartition(11, "cup")
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"\bExchange\b", plan)) == 1
        1 / 0
    assert spark.conf.get(SHUFFLE_SETTING) != "11"


def test_register_is_worked_out_once(spark, few_orders, monkeypatch):
    calls, projects = [], entry.Proxy.projects
    monkeypatch.setattr(entry.Proxy, "projects", lambda p: calls.append(p) or projects(p))
    checks = {r.rule: r for r in entry.quality_metrics(spark, few_orders).collect()}
    assert len(calls) == 1
    assert checks["same_rows"].observed == 120 and checks["same_keys"].passed


def test_fingerprint_is_the_sum_of_60_bits(spark):
    keys = [None, "", "-", *[f"cup {n}" for n in range(2000)]]
    df = spark.createDataFrame([(k,) for k in keys], "cup string")
    texts = ["-" if k is None else f"={k}" for k in keys]
    total = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts)
    assert df.agg(fingerprint(("cup",))).first()[0] == total % (1 << 62)
    assert df.where("false").agg(fingerprint(("cup",))).first()[0] == 0
    plan = df.agg(fingerprint(("cup",)))._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast" not in plan  # no decimal for each row


def test_register_and_sides_are_written_side_by_side(spark, few_orders, monkeypatch):
    write, lock, running, most = entry.layers.write_table, threading.Lock(), set(), [0]

    def counted(df, path, **kind):
        with lock:
            running.add(path)
            most[0] = max(most[0], len(running))
        try:
            return write(df, path, **kind)
        finally:
            with lock:
                running.discard(path)

    monkeypatch.setattr(entry.layers, "write_table", counted)
    assert entry.queries()["stored_wide_register"](spark, few_orders).count() == 120
    assert 1 < most[0] <= entry.WRITES_AT_ONCE
