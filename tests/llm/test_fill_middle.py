"""Fill in the middle against cuts by a pattern, and back."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from publicspend.llm import fill_middle
from publicspend.llm.fill_middle import BlockCounts, MiddleRules

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def expected(doc_id, text, rules=MiddleRules()):
    text = text or ""
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in rules.marks) or h[2] % 100 >= rules.percent:
        return (doc_id, n, "plain", None, None, text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < rules.spm_percent:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def texts(rng):
    alphabet = ["\n", "\n", "a", "é", "日", "😀", " ", "<", "P", ">", "\r", "word "]
    plain = ["".join(rng.choices(alphabet, k=rng.choice([1, 3, 20, 300]))) for _ in range(150)]
    marks = ["<P>", "a\n<S>", "x<M>\n", "<P", "M>", "<", "\n<\n<S\n>", "\n", "\n\n", "a", "a\n"]
    long = ["é" * 9000 + "\n" + "ab\n" * 9000 + "😀" * 5000, "\n" * 20_000, "q" * 20_000]
    return plain + marks + long + ["", None]


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_cuts_and_back(spark, block):
    rows = list(enumerate(texts(random.Random(3))))
    rows += [(None, "a\nb\nc"), (5, rows[5][1]), (5, rows[5][1]), (-4, "x\ny\n")]
    docs = spark.createDataFrame(
        [(t, i, "z") for i, t in rows], "text string, doc_id bigint, output string"
    ).repartition(3)
    rules = MiddleRules(block=block)
    cut = fill_middle.fill_in_middle(docs, rules)
    found = cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted((expected(i, t) + (t or "",) for i, t in rows), key=repr)
    hashes = fill_middle.digest(cut).where("form <> 'plain' AND output_sha256 = restored_sha256")
    assert hashes.count() == 0


def test_shares_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "a\nb\n") for i in range(400)], "doc_id bigint, text string")
    rules = MiddleRules(percent=30, spm_percent=0)
    forms = {r.form: r["count"] for r in fill_middle.fill_in_middle(docs, rules).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_descent_finds_each_border():
    rng = random.Random(9)
    raw = "".join(rng.choices(["\n", "a", "é😀", "\nlong line"], k=700)).encode()
    for block in (1, 2, 5, 64, 1 << 20):
        counts = BlockCounts(np.frombuffer(raw, np.uint8), block)
        units = UNIT.findall(raw.decode())
        assert counts.n == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert counts.cut(k) == (len(head.encode()), len(head))
