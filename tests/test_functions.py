import pytest
from pyspark.sql import functions as F

from publicspend.functions import text
from publicspend.functions.measures import stable_round
from publicspend.operators import register, strategic
from publicspend.rules import MACRO_STATES


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_comma_decimal(spark):
    cases = {
        "1234,56": 1234.56, "1.234,56": None, "": None, "abc": None, "12.5d": None, "12f": None,
        "0x1p3": None, "inf": None, "nan": None, " 7,5 ": 7.5, "1e3": 1000.0, "-3,": -3.0,
        ",5": 0.5, "1_000": None, None: None,
    }
    assert apply(spark, text.comma_decimal, cases) == list(cases.values())


def test_italian_number(spark):
    cases = {"1.234,5": 1234.5, "1.234.567": 1234567.0, "n.d.": None, " 12 ": 12.0, "-0,5": -0.5}
    assert apply(spark, text.italian_number, cases) == list(cases.values())


def test_lenient_int(spark):
    cases = {"2024": 2024, " 7 ": 7, "2024.7": 2025, "1e3": 1000, "x": None, "": None, "9e12": None}
    assert apply(spark, text.lenient_int, cases) == list(cases.values())


def test_text(spark):
    assert apply(spark, text.cleaned_text, [" a ", "  ", "", None]) == ["a", None, None, None]
    assert apply(spark, text.usable_key, ["a", " ", "", None, " a"]) == [
        True, False, False, False, True,
    ]
    assert apply(spark, lambda c: text.clipped(c, 5), ["abcde", "abcdef", None]) == [
        "abcde", "abcde...", None,
    ]


@pytest.mark.parametrize("value, digits, expected", [(1.005, 2, 1.01), (0.1 + 0.2, 1, 0.3),
                                                     (2.5, 0, 3.0), (1e73, 3, 1e73)])
def test_stable_round(spark, value, digits, expected):
    row = spark.range(1).select(stable_round(F.lit(value), digits)).first()
    assert row[0] == expected


def test_project_flags(spark):
    raw = {c: "" for c in register.PROJECT_COLUMNS}
    cases = [("CHIUSO", None), ("ANNULLATO", ""), ("REVOCATO", "  "), ("ATTIVO", "X"), (None, " X")]
    rows = [
        tuple((raw | {"CUP": str(i), "STATO_PROGETTO": s, "CUP_MASTER": m,
                      "COSTO_PROGETTO": "1500000000,5", "FINANZIAMENTO_PROGETTO": "x"}).values())
        for i, (s, m) in enumerate(cases)
    ]
    schema = ", ".join(f"{c} string" for c in raw)
    mart = register.project_mart(register.clean_projects(spark.createDataFrame(rows, schema)))
    found = mart.orderBy("cup").collect()
    assert [r.flag_chiuso for r in found] == [True, True, True, False, False]
    assert [r.flag_sub_progetto for r in found] == [False, False, False, True, True]
    assert (found[0].costo_progetto, found[0].costo_mld) == (1500000000.5, 1.5)
    assert found[0].finanziamento_progetto is None
    assert len(mart.columns) == 20


def test_works(spark):
    headers = strategic.WORKS_TEXT | strategic.WORKS_INTEGERS | strategic.WORKS_AMOUNTS
    labels = [s for states in MACRO_STATES.values() for s in states] + ["altro", None]
    costs = ["1.234,5", None, "0", "10"]

    def row(i, state):
        values = dict.fromkeys(headers, None) | {
            "progressivo": str(i), "cup": " C ", "denominazione": "D", "stato_attuazione": state,
            "costi_mln_euro": costs[i % 4], "disponibilita_mln_euro": "4",
            "anno_ultimazione_previsto": "2026.0", "luogo_lavori": "",
        }
        return tuple(values.values())

    schema = ", ".join(f"`{h}` string" for h in headers.values())
    raw = spark.createDataFrame([row(i, s) for i, s in enumerate(labels)], schema)
    found = strategic.works_mart(strategic.clean_works(raw, 2024)).orderBy("progressivo").collect()
    expected = [name for name, states in MACRO_STATES.items() for _ in states]
    assert [r.macro_stato for r in found] == expected + ["non indicato"] * 2
    gaps = [(r.gap_finanziario_mln_euro, r.pct_copertura) for r in found[:4]]
    assert gaps == [(1230.5, 0.3), (None, None), (-4.0, None), (6.0, 40.0)]
    assert (found[0].anno, found[0].cup, found[0].anno_ultimazione_previsto) == (2024, "C", 2026)
    assert found[0].luogo_lavori is None and len(found[0]) == 18
