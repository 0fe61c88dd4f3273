"""Cell-type inference on the FIXTURES.md cells."""

import pytest
from pyspark.sql import functions as F

from civiclens.functions import celltypes as ct

CASES = [
    ("", "empty"), (None, "empty"),
    ("12", "int"), (" 12 ", "int"), ("+5", "int"), ("1_000", "int"), ("12345678901234567890", "int"),
    ("-7", "int"),
    ("1.5", "real"), (".5", "real"), ("5.", "real"), ("1.e3", "real"), ("-0.25E-2", "real"),
    ("1.5f", "text"), ("1e5", "text"), ("nan", "text"), ("1__0", "text"), ("1.2.3", "text"),
    ("2019-01-01", "date"), ("01/02/2010 12:00:00 AM", "date"), ("2024-01-01 00:00:07", "date"),
    ("1/2/2010", "date"),
    ("2019-01-01T00:00:00.000", "date"), ("2019-01-01T00:00:00Z", "date"),
    ("2019-01-01 10:30:00.123456", "date"), ("2019-01-01 10:30", "date"),
    ("2019-01-01T10:30:00+02:00", "date"),
    ("2019/01/05", "date"), ("01/05/2019 10:30", "date"), ("05-JAN-19", "date"),
    ("05-Jan-2019", "date"), ("January 5, 2019", "date"), ("Jan 5 2019", "date"),
    ("5 January 2019", "date"), ("Room 5, 2019", "text"), ("12-ABC-99", "text"),
    ("Mon", "text"), ("10:30", "text"), ("2019-13-45", "text"), ("#", "text"), ("abc", "text"),
]


def test_cell_types(spark):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
    got = [r.t for r in df.select(ct.cell_type(F.col("v")).alias("t")).collect()]
    assert got == [t for _, t in CASES]


@pytest.mark.parametrize("v,expect", [("1_000", 1000), (" +12 ", 12), ("12345678901234567890", 12345678901234567890)])
def test_int_value_is_exact(spark, v, expect):
    got = spark.createDataFrame([(v,)], "v string").select(ct.int_value(F.col("v")).alias("x")).first().x
    assert int(got) == expect


def test_python_semantics_agree_on_ascii(spark):
    """The int/real grammar equals Python's int()/float()-with-dot on a
    generated set of ASCII strings."""
    import itertools

    def py_type(s):
        if s == "":
            return "empty"
        try:
            int(s)
            return "int"
        except ValueError:
            pass
        if "." in s:
            try:
                float(s)
                return "real"
            except ValueError:
                pass
        return "other"

    alphabet = ["1", "_", ".", "e", "-", " ", "a"]
    vals = ["".join(p) for n in range(1, 5) for p in itertools.product(alphabet, repeat=n)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    t = ct.cell_type(F.col("v"))
    got = {r.v: r.t for r in df.select("v", F.when(t.isin("int", "real", "empty"), t)
                                       .otherwise("other").alias("t")).collect()}
    bad = [v for v in vals if got[v] != py_type(v)]
    assert not bad, bad[:20]


def test_instants_keep_fractions_and_zones(spark):
    vals = ["2019-01-01 00:00:00.25", "2019-01-01T02:00:00+02:00", "2019-01-01T00:00:00Z", "05-JAN-19"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    a, b, c, d = [r.t for r in df.select(ct.date_value(F.col("v")).alias("t")).collect()]
    assert a.microsecond == 250000 and b == c and (d.year, d.month, d.day) == (2019, 1, 5)
