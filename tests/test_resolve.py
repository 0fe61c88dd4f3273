"""LCS distance and name resolution against plain Python."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civiclens.operators.resolve import edit_distance, resolve_names


def _lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


def _dist(a, b):
    return len(a) + len(b) - 2 * _lcs(a, b)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.text("abcAB _", max_size=9), st.text("abcAB _", max_size=9)),
                min_size=50, max_size=50))
def test_edit_distance(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.d for r in df.select(edit_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [_dist(a, b) for a, b in pairs]


def test_known_matches(spark):
    headers = ["Street Name", "Vehicle Color", "Business Website or Other URL", "Borough"]
    cands = spark.createDataFrame([("ds", h, i) for i, h in enumerate(headers)],
                                  "dataset_name string, column_name string, position int")
    targets = spark.createDataFrame(
        [("ds", "StreetName"), ("ds", "Vehicle_Color"), ("ds", "Business_Website_or_Other_URL"),
         ("ds", "BOROUGH"), ("other", "x")], "dataset_name string, given_name string")
    got = {r.given_name: r.resolved_name for r in
           resolve_names(targets, cands, ["dataset_name"]).collect()}
    assert got["StreetName"] == "Street Name"
    assert got["Vehicle_Color"] == "Vehicle Color"
    assert got["Business_Website_or_Other_URL"] == "Business Website or Other URL"
    assert got["x"] is None
    # ties go to the first header
    expect = min(range(len(headers)), key=lambda i: (_dist("BOROUGH", headers[i]), i))
    assert got["BOROUGH"] == headers[expect]


def test_longer_than_a_word_of_bits(spark):
    import random
    rng = random.Random(2)
    sizes = [0, 1, 59, 60, 61, 119, 120, 121, 200]
    pairs = [("".join(rng.choice("abcé漢") for _ in range(a)), "".join(rng.choice("abcé漢") for _ in range(b)))
             for a in sizes for b in (0, 1, 60, 75, 150)]
    df = spark.createDataFrame([*pairs, (None, "a")], "a string, b string")
    got = [r.d for r in df.select(edit_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [*[_dist(a, b) for a, b in pairs], None]
