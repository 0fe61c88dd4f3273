"""Relational operators on hand-made fixtures (FIXTURES.md edge rows)."""

import datetime as dt

from pyspark.sql import functions as F

from civiclens.operators import relational as rel


def _parking(spark):
    rows = [  # summons, issue_date, code, plate, state
        (1, dt.date(2016, 3, 5), 21, "P1", "NY"),
        (1, dt.date(2016, 3, 5), 21, "P1", "NY"),   # duplicate summons
        (2, dt.date(2016, 3, 7), 38, "P2", None),   # NULL state
        (3, dt.date(2016, 3, 7), 38, "P2", None),
        (4, dt.date(2016, 3, 12), 14, "P3", "NJ"),
        (5, dt.date(2016, 3, 14), 14, "P3", "NJ"),
        (6, dt.date(2016, 3, 15), 21, "P4", "NY"),
    ]
    return spark.createDataFrame(rows, "summons long, issue_date date, code int, plate string, state string")


def test_anti_join_keeps_duplicates(spark):
    park = _parking(spark).repartition(3)
    opened = spark.createDataFrame([(4, 10.0), (9, 1.0)], "summons long, amount double")
    got = sorted(r.summons for r in rel.unresolved(park, opened, "summons").collect())
    assert got == [1, 1, 2, 3, 5, 6]


def test_count_by_null_key_modes(spark):
    park = _parking(spark)
    all_rows = {r.state: r.num for r in rel.count_by(park, "state").collect()}
    sql_like = {r.state: r.num for r in rel.count_by(park, "state", count_nulls=False).collect()}
    assert all_rows[None] == 2 and sql_like[None] == 0


def test_bucket_null_goes_to_other(spark):
    got = {r.bucket: r.num for r in rel.bucket_count(_parking(spark), "state", "NY").collect()}
    assert got == {"NY": 3, "Other": 4}


def test_most_frequent_keeps_ties(spark):
    got = sorted((r.plate, r.state, r.num) for r in
                 rel.most_frequent(_parking(spark).repartition(4), ["plate", "state"]).collect())
    assert got == [("P1", "NY", 2), ("P2", None, 2), ("P3", "NJ", 2)]


def test_top_k_total_order(spark):
    got = [(r.plate, r.num) for r in rel.top_k(_parking(spark), ["plate", "state"], 2).collect()]
    assert got == [("P1", 2), ("P2", 2)]


def test_calendar_average(spark):
    got = {r.code: (r.weekend_average, r.weekday_average) for r in
           rel.calendar_average(_parking(spark), "code", "issue_date", (5, 6, 12, 13), 4, 27).collect()}
    assert got[21] == (round(2 / 4, 2), round(1 / 27, 2))
    assert got[38] == (0.0, round(2 / 27, 2))
    assert got[14] == (0.25, round(1 / 27, 2))


def test_sum_avg_rounding(spark):
    df = spark.createDataFrame([("ABC", 1.005), ("ABC", 2.0), ("XY", None)], "t string, amt double")
    got = {r.t: (r.total, r.average) for r in rel.sum_avg_by(df, "t", "amt").collect()}
    assert got["ABC"][0] == 3.01 and got["XY"] == (None, None)


def test_top_k_per_group_ties_by_item(spark):
    rows = [("b1", "x")] * 3 + [("b1", "y")] * 2 + [("b1", "z")] * 2 + [("b2", "x")]
    df = spark.createDataFrame(rows, "g string, item string").repartition(3)
    got = sorted((r.g, r.item, r.rank) for r in rel.top_k_per_group(df, "g", "item", 2).collect())
    assert got == [("b1", "x", 1), ("b1", "y", 2), ("b2", "x", 1)]


def test_fill_from_lookup(spark):
    comp = spark.createDataFrame(
        [(1, "10001", "Unspecified"), (2, "99999", "Unspecified"), (3, None, "Unspecified"),
         (4, "10001", "QUEENS")], "id int, zip string, borough string")
    lk = spark.createDataFrame([("10001", "MANHATTAN"), ("10001", "MANHATTAN")], "zip string, b string")
    got = {r.id: r.filled for r in
           rel.fill_from_lookup(comp, "zip", "borough", lk, "zip", "b", out="filled").collect()}
    assert got == {1: "MANHATTAN", 2: None, 3: "Unspecified", 4: "QUEENS"}


def test_word_count_matches_python(spark):
    import string
    lines = ["Hello, world!  hello...", "  'quoted' -- Dash-word ", "", "ÉTÉ été"]
    expect = {}
    for line in lines:
        for w in line.strip().split():
            w = w.strip(string.punctuation)
            if w:
                expect[w.lower()] = expect.get(w.lower(), 0) + 1
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    got = {r.word: r.num for r in rel.word_count(df, "text").collect()}
    assert got == expect
