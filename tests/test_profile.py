"""Profiler against brute force on a small multi-partition table."""

import math
from collections import Counter

from pyspark.sql import functions as F

from civiclens.operators import profile as prof

ROWS = [
    ("1", "abc", "2019-01-01", "", "1.5"),
    ("2", "de", "2019-01-03", "", "x"),
    ("2", "abc", "01/02/2010 12:00:00 AM", "", "2"),
    ("-3", "#", "Mon", "", None),
    ("1_000", "zz", "2019-01-02", "", "3.25"),
    ("7", "de", "2018-12-31", "", "1.5"),
]
COLS = ["n", "t", "d", "e", "m"]


def _cells(spark):
    df = spark.createDataFrame(ROWS, ", ".join(f"{c} string" for c in COLS)).repartition(3)
    return prof.melt_cells(df, "ds")


def test_counts_and_top5(spark):
    cells = _cells(spark)
    freq = prof.value_frequencies(cells)
    counts = {r.column_name: r for r in prof.column_counts(freq).collect()}
    for i, c in enumerate(COLS):
        vals = [(r[i] or "") for r in ROWS]
        assert counts[c].number_cells == len(vals)
        assert counts[c].number_empty_cells == sum(v == "" for v in vals)
        assert counts[c].number_non_empty_cells + counts[c].number_empty_cells == counts[c].number_cells
        assert counts[c].number_distinct_values == len(set(vals))
    top = prof.frequent_values(freq, 2).filter(F.col("column_name") == "t").orderBy("rank").collect()
    assert [(r.value, r.freq) for r in top] == [("abc", 2), ("de", 2)]


def test_numeric_text_date_stats(spark):
    typed = prof.typed_frequencies(prof.value_frequencies(_cells(spark)))
    num = {(r.column_name, r.cell_type): r for r in prof.numeric_stats(typed).collect()}
    ints = [1, 2, 2, -3, 1000, 7]
    r = num[("n", "int")]
    mean = sum(ints) / len(ints)
    assert (r["count"], r.max_value, r.min_value) == (6, 1000.0, -3.0)
    assert abs(r.mean - mean) < 1e-9
    ss = sum((x - mean) ** 2 for x in ints)
    assert abs(r.root_sum_sq_dev - math.sqrt(ss)) < 1e-9
    assert abs(r.stddev - math.sqrt(ss / len(ints))) < 1e-9
    assert num[("m", "real")]["count"] == 3 and num[("m", "int")]["count"] == 1
    text = {r.column_name: r for r in prof.text_stats(typed).collect()}
    assert text["t"].shortest_value == "#" and text["t"].longest_value == "abc"
    assert abs(text["t"].average_length - sum(map(len, ["abc", "de", "abc", "#", "zz", "de"])) / 6) < 1e-12
    dates = {r.column_name: r for r in prof.date_stats(typed).collect()}
    assert dates["d"]["count"] == 5
    assert dates["d"].max_value == "2019-01-03" and dates["d"].min_value == "01/02/2010 12:00:00 AM"


def test_documents_keep_empty_columns(spark):
    docs = prof.profile_documents(_cells(spark)).collect()
    assert len(docs) == 1
    cols = {c.column_name: c for c in docs[0].columns}
    assert set(cols) == set(COLS)
    assert cols["e"].data_types == [] and cols["e"].number_empty_cells == 6
    types = {b.type: b["count"] for b in cols["m"].data_types}
    assert types == {"REAL": 3, "INTEGER (LONG)": 1, "TEXT": 1}
    assert docs[0].key_column_candidates == sorted(COLS)
    assert docs[0].unique_columns == ["d"]


def test_summary(spark):
    counts = prof.type_counts(_cells(spark))
    s = {r.column_name: r for r in prof.profile_summary(counts).collect()}
    assert s["e"].sparsity == 1.0 and s["e"].cleanliness == 1.0 and s["e"].n_types == 0
    assert abs(s["m"].cleanliness - 3 / 5) < 1e-12
    totals = {r.data_type: r.num for r in prof.type_totals(counts).collect()}
    assert sum(totals.values()) == sum(1 for r in ROWS for v in r if v not in (None, ""))


def test_integers_of_any_length(spark):
    """Extremes are exact and no integer leaves the sums, however long."""
    cells = {"both": ["1" * 40, "10", "-2", "-" + "3" * 45, "0020", "-0"],
             "below": ["-" + "9" * 41, "-" + "8" * 41, "-7"],
             "above": ["9" * 39, "1" + "0" * 39, " +5 "]}
    rows = [("ds", c, v) for c, vs in cells.items() for v in vs]
    df = spark.createDataFrame(rows, "dataset_name string, column_name string, value string")
    got = {r.column_name: r for r in prof.numeric_stats(
        prof.typed_frequencies(prof.value_frequencies(df))).collect()}
    for c, vs in cells.items():
        nums = [int(v) for v in vs]
        assert (int(got[c].max_int), int(got[c].min_int)) == (max(nums), min(nums))
        assert got[c]["count"] == len(nums)
        assert abs(got[c].mean - sum(nums) / len(nums)) <= 1e-9 * max(map(abs, nums))


def test_summary_reads_type_counts_only(spark):
    plan = prof.profile_summary(prof.type_counts(_cells(spark)))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan
