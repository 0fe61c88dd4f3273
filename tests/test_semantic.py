"""Semantic rules: fixture cells per rule, long form equals wide form,
scoring edge cases."""

import pytest
from pyspark.sql import functions as F

from civiclens.functions.validators import choose_rule, rule_table, semantic_label
from civiclens.operators import semantic as sem

# (column name, value, expected label)
CASES = [
    ("First Name", "Smith, John", "person_name"), ("last_name", "O'Neil", "Other"),
    ("business_name", "A", "Other"), ("Business Name", "AB", "business_name"),
    ("StreetName", "5th Avenue", "street_name"), ("street_name", "Main St", "Other"),
    ("street_name", "Broadway", "street_name"),
    ("school_name", "P.S. 12 School", "school_name"),
    ("Park_Facility", "Hil", "Other"), ("park", "Hills", "park_playground"),
    ("school_type", "K-8", "school_level"), ("core_subject", "Art", "subject_in_school"),
    ("interest6", "Law", "Other"), ("agency", "DOT", "city_agency"), ("agency", "827", "city_agency"),
    ("agency", "XY", "Other"), ("house_number", "12-14", "house_number"), ("house_number", "-1", "Other"),
    ("prem_typ_desc", "STREET", "location_type"), ("prem_typ_desc", "1st floor", "Other"),
    ("phone", "(212) 555-1234", "phone_number"), ("phone", "2125551234", "Other"),
    ("website", "http://www.nyc.gov/html/dot", "website"), ("URL", "nyc gov", "Other"),
    ("website", "a" * 40 + "!", "Other"),
    ("latitude", "40.71", "lat_coordinates"), ("latitude", "91", "Other"),
    ("longitude", "-181", "Other"), ("longitude", "-73.9", "lon_coordinates"),
    ("location", "(40.7, -73.9)", "lat_lon_cord"), ("location", "(40.7, -200.1)", "Other"),
    ("zip_code", " 10001-1234", "zip_code"), ("zip", "1001", "Other"),
    ("borough", "BROOKLYN", "borough"), ("borough", "Q", "borough"), ("borough", "6", "Other"),
    ("city", "Brooklyn", "city"), ("city", "New York", "Other"),
    ("neighborhood", "Park Slope", "neighborhood"), ("Park Neighborhood", "Slope", "park_playground"),
    ("Neighborhood", "Harlem", "neighborhood"), ("neighborhood", "9th", "Other"),
    ("address", "12 Main St, NY 10001", "address"), ("address", "12 Main St\n10001", "Other"),
    ("building_classification", "R4", "building_classification"),
    ("vehicle_color", "RED", "color"), ("vehicle_make", "4WD", "Other"),
    ("vehicle_make", "TOYOTA", "car_make"), ("vehicle_type", "SUBN", "vehicle_type"),
    ("other_col", "anything", "other_col"), ("city", "", "NULL"), ("city", None, "NULL"),
]


@pytest.mark.parametrize("name,value,expect", CASES)
def test_rules_wide(spark, name, value, expect):
    df = spark.createDataFrame([(value,)], "v string")
    from civiclens.functions.validators import column_label
    got = df.select(column_label(name, F.col("v")).alias("l")).first().l
    assert got == expect


def test_long_form_equals_wide_form(spark):
    df = spark.createDataFrame([(n, v) for n, v, _ in CASES], "column_name string, value string")
    got = [r.l for r in df.select(semantic_label(F.col("column_name"), F.col("value")).alias("l")).collect()]
    assert got == [e for _, _, e in CASES]


def test_strict_reference_street_words():
    strict = rule_table(strict_reference=True)
    street = next(r for r in strict if r.label == "street_name")
    assert "placeroute" in street.validator.args[0] and "place" not in street.validator.args[0]
    assert choose_rule("Zip Code").label == "zip_code"
    assert choose_rule("nothing") is None


def test_label_counts_and_documents(spark):
    df = spark.createDataFrame([("BROOKLYN", "x"), ("Q", "y"), ("", "z"), ("Mars", None)],
                               "borough string, misc string")
    counts = {(r.column_name, r.semantic_type): r["count"]
              for r in sem.semantic_labels(df, "d").collect()}
    assert counts == {("borough", "borough"): 2, ("borough", "NULL"): 1, ("borough", "Other"): 1,
                      ("misc", "misc"): 3, ("misc", "NULL"): 1}
    doc = sem.semantic_documents(sem.semantic_labels(df, "d")).first()
    assert doc.dataset_name == "d" and [c.column_name for c in doc.columns] == ["borough", "misc"]
    doc = sem.semantic_documents(sem.semantic_labels(df, "d"), qualify_columns=True).first()
    assert [c.column_name for c in doc.columns] == ["d_borough", "d_misc"]


def test_scores_never_predicted_label(spark):
    pred = spark.createDataFrame([("a", "d1", "c1"), ("a", "d2", "c1"), ("b", "d3", "c1")],
                                 "label string, dataset_name string, column_name string")
    truth = spark.createDataFrame([("a", "d1", "c1"), ("b", "d2", "c1"), ("c", "d9", "c9")],
                                  "label string, dataset_name string, column_name string")
    got = {r.label: (r.precision, r.recall) for r in sem.score_labels(pred, truth).collect()}
    assert got == {"a": (0.5, 1.0), "b": (0.0, 0.0), "c": (None, 0.0)}


def test_classification_metrics(spark):
    rows = [(1.0, 1.0)] * 5 + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 3
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = {r.label: r for r in sem.classification_metrics(df).collect()}
    assert got[1.0].precision == 1.0 and abs(got[1.0].recall - 5 / 7) < 1e-12
    assert abs(got[0.0].accuracy - 0.8) < 1e-12


def test_label_targets_resolves_then_labels(spark):
    from civiclens.operators.profile import melt_cells
    df = spark.createDataFrame([("BROOKLYN", "12 Main St 10001"), ("Mars", "x")],
                               "`Borough Name` string, `Street Address` string")
    cells = melt_cells(df, "ds")
    headers = sem.header_table(spark, {"ds": df})
    targets = spark.createDataFrame([("ds", "Borough_Name"), ("ds", "Street_Address")],
                                    "dataset_name string, given_name string")
    got = {(r.column_name, r.semantic_type): r["count"]
           for r in sem.label_targets(cells, headers, targets).collect()}
    assert got == {("Borough Name", "borough"): 1, ("Borough Name", "Other"): 1,
                   ("Street Address", "address"): 1, ("Street Address", "Other"): 1}


def test_explain_document_without_words(spark):
    from civiclens.operators import textml
    df = spark.createDataFrame([("a", "good words here", 1), ("b", "bad words there", 2)] * 5,
                               "category string, text string, id long")
    model = textml.fit(df)
    out = textml.explain(model, spark.createDataFrame([(7, "!!! ...")], "id long, text string"), 3, 16)
    assert out.count() == 0


def test_targets_read_only_their_columns(spark, tmp_path):
    """Names are resolved before the scan, which then reads one column."""
    from civiclens.operators import semantic as sem
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([("BRONX", "x", 1), ("Zz", "y", 2)], "borough string, note string, n int") \
         .write.parquet(path)
    targets = spark.createDataFrame([("t", "boro ugh")], "dataset_name string, given_name string")
    frames = {"t": spark.read.parquet(path)}
    out = sem.label_target_frames(spark, frames, targets)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<borough:string>" in plan
    cells = sem.melt_cells(frames["t"], "t")
    slow = sem.label_targets(cells, sem.header_table(spark, frames), targets)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, slow.collect())) != []
    assert sem.label_target_frames(spark, frames, targets.limit(0)).count() == 0
