"""Variant parameters: rule thresholds, draft rules, date-by-name, row
index, sampling, key-length filter."""

from pyspark.sql import functions as F

from civiclens.functions.validators import column_label, draft_rule_table
from civiclens.operators import profile as prof
from civiclens.operators import relational as rel
from civiclens.operators import rules


def _items(spark):
    # uid 0..9: a=1 always; v=1 for uids 0..4, v=2 for 5..9; r=1 for 0..7
    rows = [(u, "a", 1) for u in range(10)]
    rows += [(u, "vdecile", 1 if u < 5 else 2) for u in range(10)]
    rows += [(u, "race", 1) for u in range(8)]
    return spark.createDataFrame(rows, "uid int, attr string, val int")


def test_threshold_variants(spark):
    items = _items(spark)
    f1 = rules.frequent_items(items, 1)
    f2 = rules.frequent_pairs(items, f1, 1)
    # conf(a=1 -> v=1) = 5/10 exactly
    incl = {(r.val2, r.conf) for r in rules.rules2(f1, f2, 0.5).collect() if r.attr1 == "a"}
    strict = {(r.val2, r.conf) for r in rules.rules2(f1, f2, 0.5, strict=True).collect() if r.attr1 == "a"}
    assert incl == {(1, 0.5), (2, 0.5)} and strict == set()
    rounded = rules.rules2(f1, f2, 0.6, conf_decimals=0).filter(F.col("attr1") == "a").count()
    assert rounded == 2  # round(0.5) = 1.0 (HALF_UP) passes 0.6


def test_protection_variants(spark):
    items = _items(spark)
    rs = rules.mine_rules(items, 1, 0.0, 0.0, protected="race", materialize_as=None)
    exact = rs.pd_r3.count()
    loose = rules.protected_rules(rs.r2, rs.r3, 0.0, "race", match_consequent_value=False).count()
    assert loose >= exact > 0


def test_draft_rules_and_date_by_name(spark):
    df = spark.createDataFrame([("10001",), ("20001",)], "v string")
    got = [r.l for r in df.select(column_label("zip", F.col("v"), draft_rule_table()).alias("l")).collect()]
    assert got == ["ny_zipcode", "Other"]
    cells = spark.createDataFrame([("ds", "report_year", "FY2019"), ("ds", "note", "FY2019")],
                                  "dataset_name string, column_name string, value string")
    freq = prof.value_frequencies(cells)
    types = {r.column_name: r.cell_type for r in prof.typed_frequencies(freq, date_by_name=True).collect()}
    assert types == {"report_year": "date", "note": "text"}


def test_row_index_sample_and_key_length(spark):
    df = spark.createDataFrame([(f"k{i % 3}", float(i)) for i in range(30)], "k string, v double").repartition(4)
    idx = rel.row_index(df, ["v"]).orderBy("v").collect()
    assert [r.id for r in idx] == list(range(30))
    assert rel.sample_one(df, 0.5, 3).count() == 1
    lic = spark.createDataFrame([("ABC", 1.0), ("AB", 2.0)], "t string, x double")
    assert [r.t for r in rel.sum_avg_by(lic, "t", "x", key_length=3).collect()] == ["ABC"]


def test_rounded_confidence_and_consequent_values(spark):
    rows = [(u, "a", 1) for u in range(3)] + [(0, "vdecile", 1), (1, "vdecile", 1), (2, "vdecile", 2)]
    rows += [(u, "race", 1) for u in range(3)]
    items = spark.createDataFrame(rows, "uid int, attr string, val int")
    f1 = rules.frequent_items(items, 1)
    f2 = rules.frequent_pairs(items, f1, 1)
    f3 = rules.frequent_triples(items, f1, None, 1)
    got = {(r.attr1, r.val2): r.conf for r in rules.rules2(f1, f2, 0.0, conf_decimals=2).collect()}
    assert got == {("a", 1): 0.67, ("a", 2): 0.33, ("race", 1): 0.67, ("race", 2): 0.33}
    assert {r.val2 for r in rules.rules2(f1, f2, 0.0, consequent_values=[2]).collect()} == {2}
    assert {r.val3 for r in rules.rules3(f2, f3, 0.0, consequent_values=[1]).collect()} == {1}


def test_date_by_name_comes_before_numbers(spark):
    cells = spark.createDataFrame([("ds", "year", "2019"), ("ds", "n", "2019")],
                                  "dataset_name string, column_name string, value string")
    typed = prof.typed_frequencies(prof.value_frequencies(cells), date_by_name=True)
    assert {r.column_name: r.cell_type for r in typed.collect()} == {"year": "date", "n": "int"}
