"""Readers and writers on small files written to a temporary folder."""

import gzip
import os

import pytest

from pyspark.sql import functions as F

from civiclens.sources import readers, writers


def test_positional_and_tsv(spark, tmp_path):
    p = tmp_path / "park.csv"
    p.write_text('1,2016-03-05,21,x,"a, b",NY\n2,2016-03-07,bad,x,y,\n')
    df = readers.read_positional_csv(spark, str(p), {0: ("summons", "bigint"), 1: ("issue_date", "date"),
                                                     2: ("code", "int"), 5: ("state", "string")}, width=6)
    rows = df.orderBy("summons").collect()
    assert rows[0].code == 21 and rows[0].state == "NY" and rows[1].code is None
    t = tmp_path / "ds.tsv.gz"
    with gzip.open(t, "wt") as f:
        f.write("a\tb\tb\n1\t\"x\ty\"\t3\n2\n4\t5\t6\t7\n")
    tsv = readers.read_tsv_strings(spark, str(t), partitions=2)
    assert len(tsv.columns) == 3 and tsv.count() == 3


def test_manifest_targets_lookup_labels(spark, tmp_path):
    m = tmp_path / "files.csv"
    m.write_text("/data/a.tsv.gz 100\ni296-73x5/data/b.tsv.gz 7\n/data/c.tsv.gz x\n")
    got = {r.dataset_name: r.valid for r in readers.read_manifest(spark, str(m)).collect()}
    assert got == {"a.tsv.gz": True, "b.tsv.gz": False, "c.tsv.gz": False}
    tg = tmp_path / "targets.txt"
    tg.write_text("['ab-12.Street_Name.txt.gz', 'cd-34.Color.txt.gz', 'ab-12.Street_Name.txt.gz']\n")
    got = sorted(tuple(r) for r in readers.read_targets(spark, str(tg)).collect())
    assert got == [("ab-12", "Street_Name"), ("cd-34", "Color")]
    z = tmp_path / "zip.csv"
    z.write_text("10001,Manhattan\n10301,Staten\n")
    assert {r.zip: r.borough for r in readers.read_lookup(spark, str(z)).collect()} == {
        "10001": "MANHATTAN", "10301": "STATEN ISLAND"}
    lab = tmp_path / "labels.csv"
    lab.write_text("Dataset,Label\n'ab-12.Street_Name.txt.gz',street_name\n")
    assert readers.read_label_table(spark, str(lab)).first().asDict() == {
        "label": "street_name", "dataset_name": "ab-12", "column_name": "Street_Name"}


def test_labelled_text_and_many_datasets(spark, tmp_path):
    for cat, n in (("alt.atheism", 2), ("soc.religion.christian", 1)):
        os.makedirs(tmp_path / "docs" / cat)
        for i in range(n):
            (tmp_path / "docs" / cat / f"{i}.txt").write_text(f"line one\nline {i}\n")
    df = readers.read_labelled_text(spark, str(tmp_path / "docs" / "*"))
    assert sorted(r.category for r in df.collect()) == ["alt.atheism", "alt.atheism", "soc.religion.christian"]
    (tmp_path / "x.tsv").write_text("c1\tc2\n1\ta\n")
    cells, bad = readers.melt_datasets(spark, {"x": str(tmp_path / "x.tsv"),
                                               "missing": str(tmp_path / "nope.tsv")})
    assert cells.count() == 2 and [r.dataset_name for r in bad.collect()] == ["missing"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("ABC", 1.234, 3), ("XY", None, None)], "k string, v double, n int")
    got = sorted(r.value for r in writers.format_rows(df, "%s\t%.2f, %d", ["k", "v", "n"]).collect())
    assert got == ["ABC\t1.23, 3", "XY\tnull, null"]
    done = spark.createDataFrame([("a", "c")], "dataset_name string, column_name string")
    todo = spark.createDataFrame([("a", "c"), ("b", "c")], "dataset_name string, column_name string")
    assert [r.dataset_name for r in writers.skip_finished(todo, done, ["dataset_name", "column_name"]).collect()] == ["b"]
    writers.write_sorted_single(df.select(F.col("k").alias("value")), str(tmp_path / "out"), ["value"])
    parts = [f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]
    assert len(parts) == 1
    merged = writers.merge_documents(df.select("k", "n"), "datasets").first().json
    assert merged.startswith('{"datasets":[')


def test_manifest_and_target_drivers(spark, tmp_path):
    from civiclens.plans import drivers
    (tmp_path / "d1.tsv").write_text("Borough\tCount\nBROOKLYN\t3\nMars\t\n")
    (tmp_path / "d2.tsv").write_text("Street Name\nMain Street\n")
    man = tmp_path / "files.csv"
    man.write_text(f"{tmp_path}/d1.tsv 10\n{tmp_path}/d2.tsv 5\nbroken/d3.tsv 1\n{tmp_path}/nope.tsv 3\n")
    docs, bad = drivers.profile_manifest(spark, str(man))
    assert sorted(r.dataset_name for r in docs.collect()) == ["d1.tsv", "d2.tsv"]
    assert sorted(r.dataset_name for r in bad.collect()) == ["d3.tsv", "nope.tsv"]
    tg = tmp_path / "targets.txt"
    tg.write_text("['d1.Borough.txt.gz', 'd2.Street_Name.txt.gz']")
    got = {(r.dataset_name, r.column_name, r.semantic_type): r["count"]
           for r in drivers.label_target_columns(spark, str(tg), str(tmp_path), suffix=".tsv")[0].collect()}
    assert got == {("d1", "Borough", "borough"): 1, ("d1", "Borough", "Other"): 1,
                   ("d2", "Street Name", "street_name"): 1}


def test_quotes_as_in_pythons_csv(spark, tmp_path):
    import csv
    from civiclens.sources import readers
    rows = [["a", "b"], ['say "hi" now', "x,y"], ["tab\there", ""]]
    with open(tmp_path / "q.csv", "w", newline="") as f:
        csv.writer(f).writerows(rows)
    with open(tmp_path / "q.tsv", "w", newline="") as f:
        csv.writer(f, delimiter="\t").writerows(rows)
    for df in (readers.read_csv(spark, str(tmp_path / "q.csv")),
               readers.read_tsv_strings(spark, str(tmp_path / "q.tsv"))):
        assert [[x or "" for x in r] for r in df.collect()] == rows[1:]


def test_percent_sign_and_equal_base_names(spark, tmp_path):
    from civiclens.plans import drivers
    from civiclens.sources import writers
    df = spark.createDataFrame([(5, "x")], "n int, s string")
    assert writers.format_rows(df, "100%% %d%%%s", ["n", "s"]).first()[0] == "100% 5%x"
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.tsv").write_text("h\n1\n")
    (tmp_path / "m.txt").write_text(f"{tmp_path}/a/x.tsv 1\n{tmp_path}/b/x.tsv 1\n")
    docs, _ = drivers.profile_manifest(spark, str(tmp_path / "m.txt"))
    assert docs.count() == 2


def test_unreadable_target_is_quarantined(spark, tmp_path):
    from civiclens.plans import drivers
    (tmp_path / "t.txt").write_text("['gone.col.txt.gz']")
    _, bad = drivers.label_target_columns(spark, str(tmp_path / "t.txt"), str(tmp_path), suffix=".tsv")
    assert [r.dataset_name for r in bad.collect()] == ["gone"]


def test_one_file_in_order(spark, tmp_path):
    import json
    from civiclens.sources import writers
    df = spark.range(5000).select(F.format_string("%05d", F.expr("4999 - id")).alias("value")).repartition(9)
    for _ in range(2):  # the second overwrites the first
        writers.write_sorted_single(df, str(tmp_path / "one"), ["value"])
    (part,) = [f for f in os.listdir(tmp_path / "one") if f.startswith("part-")]
    assert (tmp_path / "one" / part).read_text().split() == [f"{i:05d}" for i in range(5000)]
    with pytest.raises(FileExistsError):
        writers.write_sorted_single(df, str(tmp_path / "one"), ["value"], mode="error")
    docs = spark.createDataFrame([(f"d{i:03}", [i]) for i in range(300)], "name string, v array<int>").repartition(7)
    writers.write_merged_documents(docs, str(tmp_path / "m"), ["name"])
    (part,) = [f for f in os.listdir(tmp_path / "m") if f.startswith("part-")]
    assert json.loads((tmp_path / "m" / part).read_text()) == {"datasets": [{"name": f"d{i:03}", "v": [i]} for i in range(300)]}
    writers.write_merged_documents(docs.filter("name > 'x'"), str(tmp_path / "e"), ["name"])
    (part,) = [f for f in os.listdir(tmp_path / "e") if f.startswith("part-")]
    assert json.loads((tmp_path / "e" / part).read_text()) == {"datasets": []}
