"""Broken rows and broken datasets stay apart from the others."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from civiclens.plans import drivers
from civiclens.sources import isolation


def write_gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def cut(path, share=0.5):
    data = path.read_bytes()
    path.write_bytes(data[:int(len(data) * share)])


def noise(seed, n):
    rng = random.Random(seed)
    return "k\tv\n" + "".join(f"{rng.random()}\t{rng.getrandbits(60)}\n" for _ in range(n))


def test_broken_datasets_take_no_other_with_them(spark, tmp_path):
    write_gz(tmp_path / "good.tsv.gz", "a\tb\n1\tx\n2\ty\n2\t\n")
    for name in ("cut1", "cut2"):
        write_gz(tmp_path / f"{name}.tsv.gz", noise(name, 200000))
        cut(tmp_path / f"{name}.tsv.gz")
    (tmp_path / "nogzip.tsv.gz").write_text("a\tb\n1\t2\n")
    (tmp_path / "long.tsv").write_text('a\tb\n1\t"q\t1"\n3\t4\t5\n6\n3\t4\t5\n"7\t7"\t8\t\n')
    names = ("good.tsv.gz", "cut1.tsv.gz", "cut2.tsv.gz", "nogzip.tsv.gz", "long.tsv", "gone.tsv")
    (tmp_path / "m").write_text("".join(f"{tmp_path}/{n} 1\n" for n in names) + "x/glued.tsv 1\n")
    docs, quarantine = drivers.profile_manifest(spark, str(tmp_path / "m"))
    got = {d.dataset_name: {c.column_name: c for c in d.columns} for d in docs.collect()}
    assert sorted(got) == ["good.tsv.gz", "long.tsv"]
    assert got["good.tsv.gz"]["a"].number_non_empty_cells == 3
    assert (got["long.tsv"]["a"].number_non_empty_cells, got["long.tsv"]["b"].number_non_empty_cells,
            got["long.tsv"]["b"].number_empty_cells) == (2, 1, 1)
    assert got["long.tsv"]["b"].frequent_values == ["", "q\t1"]
    bad = sorted(((r.dataset_name, r.record or "", r.num) for r in quarantine.collect()))
    assert bad == [("cut1.tsv.gz", "", None), ("cut2.tsv.gz", "", None), ("glued.tsv", "", None),
                   ("gone.tsv", "", None), ("long.tsv", '"7\t7"\t8\t', 1), ("long.tsv", "3\t4\t5", 2),
                   ("nogzip.tsv.gz", "", None)]
    reasons = {r.dataset_name: r.reason for r in quarantine.collect()}
    assert "EOFException" in reasons["cut1.tsv.gz"]


def test_targets_of_a_broken_dataset(spark, tmp_path):
    write_gz(tmp_path / "cut.tsv.gz", "Borough\tv\n" + noise(3, 200000))
    cut(tmp_path / "cut.tsv.gz")
    write_gz(tmp_path / "good.tsv.gz", "Borough\nBROOKLYN\nQUEENS\tmore\n")
    (tmp_path / "t").write_text("['cut.Borough.txt.gz', 'good.Borough.txt.gz']")
    labels, bad = drivers.label_target_columns(spark, str(tmp_path / "t"), str(tmp_path))
    assert [(r.dataset_name, r.semantic_type, r["count"]) for r in labels.collect()] == [("good", "borough", 1)]
    assert [r.dataset_name for r in bad.collect()] == ["cut"]


def test_nothing_readable(spark, tmp_path):
    write_gz(tmp_path / "cut.tsv.gz", noise(4, 200000))
    cut(tmp_path / "cut.tsv.gz")
    (tmp_path / "m").write_text(f"{tmp_path}/cut.tsv.gz 1\n")
    docs, quarantine = drivers.profile_manifest(spark, str(tmp_path / "m"))
    assert docs is None and [r.dataset_name for r in quarantine.collect()] == ["cut.tsv.gz"]


def test_failures_of_the_job_itself_are_raised(spark):
    good = {"a": spark.range(3)}
    with pytest.raises(Exception, match="boom"):
        isolation.contained(good, lambda frames: frames["a"].select(F.raise_error(F.lit("boom"))))


def test_header_named_like_the_record(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("_corrupt_record\tb\n1\t2\n1\t2\t3\n")
    df = isolation.read_tsv_records(spark, str(tmp_path / "x.tsv"), ["_corrupt_record", "b"])
    assert [tuple(r) for r in isolation.good_rows(df).collect()] == [("1", "2")]
    cells = isolation.melt_rows(df, "x").collect()
    assert sorted((r.column_name or "", r.value) for r in cells) == [("", "1\t2\t3"), ("_corrupt_record", "1"), ("b", "2")]


def test_separators_outside_quotes(spark):
    rows = ['a\tb', 'a\tb\tc', '"a\tb"\tc', '"a\tb"\tc\t', '"x""\t"\t"\t"', 'x"\t"y', None]
    df = spark.createDataFrame([(r,) for r in rows], "r string")
    got = [x[0] for x in df.select(isolation.too_long(F.col("r"), 2)).collect()]
    assert got == [False, True, False, True, False, False, False]
