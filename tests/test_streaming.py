"""Streaming word count equals the batch word count."""

from civiclens.operators import relational as rel
from civiclens.streaming import wordstream


def test_stream_word_count(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("Hello, world!\nhello again\n")
    (src / "b.txt").write_text("World: again; AGAIN\n")
    lines = wordstream.text_stream(spark, str(src), max_files_per_trigger=1)
    q = wordstream.start_complete(wordstream.word_counts(lines), str(tmp_path / "ckpt"),
                                  name="wc_test")
    try:
        q.processAllAvailable()
        got = {r.word: r.num for r in spark.sql("SELECT * FROM wc_test").collect()}
    finally:
        q.stop()
    batch = spark.read.text(str(src)).withColumnRenamed("value", "text")
    assert got == {r.word: r.num for r in rel.word_count(batch, "text").collect()}
    assert got["again"] == 3


def test_results_as_files(spark, tmp_path):
    import pytest
    src = tmp_path / "in"
    src.mkdir()
    for i, text in enumerate(("a b\n", "b c\n", "c c\n")):
        (src / f"{i}.txt").write_text(text)
    counts = wordstream.word_counts(wordstream.text_stream(spark, str(src), max_files_per_trigger=1))
    q = wordstream.start_complete(counts, str(tmp_path / "ckpt"), path=str(tmp_path / "out"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(str(tmp_path / "out"))
    last = out.selectExpr("max(batch)").first()[0]
    assert {r.word: r.num for r in out.where(f"batch = {last}").collect()} == {"a": 1, "b": 2, "c": 3}
    with pytest.raises(ValueError, match="path"):
        wordstream.start_complete(counts, str(tmp_path / "c2"))
