"""Structured Streaming forms of the reference's streaming-style jobs.

The reference's word count ran as a Hadoop-Streaming mapper/reducer pair
over stdin; here the same transformation runs incrementally over files
arriving in a folder.  Word counts and counts per key are algebraic, so
the state store holds one running count per key and every micro-batch is
combined map-side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens.functions.text import strip_edge_punct, whitespace_tokens


def word_counts(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Running word counts of a streaming (or static) frame of lines."""
    words = (lines.select(F.explode(whitespace_tokens(F.col(text_col))).alias("_w"))
                  .select(F.lower(strip_edge_punct(F.col("_w"))).alias("word"))
                  .filter(F.col("word") != ""))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("num"))


def text_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType | str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def counts_by_key(events: DataFrame, key: str, out: str = "num") -> DataFrame:
    """Running count per key of a streaming frame."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def start_complete(agg: DataFrame, checkpoint: str, sink: str | None = None,
                   name: str | None = None, path: str | None = None):
    """Start an aggregation in complete mode.  ``checkpoint`` must be a
    folder every executor and the driver can reach (the cluster's shared
    checkpoint folder), so a restarted query resumes its state.

    With ``path`` the whole result after micro-batch i is written to
    ``<path>/batch=i`` (a repeated batch overwrites its own folder); with
    ``name`` it is kept on the driver as a table of that name, which only suits
    small results.  Other sinks are given by ``sink``."""
    w = agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if sink is None and path is not None:
        folder = path.rstrip("/")
        return w.foreachBatch(
            lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/batch={i}")).start()
    if sink is None and name is None:
        raise ValueError("give a path for the results, or a name to keep them on the driver")
    if sink in (None, "memory"):
        return w.format("memory").queryName(name or "counts").start()
    w = w.format(sink)
    return (w.option("path", path) if path else w).start()
