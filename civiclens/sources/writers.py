"""Sinks: formatted text rows, per-dataset JSON documents, merged
documents, skip-finished filtering and small sorted single files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.operators._plan import global_rank


def format_rows(df: DataFrame, fmt: str, cols: Sequence[str | Column],
                out: str = "value") -> DataFrame:
    """One text column via ``format_string`` (``%s``, ``%d``, ``%.2f``).

    A NULL under ``%.2f`` prints as ``nu`` in Spark, so numeric NULLs are
    printed as ``null`` through ``%s`` instead: the caller's ``%.2f`` is
    applied only to non-NULL values.
    """
    exprs = [F.col(c) if isinstance(c, str) else c for c in cols]
    specs = _split_specs(fmt)
    if len(specs) - 1 != len(exprs):
        raise ValueError("number of format specifiers and columns differ")
    pieces = [F.lit(specs[0].replace("%%", "%"))]
    for spec_text, e in zip(specs[1:], exprs):
        spec, rest = spec_text
        one = F.format_string(spec, e)
        pieces.append(F.when(e.isNull(), F.lit("null")).otherwise(one) if spec.endswith("f") else one)
        pieces.append(F.lit(rest.replace("%%", "%")))
    return df.select(F.concat(*pieces).alias(out))


def _split_specs(fmt: str) -> list:
    """``'%d\\t%s'`` → ``['', ('%d', '\\t'), ('%s', '')]``."""
    parts = re.split(r"(?<!%)((?:%%)*)(%[-+ 0#]*\d*(?:\.\d+)?[sdf])", fmt)
    # groups of three: signs written twice before a specifier, the specifier,
    # and the text after it
    text, out = parts[0] + (parts[1] if len(parts) > 1 else ""), []
    out.append(text)
    for i in range(2, len(parts), 3):
        after = parts[i + 1] + (parts[i + 2] if i + 2 < len(parts) else "")
        out.append((parts[i], after))
    return out


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One string column written as text part files."""
    df.write.mode(mode).text(path)


def write_tab_joined(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """``key\\tvalue...`` lines (the ``saveAsTextFile`` layout)."""
    df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value")) \
      .write.mode(mode).text(path)


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite",
                    key: str = "dataset_name") -> None:
    """One JSON document per dataset, partitioned by dataset name."""
    docs.withColumn("_part", F.col(key)).write.mode(mode).partitionBy("_part").json(path)


def merge_documents(docs: DataFrame, root_key: str = "datasets") -> DataFrame:
    """All documents under one root key as a single JSON string
    (``{"datasets": [...]}``).  One row per dataset goes into one group,
    so use it for result documents, not for data; many documents go to
    :func:`write_merged_documents`."""
    return docs.agg(F.to_json(F.struct(
        F.array_sort(F.collect_list(F.struct(*docs.columns))).alias(root_key))).alias("json"))


def score_document(scores: DataFrame) -> DataFrame:
    """The precision/recall document of :func:`semantic.score_labels` rows as
    one JSON string: ``{"results": [{label: [{"precision": p}, {"recall": r}]}]}``,
    labels in order.  One row per label goes into one group, so the document
    is as long as the list of labels."""
    entry = F.create_map(F.col("label"), F.array(
        F.create_map(F.lit("precision"), F.col("precision")),
        F.create_map(F.lit("recall"), F.col("recall"))))
    ordered = F.array_sort(F.collect_list(F.struct("label", F.to_json(entry).alias("entry"))))
    items = F.array_join(F.transform(ordered, lambda x: x["entry"]), ",")
    return scores.agg(F.concat(F.lit('{"results":['), items, F.lit("]}")).alias("json"))


def write_score_document(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """:func:`score_document` as a JSON text file."""
    score_document(scores).withColumnRenamed("json", "value").write.mode(mode).text(path)


def skip_finished(targets: DataFrame, finished: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets not produced yet (``left_anti`` on the keys)."""
    return targets.join(finished.select(*keys).distinct(), list(keys), "left_anti")


def _file_system(spark, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _join_files(spark, folders: Sequence[str], target: str) -> None:
    """The part files of the folders, in order, as the one file ``target``.

    A file system that can join files (HDFS) only changes its directory; on
    others the driver copies the bytes from stream to stream, holding none.
    """
    fs, hadoop_path = _file_system(spark, target)
    parts = []
    for folder in folders:
        names = sorted(str(s.getPath()) for s in fs.listStatus(hadoop_path(folder))
                       if s.getPath().getName().startswith("part-"))
        parts += [hadoop_path(n) for n in names if fs.getFileStatus(hadoop_path(n)).getLen() > 0]
    out = fs.create(hadoop_path(target), True)
    if fs.getUri().getScheme() == "hdfs":
        out.close()
        array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            array[i] = p
        if parts:
            fs.concat(hadoop_path(target), array)
        return
    try:
        for p in parts:
            stream = fs.open(p)
            try:
                spark._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out)
            finally:
                stream.close()
    finally:
        out.close()


def _write_joined(spark, frames: Sequence[DataFrame], path: str, mode: str) -> None:
    """Text frames, each in the order of its partitions, as the single file
    ``part-00000`` of the folder ``path``."""
    path = path.rstrip("/")
    fs, hadoop_path = _file_system(spark, path)
    if fs.exists(hadoop_path(path)):
        if mode == "ignore":
            return
        if mode != "overwrite":
            raise FileExistsError(path)
        fs.delete(hadoop_path(path), True)
    folders = [f"{path}/_parts/{i}" for i in range(len(frames))]
    for df, folder in zip(frames, folders):
        df.write.text(folder)
    _join_files(spark, folders, f"{path}/part-00000")
    fs.delete(hadoop_path(f"{path}/_parts"), True)
    fs.create(hadoop_path(f"{path}/_SUCCESS"), True).close()


def write_sorted_single(df: DataFrame, path: str, order: Sequence[str | Column],
                        mode: str = "overwrite") -> None:
    """One string column as one sorted text file (the reference's
    ``getmerge`` + ``sort``): range-sorted part files, joined in order by the
    file system, so no task holds the whole."""
    ordered = df.orderBy(*order).select(df.columns[0])
    _write_joined(df.sparkSession, [ordered], path, mode)


def write_merged_documents(docs: DataFrame, path: str, order: Sequence[str],
                           root_key: str = "datasets", mode: str = "overwrite") -> None:
    """All documents in the order of ``order`` (a total order) under one root key
    as one JSON file: ``{"datasets": [`` and ``]}`` around range-sorted part files
    with a document a line.  No aggregate holds the documents."""
    spark = docs.sparkSession
    ranked = global_rank(docs, list(order), "_place")
    comma = F.when(F.col("_place") == 0, F.lit("")).otherwise(F.lit(","))
    lines = (ranked.orderBy("_place")
                   .select(F.concat(comma, F.to_json(F.struct(*docs.columns))).alias("value")))

    def line(text):
        return spark.range(1).coalesce(1).select(F.lit(text).alias("value"))
    _write_joined(spark, [line(f'{{"{root_key}": ['), lines, line("]}")], path, mode)
