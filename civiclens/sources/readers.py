"""Readers for the reference's inputs (all lazy DataFrames).

Every reader declares its schema when it is known; inference stays an
option.  Malformed rows do not fail a dataset (PERMISSIVE mode).  Cells beyond
a row's columns are not kept here; ``isolation`` keeps such records apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens.operators.profile import melt_cells


def read_csv(spark: SparkSession, path: str | Sequence[str], header: bool = True,
             schema: T.StructType | str | None = None, infer: bool = False,
             sep: str = ",", escape: str = '"') -> DataFrame:
    """CSV with header; explicit schema, inference, or all strings.  A quote
    within quotes is written twice, as in Python's ``csv``; pass Spark's own
    default, ``escape="\\\\"``, for files with backslash escapes."""
    r = (spark.read.option("header", header).option("sep", sep).option("quote", '"')
         .option("escape", escape))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_positional_csv(spark: SparkSession, path: str | Sequence[str],
                        columns: Mapping[int, tuple[str, str]], width: int | None = None) -> DataFrame:
    """Header-less CSV addressed by position: ``{index: (name, type)}``.

    Read as strings (quote-aware), then ``try_cast`` — a bad value becomes
    NULL instead of failing the job.
    """
    n = width or (max(columns) + 1)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])
    raw = (spark.read.option("header", False).option("quote", '"').option("escape", '"')
           .schema(schema).csv(path))
    return raw.select(*[F.col(f"_c{i}").try_cast(t).alias(name)
                        for i, (name, t) in sorted(columns.items())])


def read_tsv_strings(spark: SparkSession, path: str | Sequence[str],
                     partitions: int | None = None) -> DataFrame:
    """Tab-separated, header, all strings (the open-data tables).

    A gzip file is not splittable and arrives as one partition; pass
    ``partitions`` to spread the rows right after the read.
    """
    df = (spark.read.option("sep", "\t").option("header", True).option("quote", '"')
          .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    return df.repartition(partitions) if partitions else df


def read_labelled_text(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """One row per file: ``(category, text, path)``; the category is the
    name of the file's parent folder."""
    df = spark.read.text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return df.select(F.element_at(F.split(path, "/"), -2).alias("category"),
                     F.col("value").alias("text"), path.alias("path"))


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_tagged(spark: SparkSession, inputs: Mapping[str, str], **csv_options) -> DataFrame:
    """Several inputs in one frame, told apart by a ``source`` column (the
    reference branched on the mapper's input file name)."""
    out = None
    for tag, path in inputs.items():
        df = spark.read.options(**csv_options).csv(path).withColumn("source", F.lit(tag))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_lookup(spark: SparkSession, path: str, key: str = "zip",
                value: str = "borough") -> DataFrame:
    """Small header-less ``key,value`` map, values normalised: ``Staten``
    becomes ``STATEN ISLAND``, everything else upper case."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.StringType())])
    df = spark.read.option("header", False).schema(schema).csv(path)
    v = F.col(value)
    return df.select(key, F.when(v == "Staten", F.lit("STATEN ISLAND")).otherwise(F.upper(v)).alias(value))


def read_manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path size`` per line, blank-separated.  Adds ``dataset_name`` (file
    name) and ``valid``: a path must be absolute (``/...``, also behind a scheme as
    in ``hdfs:/...``) and the size must be a number (the reference's list has a path with an id glued in front)."""
    raw = spark.read.text(path)
    parts = F.split(F.trim("value"), r"\s+")
    df = raw.select(F.element_at(parts, 1).alias("path"),
                    F.element_at(parts, 2).try_cast("long").alias("size"))
    return df.select(
        "path", "size",
        F.element_at(F.split("path", "/"), -1).alias("dataset_name"),
        (F.col("path").rlike(r"^([A-Za-z][\w+.-]*:)?/") & F.col("size").isNotNull()).alias("valid"))


def melt_datasets(spark: SparkSession, paths: Mapping[str, str], partitions: int | None = None,
                  ) -> tuple[DataFrame | None, DataFrame]:
    """Cells of many TSV datasets as ONE frame (one profiling job for all).

    Headers are read per dataset when the plan is built (first line only);
    a dataset whose header cannot be read goes to the quarantine frame
    ``(dataset_name, reason)`` instead of failing the run.  The frames are
    lazy: one that breaks after its header fails the job that reads them, unless
    it runs in ``isolation.contained``.
    """
    frames, bad = read_many(spark, paths, partitions)
    parts = [melt_cells(df, name, [c for c in df.columns if c != "_corrupt_record"])
             for name, df in frames.items()]
    quarantine = spark.createDataFrame(bad, "dataset_name string, reason string")
    return union_all(parts), quarantine


def read_many(spark: SparkSession, paths: Mapping[str, str], partitions: int | None = None,
              threads: int = 16) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """``{name: DataFrame}`` for many TSV datasets plus ``[(name, reason)]``
    for those whose header cannot be read.  Reading a header is a small job
    per file; a few threads submit them concurrently (plan building only)."""
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        name, path = item
        try:
            return name, read_tsv_strings(spark, path, partitions), None
        except Exception as e:  # noqa: BLE001 - per-dataset isolation
            return name, None, f"{type(e).__name__}: {str(e)[:200]}"

    frames, bad = {}, []
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for name, df, err in pool.map(one, list(paths.items())):
            if err is None:
                frames[name] = df
            else:
                bad.append((name, err))
    return frames, bad


def union_all(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union many frames as a balanced tree: analysis stays O(n log n) for
    thousands of datasets (a left-deep chain re-analyses the growing plan
    at every step); Catalyst flattens the unions afterwards."""
    frames = list(frames)
    if not frames:
        return None
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """The target list ``['<dataset>.<column>.txt.gz', ...]`` as distinct
    ``(dataset_name, column_name)`` rows."""
    raw = spark.read.text(path, wholetext=True)
    items = raw.select(F.explode(F.split(F.regexp_replace("value", r"^\s*\[|\]\s*$", ""),
                                         r",\s*")).alias("item"))
    names = items.select(F.regexp_replace(F.trim("item"), "^'|'$", "").alias("item"))
    parts = F.split("item", r"\.")
    return (names.filter(F.col("item") != "")
            .select(F.element_at(parts, 1).alias("dataset_name"),
                    F.element_at(parts, 2).alias("column_name"))
            .dropDuplicates())


def read_documents(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | str | None = None) -> DataFrame:
    """JSON result documents (one per file, multi-line)."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema is not None else r).json(path)


def read_label_table(spark: SparkSession, path: str, dataset_col: str = "Dataset",
                     label_col: str = "Label") -> DataFrame:
    """Ground-truth labels ``'<id>.<column>.txt.gz' → label`` as
    ``(label, dataset_name, column_name)``."""
    df = read_csv(spark, path)
    ds = F.regexp_replace(F.trim(F.col(dataset_col)), "^'+|'+$", "")
    parts = F.split(ds, r"\.")
    return df.select(F.col(label_col).alias("label"),
                     F.element_at(parts, 1).alias("dataset_name"),
                     F.element_at(parts, 2).alias("column_name")).distinct()
