"""The reference's top-level runs as library calls, each ONE Spark job
instead of a driver loop that starts jobs per dataset.

* :func:`profile_manifest` — profile every dataset listed in a manifest.
* :func:`label_target_columns` — semantic labels for a list of
  ``<dataset>.<column>`` targets, resolving each given name to the closest
  header of its dataset.

A dataset that breaks, at its header or later, goes to the quarantine and takes
no other with it (``sources.isolation``).  Only metadata passes through the
driver: the manifest's paths (to build one read per dataset) and each dataset's
header row.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.operators import profile as prof
from civiclens.operators import semantic as sem
from civiclens.sources import isolation, readers


def profile_manifest(spark: SparkSession, manifest_path: str, partitions: int | None = None,
                     k: int = 5) -> tuple[DataFrame | None, DataFrame]:
    """``(documents, quarantine)``: one profile document per readable dataset.

    The quarantine ``(dataset_name, reason, record, num)`` lists malformed
    manifest lines, datasets whose header or whose rows cannot be read (these
    take no others with them), and every record that has more cells than its
    header, with the number of times it stands there.  Such records are left
    out of the profile.  Documents are None if no dataset can be read.
    """
    manifest = readers.read_manifest(spark, manifest_path)
    bad_lines = (manifest.filter(~F.col("valid"))
                 .select(F.coalesce("dataset_name", "path").alias("dataset_name"),
                         F.lit("malformed manifest line").alias("reason")))
    # Datasets of one base name are told apart by their whole path.
    rows = manifest.filter(F.col("valid")).select("dataset_name", "path").distinct().collect()
    seen = Counter(r.dataset_name for r in rows)
    paths = {r.dataset_name if seen[r.dataset_name] == 1 else r.path: r.path for r in rows}
    headers, unreadable = readers.read_many(spark, paths)
    records = {name: isolation.read_tsv_records(spark, paths[name], df.columns, partitions)
               for name, df in headers.items()}

    def frequencies(frames):
        cells = readers.union_all([isolation.melt_rows(df, name) for name, df in frames.items()])
        return prof.value_frequencies(cells)

    freq, broken = isolation.contained(records, frequencies)
    whole = spark.createDataFrame(unreadable + broken, "dataset_name string, reason string").union(bad_lines)
    quarantine = whole.select("dataset_name", "reason", F.lit(None).cast("string").alias("record"),
                              F.lit(None).cast("long").alias("num"))
    if freq is None:
        return None, quarantine
    too_long = freq.filter(F.col("column_name").isNull()).select(
        "dataset_name", F.lit("more cells than columns").alias("reason"),
        F.col("value").alias("record"), F.col("freq").alias("num"))
    return (prof.profile_documents(freq.filter(F.col("column_name").isNotNull()), k, counted=True),
            quarantine.union(too_long))


def label_target_columns(spark: SparkSession, targets_path: str, data_root: str,
                         suffix: str = ".tsv.gz", partitions: int | None = None,
                         ) -> tuple[DataFrame, DataFrame]:
    """``(labels, quarantine)``: label counts for the target list (duplicates
    removed), one job, and the targets' datasets whose header or rows cannot be
    read ``(dataset_name, reason)``.  Records with more cells than their header
    are left out, as in :func:`profile_manifest`.

    Each dataset ``<data_root>/<dataset><suffix>`` is read once; the given
    column name is resolved to the closest header (insert/delete distance).
    """
    targets = readers.read_targets(spark, targets_path).withColumnRenamed("column_name", "given_name")
    names = [r.dataset_name for r in targets.select("dataset_name").distinct().collect()]
    paths = {n: f"{data_root.rstrip('/')}/{n}{suffix}" for n in names}
    headers, unreadable = readers.read_many(spark, paths)
    rows = {n: isolation.good_rows(isolation.read_tsv_records(spark, paths[n], df.columns, partitions))
            for n, df in headers.items()}
    labels, broken = isolation.contained(rows, lambda frames: sem.label_target_frames(spark, frames, targets))
    if labels is None:
        labels = spark.createDataFrame([], sem.LABEL_COUNTS)
    return labels, spark.createDataFrame(unreadable + broken, "dataset_name string, reason string")
