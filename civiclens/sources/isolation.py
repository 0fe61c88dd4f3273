"""Containment of broken rows and broken datasets (K5).

* Row level: a record with more cells than its header is kept apart instead of
  losing cells.  :func:`melt_rows` gives it as one cell with a NULL column name
  that holds the whole record, so good cells and quarantined records come from
  the same scan.  Records with fewer cells stay, with NULL cells.
* Dataset level: :func:`contained` computes one job over many datasets.  If it
  fails, every dataset is read to its end in a job of its own (a failing job
  ends no other), those that cannot be read go to the quarantine with their
  reason, and the one job runs again over the others.  A run without broken
  datasets costs nothing extra.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens.operators._plan import materialize

RECORD = "_corrupt_record"


def _record_column(columns: list[str]) -> str:
    """A name for the raw record that no header has (names are compared
    without case)."""
    taken, name = {c.lower() for c in columns}, RECORD
    while name in taken:
        name += "_"
    return name


def read_tsv_records(spark: SparkSession, path: str, header: list[str],
                     partitions: int | None = None) -> DataFrame:
    """A TSV file with the given header, all strings, and the raw record of
    every row that has another number of cells (the last column)."""
    record = _record_column(header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, record]])
    df = (spark.read.schema(schema).option("sep", "\t").option("header", True)
          .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", record).csv(path))
    return df.repartition(partitions) if partitions else df


def too_long(record: Column, n_columns: int, sep: str = "\t") -> Column:
    """Whether a raw record has more than ``n_columns`` cells: separators
    outside of quoted cells are counted."""
    quoted = rf'(^|{sep})"(?:[^"]|"")*"'
    bare = F.regexp_replace(record, quoted, "$1")
    n_seps = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))
    return F.coalesce(n_seps >= n_columns, F.lit(False))


def good_rows(records: DataFrame) -> DataFrame:
    """Rows of :func:`read_tsv_records` without the records that are too long."""
    *columns, record = records.columns
    return records.filter(~too_long(F.col(f"`{record}`"), len(columns))).select(
        *[F.col(f"`{c}`") for c in columns])


def melt_rows(records: DataFrame, dataset_name: str) -> DataFrame:
    """``(dataset_name, column_name, value)``: the cells of good rows, and a
    record that is too long as one cell without a column name."""
    *columns, record = records.columns
    quoted = [F.col(f"`{c}`") for c in records.columns]
    marked = records.select(*quoted, too_long(quoted[-1], len(columns)).alias("_too_long"))
    cells = marked.unpivot(["_too_long"], quoted, "_name", "value")
    is_record = F.col("_name") == record
    return (cells.filter(is_record == F.col("_too_long"))
                 .select(F.lit(dataset_name).alias("dataset_name"),
                         F.when(~is_record, F.col("_name")).alias("column_name"), "value"))


def reason_of(error: Exception) -> str:
    """The innermost cause of a failed job, on one line."""
    causes = re.findall(r"Caused by: ([\w.$]+(?:: [^\n]*)?)", str(error))
    text = causes[-1] if causes else f"{type(error).__name__}: {error}"
    return text.split("\n")[0][:200]


def unreadable(frames: Mapping[str, DataFrame], threads: int = 16) -> list[tuple[str, str]]:
    """``[(name, reason)]`` of the frames that cannot be read to their end.
    One job each, run side by side."""
    def probe(item):
        name, df = item
        try:
            df.write.format("noop").mode("overwrite").save()
            return None
        except Exception as e:  # noqa: BLE001 - the reason is the result
            return name, reason_of(e)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return [bad for bad in pool.map(probe, frames.items()) if bad]


def contained(frames: Mapping[str, DataFrame], build: Callable[[dict[str, DataFrame]], DataFrame],
              threads: int = 16) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """``(build(readable frames), computed; [(name, reason)] of the others)``.

    The result is written to the checkpoint folder, so it is computed once and
    outlives lost executors.  A failure that is no dataset's (nothing that a
    probe finds) is raised.
    """
    left, quarantine = dict(frames), []
    while left:
        try:
            return materialize(build(left)), quarantine
        except Exception:  # noqa: BLE001 - told apart by the probes
            broken = unreadable(left, threads)
            if not broken:
                raise
            quarantine += broken
            left = {n: df for n, df in left.items() if n not in dict(broken)}
    return None, quarantine
