"""Plan-shaping helpers shared by the operators.

* ``sized_broadcast`` — broadcast a side only after proving it is small;
  beyond the bound the ordinary shuffle join stays (and AQE may still
  switch to broadcast at run time from real stage sizes).
* ``global_ntile`` / ``global_rank`` — exact ranks over a total order
  without a one-partition window and without a checkpoint: ranges between
  splitters from a sample by hash, ranks within a range, offsets from a table
  with one row per range.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.session import ensure_checkpoint_dir

# A lookup side with at most this many rows is broadcast.  Dimension
# tables of the reference (zip map, frequent items, per-column means) are
# far below it.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Runs a bounded job: ``limit(max_rows + 1)`` stops early on large
    inputs, so the check costs at most ``max_rows + 1`` rows of work.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is proven small, in rows and in bytes of
    its text form, else ``df`` unchanged.  One bounded job, as in
    :func:`has_at_most`."""
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return F.broadcast(df) if seen.n <= max_rows and (seen.b or 0) <= max_bytes else df


def task_count(df: DataFrame) -> int:
    """How many tasks a spread of rows gets: the session's shuffle partitions,
    which follow the data, and at least one per core."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread_input(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over at least ``min_partitions`` tasks (default: the
    cluster's parallelism) when the input has fewer partitions — e.g. a
    gzip file or a single row group — before CPU-heavy per-row work.  On a
    cluster scan with thousands of splits this returns ``df`` unchanged."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def materialize(df: DataFrame, how: str | None = "checkpoint") -> DataFrame:
    """Compute ``df`` once for several consumers.

    ``"checkpoint"`` writes it to the cluster's checkpoint folder (survives
    executor loss, cuts the lineage); ``"persist"`` caches it (recomputed
    from lineage if an executor is lost); ``None`` leaves it lazy.
    """
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


# Rows sampled per range of a global rank.
SAMPLE_PER_RANGE = 64


def _key(df: DataFrame, order: list[Column | str]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])


def range_splitters(keys: DataFrame, n_ranges: int) -> Column:
    """A literal: the sorted array of ``n_ranges - 1`` keys (column ``k``, a struct)
    or fewer that cut the keys into ranges of about equal size.

    They come from a sample by hash (so many keys whatever the input's size),
    which depends on the keys only: any plan, partitioning or retried task finds
    the same splitters.  As text they may lose digits of a second; any cut is
    right as long as all rows see the same.
    """
    total = keys.count()
    share = min(1.0, n_ranges * SAMPLE_PER_RANGE / max(total, 1))
    cut = F.lit(int(share * (1 << 62))).cast("long")
    drawn = F.shiftright(F.xxhash64("k"), 1).bitwiseAND((1 << 62) - 1) <= cut
    sample = keys.filter(drawn).distinct().agg(F.array_sort(F.collect_list("k")).alias("s"))
    n = F.size("s")
    places = F.sequence(F.lit(1), F.lit(max(n_ranges - 1, 1)))
    cuts = F.transform(places, lambda i: F.get("s", F.floor(i * n / n_ranges).cast("int")))
    found = sample.select(F.when(n > 0, F.array_distinct(cuts)).alias("splitters"))
    text = found.select(F.to_json("splitters")).first()[0]
    return F.from_json(F.lit(text or "[]"), found.schema["splitters"].dataType)


def _steps(n_ranges: int) -> list[int]:
    """The strides of a binary search among fewer than ``n_ranges`` splitters."""
    return [1 << b for b in reversed(range(n_ranges.bit_length()))]


def _step(found: Column, stride: Column, key: Column, splitters: Column) -> Column:
    """``found`` splitters are at most ``key``: so many more if one ``stride`` on is.
    Beyond the last splitter there is NULL, which is no larger number."""
    return found + F.when(F.get(splitters, found + stride - 1) <= key, stride).otherwise(F.lit(0))


def range_of(key: Column, splitters: Column, n_ranges: int) -> Column:
    """How many splitters are at most ``key``, by binary search."""
    strides = F.array(*[F.lit(s) for s in _steps(n_ranges)])
    return F.aggregate(strides, F.lit(0), lambda found, stride: _step(found, stride, key, splitters))


def with_range(df: DataFrame, key: Column, splitters: Column, n_ranges: int, out_col: str) -> DataFrame:
    """``df`` with :func:`range_of` as a column.  Each stride is a projection of its
    own, which Spark compiles; a lambda function is interpreted row by row."""
    out = df.withColumn(out_col, F.lit(0))
    for stride in _steps(n_ranges):
        out = out.withColumn(out_col, _step(F.col(out_col), F.lit(stride), key, splitters))
    return out


def global_rank(df: DataFrame, order: list[Column | str], out_col: str = "rank0",
                partitions: int | None = None) -> DataFrame:
    """Add a 0-based rank following ``order`` (columns, ascending, NULLs first,
    which must be a total order) and the number of rows, ``_total``.

    Rows are dealt to ranges by splitters that depend on the data alone, ranked
    within their range, and moved by the number of rows in the ranges before:
    nothing is written down, and a recomputed task gives the same ranks.  Only
    the table of range sizes (one row per range) is broadcast.
    """
    n = partitions or task_count(df)
    key = _key(df, order)
    splitters = range_splitters(df.select(key.alias("k")), n)
    ranged = with_range(df, key, splitters, n, "_range")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: a window without partitionBy is bounded here.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return (ranged.withColumn("_local", local).join(F.broadcast(offsets), "_range")
                  .withColumn(out_col, F.col("_offset") + F.col("_local"))
                  .drop("_range", "_local", "_offset"))


def global_ntile(df: DataFrame, n: int, order: list[Column | str],
                 out_col: str = "ntile") -> DataFrame:
    """SQL ``ntile(n) OVER (ORDER BY order)`` without a single-task window.

    Buckets are numbered 1..n; the first ``total % n`` buckets hold one
    row more than the others, as in the SQL standard.
    """
    ranked = global_rank(df, order, "_r")
    total = F.col("_total")
    q = F.floor(total / n).cast("long")
    r = total - q * n
    big = r * (q + 1)
    tile = (F.when(q == 0, F.col("_r") + 1)
             .when(F.col("_r") < big, F.floor(F.col("_r") / (q + 1)) + 1)
             .otherwise(r + F.floor((F.col("_r") - big) / q) + 1))
    return ranked.withColumn(out_col, tile.cast("int")).drop("_r", "_total")
