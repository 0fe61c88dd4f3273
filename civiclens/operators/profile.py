"""Generic column profiling of string tables (many datasets in one job).

Plan: melt every dataset to cells ``(dataset_name, column_name, value)``,
then ONE heavy shuffle — ``groupBy(dataset, column, value).count()`` with
map-side partial counts — gives the value-frequency table.  Every statistic
is a weighted aggregate over that table, so types are inferred once per
distinct value, not per cell, and nothing re-reads the input.

Skew: a hot value is one row of the frequency table after the partial
aggregation; a column with very many distinct values is spread over the
``(dataset, column, value)`` hash partitions for every aggregate, and its
top-k window ships at most k rows per map task (``WindowGroupLimit``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions import celltypes as ct

KEY = ["dataset_name", "column_name"]


def melt_cells(df: DataFrame, dataset_name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per cell: ``(dataset_name, column_name, value STRING)``.

    Columns keep their identity even when headers repeat (Spark's reader
    renames duplicates), and short rows give NULL cells.
    """
    cols = list(columns or df.columns)
    as_text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    melted = as_text.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "value")
    return melted.select(F.lit(dataset_name).alias("dataset_name"), "column_name", "value")


def value_frequencies(cells: DataFrame) -> DataFrame:
    """``(dataset_name, column_name, value, freq)``; NULL counts as ``''``
    (otherwise NULL and '' would be two distinct values)."""
    return (cells.select(*KEY, F.coalesce(F.col("value"), F.lit("")).alias("value"))
                 .groupBy(*KEY, "value").agg(F.count(F.lit(1)).alias("freq")))


def typed_frequencies(freq: DataFrame, formats: Sequence[str] | None = ct.DATE_FORMATS,
                      date_by_name: bool = False) -> DataFrame:
    """Adds the cell type and the parsed forms of every distinct value.
    ``date_by_name=True`` applies a draft rule of the reference: all
    non-empty cells of columns named like dates (date, year, ...) are dates."""
    v = F.col("value")
    flags = freq.select(
        "*",
        ct.is_empty(v).alias("_empty"),
        v.rlike(ct.INT_PATTERN).alias("_int"),
        v.rlike(ct.REAL_PATTERN).alias("_real"))
    # each value is parsed as a date at most once, and only when it is not
    # empty, int or real
    parsed = flags.withColumn(
        "ts", F.when(~(F.col("_empty") | F.col("_int") | F.col("_real")), ct.date_value(v, formats)))
    kind = (F.when(F.col("_empty"), F.lit(ct.EMPTY))
             .when(ct.name_like_date(F.col("column_name")) if date_by_name else F.lit(False),
                   F.lit(ct.DATE))
             .when(F.col("_int"), F.lit(ct.INT)).when(F.col("_real"), F.lit(ct.REAL))
             .when(F.col("ts").isNotNull(), F.lit(ct.DATE))
             .otherwise(F.lit(ct.TEXT)))
    return parsed.select(
        *freq.columns, kind.alias("cell_type"),
        ct.int_value(v).alias("int_value"),
        ct.int_as_double(v).alias("int_double"),
        ct.real_value(v).alias("real_value"),
        "ts", F.length(v).alias("len"))


def cell_table(cells: DataFrame, formats: Sequence[str] | None = ct.DATE_FORMATS) -> DataFrame:
    """Every cell with its type (no aggregation)."""
    return cells.withColumn("cell_type", ct.cell_type(F.col("value"), formats))


def column_counts(freq: DataFrame) -> DataFrame:
    """Non-empty, empty and total cells and distinct values per column
    (``''`` is a distinct value, as in the reference)."""
    empty = ct.is_empty(F.col("value"))
    return freq.groupBy(*KEY).agg(
        F.sum(F.when(~empty, F.col("freq")).otherwise(0)).cast("long").alias("number_non_empty_cells"),
        F.sum(F.when(empty, F.col("freq")).otherwise(0)).cast("long").alias("number_empty_cells"),
        F.sum("freq").cast("long").alias("number_cells"),
        F.count(F.lit(1)).alias("number_distinct_values"))


def frequent_values(freq: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent values per column; ties by value ascending."""
    w = Window.partitionBy(*KEY).orderBy(F.col("freq").desc(), F.col("value").asc())
    return (freq.withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= k))


def column_stats(typed: DataFrame) -> DataFrame:
    """Every per-column statistic in ONE aggregation over the typed
    frequency table (conditional aggregates per type).  Only the deviation
    needs a second pass (:func:`_deviations`)."""
    f, v, t = F.col("freq"), F.col("value"), F.col("cell_type")
    empty = ct.is_empty(v)

    def on(type_name, e):
        return F.when(t == type_name, e)

    aggs = [
        F.sum(F.when(~empty, f).otherwise(0)).cast("long").alias("number_non_empty_cells"),
        F.sum(F.when(empty, f).otherwise(0)).cast("long").alias("number_empty_cells"),
        F.sum(f).cast("long").alias("number_cells"),
        F.count(F.lit(1)).alias("number_distinct_values"),
    ]
    for name, val in ((ct.INT, F.col("int_double")), (ct.REAL, F.col("real_value"))):
        aggs += [
            F.sum(on(name, f)).cast("long").alias(f"{name}_count"),
            F.max(on(name, val)).alias(f"{name}_max"),
            F.min(on(name, val)).alias(f"{name}_min"),
            F.sum(on(name, val * f)).alias(f"{name}_sum"),
        ]
    # Integers have any length: the larger magnitude has more digits or, of
    # equally many, the later ones.
    negative, digits = ct.int_digits(v)
    size = F.struct(F.length(digits).alias("n"), digits.alias("digits"))
    below, above = (t == ct.INT) & negative, (t == ct.INT) & ~negative
    aggs += [
        F.max(F.when(above, size)).alias("_above_max"), F.min(F.when(above, size)).alias("_above_min"),
        F.max(F.when(below, size)).alias("_below_max"), F.min(F.when(below, size)).alias("_below_min"),
    ]
    aggs += [
        F.sum(on(ct.TEXT, f)).cast("long").alias("text_count"),
        F.min_by(on(ct.TEXT, v), on(ct.TEXT, F.struct("len", "value"))).alias("shortest_value"),
        F.min_by(on(ct.TEXT, v), on(ct.TEXT, F.struct((-F.col("len")).alias("nlen"), "value")))
         .alias("longest_value"),
        F.sum(on(ct.TEXT, F.col("len") * f)).alias("text_len_sum"),
        F.sum(on(ct.DATE, f)).cast("long").alias("date_count"),
        F.max_by(on(ct.DATE, v), on(ct.DATE, F.struct("ts", "value"))).alias("date_max"),
        F.min_by(on(ct.DATE, v), on(ct.DATE, F.struct("ts", "value"))).alias("date_min"),
    ]
    stats = typed.groupBy(*KEY).agg(*aggs)
    return (stats
            .withColumn("int_mean", F.col("int_sum") / F.col("int_count"))
            .withColumn("real_mean", F.col("real_sum") / F.col("real_count"))
            .withColumn("int_max_text", F.coalesce("_above_max.digits",
                                                   F.concat(F.lit("-"), "_below_min.digits")))
            .withColumn("int_min_text", F.coalesce(F.concat(F.lit("-"), "_below_max.digits"),
                                                   "_above_min.digits"))
            .drop("_above_max", "_above_min", "_below_max", "_below_min"))


def _deviations(typed: DataFrame, stats: DataFrame) -> DataFrame:
    """Second pass: ``sum(freq * (x - mean)^2)`` per column for int and real
    cells (``int_ss``, ``real_ss``).

    The means table has one row per profiled column (bounded by the
    catalogue's width, not by the data), so it is broadcast.  There is no
    filter and the join keeps every typed row (left join): a filter on the
    type or the not-null filters of an inner join would be pushed below the
    value-frequency aggregation, which then could not share its shuffle
    with the first pass.
    """
    means = F.broadcast(stats.select(*KEY, "int_mean", "real_mean"))
    t, f = F.col("cell_type"), F.col("freq")
    dx_int = F.col("int_double") - F.col("int_mean")
    dx_real = F.col("real_value") - F.col("real_mean")
    return (typed.join(means, KEY, "left")
                 .groupBy(*KEY)
                 .agg(F.sum(F.when(t == ct.INT, f * dx_int * dx_int)).alias("int_ss"),
                      F.sum(F.when(t == ct.REAL, f * dx_real * dx_real)).alias("real_ss")))


def _numeric_rows(stats: DataFrame, dev: DataFrame) -> DataFrame:
    """One row per (column, int|real) present."""
    def block(name):
        n, ss = F.col(f"{name}_count"), F.col(f"{name}_ss")
        return F.struct(
            F.lit(name).alias("cell_type"), n.alias("count"),
            F.col(f"{name}_max").cast("double").alias("max_value"),
            F.col(f"{name}_min").cast("double").alias("min_value"),
            (F.col("int_max_text") if name == ct.INT else F.lit(None).cast("string")).alias("max_int"),
            (F.col("int_min_text") if name == ct.INT else F.lit(None).cast("string")).alias("min_int"),
            F.col(f"{name}_mean").alias("mean"),
            F.sqrt(ss / n).alias("stddev"),
            F.sqrt(ss).alias("root_sum_sq_dev"))
    both = stats.join(dev, KEY, "left")
    return (both.select(*KEY, F.explode(F.array(block(ct.INT), block(ct.REAL))).alias("b"))
                .filter(F.col("b.count") > 0)
                .select(*KEY, "b.*"))


def numeric_stats(typed: DataFrame) -> DataFrame:
    """Per (column, int|real): count, max, min, mean, population standard
    deviation and the reference's undivided ``sqrt(sum((x - mean)^2))``;
    ``max_int`` and ``min_int`` are the exact integers as text.
    The deviation is a second pass against the means, not
    ``sum(x^2) - n*mean^2``, which cancels badly."""
    stats = column_stats(typed)
    return _numeric_rows(stats, _deviations(typed, stats))


def text_stats(typed: DataFrame) -> DataFrame:
    """Per text column: count, shortest and longest value (ties: smallest
    value), average length."""
    return (column_stats(typed).filter(F.col("text_count") > 0)
            .select(*KEY, F.col("text_count").alias("count"), "shortest_value", "longest_value",
                    (F.col("text_len_sum") / F.col("text_count")).alias("average_length")))


def date_stats(typed: DataFrame) -> DataFrame:
    """Per date column: count, latest and earliest cell by parsed instant;
    the original text is returned (ties: by text)."""
    return (column_stats(typed).filter(F.col("date_count") > 0)
            .select(*KEY, F.col("date_count").alias("count"),
                    F.col("date_max").alias("max_value"), F.col("date_min").alias("min_value")))


_BLOCK_FIELDS = ("type", "count", "max_value", "min_value", "mean", "stddev", "root_sum_sq_dev",
                 "shortest_values", "longest_values", "average_length")


def _block(**given) -> Column:
    types = {"type": "string", "count": "long", "max_value": "string", "min_value": "string",
             "mean": "double", "stddev": "double", "root_sum_sq_dev": "double",
             "shortest_values": "string", "longest_values": "string", "average_length": "double"}
    return F.struct(*[(given[k] if k in given else F.lit(None)).cast(types[k]).alias(k)
                      for k in _BLOCK_FIELDS])


def column_profiles(cells: DataFrame, k: int = 5,
                    formats: Sequence[str] | None = ct.DATE_FORMATS, date_by_name: bool = False,
                    counted: bool = False) -> DataFrame:
    """One row per (dataset, column) with counts, top-k values and type
    blocks.  ``counted``: ``cells`` are :func:`value_frequencies` rows.  Columns that are entirely empty are kept with no type block
    (the reference dropped them through an inner join).

    The typed frequency table is read by two aggregations only; type blocks
    are assembled from the one row of statistics per column.
    """
    freq = cells if counted else value_frequencies(cells)
    typed = typed_frequencies(freq, formats, date_by_name)
    stats = column_stats(typed)
    dev = _deviations(typed, stats)
    top = (frequent_values(freq, k)
           .groupBy(*KEY)
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))),
                            lambda x: x["value"]).alias("frequent_values")))

    def num_block(name, label):
        n, ss = F.col(f"{name}_count"), F.col(f"{name}_ss")
        ends = "_text" if name == ct.INT else ""
        return F.when(n > 0, _block(
            type=F.lit(label), count=n,
            max_value=F.col(f"{name}_max{ends}").cast("string"),
            min_value=F.col(f"{name}_min{ends}").cast("string"),
            mean=F.col(f"{name}_mean"), stddev=F.sqrt(ss / n), root_sum_sq_dev=F.sqrt(ss)))

    blocks = F.array(
        num_block(ct.INT, ct.TYPE_LABELS[ct.INT]),
        num_block(ct.REAL, ct.TYPE_LABELS[ct.REAL]),
        F.when(F.col("text_count") > 0, _block(
            type=F.lit(ct.TYPE_LABELS[ct.TEXT]), count=F.col("text_count"),
            shortest_values=F.col("shortest_value"), longest_values=F.col("longest_value"),
            average_length=F.col("text_len_sum") / F.col("text_count"))),
        F.when(F.col("date_count") > 0, _block(
            type=F.lit(ct.TYPE_LABELS[ct.DATE]), count=F.col("date_count"),
            max_value=F.col("date_max"), min_value=F.col("date_min"))))
    return (stats.join(dev, KEY, "left").join(top, KEY, "left")
                 .select(*KEY, "number_non_empty_cells", "number_empty_cells", "number_cells",
                         "number_distinct_values", "frequent_values",
                         F.array_sort(F.filter(blocks, lambda b: b.isNotNull())).alias("data_types")))


def profile_documents(cells: DataFrame, k: int = 5,
                      formats: Sequence[str] | None = ct.DATE_FORMATS, counted: bool = False) -> DataFrame:
    """One nested document per dataset, the reference's JSON layout:
    ``dataset_name, key_column_candidates, unique_columns, columns[...]``.

    ``key_column_candidates`` is every header, as in the reference;
    ``unique_columns`` adds the columns that really are keys (all values
    distinct, none empty).
    """
    cols = column_profiles(cells, k, formats, counted=counted)
    unique = ((F.col("number_distinct_values") == F.col("number_cells"))
              & (F.col("number_empty_cells") == 0))
    col_struct = F.struct(
        "column_name", "number_non_empty_cells", "number_empty_cells",
        "number_distinct_values", "frequent_values", "data_types")
    return cols.groupBy("dataset_name").agg(
        F.array_sort(F.collect_list("column_name")).alias("key_column_candidates"),
        F.array_sort(F.collect_list(F.when(unique, F.col("column_name")))).alias("unique_columns"),
        F.array_sort(F.collect_list(col_struct)).alias("columns"))


def type_counts(cells: DataFrame, formats: Sequence[str] | None = ct.DATE_FORMATS) -> DataFrame:
    """``(dataset_name, column_name, cell_type, num)``: all that the summary
    and the totals need of a profile."""
    typed = typed_frequencies(value_frequencies(cells), formats)
    return (typed.groupBy(*KEY, "cell_type")
                 .agg(F.sum("freq").cast("long").alias("num")))


def profile_summary(counts: DataFrame) -> DataFrame:
    """Per column: emptiness ratio (the reference calls it sparsity),
    cleanliness ``max(type count) / sum(type count)`` (1 for ≤ 1 type) and
    the number of types.  Input: :func:`type_counts` rows."""
    num, filled = F.col("num"), F.col("cell_type") != ct.EMPTY
    per = counts.groupBy(*KEY).agg(
        F.sum("num").alias("_all"), F.sum(F.when(filled, num)).alias("_filled"),
        F.max(F.when(filled, num)).alias("_top"), F.count(F.when(filled, num)).alias("n_types"))
    return per.select(
        *KEY,
        ((F.col("_all") - F.coalesce("_filled", F.lit(0))) / F.col("_all")).alias("sparsity"),
        F.when(F.col("n_types") <= 1, F.lit(1.0)).otherwise(F.col("_top") / F.col("_filled"))
         .alias("cleanliness"),
        "n_types")


def type_totals(counts: DataFrame) -> DataFrame:
    """Total cells per data type over all profiled columns; input:
    :func:`type_counts` rows."""
    label = F.create_map(*[F.lit(x) for pair in ct.TYPE_LABELS.items() for x in pair])
    return (counts.filter(F.col("cell_type") != ct.EMPTY)
                  .groupBy(label[F.col("cell_type")].alias("data_type"))
                  .agg(F.sum("num").cast("long").alias("num")))
