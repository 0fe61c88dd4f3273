"""Semantic typing of columns and its precision/recall scoring.

Labels are Catalyst expressions over the melted cells, so one job labels
any number of columns of any number of datasets; counting is an
aggregation with map-side partial counts (a hot label is no hot task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions.validators import (Rule, column_label, label_by_rule, rule_index,
                                            semantic_label)
from civiclens.operators._plan import sized_broadcast
from civiclens.operators.profile import melt_cells
from civiclens.operators.resolve import resolve_names

KEY = ["dataset_name", "column_name"]


def label_cells(cells: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Adds ``semantic_type`` to ``(dataset_name, column_name, value)`` cells."""
    return cells.withColumn("semantic_type",
                            semantic_label(F.col("column_name"), F.col("value"), rules))


def label_counts(cells: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """``(dataset_name, column_name, semantic_type, label, count)``; the
    reference writes the type twice (as type and as label)."""
    return count_labels(label_cells(cells, rules))


def label_wide(df: DataFrame, dataset_name: str, columns: Sequence[str] | None = None,
               rules: Sequence[Rule] | None = None) -> DataFrame:
    """Labels of a wide table, one per cell: ``(dataset_name, column_name,
    semantic_type)``.  The column name is a literal here, so Catalyst folds
    the rule choice and each column keeps only its own validator — the
    rule is chosen once per column, at plan time."""
    cols = list(columns or df.columns)
    labels = df.select(*[column_label(c, F.col(f"`{c}`").cast("string"), rules).alias(c)
                         for c in cols])
    return melt_cells(labels, dataset_name, cols).withColumnRenamed("value", "semantic_type")


def count_labels(labelled: DataFrame) -> DataFrame:
    """Counts per (dataset, column, semantic type) of labelled cells."""
    return (labelled.groupBy(*KEY, "semantic_type")
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("label", F.col("semantic_type")))


def semantic_labels(df: DataFrame, dataset_name: str, columns: Sequence[str] | None = None,
                    rules: Sequence[Rule] | None = None) -> DataFrame:
    """Label counts for columns of one wide table."""
    return count_labels(label_wide(df, dataset_name, columns, rules))


def semantic_documents(counts: DataFrame, qualify_columns: bool = False) -> DataFrame:
    """One nested document per dataset:
    ``dataset_name, columns[{column_name, semantic_types[{semantic_type, label, count}]}]``.
    ``qualify_columns=True`` names columns ``<dataset>_<column>``, as the
    merged result documents did."""
    if qualify_columns:
        counts = counts.withColumn("column_name",
                                   F.concat_ws("_", F.col("dataset_name"), F.col("column_name")))
    per_col = (counts.groupBy(*KEY)
               .agg(F.array_sort(F.collect_list(
                   F.struct("semantic_type", "label", "count"))).alias("semantic_types")))
    return (per_col.groupBy("dataset_name")
                   .agg(F.array_sort(F.collect_list(
                       F.struct("column_name", "semantic_types"))).alias("columns")))


def predicted_columns(counts: DataFrame) -> DataFrame:
    """``(label, dataset_name, column_name)``: a column counts as predicted
    for a label when at least one of its cells received it."""
    return counts.select(F.col("semantic_type").alias("label"), *KEY).distinct()


def score_labels(pred: DataFrame, truth: DataFrame, item: Sequence[str] = KEY) -> DataFrame:
    """Precision and recall per label of ``truth``.

    ``pred`` and ``truth`` hold ``(label, *item)``.  Precision is NULL for a
    label that was never predicted (the reference raised KeyError).
    """
    keys = ["label", *item]
    p = pred.select(*keys).distinct()
    t = truth.select(*keys).distinct()
    n_true = t.groupBy("label").agg(F.count(F.lit(1)).alias("n_true"))
    n_pred = p.groupBy("label").agg(F.count(F.lit(1)).alias("n_pred"))
    hit = (p.join(t, keys).groupBy("label").agg(F.count(F.lit(1)).alias("n_correct")))
    return (n_true.join(n_pred, "label", "left").join(hit, "label", "left")
            .select("label",
                    F.coalesce("n_correct", F.lit(0)).cast("long").alias("n_correct"),
                    F.col("n_pred").cast("long").alias("n_pred"),
                    F.col("n_true").cast("long").alias("n_true"),
                    F.try_divide(F.coalesce("n_correct", F.lit(0)), F.col("n_pred")).alias("precision"),
                    (F.coalesce("n_correct", F.lit(0)) / F.col("n_true")).alias("recall")))


def classification_metrics(df: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support, plus overall accuracy
    and weighted F1 on every row.  Built from the confusion counts (one row
    per (label, prediction) pair), never from collected predictions.

    The reference's ``fMeasure()`` without a label is this accuracy.
    """
    conf = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    classes = conf.select(F.col("y").alias("cls")).union(conf.select(F.col("p").alias("cls"))).distinct()
    tp = conf.filter(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    support = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("n_pred"))
    per = (classes.join(tp, "cls", "left").join(support, "cls", "left").join(predicted, "cls", "left")
           .fillna(0, ["tp", "support", "n_pred"])
           .withColumn("precision", F.try_divide(F.col("tp"), F.col("n_pred")))
           .withColumn("recall", F.try_divide(F.col("tp"), F.col("support")))
           .withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"),
                                          F.col("precision") + F.col("recall"))))
    # One row per class: a window over all rows is bounded by the classes.
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("support").over(everything)
    return per.select(
        F.col("cls").alias("label"),
        F.col("tp").cast("long").alias("tp"),
        F.col("n_pred").cast("long").alias("n_pred"),
        F.col("support").cast("long").alias("support"),
        "precision", "recall", "f1",
        (F.sum("tp").over(everything) / total).alias("accuracy"),
        (F.sum(F.coalesce(F.col("f1"), F.lit(0.0)) * F.col("support")).over(everything) / total)
        .alias("weighted_f1"))


def header_table(spark, datasets) -> DataFrame:
    """``(dataset_name, column_name, position)`` from the schemas of
    ``{dataset_name: DataFrame}`` — schema metadata, one row per header."""
    rows = [(name, c, i) for name, df in datasets.items() for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "dataset_name string, column_name string, position int")


LABEL_COUNTS = ("dataset_name string, column_name string, semantic_type string, count long, "
                "label string")


def label_target_frames(spark, frames: dict[str, DataFrame], targets: DataFrame,
                        rules: Sequence[Rule] | None = None) -> DataFrame:
    """:func:`label_targets` for ``{dataset_name: DataFrame}``.  Names are
    resolved against the schemas first (at most one row per header comes to
    the driver), so each scan reads only its chosen columns and each column
    keeps only its own validator."""
    resolved = resolve_names(targets, header_table(spark, frames), ["dataset_name"])
    chosen: dict[str, list[str]] = {}
    known = resolved.filter(F.col("resolved_name").isNotNull())
    for r in known.select("dataset_name", "resolved_name").distinct().collect():
        chosen.setdefault(r.dataset_name, []).append(r.resolved_name)
    out = None
    for name in sorted(chosen):
        m = label_wide(frames[name], name, sorted(chosen[name]), rules)
        out = m if out is None else out.unionByName(m)
    return spark.createDataFrame([], LABEL_COUNTS) if out is None else count_labels(out)


def label_targets(cells: DataFrame, headers: DataFrame, targets: DataFrame,
                  rules: Sequence[Rule] | None = None) -> DataFrame:
    """The reference's per-target flow as one job: every target
    ``(dataset_name, given_name)`` is resolved to the closest header of its
    dataset (insert/delete distance, first header wins ties), only that
    column's cells are kept (semi-join) and labelled by its rule.
    Returns label counts per (dataset, resolved column)."""
    resolved = resolve_names(targets, headers, ["dataset_name"])
    # One row per resolved column (bounded by the target list): the rule is
    # chosen here, once per column, and joined to the cells in place of a
    # semi-join, so per cell only that column's validator runs.
    chosen = (resolved.select("dataset_name", F.col("resolved_name").alias("column_name"))
              .distinct()
              .withColumn("_rule", rule_index(F.col("column_name"), rules)))
    wanted = cells.join(sized_broadcast(chosen), KEY)
    labelled = wanted.withColumn(
        "semantic_type", label_by_rule(F.col("column_name"), F.col("value"), F.col("_rule"), rules))
    return count_labels(labelled)
