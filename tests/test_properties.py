"""Properties from the test strategy: partition invariance, anti ∪ semi =
input, type counts add up to the non-empty cells."""

from pyspark.sql import functions as F

from civiclens.operators import profile as prof
from civiclens.operators import relational as rel
from civiclens.operators import semantic as sem
from civiclens.sources.readers import union_all
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df):
    """Rows with floats to 9 significant digits: double sums depend on the
    order partitions are combined in."""
    return sorted((_norm(tuple(r)) for r in df.collect()), key=repr)


def test_profile_partition_invariance(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "props",
        F.col("value").cast("string").alias("value"))
    one = prof.column_profiles(prof.melt_cells(ev.coalesce(1), "ev"))
    many = prof.column_profiles(prof.melt_cells(ev.repartition(8), "ev"))
    assert _rows(one) == _rows(many)
    for r in one.collect():
        assert sum(b["count"] for b in r.data_types) == r.number_non_empty_cells
        assert r.number_non_empty_cells + r.number_empty_cells == r.number_cells


def test_semantic_partition_invariance(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(F.col("url").alias("website"))
    assert _rows(sem.semantic_labels(pages.coalesce(1), "p")) == _rows(sem.semantic_labels(pages.repartition(8), "p"))


def test_anti_and_semi_partition_the_input(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    anti = rel.unresolved(orders, items, "o_orderkey", "l_orderkey")
    semi = orders.join(items.select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi")
    assert anti.count() + semi.count() == orders.count()
    assert anti.join(semi, "o_orderkey").count() == 0


def test_union_all_balanced(spark):
    frames = [spark.createDataFrame([(i,)], "x int") for i in range(13)]
    assert sorted(r.x for r in union_all(frames).collect()) == list(range(13))
    assert union_all([]) is None
