"""Plan helpers: exact distributed ntile and the sized broadcast."""

from pyspark.sql import functions as F

from civiclens.operators._plan import global_ntile, has_at_most, sized_broadcast


def _py_ntile(n_rows, n):
    q, r = divmod(n_rows, n)
    out = []
    for b in range(n):
        out += [b + 1] * (q + (1 if b < r else 0))
    return out


def test_global_ntile_equals_sql_ntile(spark):
    rows = [(i, float((i * 7919) % 101)) for i in range(1003)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    got = global_ntile(df, 10, ["v", "k"], "tile").orderBy("v", "k").collect()
    assert [r.tile for r in got] == _py_ntile(1003, 10)
    # with other columns pruned differently downstream, tiles stay put
    counts = {r.tile: r["count"] for r in
              global_ntile(df.withColumn("x", F.lit(1)), 10, ["v", "k"], "tile")
              .groupBy("tile").count().collect()}
    assert sorted(counts.values()) == sorted(_py_ntile(1003, 10).count(i) for i in range(1, 11))


def test_global_ntile_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "k long")
    assert [r.t for r in global_ntile(df, 10, ["k"], "t").orderBy("k").collect()] == [1, 2, 3]


def test_sized_broadcast(spark):
    small = spark.range(10)
    assert has_at_most(small, 10) and not has_at_most(small, 9)
    plan = spark.range(1000).join(sized_broadcast(small, 100), "id")._jdf.queryExecution().toString()
    assert "broadcast" in plan.lower()


def test_global_ntile_with_a_hot_value(spark):
    """One price holds a third of all rows; the total order (price, key)
    still gives the exact SQL tiles."""
    rows = [(i, 5.0 if i % 3 == 0 else float(i % 97)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(6)
    got = global_ntile(df, 7, ["v", "k"], "tile").orderBy("v", "k").collect()
    assert [r.tile for r in got] == _py_ntile(3000, 7)


def test_broadcast_is_bounded_in_bytes(spark):
    from civiclens.operators._plan import sized_broadcast
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) AS t")
    marked = lambda d: "ResolvedHint" in d._jdf.queryExecution().logical().toString()
    assert marked(sized_broadcast(wide)) or "broadcast" in sized_broadcast(wide)._jdf.queryExecution().logical().toString()
    assert sized_broadcast(wide, max_bytes=50_000) is wide and sized_broadcast(wide, max_rows=99) is wide


def test_anti_join_keeps_null_keys(spark):
    from civiclens.operators import relational as rel
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.v for r in rel.unresolved(left, right, "k").collect()) == [1, 2, 4, 5]


def test_rank_without_checkpoint(spark):
    """The same ranks under another partitioning and order of rows, NULLs and
    strings among the keys, and nothing written down."""
    import random

    from civiclens.operators._plan import global_rank
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "ä", ""]), rng.choice([None, 1.5, -2.0]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "s string, v double, k int")
    ranks = []
    for d in (df.repartition(7), df.orderBy(F.rand(3)).coalesce(2)):
        out = global_rank(d, ["s", "v", "k"], "r", partitions=9)
        ranks.append({r.k: r.r for r in out.collect()})
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    assert ranks[0] == ranks[1] == {r[2]: i for i, r in enumerate(want)}


def test_rank_of_few_rows(spark):
    from civiclens.operators._plan import global_rank
    df = spark.createDataFrame([(i,) for i in range(3)], "k int")
    assert sorted((r.k, r.r, r._total) for r in global_rank(df, ["k"], "r").collect()) == [(0, 0, 3), (1, 1, 3), (2, 2, 3)]
    assert global_rank(df.filter("k > 5"), ["k"], "r").count() == 0


def test_ranges_are_even(spark):
    from civiclens.operators._plan import range_of, range_splitters
    keys = spark.range(100000).select(F.struct(F.expr("id * id").alias("a")).alias("k"))
    cut = range_splitters(keys, 20)
    n = [r["count"] for r in keys.groupBy(range_of(F.col("k"), cut, 20)).count().collect()]
    assert len(n) == 20 and min(n) > 2500 and max(n) < 10000


def test_ranges_of_a_rank_are_compiled(spark):
    """The search for a row's range is no lambda function, which Spark interprets."""
    from civiclens.operators._plan import _key, global_rank, range_of, range_splitters, with_range
    df = spark.range(500).selectExpr("IF(id % 9 = 0, NULL, id * 37 % 101) AS v", "id AS k")
    for n in (1, 2, 8, 9, 40):
        key = _key(df, ["v", "k"])
        cut = range_splitters(df.select(key.alias("k")), n)
        got = with_range(df, key, cut, n, "r").withColumn("same", range_of(key, cut, n))
        rows = sorted(got.collect(), key=lambda r: (r.v is not None, r.v, r.k))
        found = [r.r for r in rows]
        assert found == [r.same for r in rows] == sorted(found) and 0 <= found[0] and found[-1] < n
        splitters = {tuple(s) for s in got.select(cut.alias("s")).first().s if s}
        want, below = [], 0
        for r in rows:
            below += (r.v, r.k) in splitters
            want.append(below)
        assert found == want
    plan = global_rank(df, ["v", "k"], "r")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
