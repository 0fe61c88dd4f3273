"""Relational summaries: anti-join, counts, sums and averages, buckets,
arg-max with ties, top-k, calendar averages, top-k per group, lookup fill
and word count.

All of them are one or two shuffles with map-side partial aggregation;
none gathers a group into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions.text import strip_edge_punct, whitespace_tokens
from civiclens.operators._plan import global_rank, sized_broadcast, spread_input


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def unresolved(df: DataFrame, closed: DataFrame, key: str,
               closed_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` has no match in ``closed`` (anti-join).

    Duplicate left rows are kept.  Written as ``left_anti``: Catalyst does not
    turn ``LEFT JOIN ... WHERE right IS NULL`` into an anti join, so that form
    would carry the whole right side through the join.
    """
    ck = closed_key or key
    # Only the distinct keys of the right side matter; deduplicating them
    # map-side before the shuffle shrinks it when keys repeat (several
    # line items per order, clustered in the files).
    right = closed.select(F.col(ck).alias("_ck")).distinct()
    # A NULL key matches nothing: those rows stay, and keep out of the shuffle
    # that would send all of them to one task.
    known = df.filter(F.col(key).isNotNull())
    return (known.join(right, known[key] == right["_ck"], "left_anti")
                 .union(df.filter(F.col(key).isNull())))


def count_by(df: DataFrame, keys: str | Sequence[str], out: str = "num",
             count_nulls: bool = True) -> DataFrame:
    """Rows per key.  ``count_nulls=False`` reproduces SQL ``count(key)``,
    which gives a NULL key the count 0."""
    ks = _cols(keys)
    agg = F.count(F.lit(1)) if count_nulls else F.count(F.col(ks[0]))
    return df.groupBy(*ks).agg(agg.alias(out))


def sum_avg_by(df: DataFrame, key: str | Sequence[str], value: str,
               total: str = "total", average: str = "average",
               decimals: int | None = 2, key_length: int | None = None) -> DataFrame:
    """Sum and mean of ``value`` per key, rounded like the ``%.2f`` output.
    ``key_length`` keeps only keys of that length (the MapReduce variant
    accepted licence types of exactly 3 characters)."""
    if key_length is not None:
        df = df.filter(F.length(F.col(_cols(key)[0])) == key_length)
    s, a = F.sum(value), F.avg(value)
    if decimals is not None:
        s, a = F.round(s, decimals), F.round(a, decimals)
    return df.groupBy(*_cols(key)).agg(s.alias(total), a.alias(average))


def two_way_bucket(col: Column | str, value: str, other: str = "Other") -> Column:
    """``CASE WHEN col = value THEN value ELSE other END``; NULL goes to other."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(value), F.lit(value)).otherwise(F.lit(other))


def bucket_count(df: DataFrame, col: str, value: str, other: str = "Other",
                 bucket: str = "bucket", out: str = "num") -> DataFrame:
    """Count per two-way bucket (e.g. state ``NY`` against all others)."""
    return (df.select(two_way_bucket(col, value, other).alias(bucket))
              .groupBy(bucket).agg(F.count(F.lit(1)).alias(out)))


def most_frequent(df: DataFrame, keys: str | Sequence[str], out: str = "num") -> DataFrame:
    """Every key group whose count equals the largest count (ties kept).

    The maximum is a global aggregate of exactly one row, so broadcasting it
    is bounded; the match is an equi-join on the count.
    """
    counts = count_by(df, keys, out)
    top = counts.agg(F.max(out).alias("_max"))
    return (counts.join(F.broadcast(top), counts[out] == top["_max"])
                  .drop("_max"))


def top_k(df: DataFrame, keys: str | Sequence[str], k: int = 20,
          out: str = "num") -> DataFrame:
    """The ``k`` largest key groups by count, ties broken by the keys.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps k rows, so only k rows per task travel.
    """
    ks = _cols(keys)
    return (count_by(df, ks, out)
            .orderBy(F.col(out).desc(), *[F.col(k_).asc() for k_ in ks])
            .limit(k))


def calendar_average(df: DataFrame, key: str | Sequence[str], date_col: str,
                     days: Sequence[int], n_in: float, n_out: float,
                     in_name: str = "weekend_average",
                     out_name: str = "weekday_average",
                     decimals: int | None = 2) -> DataFrame:
    """Per key: rows on the given days of the month divided by ``n_in`` and
    rows on the other days divided by ``n_out`` — one scan, one shuffle
    (the reference unions two filtered scans)."""
    day = F.dayofmonth(F.col(date_col))
    hit = day.isin(list(days))
    inside = F.sum(F.when(hit, 1).otherwise(0)) / F.lit(float(n_in))
    outside = F.sum(F.when(~hit, 1).otherwise(0)) / F.lit(float(n_out))
    if decimals is not None:
        inside, outside = F.round(inside, decimals), F.round(outside, decimals)
    return df.groupBy(*_cols(key)).agg(inside.alias(in_name), outside.alias(out_name))


def top_k_per_group(df: DataFrame, group: str | Sequence[str], item: str | Sequence[str],
                    k: int = 5, out: str = "num", rank: str = "rank") -> DataFrame:
    """Count per (group, item), keep the ``k`` most frequent items per group.

    Ties are broken by the item ascending.  Spark inserts a
    ``WindowGroupLimit`` before the exchange, so a group with very many
    items ships at most k rows per map task.
    """
    gs, its = _cols(group), _cols(item)
    counts = df.groupBy(*gs, *its).agg(F.count(F.lit(1)).alias(out))
    w = Window.partitionBy(*gs).orderBy(F.col(out).desc(), *[F.col(c).asc() for c in its])
    return (counts.withColumn(rank, F.row_number().over(w))
                  .filter(F.col(rank) <= k))


def lookup_map(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup table with one row per key (a dictionary): when a key repeats,
    the largest value wins, so the result does not depend on file order."""
    return lookup.groupBy(F.col(key).alias("_lk")).agg(F.max(value).alias("_lv"))


def fill_from_lookup(df: DataFrame, key: str, value: str, lookup: DataFrame,
                     lookup_key: str, lookup_value: str, sentinel: str = "Unspecified",
                     out: str | None = None, max_lookup_rows: int = 1_000_000) -> DataFrame:
    """Replace ``value`` by the looked-up value where it equals ``sentinel``
    and ``key`` is present.  A key missing from the lookup gives NULL; a
    NULL key keeps the original value."""
    lk = sized_broadcast(lookup_map(lookup, lookup_key, lookup_value), max_lookup_rows)
    joined = df.join(lk, df[key] == lk["_lk"], "left")
    filled = (F.when(F.col(key).isNotNull() & (F.col(value) == F.lit(sentinel)), F.col("_lv"))
               .otherwise(F.col(value)))
    return joined.withColumn(out or value, filled).drop("_lk", "_lv")


def word_count(df: DataFrame, text_col: str, word: str = "word", out: str = "num") -> DataFrame:
    """Words split on whitespace, edge punctuation stripped, lower-cased,
    empty words dropped, counted."""
    text = spread_input(df.select(text_col))
    words = (text.select(F.explode(whitespace_tokens(F.col(text_col))).alias("_w"))
               .select(F.lower(strip_edge_punct(F.col("_w"))).alias(word))
               .filter(F.col(word) != ""))
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(out))


def row_index(df: DataFrame, order: Sequence[str | Column], out: str = "id") -> DataFrame:
    """0-based row index following a declared total order (the reference
    used ``zipWithIndex``, whose numbering depends on partitioning)."""
    return global_rank(df, list(order), out).drop("_total")


def sample_one(df: DataFrame, fraction: float = 0.1, seed: int = 10) -> DataFrame:
    """A random sample, then one row of it (a sampling operator: the limit
    is the feature)."""
    return df.sample(False, fraction, seed).limit(1)


def sample_rows(df: DataFrame, k: int, key: Sequence[str], seed: int = 10) -> DataFrame:
    """``k`` random rows: those with the smallest MD5 of seed and key, ties by
    the key (a sampling operator: the limit is the feature).  The choice depends
    on the keys only, not on partitioning; every task keeps k rows."""
    salted = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]).cast("binary"))
    return df.orderBy(salted, *key).limit(k)
