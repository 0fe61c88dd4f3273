"""Fuzzy name resolution: pick, per group, the candidate name closest to a
given name by insert/delete edit distance ``|x| + |y| - 2·LCS(x, y)``
(case-sensitive; the first candidate in position order wins ties).

Spark's ``levenshtein`` is a different distance (a substitution costs 1,
here 2).  The LCS is computed bit-parallel (Crochemore et al. 2001; Hyyro 2004)
with SQL higher-order functions, JVM-side: the given name becomes, per
distinct character, a mask of its places (words of ``WORD`` bits), and every
character of the candidate updates all places with a few integer operations
instead of one step per place.  Masks are built once per given name.

Plan: an equi-join of targets with the candidates of their own group
(a dataset's headers), then ``min_by`` per target.  A target meets only
its group's candidates; groups are schema-sized, not data-sized.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Bits of a mask word: sums of two words and a carry stay below 2^63, so the
# additions never overflow (under ANSI rules that would be an error).
WORD = 60
_FULL = (1 << WORD) - 1


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def place_masks(text: Column) -> Column:
    """``struct(n, masks)``: the length, and per distinct character the mask of
    its places as an array of ``WORD``-bit words."""
    chars = F.split(text, "")
    last = F.floor((F.length(text) - 1) / WORD).cast("int")

    def mask(c: Column) -> Column:
        def word(k: Column) -> Column:
            part = F.slice(chars, k * WORD + 1, F.lit(WORD))
            bits = F.transform(part, lambda x, i: F.when(x == c, _bit(i)).otherwise(F.lit(0).cast("long")))
            return F.aggregate(bits, F.lit(0).cast("long"), lambda m, x: m + x)
        return F.transform(F.sequence(F.lit(0), last), word)

    entries = F.transform(F.array_distinct(chars), lambda c: F.struct(c, mask(c)))
    none = F.lit(None).cast("map<string,array<bigint>>")
    return F.struct(F.length(text).alias("n"),
                    F.when(F.length(text) > 0, F.map_from_entries(entries)).otherwise(none).alias("masks"))


def _update(v: Column, m: Column, carry: Column, full: Column) -> Column:
    """``(next word, carry)``: zero bits are the places where the longest common
    subsequence with what has been read grows."""
    u = v.bitwiseAND(m)
    total = v + u + carry
    return F.struct(total.bitwiseOR(v - u).bitwiseAND(full).alias("v"),
                    F.shiftright(total, WORD).alias("carry"))


def lcs_of_masks(places: Column, other: Column) -> Column:
    """LCS length of the text behind :func:`place_masks` and ``other``."""
    n, masks = places["n"], places["masks"]
    chars = F.split(other, "")
    zero, whole = F.lit(0).cast("long"), F.lit(_FULL).cast("long")
    low = _bit(F.least(n, F.lit(WORD))) - 1  # ones at all places of a text of one word

    def one(v: Column, c: Column) -> Column:
        m = F.element_at(F.try_element_at(masks, c), 1)
        return F.when(m.isNull(), v).otherwise(_update(v, m, zero, low)["v"])

    short = n - F.bit_count(F.aggregate(chars, low, one))

    # longer texts: words from low to high, the carry goes on to the next
    first = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / WORD).cast("int")),
                        lambda k: F.when((k + 1) * WORD <= n, whole).otherwise(_bit(n - k * WORD) - 1))

    def every(words: Column, c: Column) -> Column:
        start = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("v"))
        triples = F.arrays_zip(words.alias("w"), F.try_element_at(masks, c).alias("m"), first.alias("full"))

        def step(state: Column, t: Column) -> Column:
            new = _update(t["w"], t["m"], state["carry"], t["full"])
            return F.struct(new["carry"].alias("carry"), F.concat(state["v"], F.array(new["v"])).alias("v"))
        moved = F.aggregate(triples, start, step)["v"]
        return F.when(F.try_element_at(masks, c).isNull(), words).otherwise(moved)

    ones = F.aggregate(F.transform(F.aggregate(chars, first, every), lambda w: F.bit_count(w)),
                       F.lit(0), lambda a, x: a + x)
    empty = (n == 0) | (F.length(other) == 0)
    return F.when(empty, F.lit(0)).when(n <= WORD, short).otherwise(n - ones)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings."""
    return lcs_of_masks(place_masks(a), b)


def edit_distance(a: Column, b: Column) -> Column:
    """Insert/delete distance ``|a| + |b| - 2·LCS(a, b)``."""
    return F.length(a) + F.length(b) - 2 * lcs_length(a, b)


def resolve_names(targets: DataFrame, candidates: DataFrame, group: Sequence[str],
                  given: str = "given_name", name: str = "column_name",
                  position: str = "position", out: str = "resolved_name") -> DataFrame:
    """The closest candidate name of its group for every distinct target.

    ``targets``: ``(*group, given)``; ``candidates``: ``(*group, name,
    position)``.  Returns ``(*group, given, out, distance)``; a target whose
    group has no candidate gets NULL.
    """
    keys = [*group, given]
    t = targets.select(*keys).distinct().withColumn("_places", place_masks(F.col(given)))
    cand = candidates.select(*group, F.col(name).alias("_name"), F.col(position).alias("_pos"))
    # left join: a target without candidates keeps one row with NULLs,
    # which min_by ignores, so it comes out unresolved (NULL)
    pairs = t.join(cand, list(group), "left").withColumn(
        "_dist", F.length(given) + F.length("_name") - 2 * lcs_of_masks(F.col("_places"), F.col("_name")))
    best = pairs.groupBy(*keys).agg(
        F.min_by(F.struct("_name", "_dist"), F.struct("_dist", "_pos")).alias("_best"))
    return best.select(*keys, F.col("_best._name").alias(out),
                       F.col("_best._dist").alias("distance"))
