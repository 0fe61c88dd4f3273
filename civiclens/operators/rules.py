"""Frequent itemsets of size 1-3 over a long ``(uid, attr, val)`` table,
association rules with a fixed consequent attribute, and the protection
(discrimination) ratio of rules that add a protected attribute.

Plan shape, for any scale:

* ``F1`` is one aggregation with map-side partial counts.
* Items are pruned to ``F1`` with a semi-join before they are grouped
  (Apriori pruning), against a size-checked broadcast of ``F1`` — never a
  shuffle of the item table by its skewed (attr, val) key.
* One shuffle by ``uid`` of partly gathered rows makes baskets, one column to an
  attribute (:func:`grouped_baskets`).  Uids with several items of an attribute
  have sorted baskets of at most ``BASKET`` items (:func:`baskets`); one with more
  items has several, whose pairs across are found by a join of baskets.  Uids
  with the same items are counted together (:func:`counted_baskets`, combined
  map-side).  Pairs and triples are enumerated
  within baskets by higher-order functions, once per different basket, without
  another shuffle by ``uid``.  Their counts combine map-side, so a hot pair does
  not load one task.
* Triples: pairs of non-consequent items with the uid's consequent items.  By
  anti-monotonicity the frequent ones equal those of the reference's candidate
  table ``C3``; pruning by ``F2`` is optional.
* Rules are equi-joins between these small frequent tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.operators._plan import materialize, sized_broadcast



def long_items(wide: DataFrame, uid: str, attrs: Sequence[str],
               attr: str = "attr", val: str = "val") -> DataFrame:
    """Melt a wide table into the long ``(uid, attr, val INT)`` form."""
    cast = wide.select(F.col(uid).alias("uid"),
                       *[F.col(a).cast("int").alias(a) for a in attrs])
    return cast.unpivot("uid", list(attrs), attr, val)


def frequent_items(items: DataFrame, supp: int) -> DataFrame:
    """F1(attr, val, supp): items present in at least ``supp`` rows."""
    return (items.groupBy("attr", "val").agg(F.count(F.lit(1)).alias("supp"))
                 .filter(F.col("supp") >= supp))


def _pruned(items: DataFrame, f1: DataFrame) -> DataFrame:
    # Broadcast F1 behind a size check (cheap when F1 is materialised, one
    # aggregation otherwise).  A shuffle semi-join would move the whole item
    # table by (attr, val) — a skewed key: one status value can hold a third
    # of the rows — only to drop infrequent items.
    return items.join(sized_broadcast(f1.select("attr", "val")), ["attr", "val"], "left_semi")


# Items of one basket: so many squared are enumerated in one place.
BASKET = 64


def baskets(items: DataFrame, f1: DataFrame, consequent: str | None = None,
            size: int = BASKET) -> DataFrame:
    """``uid, chunk, items``: the frequent items of every uid in the order of
    (attr, val), at most ``size`` to a row, and with ``consequent`` its items of
    that attribute (``cons``) beside each.  One shuffle by uid."""
    t = _pruned(items.filter(F.col("uid").isNotNull()), f1)
    by_uid = Window.partitionBy("uid").orderBy("attr", "val")
    whole = by_uid.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = by_uid.rowsBetween(0, size - 1)
    # One sort, one window: a basket is the items from every ``size``-th on.  Lists
    # of plain columns, as a struct would be shuffled beside the columns it is of.
    t = t.select("uid", (F.row_number().over(by_uid) - 1).alias("_place"),
                 F.collect_list("attr").over(held).alias("attr"), F.collect_list("val").over(held).alias("val"),
                 *([] if consequent is None else
                   [F.collect_list(F.when(F.col("attr") == consequent, F.col("val"))).over(whole).alias("cons")]))
    extra = [] if consequent is None else [F.transform(
        "cons", lambda v: F.struct(F.lit(consequent).alias("attr"), v.alias("val"))).alias("cons")]
    return t.filter(F.col("_place") % size == 0).select(
        "uid", F.floor(F.col("_place") / size).cast("int").alias("chunk"),
        F.arrays_zip("attr", "val").alias("items"), *extra)


def counted_baskets(grouped: DataFrame) -> DataFrame:
    """:func:`baskets` with the equal ones of uids that have one basket only in one
    row without a uid; ``n``: how many they are.  Baskets of other uids keep
    their uid, by which their pairs across are found."""
    rest = [c for c in grouped.columns if c == "cons"]
    several = F.max("chunk").over(Window.partitionBy("uid")) > 0
    return (grouped.withColumn("uid", F.when(several, F.col("uid")))
                   .groupBy("uid", "chunk", "items", *rest).agg(F.count(F.lit(1)).alias("n")))


# Attributes whose values are gathered beside each other, one column each.
WIDE = 32


def grouped_baskets(items: DataFrame, f1: DataFrame, consequent: str | None = None,
                    how: str | None = "checkpoint") -> DataFrame:
    """The rows of :func:`counted_baskets`, computed once (``how``).

    A uid with one item of an attribute at most is a row of values, one column to
    an attribute: a hash aggregation with states of fixed size, combined before
    the shuffle, instead of a sort of all items and a list per uid.  Other uids
    (and all, with more than ``WIDE`` attributes) have lists of their items.
    """
    named = f1.filter(F.col("attr").isNotNull() & F.col("val").isNotNull()).select("attr").distinct()
    attrs = sorted(r.attr for r in named.limit(WIDE + 1).collect())
    if not 0 < len(attrs) <= WIDE:
        return materialize(counted_baskets(baskets(items, f1, consequent)), how)
    cols = [f"_v{i}" for i in range(len(attrs))]
    by_uid = _pruned(items.filter(F.col("uid").isNotNull()), f1).groupBy("uid").agg(
        *[F.max(F.when(F.col("attr") == a, F.col("val"))).alias(c) for a, c in zip(attrs, cols)],
        F.count(F.lit(1)).alias("_held"))
    single = sum(F.col(c).isNotNull().cast("int") for c in cols) == F.col("_held")
    # those with several items of an attribute fall into one row here
    counted = materialize(
        by_uid.groupBy(single.alias("_single"), *[F.when(single, F.col(c)).alias(c) for c in cols])
              .agg(F.count(F.lit(1)).alias("n")), how)

    def held(names):
        of = [F.struct(F.lit(a).alias("attr"), F.col(c).alias("val")) for a, c in zip(attrs, cols) if a in names]
        # of no names: an empty list of the same type
        return F.filter(F.array(*of), lambda x: x["val"].isNotNull()) if of else F.slice(held(attrs), 1, 0)
    extra = [] if consequent is None else [held([consequent]).alias("cons")]
    whole = counted.filter("_single").select(
        F.lit(None).cast(items.schema["uid"].dataType).alias("uid"), F.lit(0).alias("chunk"),
        held(attrs).alias("items"), *extra, "n")
    if counted.filter(~F.col("_single")).isEmpty():
        return whole
    several = items.join(by_uid.filter(~single).select("uid"), "uid", "left_semi")
    return whole.unionByName(materialize(counted_baskets(baskets(several, f1, consequent)), how))


def _blocks(grouped: DataFrame) -> DataFrame:
    """``uid, a, b[, cons][, n]``: arrays of items whose pairs, the first from a and
    the second from b, are all pairs of the uid (of ``n`` uids) once."""
    rest = [c for c in grouped.columns if c in ("cons", "n")]
    own = grouped.select("uid", F.col("items").alias("a"), F.col("items").alias("b"), *rest)
    later = grouped.filter(F.col("chunk") > 0)
    if later.isEmpty():
        return own
    # items are in order over the baskets of a uid too
    later = later.select("uid", F.col("chunk").alias("_later"), F.col("items").alias("b"))
    across = (grouped.join(later, "uid").filter(F.col("chunk") < F.col("_later"))
                     .select("uid", F.col("items").alias("a"), "b", *rest))
    return own.unionByName(across)


def _ordered_pairs(a: Column, b: Column) -> Column:
    """Pairs ``(x, y)`` of x in a and y in b with ``x.attr < y.attr``."""
    return F.flatten(F.transform(a, lambda x: F.transform(
        F.filter(b, lambda y: x["attr"] < y["attr"]),
        lambda y: F.struct(x.alias("x"), y.alias("y")))))


def _item_columns(item: str, n: int) -> list[Column]:
    return [F.col(f"{item}.attr").alias(f"attr{n}"), F.col(f"{item}.val").alias(f"val{n}")]


def _pairs(grouped: DataFrame, last: str | None) -> DataFrame:
    blocks = _blocks(grouped)
    rest = [c for c in blocks.columns if c == "n"]
    p = blocks.select("uid", *rest, F.explode(_ordered_pairs(F.col("a"), F.col("b"))).alias("p"))
    out = p.select("uid", *rest, *_item_columns("p.x", 1), *_item_columns("p.y", 2))
    if last is None:
        return out
    back = p.filter(F.col("p.x.attr") == last)
    return out.unionAll(back.select("uid", *rest, *_item_columns("p.y", 1), *_item_columns("p.x", 2)))


def uid_pairs(items: DataFrame, f1: DataFrame, last: str | None = None) -> DataFrame:
    """Per uid, every pair of frequent items with ``attr1 < attr2``.  The
    attribute ``last`` also follows those that sort after it."""
    return _pairs(materialize(baskets(items, f1)), last)


def _uids(grouped: DataFrame) -> Column:
    """The number of uids in rows that were made of baskets."""
    return F.sum("n") if "n" in grouped.columns else F.count(F.lit(1))


def frequent_pairs(items: DataFrame, f1: DataFrame, supp: int,
                   last: str | None = None, grouped: DataFrame | None = None) -> DataFrame:
    """F2(attr1, val1, attr2, val2, supp).  With ``last`` (the consequent),
    pairs of a later attribute and this one are counted as well, so that
    :func:`rules2` finds rules with any attribute on the left.  ``grouped``:
    :func:`baskets`, counted or not, that are there already."""
    if grouped is None:
        grouped = grouped_baskets(items, f1)
    return (_pairs(grouped, last).groupBy("attr1", "val1", "attr2", "val2")
            .agg(_uids(grouped).alias("supp"))
            .filter(F.col("supp") >= supp))


def frequent_triples(items: DataFrame, f1: DataFrame, f2: DataFrame | None, supp: int,
                     consequent: str = "vdecile", any_position: bool = False,
                     grouped: DataFrame | None = None) -> DataFrame:
    """F3(attr1, val1, attr2, val2, attr3, val3, supp) with ``attr3`` the
    consequent attribute — the reference's C3 candidates, counted.
    ``any_position=True`` also counts left items that sort after the
    consequent (an ``f2`` given then must hold those pairs).

    Per uid: pairs of non-consequent items (``attr1 < attr2``,
    ``attr1 < consequent``) with each of the uid's consequent items.  C3 also
    asks that (item1, item2) and (item1, consequent) be in F2; a triple with
    support >= ``supp`` has both pairs frequent (anti-monotonicity), so the
    counts kept are the same with or without that test.  Passing ``f2`` applies
    it as an early (broadcast-sized) semi-join, which pays off when many pairs
    are infrequent.  ``grouped``: :func:`baskets` with this consequent,
    counted or not.
    """
    if grouped is None:
        grouped = grouped_baskets(items, f1, consequent)
    n = [c for c in grouped.columns if c == "n"]
    with_cons = _blocks(grouped.filter(F.size("cons") > 0))

    def left(x: Column) -> Column:
        return x["attr"] != consequent if any_position else x["attr"] < consequent
    pairs = _ordered_pairs(F.filter("a", left), F.filter("b", lambda y: y["attr"] != consequent))
    t = with_cons.select(*n, F.explode(pairs).alias("p"), "cons")
    triples = t.select(*n, *_item_columns("p.x", 1), *_item_columns("p.y", 2), F.explode("cons").alias("c"))
    triples = triples.select(*n, "attr1", "val1", "attr2", "val2", *_item_columns("c", 3))
    if f2 is not None:
        keys = f2.select("attr1", "val1", "attr2", "val2")
        triples = triples.join(keys, ["attr1", "val1", "attr2", "val2"], "left_semi")
        cons_keys = f2.filter(F.col("attr2") == consequent).select(
            "attr1", "val1", F.col("attr2").alias("attr3"), F.col("val2").alias("val3"))
        triples = triples.join(cons_keys, ["attr1", "val1", "attr3", "val3"], "left_semi")
    return (triples.groupBy("attr1", "val1", "attr2", "val2", "attr3", "val3")
                   .agg(_uids(grouped).alias("supp"))
                   .filter(F.col("supp") >= supp))


def _passes(value, threshold: float, strict: bool):
    return value > threshold if strict else value >= threshold


def _ratio(part, whole, decimals: int | None):
    r = F.col(part) / F.col(whole)
    return r if decimals is None else F.round(r, decimals)


def _consequent(attr: str, val: str, name: str, values: Sequence[int] | None):
    wanted = F.col(attr) == name
    return wanted if values is None else wanted & F.col(val).isin(*values)


def rules2(f1: DataFrame, f2: DataFrame, conf: float,
           consequent: str = "vdecile", strict: bool = False,
           conf_decimals: int | None = None,
           consequent_values: Sequence[int] | None = None) -> DataFrame:
    """R2: item → consequent item, conf = supp(pair) / supp(item).

    Variants of the reference's other drafts: ``strict=True`` uses ``>``;
    ``conf_decimals=2`` rounds the confidence, in the test and in the result;
    ``consequent_values`` keeps rules to these values of the consequent only.
    """
    lhs = f1.select(F.col("attr").alias("attr1"), F.col("val").alias("val1"),
                    F.col("supp").alias("_s1"))
    return (f2.filter(_consequent("attr2", "val2", consequent, consequent_values))
              .join(lhs, ["attr1", "val1"])
              .withColumn("conf", _ratio("supp", "_s1", conf_decimals))
              .filter(_passes(F.col("conf"), conf, strict))
              .select("attr1", "val1", "attr2", "val2", "supp", "conf"))


def rules3(f2: DataFrame, f3: DataFrame, conf: float,
           consequent: str = "vdecile", strict: bool = False,
           conf_decimals: int | None = None,
           consequent_values: Sequence[int] | None = None) -> DataFrame:
    """Two items → consequent item, conf = supp(triple) / supp(pair);
    variants as in :func:`rules2`."""
    lhs = f2.withColumnRenamed("supp", "_s2")
    return (f3.filter(_consequent("attr3", "val3", consequent, consequent_values))
              .join(lhs, ["attr1", "val1", "attr2", "val2"])
              .withColumn("conf", _ratio("supp", "_s2", conf_decimals))
              .filter(_passes(F.col("conf"), conf, strict))
              .select("attr1", "val1", "attr2", "val2", "attr3", "val3", "supp", "conf"))


def protected_rules(r2: DataFrame, r3: DataFrame, prot: float,
                    protected: str = "race", any_position: bool = False,
                    match_consequent_value: bool = True, match_left_value: bool = True,
                    strict: bool = False, prot_decimals: int | None = None) -> DataFrame:
    """PD_R3: rules of R3 whose second item is the protected attribute,
    with prot = conf(R3) / conf(R2 of the same first item and consequent).

    ``any_position=True`` also accepts the protected attribute as the first
    item (then the other item is the base rule's left side); give it rules
    mined with the same option.  The other
    drafts of the reference are parameters: ``match_consequent_value=False``
    joins the base rule on the consequent attribute only,
    ``match_left_value=False`` on the left attribute only, ``strict`` uses
    ``>`` and ``prot_decimals`` rounds the ratio.
    """
    base = r2.select(F.col("attr1").alias("_ba"), F.col("val1").alias("_bv"),
                     F.col("attr2").alias("_ca"), F.col("val2").alias("_cv"),
                     F.col("conf").alias("_bconf"))
    on = [r3["attr3"] == base["_ca"]]
    if match_consequent_value:
        on.append(r3["val3"] == base["_cv"])
    second = (F.col("attr2") == protected) & (F.col("attr1") == F.col("_ba"))
    if match_left_value:
        second = second & (F.col("val1") == F.col("_bv"))
    if any_position:
        first = (F.col("attr1") == protected) & (F.col("attr2") == F.col("_ba"))
        if match_left_value:
            first = first & (F.col("val2") == F.col("_bv"))
        joined = r3.join(base, on).filter(second | first)
    else:
        cond = on + [r3["attr1"] == base["_ba"]]
        if match_left_value:
            cond.append(r3["val1"] == base["_bv"])
        joined = r3.filter(F.col("attr2") == protected).join(base, cond)
    return (joined.withColumn("prot", _ratio("conf", "_bconf", prot_decimals))
                  .filter(_passes(F.col("prot"), prot, strict))
                  .select("attr1", "val1", "attr2", "val2", "attr3", "val3",
                          "supp", "conf", "prot").distinct())


@dataclass
class RuleSet:
    f1: DataFrame
    f2: DataFrame
    f3: DataFrame
    r2: DataFrame
    r3: DataFrame
    pd_r3: DataFrame

    def unpersist(self) -> None:
        for df in (self.f1, self.f2, self.f3):
            df.unpersist()


def mine_rules(items: DataFrame, supp: int, conf: float, prot: float,
               consequent: str = "vdecile", protected: str = "race",
               materialize_as: str | None = "checkpoint", any_position: bool = False,
               keep_items: bool = True) -> RuleSet:
    """All levels at once.  The long item table, its baskets and the small
    frequent tables are computed once each (``materialize_as``: "checkpoint",
    "persist" or None) so that R2, R3 and PD_R3 do not recompute them — the
    reference's views were re-planned for every write.  ``keep_items=False``:
    the items are cheap to read twice, as when melted from a table that is
    computed already; they are not written down again.  ``any_position=True``
    puts no condition on the order of attribute names: items that sort after
    the consequent stand on the left too, and the protected attribute may be
    either left item."""
    keep = lambda d: materialize(d, materialize_as)
    items = keep(items) if keep_items else items
    f1 = keep(frequent_items(items, supp))
    grouped = grouped_baskets(items, f1, consequent, materialize_as)
    f2 = keep(frequent_pairs(items, f1, supp, consequent if any_position else None, grouped))
    f3 = keep(frequent_triples(items, f1, None, supp, consequent, any_position, grouped))
    r2 = rules2(f1, f2, conf, consequent)
    r3 = rules3(f2, f3, conf, consequent)
    return RuleSet(f1, f2, f3, r2, r3, protected_rules(r2, r3, prot, protected, any_position))
