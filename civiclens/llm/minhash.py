"""Near-duplicate groups by min-max hashing.

Each of ``bands * 3`` hash functions gives two values of a document's shingle
set, its minimum and its maximum.  Either is equal in two documents with
probability J, so half as many hash evaluations give as many unbiased values.
Both are equal with probability k/u * (k-1)/(u-1) for k of u shingles shared:
J * J in large sets, less in small ones.  A band joins the three minima and
three maxima of three functions; with 40 bands a pair at J = 0.8 is missed with
a probability of about 5e-6 in large sets, 9e-6 with 20 shingles in the union,
1.6e-5 with 10 and 6e-5 with 5.

1. Documents with equal sets are one class, represented by its smallest doc_id;
   only representatives are compared.
2. In every bucket the members are paired with the bucket's smallest: as many
   pairs as members.  The pairs are confirmed on the full sets.
3. Components are formed.  A bucket that holds several is taken up again with
   its strays only: the members outside its largest component.  Each is paired
   with a member of that component, drawn by hash, and with one drawn among the
   strays: at most two pairs a stray, and a large group of variants soon is one
   component.  Rounds end when fewer than one stray in ``FEW`` finds a link (or after
   ``PIVOTS``).
4. What strays are left are compared with all members of other components in
   their bucket, unless the sizes or the parity sketches prove that there is no
   link.  So no pair of a bucket that could join two components is left open, and
   a large group costs no pairs within it.

Defined results: a document without words has n_shingles 0, is linked with
nothing and kept; so is one with a null doc_id (its component is null);
documents that share a doc_id are one vertex if it is the smallest of their
class; copies belong to one component; ties do not arise, as the smallest
doc_id counts; an empty table gives an empty result; only doc_id and text are
read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import boxed, join_on, scratch, tidy, unboxed, written
from civiclens.llm.components import components
from civiclens.llm.shingles import linked, mix, shingles

BANDS = 40
PER_BAND = 3
PIVOTS = 4
FEW = 20
SKETCH = 1024  # bits of the parity sketch


def _functions(n: int):
    rng = np.random.default_rng(20240601)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, n, dtype=np.uint64)[:, None]


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Minimum and maximum of every hash function over the set x."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(a), np.uint64)
    for i in range(0, len(x), 512):  # blocks that stay in the CPU's cache
        v = a * x[i:i + 512] + b
        np.minimum(low, v.min(axis=1), out=low)
        np.maximum(high, v.max(axis=1), out=high)
    return low, high


def band_keys(x: np.ndarray, a, b, bands: int) -> np.ndarray:
    low, high = signature(x, a, b)
    values = np.concatenate([low.reshape(bands, PER_BAND), high.reshape(bands, PER_BAND)], axis=1)
    key = np.arange(bands, dtype=np.uint64)
    for j in range(values.shape[1]):
        key = mix(key * np.uint64(31) + values[:, j])
    return key.view(np.int64)


def parity(x: np.ndarray) -> np.ndarray:
    """Per cell, whether an odd number of elements falls into it.  Two such
    sketches differ in at most as many cells as the sets differ in elements."""
    cell = (mix(x ^ np.uint64(_SALT)) % np.uint64(SKETCH)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=SKETCH).astype(np.uint8) & 1).view(np.int64)


def _sketch(words: int, bands: int):
    def run(batches):
        a, b = _functions(bands * PER_BAND)
        for batch in batches:
            n, s1, s2, keys, odd = [], [], [], [], []
            for text in batch.column("text"):
                x = shingles(text.as_py(), words)
                n.append(len(x))
                # two sums over differently mixed elements identify the set
                s1.append(int(mix(x + np.uint64(1)).sum().view(np.int64)) if len(x) else 0)
                s2.append(int(mix(x ^ np.uint64(_SALT)).sum().view(np.int64)) if len(x) else 0)
                keys.append(band_keys(x, a, b, bands) if len(x) else np.zeros(0, np.int64))
                odd.append(parity(x))
            ends = np.cumsum([0] + [len(k) for k in keys])
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_h"), pa.array(n, pa.int64()),
                 pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
                 pa.array(odd, pa.list_(pa.int64()))],
                names=["doc_id", "_h", "n", "s1", "s2", "keys", "odd"])
    return run


_SALT = 0x5851F42D4C957F2D


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b, link`` of the pairs (a, b), from their full sets."""
    def run(batches):
        last = (None, None)
        for batch in batches:
            ids, ta, tb = batch.column("a"), batch.column("_ta"), batch.column("_tb")
            link = []
            for x, p, q in zip(ids.to_pylist(), ta, tb):
                p = p.as_py()
                if last[0] != p:
                    last = (p, shingles(p, words))
                link.append(linked(last[1], shingles(q.as_py(), words), percent))
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("b"), pa.array(link, pa.bool_())], names=["a", "b", "link"])

    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta")), "a")
                 .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb")), "b"))
    return both.select("a", "b", "_ta", "_tb").mapInArrow(
        tidy(run), "a long, b long, link boolean")


def _possible(x: str, y: str, percent: int):
    """False only where sizes and parity sketches rule a link out: sets whose
    similarity is at least percent / 100 differ in so many elements at most."""
    apart = sum((F.bit_count(F.get(f"{x}odd", i).bitwiseXOR(F.get(f"{y}odd", i)))
                 for i in range(SKETCH // 64)), F.lit(0))
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (apart * (100 + percent) <= (n + m) * (100 - percent)))


def _label(df: DataFrame, label: DataFrame, node: str, out: str) -> DataFrame:
    own = label.select(F.col("node").alias(node), F.col("component").alias("_c"))
    return df.join(own, node, "left").withColumn(out, F.coalesce("_c", node)).drop("_c")


def _strays(members: DataFrame, label: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(``key, m, l, p``: the members outside the largest component of their
    bucket, their component and a member of the largest; the labelled members)."""
    labelled = _label(members, label, "m", "l")
    parts = labelled.groupBy("key", "l").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("m", F.xxhash64("m", F.lit(turn))).alias("p"))
    top = parts.groupBy("key").agg(F.max(F.struct("n", "l", "p")).alias("t"), F.count(F.lit(1)).alias("parts"))
    top = top.where("parts > 1").select(F.col("key").alias("_key"), F.col("t.l").alias("_top"), F.col("t.p").alias("p"))
    strays = labelled.join(top, (F.col("key") == F.col("_key")) & (F.col("l") != F.col("_top")))
    return written(strays.select("key", "m", "l", "p"), "strays"), labelled


def _new(pairs: DataFrame, done: DataFrame | None, sizes: DataFrame, texts: DataFrame,
         words: int, percent: int):
    """(links among the pairs that are not done yet, all pairs done)."""
    pairs = pairs.distinct()
    if done is not None:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    pairs = written(pairs, "pairs")
    may = pairs
    for k in ("a", "b"):
        may = may.join(sizes.select(F.col("doc_id").alias(k), F.col("n").alias(f"{k}_n"),
                                    F.col("odd").alias(f"{k}_odd")), k)
    may = may.where(_possible("a_", "b_", percent)).select("a", "b")
    found = written(_confirm(may, texts, words, percent).where("link").select("a", "b"), "links")
    return found, pairs if done is None else done.unionByName(pairs)


def _merge(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after these further links: components of components."""
    both = _label(_label(links, label, "a", "a_l"), label, "b", "b_l")
    up = components(both.select("a_l", "b_l"), "a_l", "b_l")
    top = up.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = (label.join(top, "component", "left")
                .select("node", F.coalesce("_to", "component").alias("component")))
    return written(old.unionByName(up.join(label, "node", "left_anti").select("node", "component"))
                   .distinct(), "labels")


def _components(docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, component`` of the representatives that are linked with others."""
    members = reps.select(F.col("doc_id").alias("m"), F.explode("keys").alias("key"))
    smallest = members.groupBy("key").agg(F.min("m").alias("c"), F.max("m").alias("_top"))
    smallest = smallest.where(F.col("c") != F.col("_top")).select("key", "c")
    members = written(members.join(smallest, "key").distinct(), "buckets")

    near = members.select("m").distinct()
    sizes = written(reps.join(near, reps["doc_id"] == near["m"], "left_semi")
                    .select("doc_id", "n", "odd").distinct(), "sizes")
    texts = docs.join(near, docs["doc_id"] == near["m"], "left_semi").select("doc_id", "text")
    texts = written(texts.distinct(), "texts")

    # first pairs: every member with the smallest of its bucket
    pairs = members.where("m != c").select(F.col("c").alias("a"), F.col("m").alias("b"))
    found, done = _new(pairs, None, sizes, texts, words, percent)
    label = components(found)
    # then strays with members drawn anew in every round, and in the end with all
    # of other components
    members = members.select("key", "m")
    for turn in range(PIVOTS):
        strays, _ = _strays(members, label, turn)
        drawn = strays.groupBy("key").agg(
            F.min_by(F.struct("m", "l"), F.xxhash64("m", F.lit(turn))).alias("d"))
        drawn = drawn.select("key", F.col("d.m").alias("q"), F.col("d.l").alias("ql"))
        among = strays.join(drawn, "key").where(F.col("l") != F.col("ql")).select("m", F.col("q").alias("p"))
        pairs = strays.select("m", "p").unionByName(among)
        found, done = _new(pairs.select(F.least("m", "p").alias("a"), F.greatest("m", "p").alias("b")),
                           done, sizes, texts, words, percent)
        links = found.count()
        if links:
            label = _merge(label, found)
        if links * FEW < strays.count():
            break
    strays, labelled = _strays(members, label, PIVOTS)
    of = sizes.select(F.col("doc_id").alias("m"), "n", "odd")
    x = strays.join(of, "m").select("key", *[F.col(k).alias(f"x_{k}") for k in ("m", "n", "l", "odd")])
    y = labelled.join(strays.select("key").distinct(), "key").join(of, "m")
    across = (x.join(y, (x["key"] == y["key"]) & (F.col("x_l") != F.col("l")) & _possible("x_", "", percent))
               .select(F.least("x_m", "m").alias("a"), F.greatest("x_m", "m").alias("b")))
    found, _ = _new(across, done, sizes, texts, words, percent)
    if not found.isEmpty():
        label = _merge(label, found)
    return label


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    bands: int = BANDS) -> DataFrame:
    """``doc_id, _h, n_shingles, component_id, kept`` for every row of ``docs``
    (doc_id must be a whole number); _h tells rows of one doc_id apart."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"))
    rows = written(docs.mapInArrow(
        tidy(_sketch(words, bands)), "doc_id long, _h long, n long, s1 long, s2 long, keys array<long>, "
                           "odd array<long>"),
        "minmax")
    real = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = real.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    reps = (real.join(classes.select("s1", "s2", "n", F.col("rep").alias("doc_id")),
                      ["s1", "s2", "n", "doc_id"]))
    with scratch(docs.sparkSession):
        label = written(_components(docs, reps, words, percent), "labels", keep=True)

    found = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = join_on(rows.select("doc_id", "_h", "n", "s1", "s2"), found, ("s1", "s2", "n"), "left")
    comp = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(),
                  F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "_h", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every group of near-duplicates.  Rows are
    compared as a whole only where a kept document stands more than once."""
    kept = near_duplicates(docs, words, percent).where("kept")
    kept = kept.groupBy("doc_id", "_h").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("s"))
    own = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))
    both = boxed(docs).join(kept, F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (own == F.col("_h")))
    once = (F.col("n") == 1) | (F.col("s") == 0) | F.col("doc_id").isNull()
    again = both.where(~once).dropDuplicates(["doc_id", "_h"])
    return both.where(once).unionAll(again).select(*unboxed(docs.columns))
