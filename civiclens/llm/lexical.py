"""Ranked lexical search by branch and bound over document FP-trees.

1. A document is restricted to the terms that some item of the block holds: its
   vector of (term, tf).  With it go its length n, and from all documents come N, L
   and every term's df.
2. Each Arrow batch of vectors is made a frequency-ordered prefix tree: a document is
   the path of its terms by falling df, so documents share the nodes of their common
   terms.  Chains of single children are one node; up to ``LEAF`` neighbouring
   documents are a leaf.
3. Every node knows the largest tf of each term below it and the smallest m below it.
   With both, a term's part of the score is at least that of any document below, so
   their weighted sum over an item's terms bounds all scores of the subtree.
4. Each item walks the tree depth first, the child with the highest bound first, and
   leaves out subtrees whose bound is below its k-th best score.  That score is kept
   from batch to batch of a task.
5. A task hands on k documents per item; a window over them ranks the whole.

Items come to the driver in blocks of at most ``BLOCK_TERMS`` (item, term) pairs, the
vocabulary that a worker holds; each block is one pass over the documents.

Defined results: a null or empty text has no terms and is neither counted nor found;
an item without terms (or with terms that no document holds) has no rows; rows that
share an item_id are one item with the terms of all of them, null included; rows that
share a doc_id are documents of their own; a null doc_id comes behind the others of
equal score; long texts are read in parts of some megabytes; an empty table on either
side gives an empty result; only doc_id (a whole number), text, item_id and text are
read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens.llm.common import tidy, written

BLOCK_TERMS = 1 << 20
LEAF = 32
PART = 4 << 20  # bytes of a text that are split at once
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
              for c in range(256))


def _terms(text: str):
    """Lists of the terms of a text."""
    raw = text.encode().translate(_TERM)
    a = 0
    while a < len(raw):
        e = raw.find(b" ", a + PART) if len(raw) - a > PART else -1
        e = len(raw) if e < 0 else e
        yield raw[a:e].split()
        a = e


def _vectors(vocabulary):
    """``doc_id, n, terms, tfs`` of the documents that have a term."""
    def run(batches):
        place = vocabulary.value.get
        for batch in batches:
            ids, n, ends, terms, tfs = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                size, counts = 0, Counter()
                for words in _terms(text.as_py() or ""):
                    size += len(words)
                    counts.update(map(place, words))
                if size:
                    counts.pop(None, None)
                    ids.append(doc_id)
                    n.append(size)
                    terms += counts.keys()
                    tfs += counts.values()
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])
    return run


def _part(tf, m):
    """A term's part of a score: grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """The FP-tree of some vectors.  ``ends`` cuts ``terms`` (places by falling
    df) and ``tfs`` into documents, none of them empty."""

    def __init__(self, ids, m, ends, terms, tfs):
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.lexsort((terms, doc))
        terms, tfs = terms[order], tfs[order]
        path = terms.astype(">u4").tobytes()  # compares like the list of places
        paths = [path[4 * a:4 * e] for a, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        size = np.diff(ends)[order]
        self.ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(self.ends[-1]) + np.repeat(ends[:-1][order] - self.ends[:-1], size)
        self.ids, self.m, self.terms, self.tfs = ids[order], m[order], terms[at], tfs[at]
        self.parts = _part(self.tfs, np.repeat(self.m, size))
        self._grow(size)

    def _grow(self, size):
        """Nodes as (first document, last, children); children by number."""
        n = len(size)
        common = np.zeros(n + 1, np.int64)  # with the document before
        for i in range(1, n):
            k = min(size[i - 1], size[i])
            a, b = self.ends[i - 1], self.ends[i]
            differ = self.terms[a:a + k] != self.terms[b:b + k]
            j = int(differ.argmax()) if k else 0
            common[i] = j if k and differ[j] else k
        self.nodes = [(0, n, [])]
        todo = [0] if n > LEAF else []
        while todo:
            me = todo.pop()
            lo, hi, children = self.nodes[me]
            inner = common[lo + 1:hi]
            cuts = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
            start = lo
            for a, e in zip(cuts[:-1], cuts[1:]):  # small children that stand together are one
                if e - start > LEAF and a > start:
                    children.append(self._node(start, a))
                    start = a
                if e - start > LEAF or e == hi:
                    children.append(self._node(start, e))
                    if e - start > LEAF:
                        todo.append(children[-1])
                    start = e
        self.bounds = [None] * len(self.nodes)
        for me in range(len(self.nodes) - 1, -1, -1):  # children stand behind their parent
            lo, hi, children = self.nodes[me]
            if children:
                term = np.concatenate([self.bounds[c][0] for c in children])
                tf = np.concatenate([self.bounds[c][1] for c in children])
            else:
                term, tf = self.terms[self.ends[lo]:self.ends[hi]], self.tfs[self.ends[lo]:self.ends[hi]]
            key = np.sort((term.astype(np.int64) << 32) | tf)
            key = key[np.append(np.diff(key >> 32) > 0, True)]  # the largest tf of each term
            self.bounds[me] = key >> 32, key & 0xFFFFFFFF
        # of all children of a node together: term, part, where each child begins
        self.below = {}
        for me, (_, _, children) in enumerate(self.nodes):
            if children:
                both = [self.bounds[c] for c in children]
                begin = np.cumsum([0] + [len(t) for t, _ in both[:-1]])
                parts = [_part(tf, self.m[self.nodes[c][0]:self.nodes[c][1]].min())
                         for c, (_, tf) in zip(children, both)]
                self.below[me] = np.concatenate([t for t, _ in both]), np.concatenate(parts), begin
        del self.bounds

    def _node(self, lo, hi):
        self.nodes.append((lo, hi, []))
        return len(self.nodes) - 1

    def search(self, weight, best) -> None:
        """Hand the documents that may be among the k best to ``best``; weight
        has the item's weight of every term, 0 elsewhere."""
        todo = [(0, _LAST)]
        while todo:
            me, bound = todo.pop()
            if bound < best.least:
                continue
            lo, hi, children = self.nodes[me]
            if children:
                term, part, begin = self.below[me]
                bounds = np.add.reduceat(weight[term] * part, begin)
                go = np.flatnonzero(bounds >= best.least)
                go = go[np.argsort(bounds[go], kind="stable")]  # the highest is popped first
                todo += zip([children[i] for i in go.tolist()], bounds[go].tolist())
            else:
                a, e = self.ends[lo], self.ends[hi]
                scores = np.add.reduceat(weight[self.terms[a:e]] * self.parts[a:e], self.ends[lo:hi] - a)
                good = scores >= best.least
                if good.any():
                    best.add(scores[good], self.ids[lo:hi][good])


class Best:
    """The k highest scores so far, equal ones by smaller doc_id."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores, ids) -> None:
        self.scores, self.ids = np.append(self.scores, scores), np.append(self.ids, ids)
        if len(self.ids) >= self.k:
            order = np.lexsort((self.ids, -self.scores))[:self.k]
            self.scores, self.ids = self.scores[order], self.ids[order]
            self.least = max(1, int(self.scores[-1]))


def _search(query, k: int):
    """``item, doc_id, score``: the k best documents of the task per item."""
    def run(batches):
        place, items, n_docs, n_terms = query.value
        best = [Best(k) for _ in items]
        weight = np.zeros(len(place), np.int64)
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            size = np.array(terms.value_lengths().to_pylist(), np.int64)
            some = size > 0  # others hold no item's term
            if not some.any():
                continue
            n = batch.column("n").to_numpy()[some]
            ids = batch.column("doc_id").fill_null(_LAST).to_numpy()[some]
            tree = Tree(ids, 50 + (50 * n * n_docs) // n_terms, np.concatenate([[0], np.cumsum(size[some])]),
                        place[terms.flatten().to_numpy()], tfs.flatten().to_numpy())
            for (own, w), b in zip(items, best):
                weight[own] = w
                tree.search(weight, b)
                weight[own] = 0
        for i, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.ids), i), pa.int32()),
                     pa.array(b.ids, pa.int64(), mask=b.ids == _LAST), pa.array(b.scores, pa.int64())],
                    names=["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, block_terms: int):
    """Lists of (item_id, its terms) of at most ``block_terms`` terms in all;
    one item is never cut."""
    block, size = [], 0
    for row in items.orderBy("item_id").toLocalIterator():
        terms = {w for words in _terms(row["text"] or "") for w in words}
        if block and block[-1][0] == row["item_id"]:
            block[-1][1].update(terms)
        else:
            if block and size + len(terms) > block_terms:
                yield block
                block, size = [], 0
            block.append((row["item_id"], terms))
        size += len(terms)
    if block:
        yield block


def _search_block(spark: SparkSession, docs: DataFrame, block, k: int, id_field) -> DataFrame:
    """``item_id, rank, doc_id, score`` of one block of items."""
    sc = spark.sparkContext
    names = sorted({t for _, terms in block for t in terms})
    at = {t: i for i, t in enumerate(names)}
    vectors = written(docs.mapInArrow(
        tidy(_vectors(sc.broadcast(at))), "doc_id long, n long, terms array<int>, tfs array<long>"), "vectors")
    whole = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(names), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[row["t"]] = row["count"]  # one row for each term of the block
    weight = np.array([math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * d + 1)))
                       for d in df.tolist()], np.int64)
    place = np.zeros(len(names), np.int64)
    place[np.lexsort((np.arange(len(names)), -df))] = np.arange(len(names))
    own = [np.array(sorted(at[t] for t in terms), np.int64) for _, terms in block]
    query = sc.broadcast((place, [(place[o], weight[o]) for o in own], whole["docs"], whole["terms"] or 1))
    found = vectors.mapInArrow(tidy(_search(query, k)), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)],
                                T.StructType([T.StructField("item", T.IntegerType()), id_field]))
    return found.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select("item_id", "text")
    id_field = T.StructField("item_id", items.schema["item_id"].dataType)
    found = [_search_block(spark, docs, block, k, id_field) for block in _blocks(items, block_terms)]
    if not found:
        return spark.createDataFrame([], T.StructType([
            id_field, T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionAll, found)
