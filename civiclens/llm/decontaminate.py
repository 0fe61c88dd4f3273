"""Benchmark decontamination with DataFrame functions only.

Words are runs of ASCII digits, letters and non-ASCII characters after A-Z are
lower-cased.  A benchmark item gives all its windows of ``n`` consecutive
words, a shorter item is one window.  The set of window hashes is broadcast
(its size is checked; a larger set is cut into blocks by hash that are
broadcast one after the other) with every place where a block of half a window
can stand in it; the documents' blocks are looked up, and a hit counts only if
all words of the window are equal.

Defined results: a null text has no words; an item without words has no
window; repeated documents get the same result each; repeated benchmark rows
count as one item; a null item_id is written as an empty string; an empty
benchmark marks nothing; an empty document table gives an empty result.
Columns other than the named ones are never read by ``scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import ascii_lower, boxed, join_on, keyed, unboxed, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_ROWS = 150_000  # rows broadcast at a time: some 30 MB


def words(text: Column) -> Column:
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, NOT_WORD), "")  # empty ones stand at the ends only


def _probes(n: int):
    """Blocks of the array column ``_w`` to look up for windows of n words.

    Every window of n words holds exactly one block of n // 2 words (at least
    one) that starts at a place of this progression, so these blocks find all
    windows with a fraction of the lookups."""
    size = max(1, n // 2)

    def one(i):
        return F.struct(i.alias("at"), F.xxhash64(F.slice("_w", i, size), F.lit(n)).alias("hash"))
    return F.when(F.size("_w") >= n, F.transform(
        F.sequence(F.lit(1), F.size("_w") - (size - 1), F.lit(n - size + 1)), one))


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """``item, win_words``: the distinct windows of every item."""
    w = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                          words(F.col("text")).alias("_w")))
    size = F.least(F.size("_w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("_w") - size + 1)
    return (w.where(F.size("_w") > 0)
             .select("item", F.explode(F.transform(starts, lambda i: F.slice("_w", i, size)))
                     .alias("win_words")).distinct())


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(hits, items): ``doc_id, _h, pos, len, win`` for every occurrence of a
    benchmark window (pos counts words from 1), and ``win, item``."""
    wins = written(benchmark_windows(benchmark, n)
                   .withColumn("win", F.sha2(F.concat_ws(" ", "win_words"), 256)), "bench-windows")
    # Every window can be met at each of its blocks that a probe can start.
    size = F.size("win_words")
    block = F.greatest(F.floor(size / 2).cast("int"), F.lit(1))
    table = (wins.select("win", "win_words").distinct()
                 .withColumn("_o", F.explode(F.sequence(F.lit(0), size - block)))
                 .withColumn("_hash", F.xxhash64(F.slice("win_words", F.col("_o") + 1, block), size)))
    table = written(table, "bench-blocks")
    lengths = [r[0] for r in wins.select(F.size("win_words")).distinct().collect()]  # at most n
    blocks = max(1, -(-table.count() // BLOCK_ROWS))
    # explode(array(x)) keeps the optimizer from moving the word split into
    # the lambda below, where it would run once per block
    rows = keyed(docs).select("doc_id", "_h", F.explode(F.array(words(F.col("text")))).alias("_w"))
    none = F.array().cast("array<struct<at:int,hash:bigint>>")
    parts = [F.coalesce(_probes(k), none) for k in sorted(lengths)]
    rows = rows.select("doc_id", "_h", "_w", (F.concat(*parts) if parts else none).alias("_x"))
    rows = rows.select("doc_id", "_h", "_w", F.explode("_x").alias("_x"))
    found = None
    for b in range(blocks):
        part = F.broadcast(table.where(F.pmod("_hash", F.lit(blocks)) == b))
        pos = F.col("_x.at") - F.col("_o")
        same = F.slice("_w", F.greatest(pos, F.lit(1)), F.size("win_words")) == F.col("win_words")
        part = rows.join(part, (F.col("_x.hash") == F.col("_hash")) & (pos > 0) & same).select(
            "doc_id", "_h", pos.alias("pos"), F.size("win_words").alias("len"), "win")
        found = part if found is None else found.unionByName(part)
    return written(found, "bench-hits"), wins.select("win", "item")


def _covered(spans: Column) -> Column:
    """Number of words inside any of the sorted (pos, len) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, s):
        end = s["pos"] + s["len"]
        fresh = F.greatest(end - F.greatest(s["pos"], acc["end"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))
    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def spans(found: DataFrame) -> DataFrame:
    """``doc_id, _h, spans``: the sorted (pos, len) hits of every document hit."""
    return found.groupBy("doc_id", "_h").agg(
        F.sort_array(F.collect_set(F.struct("pos", "len"))).alias("spans"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted array), spans."""
    found, items = hits(docs, benchmark, n)
    named = (found.select("doc_id", "_h", "win").distinct().join(items, "win")
                  .groupBy("doc_id", "_h").agg(F.sort_array(F.collect_set("item")).alias("items")))
    marked = join_on(spans(found), named, ("doc_id", "_h"))
    marked = marked.withColumn("n_hit", _covered(F.col("spans")))
    counted = keyed(docs).select("doc_id", "_h", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = join_on(counted, marked, ("doc_id", "_h"), "left")
    return out.select("doc_id", "n_words",
                      F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("spans", F.array().cast("array<struct<pos:int,len:int>>")).alias("spans"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    found, _ = hits(docs, benchmark, n)
    bad = found.select("doc_id", "_h").distinct()
    own = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))
    kept = boxed(docs).join(bad, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (own == F.col("_h")), "left_anti")
    return kept.select(*unboxed(docs.columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` with the words hit, and what stands between them, cut out of
    the texts: a run of hit words goes from the start of its first word to the
    end of its last."""
    found, _ = hits(docs, benchmark, n)
    own = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))
    both = boxed(docs).join(spans(found).select("doc_id", "_h", F.col("spans").alias("_spans")),
                            F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (own == F.col("_h")), "left")
    # The text as (gap, word) pairs; A-Z count as word characters here, as
    # the letters they are lower-cased to do.
    token = r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
    pairs = F.struct(F.regexp_extract_all("row.text", F.lit(token), F.lit(0)).alias("tok"),
                     F.regexp_extract_all("row.text", F.lit(token), F.lit(1)).alias("gap"))
    both = both.withColumn("_t", F.explode(F.array(F.when(F.col("_spans").isNotNull(), pairs))))
    zero = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("out"))

    def cut(acc, s):
        start = F.greatest(acc["next"], F.lit(1))
        before = F.array(F.array_join(F.slice("_t.tok", start, F.greatest(s["pos"] - start, F.lit(0))), ""),
                         F.get("_t.gap", s["pos"] - 1))
        return F.struct(F.greatest(acc["next"], s["pos"] + s["len"]).alias("next"),
                        F.when(s["pos"] > acc["next"], F.concat(acc["out"], before))
                         .otherwise(acc["out"]).alias("out"))

    def end(acc):
        rest = F.slice("_t.tok", F.greatest(acc["next"], F.lit(1)), F.size("_t.tok"))
        return F.concat(F.array_join(acc["out"], ""), F.array_join(rest, ""))
    text = (F.when(F.col("_spans").isNull(), F.col("row.text"))
             .otherwise(F.aggregate("_spans", zero, cut, end)))
    return both.select(*unboxed(docs.columns, text=text))
