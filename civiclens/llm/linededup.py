"""Line deduplication by pairwise alignment (patience diff).

Two documents overlap when they share a key: the hash of a shortest run of
neighbouring lines that has ``block_words`` words, often a single line.  Each
line, an empty one too, is the first of such a run and the last of another, so
two documents with a common block have its runs in common, and every line of it
is in one of them.  A rare key, held by at most ``rare`` documents, makes a pair
of every two of them; of a key that more documents hold, each is paired with the
first of them, so the number of pairs stays in proportion to the number of
lines, and no run is left out.  The lines of a pair are aligned: lines that both
documents hold once are anchors, their longest increasing sequence cuts the rest
into gaps, and equal lines at a gap's ends are matched as well.  A block of
aligned neighbouring lines with ``block_words`` words or more is deleted from
the document with the larger doc_id.  Where equal lines are left there (blocks
that stand several times in either document, or in another order), the rest is
aligned again, now by its runs and the number of times they have stood before,
until no run is left that the other document holds.  So a line goes exactly if it
is in a run of neighbouring lines with ``block_words`` words or more that a
document with a smaller doc_id holds as well.

Blocks are judged on the input texts, not on what other pairs leave.

Defined results: a null text has no lines and stays null; an empty one has one
empty line; lines are compared without white space at their ends; rows that
share a doc_id are not compared with each other; rows with a null doc_id stay
as they are; an empty table gives an empty result; other columns are kept, and
none of their names can clash: a count whose name is taken gets a name with ``_``
behind it (``common.free_name``).
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import boxed, free_name, scratch, tidy, unboxed, written
from civiclens.llm.shingles import mix

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest sequence of (i, j), sorted by i, whose j rise as well."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back[k] = at[p - 1] if p else -1
        if p == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], both rising."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, ie, j, je = todo.pop()
        while i < ie and j < je and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < ie and j < je and a[ie - 1] == b[je - 1]:
            ie, je = ie - 1, je - 1
            out.append((ie, je))
        if i >= ie or j >= je:
            continue
        once: dict = {}
        for k in range(i, ie):
            once[a[k]] = -1 if a[k] in once else k
        seen: dict = {}
        for k in range(j, je):
            if once.get(b[k], -1) >= 0:
                seen[b[k]] = -1 if b[k] in seen else k
        anchors = _increasing(sorted((once[h], k) for h, k in seen.items() if k >= 0))
        if not anchors:
            continue
        for (x, y), (xe, ye) in zip([(i - 1, j - 1), *anchors], [*anchors, (ie, je)]):
            todo.append((x + 1, xe, y + 1, ye))
        out += anchors
    return sorted(out)


def aligned_blocks(a: list, b: list, b_words: list[int], block_words: int) -> list[tuple[int, int]]:
    """[start, end) of the lines of b in aligned blocks of enough words."""
    out, start, last, n = [], None, None, 0
    for i, j in [*patience(a, b), (-2, -2)]:
        if last is not None and (i, j) == (last[0] + 1, last[1] + 1):
            n += b_words[j]
        else:
            if last is not None and n >= block_words:
                out.append((start, last[1] + 1))
            start, n = j, b_words[j] if j >= 0 else 0
        last = (i, j)
    return out


def runs(lines: np.ndarray, words: np.ndarray, block_words: int) -> tuple[np.ndarray, ...]:
    """First line, last line and key of the shortest runs of ``block_words``
    words that start or end at each line; ``lines`` are their hashes (uint64).
    A longer run is the union of those inside it."""
    n = len(lines)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    here = np.arange(n)
    upto = np.cumsum(words, dtype=np.int64)
    before = upto - words
    end = np.searchsorted(upto, before + block_words)
    start = np.searchsorted(before, upto - block_words, "right") - 1
    s = np.r_[here[end < n], start[start >= 0]]
    e = np.r_[end[end < n], here[start >= 0]]
    # the polynomial of a run from prefix sums, shifted back to its first line
    shrink = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BACK, np.uint64)])
    grow = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum(lines * shrink, dtype=np.uint64)]
    return s, e, mix((total[e + 1] - total[s]) * grow[s] + (e - s).astype(np.uint64))


def run_keys(lines: np.ndarray, words: np.ndarray, block_words: int) -> np.ndarray:
    """Keys of the ``runs`` whose first and last line have words."""
    s, e, keys = runs(lines, words, block_words)
    return np.unique(keys[(words[s] > 0) & (words[e] > 0)])


def _seeded(a: list, b: list, has: tuple, left: tuple) -> list[tuple[int, int]]:
    """One more alignment, by runs: ``left`` are runs of b (first line, last line,
    key) that a holds among its own, ``has``.  The k-th time a run stands in b it
    is matched with the k-th time it stands in a (from the front again, if b has
    it more often); the longest sequence that rises in both is aligned."""
    places: dict[int, list[int]] = {}
    for s, key in sorted(set(zip(has[0].tolist(), has[2].tolist()))):
        places.setdefault(key, []).append(s)
    times: dict[int, int] = {}
    pairs, ends = [], {}
    for s, e, key in sorted(set(zip(*(x.tolist() for x in left)))):
        k = times[key] = times.get(key, -1) + 1
        i = places[key][k % len(places[key])]
        if a[i:i + e - s + 1] == b[s:e + 1]:
            pairs.append((i, s))
            ends[s] = max(e, ends.get(s, e))
    # of equal places in a only one can be in a rising sequence
    rising = _increasing(sorted(set(pairs), key=lambda p: (p[0], -p[1])))
    return [(s, ends[s] + 1) for _, s in rising]


def common_spans(a: list, b: list, a_words: list[int], b_words: list[int],
                 block_words: int) -> list[tuple[int, int]]:
    """[start, end) of the lines of b in blocks that are aligned with a: by lines
    first, then what is left of b again by its runs, until none is left that a
    holds."""
    gone = np.zeros(len(b), bool)
    blocks, held = aligned_blocks(a, b, b_words, block_words), set(a)
    has = own = None
    while True:
        for s, e in blocks:
            gone[s:e] = True
        if all(g or h not in held for h, g in zip(b, gone.tolist())):
            break
        if has is None:
            has, own = _shared_runs(a, b, a_words, b_words, block_words)
        covered = np.concatenate([[0], np.cumsum(gone)])
        open_ = covered[own[1] + 1] - covered[own[0]] <= own[1] - own[0]
        blocks = _seeded(a, b, has, tuple(x[open_] for x in own))
        if not blocks:
            break
    cut = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    return list(zip(cut[::2].tolist(), cut[1::2].tolist()))


def _shared_runs(a, b, a_words, b_words, block_words):
    """The runs of both documents that stand in the other as well."""
    has = runs(np.array(a, np.int64).view(np.uint64), np.array(a_words, np.int32), block_words)
    own = runs(np.array(b, np.int64).view(np.uint64), np.array(b_words, np.int32), block_words)
    both = np.intersect1d(has[2], own[2])
    return tuple(tuple(x[np.isin(r[2], both)] for x in r) for r in (has, own))


def _keys(block_words: int):
    def run(batches):
        for b in batches:
            got = [np.unique(runs(h.values.to_numpy().view(np.uint64), w.values.to_numpy(), block_words)[2])
                   for h, w in zip(b.column("lines"), b.column("words"))]
            ids = np.repeat(b.column("doc_id").to_numpy(), [len(k) for k in got])
            flat = np.concatenate(got) if got else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(flat.view(np.int64))], names=["doc_id", "h"])
    return run


def _align(block_words: int):
    def run(batches):
        for b in batches:
            ids, hs, spans = [], [], []
            for doc, h, x, y, v, w in zip(*(b.column(c).to_pylist()
                                            for c in ("b", "_h", "_la", "_lb", "_wa", "_wb"))):
                got = common_spans(x, y, v, w, block_words)
                if got:
                    ids.append(doc)
                    hs.append(h)
                    spans.append([{"s": s, "e": e} for s, e in got])
            span = pa.struct([("s", pa.int32()), ("e", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hs, pa.int64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "_h", "spans"])
    return run


def common_blocks(docs: DataFrame, rare: int = 4, block_words: int = 8) -> DataFrame:
    """``doc_id, _h, spans``: the line ranges [s, e) to delete from documents."""
    with scratch(docs.sparkSession):
        return written(_common_blocks(docs, rare, block_words), "spans", keep=True)


def _common_blocks(docs: DataFrame, rare: int, block_words: int) -> DataFrame:
    line = F.split(F.col("text"), "\n")
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_h"),
        F.transform(line, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")).alias("_t"))
    rows = rows.select("doc_id", "_h", F.transform("_t", lambda x: F.xxhash64(x)).alias("lines"),
                       F.transform("_t", lambda x: F.when(x == "", 0).otherwise(
                           F.size(F.split(x, r"\s+")))).alias("words"))
    rows = written(rows.distinct(), "lines")
    held = rows.select("doc_id", "lines", "words").mapInArrow(
        tidy(_keys(block_words)), "doc_id long, h long").distinct()
    shared = (held.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("a"))
                  .where("df > 1"))
    held = written(held.join(shared, "h"), "shared-runs")
    few = held.where(F.col("df") <= rare)
    pairs = (held.where("doc_id > a").select("a", F.col("doc_id").alias("b"))
             .unionByName(few.select("h", F.col("doc_id").alias("_a")).join(
                 few.select("h", F.col("doc_id").alias("b")), "h").where("_a < b")
                 .select(F.col("_a").alias("a"), "b")).distinct())
    both = (pairs.join(rows.select(F.col("doc_id").alias("a"), F.col("lines").alias("_la"),
                                   F.col("words").alias("_wa")), "a")
                 .join(rows.select(F.col("doc_id").alias("b"), "_h", F.col("lines").alias("_lb"),
                                   F.col("words").alias("_wb")), "b"))
    found = both.select("b", "_h", "_la", "_lb", "_wa", "_wb").mapInArrow(
        _align(block_words), "doc_id long, _h long, spans array<struct<s:int,e:int>>")
    return (found.groupBy("doc_id", "_h").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")))


def dedup_lines(docs: DataFrame, rare: int = 4, block_words: int = 8,
                counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with the common blocks cut from ``text``, and with two more
    columns (both long, named by ``counts``): lines there were, lines cut."""
    found = common_blocks(docs, rare, block_words).select(
        F.col("doc_id").alias("id"), F.col("_h").alias("h"), "spans")
    both, old = boxed(docs), F.col("row.text")
    both = both.join(found, (F.col("row.doc_id").cast("long") == F.col("id"))
                     & (F.xxhash64(old) == F.col("h")), "left")
    # explode(array(x)): the split runs once per text, not once per line
    both = both.withColumn("lines", F.explode(F.array(F.split(old, "\n"))))
    gone = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["s"], s["e"] - 1))))
    both = both.withColumn("gone", F.explode(F.array(gone)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("spans").isNull(), old).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    n_lines = F.when(old.isNull(), 0).otherwise(F.size("lines"))
    n_gone = F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0))
    return both.select(*unboxed(docs.columns, text=text),
                       n_lines.cast("long").alias(free_name(counts[0], docs.columns)),
                       n_gone.cast("long").alias(free_name(counts[1], docs.columns)))
