"""Phrase collocations by marginalising the longest word windows.

Texts are cut into pieces at punctuation and line ends, pieces into words.  Every
word opens one window: itself and its leads within the piece, ``order`` words at
most.  Only these windows are counted.  A ROLLUP over the window's columns then
sums all shorter prefixes: the last level gives the phrases of ``order`` words, the
level before it those with one word less, and so on to the single words and the
number of words of a language.  No n-grams of other lengths are made.

Windows are padded (cut short) where the piece ends, and also where no phrase can
go on: a phrase that stands ``min_count`` times consists of shorter runs that do.
Runs of one to ``order`` words are counted in ``CELLS`` saturating cells by a hash; a cell below ``min_count`` proves that all of its runs are too rare.  That table
has a fixed size (64 MB a task, 8 MB as bits on the driver and in the workers),
whatever the corpus.  It only saves windows: counts are of the words themselves, and
exact.  With far more than ten runs to a cell it saves nothing any more.

A candidate has 2 to ``order`` words and a = f(phrase) >= ``min_count``.  For its cut
after k words, l = f(first part) and r = f(rest), score = floor(2000000 a / (l + r));
the lowest score counts (ties: smallest k).  Candidates that stand within a longer
candidate b with 100 f(b) >= ``inside`` a are dropped.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count each time; ties of score and a go by the phrase in UTF-8 byte
order; texts of any length are read whole, in blocks that end between pieces (a piece
is never cut); an empty table gives an empty result; only text and lang are read,
so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclens.llm.common import small_batches, tidy, written
from civiclens.llm.shingles import _powers, mix
from civiclens.operators._plan import task_count

CELLS = 1 << 26
SALTS = 8  # parts in which the windows of equal first words are dealt
ROW = 1 << 16  # cells of a row of the table
BLOCK = 2 << 20  # bytes of text handled at once
KEPT = 800_000  # windows counted in a task before they are handed on

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 word, 1 space, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _blocks(batch: pa.RecordBatch):
    """(bytes, document starts, language of each document) of blocks of whole
    pieces, some BLOCK bytes each."""
    text, lang = batch.column("text"), batch.column("lang").to_pylist()
    edges = np.zeros(len(text) + 1, np.int64)
    parts = [b"" if t is None else t.encode() for t in text.to_pylist()]
    np.cumsum([len(p) for p in parts], out=edges[1:])
    data = np.frombuffer(b"".join(parts), np.uint8)
    a = 0
    while a < len(data):
        e = a + BLOCK
        if e >= len(data):
            e = len(data)
        else:
            ends = np.flatnonzero(_KIND[data[a:e]] == 2)
            doc = int(edges[np.searchsorted(edges, e, "right") - 1])
            cut = max(a + int(ends[-1]) + 1 if len(ends) else a, doc)
            if cut <= a:  # a piece longer than a block
                ends = np.flatnonzero(_KIND[data[e:]] == 2)
                cut = min(e + int(ends[0]) + 1 if len(ends) else len(data),
                          int(edges[np.searchsorted(edges, e, "right")]))
            e = cut
        first, last = np.searchsorted(edges, a, "right") - 1, np.searchsorted(edges, e, "left")
        yield data[a:e], np.maximum(edges[first:last] - a, 0), lang[first:last]
        a = e


class Words:
    """The words of a block: lower-cased bytes, first and last places, document."""

    def __init__(self, data, starts, langs):
        self.bytes, kind = _LOWER[data], _KIND[data]
        word = kind == 0
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        inner = starts[(starts > 0) & (starts < len(data))]
        begin[inner] = word[inner]
        end[inner - 1] = word[inner - 1]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.doc = np.searchsorted(starts, self.begin, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.begin]
        # whether the next word stands in the same piece, one space away
        self.go_on = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.plain = (self.begin[1:] - self.end[:-1] == 1) & (self.bytes[self.end[:-1]] == 32)
        self.langs = ["und" if x is None else x for x in langs]

    def cells(self, longest: int):
        """For runs of 1 to ``longest`` words: the place of the first word of those
        that stand in one piece, and their cells."""
        power, inverse = _powers(len(self.bytes) + 1)
        sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[:len(self.bytes)], out=sums[1:])
        word = mix((sums[self.end] - sums[self.begin]) * inverse[self.begin])
        salt = np.array([zlib.crc32(x.encode()) for x in self.langs] or [0], np.uint64)[self.doc]
        run, first = mix(word + (salt << np.uint64(20))), np.arange(len(word))
        for k in range(1, longest + 1):
            yield first, (run % np.uint64(CELLS)).astype(np.int64)
            stay = first[:-1] if len(first) and first[-1] == len(word) - k else first
            on = self.go_on[stay + k - 1]
            run = mix(run[:len(stay)][on] * np.uint64(31) + word[stay[on] + k])
            first = stay[on]


def _count_runs(longest: int):
    """One row for every ROW cells of the task's table of runs, compressed."""
    def run(batches):
        table = np.zeros(CELLS, np.uint8)
        for batch in batches:
            for block in _blocks(batch):
                w = Words(*block)
                for _, cells in w.cells(longest) if len(w.begin) else ():
                    cell, n = np.unique(cells, return_counts=True)
                    table[cell] = np.minimum(table[cell] + n, 255)
        rows = table.reshape(-1, ROW)
        for i in np.flatnonzero(rows.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([zlib.compress(rows[i].tobytes(), 1)], pa.binary())],
                names=["part", "cells"])
    return run


def _often(least: int):
    """Sum the rows of each part (at most the whole table in a task), and keep
    a bit for every cell that reaches ``least``."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                cells = np.frombuffer(zlib.decompress(cells), np.uint8)
                sums[i] = np.minimum(sums[i].astype(np.int16) + cells, 255).astype(np.uint8) if i in sums else cells
        for i, cells in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([np.packbits(cells >= least).tobytes()], pa.binary())],
                names=["part", "cells"])
    return run


def frequent_runs(docs: DataFrame, longest: int, min_count: int) -> np.ndarray:
    """Bits of the cells whose runs stand ``min_count`` times or more together."""
    parts = CELLS // ROW
    cells = docs.select("text", "lang").mapInArrow(tidy(_count_runs(longest)), "part int, cells binary")
    cells = cells.repartition(min(parts, task_count(docs)), "part").mapInArrow(
        tidy(_often(min(min_count, 255))), "part int, cells binary")
    bits = np.zeros((parts, ROW // 8), np.uint8)
    for row in cells.collect():  # a bit a cell
        bits[row["part"]] = np.frombuffer(row["cells"], np.uint8)
    return bits.reshape(-1)


def _window_sizes(w: Words, often: np.ndarray, order: int) -> np.ndarray:
    """The number of words of the window that each word opens: 0 if the word
    itself is too rare."""
    n = len(w.begin)
    ok = {}
    for k, (first, cell) in enumerate(w.cells(order), 1):
        ok[k] = np.zeros(n + order, bool)
        ok[k][first] = (often[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    on = np.append(w.go_on, np.zeros(order + 1, bool))
    place, size, grow = np.arange(n), ok[1][:n].astype(np.int64), ok[1][:n]
    for new in range(1, order):  # one more word, and the runs that end with it
        grow = grow & on[place + new - 1]
        for k in range(1, new + 2):
            grow = grow & ok[k][place + new - k + 1]
        size += grow
    return size


def _count_windows(bits, order: int):
    """``lang, window, n``: windows are joined by single spaces; the empty one
    stands for words that are too rare."""
    def counted(counts):
        for lang, c in counts.items():
            windows, n = iter(c), iter(c.values())
            while part := list(islice(windows, 50_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array(list(islice(n, 50_000)), pa.int64())], names=["lang", "window", "n"])

    def run(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for block in _blocks(batch):
                w = Words(*block)
                if not len(w.begin):
                    continue
                size = _window_sizes(w, bits.value, order)
                last = np.arange(len(size)) + np.maximum(size, 1) - 1
                odd = np.concatenate([[0], np.cumsum(~w.plain)])  # gaps that are no single space
                strange = odd[last] > odd[:len(size)]
                raw = w.bytes.tobytes()
                names, code = np.unique(w.langs, return_inverse=True)
                code = code[w.doc]
                by_lang = np.argsort(code, kind="stable")
                ends = np.searchsorted(code[by_lang], np.arange(len(names) + 1))
                for j, lang in enumerate(names.tolist()):
                    own = by_lang[ends[j]:ends[j + 1]]
                    c = counts.setdefault(lang, Counter())
                    c[b""] += int((size[own] == 0).sum())
                    own = own[size[own] > 0]
                    a, e, plain = w.begin[own], w.end[last[own]], ~strange[own]
                    c.update([raw[x:y] for x, y in zip(a[plain].tolist(), e[plain].tolist())])
                    c.update([b" ".join(raw[x:y].split()) for x, y in zip(a[~plain].tolist(), e[~plain].tolist())])
                if sum(map(len, counts.values())) > KEPT:
                    yield from counted(counts)
                    counts = {}
        yield from counted(counts)
    return run


def count_phrases(docs: DataFrame, order: int = 4, min_count: int = 30) -> DataFrame:
    """``lang, k, phrase, f``: all phrases of 1 to ``order`` words that stand
    ``min_count`` times or more, and with k = 0 the number of words of each lang."""
    docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    sc = docs.sparkSession.sparkContext
    # several splits to a task: the more text it has seen, the fewer windows and cells
    # it hands on for each
    splits = docs.rdd.getNumPartitions()
    docs = docs.coalesce(min(splits, max(2 * sc.defaultParallelism, splits // 4)) or 1)
    with small_batches(docs.sparkSession):
        bits = sc.broadcast(frequent_runs(docs, order, min_count))
        windows = docs.mapInArrow(tidy(_count_windows(bits, order)), "lang string, window string, n long")
        # Dealt by all words but the last two and a part of the last but one: the two
        # longest levels are final in place, the next is nearly so, and the windows
        # of a very common beginning still go to several tasks.
        parts = F.split(F.nullif("window", F.lit("")), " ")
        windows = windows.select(
            "lang", F.array_join(F.slice(parts, 1, order - 2), " ").alias("stem"),
            F.get(parts, order - 2).alias("next"), F.get(parts, order - 1).alias("tail"), "n")
        windows = windows.withColumn("salt", F.pmod(F.hash("next"), SALTS))
        windows = (windows.repartition("lang", "stem", "salt").groupBy("lang", "stem", "salt", "next", "tail")
                          .agg(F.sum("n").alias("n")))
        # windows are padded once more where the phrase is too rare to be told:
        # sums of prefixes stay, and the levels below ship far fewer rows
        m = F.sum("n").over(Window.partitionBy("lang", "stem", "salt", "next"))
        windows = windows.withColumn("m", m)
        words, stem = [f"w{i + 1}" for i in range(order)], F.split(F.nullif("stem", F.lit("")), " ")
        often = F.col("m") >= min_count
        columns = [F.get(stem, i) for i in range(order - 2)]
        columns += [F.when(often, F.col("next")), F.when(often & (F.col("n") >= min_count), F.col("tail"))]
        windows = windows.select("lang", "n", *[c.alias(w) for c, w in zip(columns, words)])
        levels = windows.rollup("lang", *words).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
        # g has a bit for every column that was summed away, the last word lowest
        k = F.lit(None).cast("int")
        for i, w in enumerate(["lang", *words]):
            here = (F.col("g") == (1 << (order - i)) - 1) & (F.lit(i == 0) | F.col(w).isNotNull())
            k = F.when(here & ((F.col("f") >= min_count) | F.lit(i == 0)), i).otherwise(k)
        levels = levels.select("lang", k.alias("k"), F.concat_ws(" ", *words).alias("phrase"), "f")
        return written(levels.where(F.col("k").isNotNull()), "phrases")


def _exact(c):
    return F.col(c).cast("decimal(38,0)")


def collocations(docs: DataFrame, order: int = 4, min_count: int = 30, inside: int = 80,
                 top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` of each language."""
    counts = count_phrases(docs, order, min_count)
    phrases = counts.where("k > 0").select("lang", "phrase", "f")
    found = counts.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k",
                                         F.split("phrase", " ").alias("w"))

    # candidates that stand within longer ones
    spans = F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1),
                              lambda i: F.array_join(F.slice("w", i, n), " ")))
    longer = (found.where("k > 2").select("lang", F.col("a").alias("b"), F.explode(F.flatten(spans)).alias("phrase"))
                   .groupBy("lang", "phrase").agg(F.max("b").alias("b")))
    found = (found.join(longer, ["lang", "phrase"], "left")
                  .where(F.col("b").isNull() | (_exact("b") * 100 < _exact("a") * inside)))

    # the cut with the lowest score
    cuts = found.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("_l"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("_r"))
    for part, count in (("_l", "l"), ("_r", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)),
                         ["lang", part])
    score = F.expr("(cast(a as decimal(38,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    best = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))
                .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))

    place = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()))
    best = best.withColumn("rank", place).where(F.col("rank") <= top)
    words = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                           "a", "l", "r", "n", "score")
