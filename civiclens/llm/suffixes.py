"""Exact removal of repeated byte strings, with a Burrows-Wheeler transform.

Every byte covered by a string of ``width`` bytes that also starts anywhere
else goes.  Texts are too large for one suffix array, so Spark first brings
together what can be equal:

1. Each window of ``width`` bytes names its anchor, the block of ``ANCHOR``
   bytes in it with the smallest hash (the leftmost of equals).  Equal windows
   have equal anchors.  Neighbouring windows with one anchor form a segment.
2. Anchors that occur once are dropped.  Equal segments of an anchor are
   counted before anything is shuffled whole: all their windows are repeated.
3. Where an anchor has different segments, one of each kind is fetched, and
   the segments of whole buckets are joined into texts of some 100 kB.  On
   the text's Burrows-Wheeler transform, intervals of equal prefixes are
   extended backwards breadth-first.  That sets the common prefixes of
   neighbouring suffixes by increasing value; it stops at ``width``, and
   neighbours without a value share at least that much.

An anchor with more than ``CROWD`` kinds of segments is split before: its
windows are dealt by a longer anchor, half of what is missing further to the
left or right, until the buckets are small or windows equal their anchor.

Defined results: a null text has no bytes; shorter texts have no windows;
matches never cross documents, but may lie in one document and may overlap;
repeated rows are repeated strings; cutting may leave bytes that are no UTF-8;
an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import join_on, written
from civiclens.llm.shingles import mix

WIDTH = 200
ANCHOR = 40
CROWD = 2000
TEXT_BYTES = 1 << 17  # of a text that is transformed as one: its arrays fit the cache
PART = (1 << 20) - 1024  # bytes whose windows are dealt with at a time
_LOW = np.uint64((1 << 20) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class _Hashes:
    """Polynomial hashes of ranges of one byte string, from prefix sums."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, b: np.ndarray):
        x = b.astype(np.uint64) + np.uint64(1)
        self.sums, self.inverse = [], []
        for base in _BASES:
            power, inverse = self._powers(base, len(b))
            s = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(x * power[:len(b)], out=s[1:])
            self.sums.append(s)
            self.inverse.append(inverse)

    @classmethod
    def _powers(cls, base, n):
        if base not in cls.tables or len(cls.tables[base][0]) < n:
            n = 1 << max(14, (n - 1).bit_length())
            both = []
            for x in (base, pow(base, -1, 1 << 64)):
                p = np.full(n, x, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            cls.tables[base] = tuple(both)
        return cls.tables[base]

    def blocks(self, size: int) -> np.ndarray:
        """Hash of every block of ``size`` bytes, by the first sums alone."""
        s = self.sums[0]
        return mix((s[size:] - s[:-size]) * self.inverse[0][:len(s) - size])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (end - start).astype(np.uint64)
        for s, inv in zip(self.sums, self.inverse):
            out = mix(out ^ ((s[end] - s[start]) * inv[start]))
        return out


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v) - w + 1
    m = -(-len(v) // w) * w
    full = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    full[:len(v)] = v
    rows = full.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def segments(text: bytes, width: int = WIDTH):
    """(anchor hash, segment hash, first window, last window, anchor place)
    of all segments of a text, as arrays."""
    out = []
    whole = np.frombuffer(text, np.uint8)
    for c in range(0, max(0, len(whole) - width + 1), PART):
        b = whole[c:c + PART + width - 1]
        h = _Hashes(b)
        block = h.blocks(ANCHOR)
        least = _sliding_min((block & ~_LOW) | np.arange(len(block), dtype=np.uint64), width - ANCHOR + 1)
        at = (least & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, len(at) - 1]
        place = at[first]
        out.append((block[place].view(np.int64),
                    h.ranges(first, last + width).view(np.int64), first + c, last + c, place + c))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


OCC = "doc_id long, _h long, key long, seg long, s long, e long, p long"


def _occurrences(width: int):
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 128):
                part = b.slice(a, 128)
                got = [segments(t.as_py().encode("utf-8", "replace"), width) for t in part.column("text")]
                rows = pa.array(np.repeat(np.arange(part.num_rows), [len(g[0]) for g in got]))
                cols = [pa.array(np.concatenate([g[i] for g in got]), pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("_h").take(rows), *cols],
                    names=["doc_id", "_h", "key", "seg", "s", "e", "p"])
    return run


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, _h, z``: texts compressed before they are shuffled."""
    def run(batches):
        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [c.compress((t.as_py() or "").encode("utf-8", "replace")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_h"), pa.array(z, pa.binary())],
                                             names=["doc_id", "_h", "z"])
    return docs.select("doc_id", "_h", "text").mapInArrow(run, "doc_id long, _h long, z binary")


SEG = "key long, doc_id long, _h long, s long, e long, p long, size int, many boolean, bytes binary"


def _fetch(width: int):
    def run(batches):
        d = zstandard.ZstdDecompressor()
        names = [c.split()[0] for c in SEG.split(", ")]
        for b in batches:
            for doc, h, z, want in zip(*(b.column(c) for c in ("doc_id", "_h", "z", "want"))):
                text, rows = d.decompress(z.as_py()), want.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["key"] for r in rows], pa.int64()),
                     pa.array([doc.as_py()] * len(rows), pa.int64()),
                     pa.array([h.as_py()] * len(rows), pa.int64()),
                     *[pa.array([r[c] for r in rows], pa.int64()) for c in "sep"],
                     pa.array([ANCHOR] * len(rows), pa.int32()),
                     pa.array([r["many"] for r in rows], pa.bool_()),
                     pa.array([text[r["s"]:r["e"] + width] for r in rows], pa.binary())], names=names)
    return run


def _split(width: int):
    """Deal the windows of crowded segments by a longer anchor."""
    def run(batches):
        names = [c.split()[0] for c in SEG.split(", ")]
        for b in batches:
            out = []
            for r in b.to_pylist():
                more = max(1, (width - r["size"] + 1) // 2)
                size, base = r["size"] + more, r["s"]
                for s, e, p in ((r["s"], min(r["e"], r["p"] - more), r["p"] - more),
                                (max(r["s"], r["p"] - more + 1), r["e"], r["p"])):
                    if s <= e:
                        # the anchor must lie in all of these windows
                        anchor = r["bytes"][p - base:p - base + size]
                        key = hashlib.blake2b(anchor + bytes([p != r["p"]]), digest_size=8).digest()
                        out.append((int.from_bytes(key, "little", signed=True), r["doc_id"], r["_h"],
                                    s, e, p, size, r["many"], r["bytes"][s - base:e - base + width]))
            cols = zip(*out) if out else [[]] * len(names)
            types = [pa.int64()] * 6 + [pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)
    return run


def transform(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, Burrows-Wheeler transform) of the rotations of a text,
    sorted by ``depth`` symbols at least."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(7):  # seven symbols of nine bits make the first key
        key = key << 9 | np.roll(text, -j)
    done = 7
    while True:
        order = np.argsort(key)
        k = key[order]
        new = np.cumsum(np.r_[0, k[1:] != k[:-1]])
        if done >= depth or new[-1] == n - 1:
            break
        rank = np.empty(n, np.int64)
        rank[order] = new
        key = rank * np.int64(n) + np.roll(rank, -done)
        done *= 2
    return order, text[order - 1]


def repeated(parts: list[bytes], width: int) -> list[np.ndarray]:
    """Per byte string, whether its window at each place occurs again in any."""
    sizes = np.array([len(p) for p in parts])
    text = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8).astype(np.int16) + 1
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0  # between the parts: a symbol that no part holds
    n = len(text)
    order, bwt = transform(text, width + 1)
    back = np.empty(n, np.int64)  # where the rotation one symbol to the left stands
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    open_ = np.ones(n + 1, bool)  # boundaries whose common prefix is unknown
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(width):
        size = hi - lo + 1
        total = int(size.sum())
        if not total:
            break
        # every rotation of every interval, extended to the left
        src = np.repeat(np.arange(len(lo)), size)
        at = back[np.arange(total) + np.repeat(lo - (np.cumsum(size) - size), size)]
        by = np.argsort(at)
        at, src = at[by], src[by]
        # neighbours from one interval and of one symbol form a new interval
        sym = text[order[at]]
        cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (src[1:] != src[:-1]) | (sym[1:] != sym[:-1]))
        first, last = at[np.r_[0, cut + 1]], at[np.r_[cut, total - 1]]
        new = open_[last + 1]
        open_[last + 1] = False
        lo, hi = first[new], last[new]
    same = open_[1:n]  # the rotations at i and i + 1 share `width` symbols
    flag = np.zeros(n, bool)
    flag[order[:-1][same]] = True
    flag[order[1:][same]] = True
    starts = ends - sizes
    return [flag[a:a + max(0, k - width + 1)] for a, k in zip(starts.tolist(), sizes.tolist())]


def _interval_rows(width: int):
    """Transform whole buckets together; spans of repeated windows."""
    def spans(held):
        rows = []
        for r, flag in zip(held, repeated([r["bytes"] for r in held], width)):
            if not r["many"] and flag.any():
                edge = np.diff(np.r_[0, flag.astype(np.int8), 0])
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                    rows.append((r["doc_id"], r["_h"], r["s"] + int(a), r["s"] + int(b) - 1))
        cols = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols],
                                          names=["doc_id", "_h", "s", "e"])

    def run(batches):
        held, size, key = [], 0, None
        for b in batches:
            for r in b.to_pylist():
                if r["key"] != key and size >= TEXT_BYTES:
                    yield spans(held)
                    held, size = [], 0
                key = r["key"]
                held.append(r)
                size += len(r["bytes"])
        if held:
            yield spans(held)
    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """``doc_id, _h, s, e``: runs of window places whose windows repeat.
    ``docs`` has doc_id, _h and text."""
    spans = ("doc_id", "_h", "s", "e")
    full = docs.where(F.octet_length("text") >= width)
    occ = full.select("doc_id", "_h", "text").mapInArrow(_occurrences(width), OCC)
    again = (occ.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.min("seg").alias("_a"),
                                    F.max("seg").alias("_b"))
                .where("_n > 1").select("key", (F.col("_a") != F.col("_b")).alias("mixed")))
    # written first: a join of two shuffles can be split where one key is hot
    occ = written(occ.join(written(again, "again"), "key"), "segments")
    found = occ.where("not mixed").select(*spans)
    mixed = occ.where("mixed")
    kinds = mixed.groupBy("key", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "_h", "s", "e", "p")).alias("one"))
    kinds = written(kinds, "kinds")
    found = found.unionByName(mixed.join(kinds.where("n > 1").select("key", "seg"), ["key", "seg"])
                              .select(*spans))
    single = kinds.groupBy("key").agg(F.min("n").alias("_m")).where("_m = 1").select("key")
    want = (kinds.join(single, "key").select("one.*", "key", (F.col("n") > 1).alias("many"))
                 .groupBy("doc_id", "_h").agg(F.collect_list(F.struct("key", "s", "e", "p", "many"))
                                              .alias("want")))
    parts = written(join_on(_packed(full), want, ("doc_id", "_h")).mapInArrow(_fetch(width), SEG), "parts")
    while True:
        count = parts.groupBy("key").count()
        crowded = written(count.where((F.col("count") > crowd)).select("key"), "crowded")
        if crowded.isEmpty():
            break
        rest = parts.join(crowded, "key", "left_anti")
        dealt = written(parts.join(crowded, "key", "left_semi").select(*parts.columns)
                        .mapInArrow(_split(width), SEG), "dealt")
        # equal pieces are counted first, as above
        dealt = dealt.withColumn("_d", F.sha2("bytes", 256))
        alike = dealt.groupBy("key", "_d").agg(F.count(F.lit(1)).alias("n"))
        alike = written(dealt.join(alike, ["key", "_d"]), "alike")
        found = found.unionByName(alike.where("n > 1 and not many").select(*spans))
        one = alike.groupBy("key", "_d").agg(F.max("many").alias("_many"), F.max("n").alias("n"),
                                             F.min(F.struct("doc_id", "_h", "s", "e", "p", "size"))
                                             .alias("one"), F.first("bytes").alias("bytes"))
        kinds = one.groupBy("key").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("key")
        one = one.join(kinds, "key").select(
            "key", "one.*", (F.col("_many") | (F.col("n") > 1)).alias("many"), "bytes")
        parts = written(rest.select(*parts.columns).unionByName(one.select(*parts.columns)), "parts")
    # sorted by key within a partition, so that buckets stay whole
    rows = parts.repartition("key").sortWithinPartitions("key")
    return found.unionByName(rows.mapInArrow(_interval_rows(width), "doc_id long, _h long, s long, e long"))


def merged(ranges: list[tuple[int, int]], width: int) -> list[list[int]]:
    """Byte runs [start, end) covered by windows starting in the ranges."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + width)
        else:
            out.append([s, e + width])
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, runs`` (array of [start, end) removed) and ``kept``
    (binary) of every row; doc_id must be a whole number."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"), "text")
    spans = (repeated_windows(docs, width, crowd).groupBy("doc_id", "_h")
             .agg(F.collect_list(F.struct("s", "e")).alias("spans")))
    both = join_on(_packed(docs), spans, ("doc_id", "_h"), "left").select("doc_id", "z", "spans")

    def cut(batches):
        d = zstandard.ZstdDecompressor()
        run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                size, runs, kept = [], [], []
                for z, spans in zip(part.column("z"), part.column("spans")):
                    text = d.decompress(z.as_py())
                    gone = merged([(x["s"], x["e"]) for x in spans.as_py() or ()], width)
                    size.append(len(text))
                    runs.append([{"start": s, "end": e} for s, e in gone])
                    edges = [0, *(x for r in gone for x in r), len(text)]
                    kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(runs, pa.list_(run)),
                     pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "runs", "kept"])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, "
                                "runs array<struct<start:bigint,end:bigint>>, kept binary")
