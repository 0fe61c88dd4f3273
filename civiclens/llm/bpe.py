"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is split by the tokenizer's pattern.  The distinct pieces of a batch
that are not yet known are sorted into buckets of similar byte length; each
bucket is one matrix of token ids, padded with -1.  In every round each row
looks up the ranks of its neighbouring pairs in an open-addressing hash table,
merges its leftmost pair of minimum rank and closes the gap; rows without a
mergeable pair leave the matrix.  A piece that is a token itself is that token.

A piece of more than ``LONG`` bytes would need as many rounds as it has bytes,
each over its whole width, so such pieces are merged with a heap instead; the
result is the same.

Defined results: a null text is encoded as an empty one; special tokens do not
exist (their strings are ordinary text); repeated rows are encoded alike; an
empty table gives an empty result; extra columns are kept by ``encode`` and
``decode`` unless they bear the name of the output column, which is replaced.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import tidy

LONG = 256
CACHE_BYTES = 32 << 20  # of known pieces, per task
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, in the order of their ids."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """Hash table from a pair of token ids to the id of their concatenation
    (which is also its rank), looked up for whole arrays at a time."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        keys, vals = [], []
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = ids.get(t[:k]), ids.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    vals.append(i)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, _EMPTY, np.uint64)
        self.vals = np.full(1 << self.bits, np.iinfo(np.int32).max, np.int32)
        self.probes = 1
        left, vals = np.array(keys, np.uint64), np.array(vals, np.int32)
        at = self._home(left)
        while len(left):
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = left[free]  # of several writers the last stays
            mine = free & (self.keys[at] == left)
            self.vals[at[mine]] = vals[mine]
            left, vals, at = left[~mine], vals[~mine], (at[~mine] + 1) & self.mask
            self.probes += bool(len(left))

    def _home(self, keys):
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left, right):
        """Ranks of the pairs; the largest int32 where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._home(keys)
        out = np.full(keys.shape, np.iinfo(np.int32).max, np.int32)
        hit = self.keys[at] == keys
        out[hit] = self.vals[at[hit]]
        todo = np.nonzero(~hit & (self.keys[at] != _EMPTY))
        for _ in range(self.probes):
            if not len(todo[0]):
                break
            p = (at[todo] + 1) & self.mask
            at[todo] = p
            found = self.keys[p] == keys[todo]
            out[tuple(x[found] for x in todo)] = self.vals[p[found]]
            more = ~found & (self.keys[p] != _EMPTY)
            todo = tuple(x[more] for x in todo)
        return out


NONE = np.iinfo(np.int32).max


class Encoder:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(tokens)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _merge_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Merge pieces of one length bucket; returns the ids of each, as the
        bytes of an int32 array."""
        width = max(map(len, pieces))
        flat = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        size = np.array([len(p) for p in pieces])
        m = np.full((len(pieces), width), -1, np.int32)
        m[np.arange(width) < size[:, None]] = flat
        out = [b""] * len(pieces)
        row = np.arange(len(pieces))
        rank = np.full((len(pieces), max(1, width - 1)), NONE, np.int32)
        live = np.arange(width - 1) < size[:, None] - 1
        rank[live] = self.pairs.ranks(m[:, :-1][live], m[:, 1:][live])
        while len(row):
            at = rank.argmin(axis=1)  # the leftmost of the smallest
            k = np.arange(len(row))
            best = rank[k, at]
            done = best == NONE
            if done.any():
                n = size[done]
                flat = m[done][np.arange(m.shape[1]) < n[:, None]].tobytes()
                end = 4 * np.cumsum(n)
                for r, a, b in zip(row[done].tolist(), (end - 4 * n).tolist(), end.tolist()):
                    out[r] = flat[a:b]
                go = ~done
                row, m, rank, size, at, best = row[go], m[go], rank[go], size[go], at[go], best[go]
                if not len(row):
                    break
                width = int(size.max())  # columns that no row uses any more go
                m, rank = m[:, :width], rank[:, :max(1, width - 1)]
                k = np.arange(len(row))
            m[k, at] = best
            # close the gap: what stands right of the merged pair moves left
            cols = np.arange(m.shape[1] - 1)
            src = cols + (cols > at[:, None])
            m = np.concatenate([np.take_along_axis(m, src, 1), np.full((len(row), 1), -1, np.int32)], 1)
            cols = np.arange(rank.shape[1])
            src = np.minimum(cols + (cols > at[:, None]), rank.shape[1] - 1)
            rank = np.take_along_axis(rank, src, 1)
            size = size - 1
            rank[cols >= size[:, None] - 1] = NONE
            # only the two pairs beside the new token have new ranks
            i = np.flatnonzero(at > 0)
            rank[i, at[i] - 1] = self.pairs.ranks(m[i, at[i] - 1], m[i, at[i]])
            i = np.flatnonzero(at < size - 1)
            rank[i, at[i]] = self.pairs.ranks(m[i, at[i]], m[i, at[i] + 1])
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a heap of (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        tok = ids.tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(ids[:-1], ids[1:]).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        cur = first + [NONE]

        def renew(i):
            j = nxt[i]
            t = None if j >= n else self.ids.get(self.tokens[tok[i]] + self.tokens[tok[j]])
            cur[i] = NONE if t is None else t
            if t is not None:
                heapq.heappush(heap, (t, i))

        while heap:
            r, i = heapq.heappop(heap)
            if tok[i] < 0 or cur[i] != r:
                continue
            j = nxt[i]
            tok[i], tok[j], cur[j] = r, -1, NONE
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            renew(i)
            if prv[i] >= 0:
                renew(prv[i])
        return np.array([t for t in tok if t >= 0], np.int32)

    def _learn(self, pieces) -> None:
        """Encode pieces and add them to the known ones."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            whole = self.ids.get(b)
            if whole is not None:
                self._know(p, whole.to_bytes(4, "little"))
            elif len(b) > LONG:
                self._know(p, self._merge_long(b).tobytes())
            else:
                buckets.setdefault((len(b) - 1) // 4, []).append((p, b))
        for k, members in buckets.items():
            step = max(1, (1 << 19) // (4 * k + 4))
            for a in range(0, len(members), step):
                part = members[a:a + step]
                for (p, _), ids in zip(part, self._merge_matrix([b for _, b in part])):
                    self._know(p, ids)

    def _know(self, piece, ids):
        self.known[piece] = ids
        self.known_bytes += 190 + len(piece) + len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of an int32 array."""
        out = []
        for a in range(0, len(texts), 64):
            found = [self.find(t) for t in texts[a:a + 64]]
            if self.known_bytes > CACHE_BYTES:
                self.known, self.known_bytes = {}, 0
            new = {p for f in found for p in f if p not in self.known}
            if new:
                self._learn(new)
            out += [b"".join(map(self.known.__getitem__, f)) for f in found]
        return out


_WORKER: dict[tuple[str, str], Encoder] = {}


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col`` (array<int>) in place of ``text_col``.
    ``ranks_path`` must be readable on every executor."""
    keep = [c for c in df.columns if c not in (text_col, ids_col)]

    def run(batches):
        key = (ranks_path, pattern)
        if key not in _WORKER:  # the tables are built once per Python worker
            _WORKER[key] = Encoder(read_ranks(ranks_path), pattern)
        enc = _WORKER[key]
        try:
            for b in batches:
                for a in range(0, b.num_rows, 256):
                    part = b.slice(a, 256)
                    ids = enc.encode([t or "" for t in part.column(len(keep)).to_pylist()])
                    ends = np.cumsum([0] + [len(x) // 4 for x in ids])
                    flat = pa.array(np.frombuffer(b"".join(ids), np.int32), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                        names=[*keep, ids_col])
        finally:  # idle workers hold the tables only
            enc.known, enc.known_bytes = {}, 0

    chosen = df.select(*keep, text_col)
    schema = F.lit(None).cast("array<int>").alias(ids_col)
    out = df.select(*keep, schema).schema
    return chosen.mapInArrow(tidy(run), out)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the bytes that the ids stand for."""
    keep = [c for c in df.columns if c != out_col]
    at = keep.index(ids_col)
    store: dict[str, np.ndarray] = {}

    def run(batches):
        if not store:
            tokens = read_ranks(ranks_path)
            store["bytes"] = np.frombuffer(b"".join(tokens), np.uint8)
            store["size"] = np.array([len(t) for t in tokens], np.int64)
            store["start"] = np.cumsum(store["size"]) - store["size"]
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                ids = part.column(at)
                flat = ids.flatten().to_numpy()
                rows = np.cumsum([0] + [x or 0 for x in ids.value_lengths().to_pylist()])
                size = store["size"][flat]
                end = np.cumsum(size)
                place = np.arange(int(end[-1]) if len(end) else 0)
                text = store["bytes"][place + np.repeat(store["start"][flat] - end + size, size)]
                cuts = np.r_[0, end][rows].astype(np.int32)
                decoded = pa.Array.from_buffers(
                    pa.binary(), part.num_rows, [None, pa.py_buffer(cuts), pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*keep, out_col])

    schema = df.select(*keep, F.lit(None).cast("binary").alias(out_col)).schema
    return df.select(*keep).mapInArrow(tidy(run), schema)
