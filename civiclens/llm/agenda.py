"""SentencePiece encoding and decoding of merge-type (BPE) models.

A text is turned into symbols, one per character, with every space as ``▁`` and
one ``▁`` put before the text.  All adjacent pairs of symbols that form a piece
stand in an agenda ordered by the piece's score (equal scores: by place, leftmost
first).  The best pair is merged, pairs that lost a symbol are passed over, and
the two pairs beside the new symbol enter the agenda, until it is empty.  A
symbol that is no piece is written as its UTF-8 bytes.  One agenda serves all new
units of some megabytes of text, whose pairs of equal score are merged by numpy in
one step; within a unit that keeps the order of the library.

No piece holds ``▁`` behind another character, so no merge goes over the place
before a ``▁``; the same holds beside a character that stands in no piece of two
characters or more (the line feed).  Texts are cut there, and a unit is merged
once as long as its worker knows it.  If a vocabulary allows neither, a text is one unit.

The units that a batch meets for the first time are also encoded by the
sentencepiece library; a difference is an error (``check=False`` leaves that out).

Models: merge type, byte fallback, the ``▁`` before the text, no character map,
no removal of white space, neither user-defined nor unused pieces.  Any other
raises a ValueError that says what is not supported.

Defined results: a null text is encoded as an empty one, which has no ids; the
names of special pieces are ordinary text; repeated rows are encoded alike; long
texts are encoded whole; an empty table gives an empty result; extra columns are
kept unless they bear the name of the output column, which is replaced.  Null
ids are decoded as none; an id out of range is an error.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.bpe import NONE, PairTable
from civiclens.llm.common import tidy

SPACE = "▁"
CACHE_UNITS = 400_000  # known units of a Python worker, some 200 bytes each
SLICE = 12 << 20  # bytes of text encoded together
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # piece types of the model format
_BPE = 2  # model type


def _fields(b: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            c = b[at]
            at += 1
            n |= (c & 127) << shift
            shift += 7
            if c < 128:
                return n

    while at < len(b):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = b[at:at + size]
            at += size
        yield key >> 3, value


class Model:
    """Pieces, scores and kinds of a model file, in the order of their ids."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = f.read()
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normal = {}, {}
        for number, value in _fields(message):
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append(p[1].decode())
                self.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, _NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        wrong = [what for bad, what in (
            (trainer.get(3, 1) != _BPE, "a model of another type than BPE"),
            (not trainer.get(35, 0), "no byte fallback"),
            (trainer.get(24, 0), "white space as a suffix"),
            (normal.get(2), "a character map"),
            (not normal.get(3, 1), "no space before the text"),
            (normal.get(4, 1), "removal of white space"),
            (not normal.get(5, 1), "spaces that stay spaces"),
            (set(self.kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}, "user-defined or unused pieces"),
        ) if bad]
        if wrong:
            raise ValueError(f"{path}: not supported: {', '.join(wrong)}")


def _gather(starts, sizes, flat):
    """The pieces flat[start:start + size] behind one another."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def _distinct(x):
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


class Index(dict):
    """Numbers the units in the order in which they are met."""

    def __missing__(self, unit):
        self[unit] = n = len(self)
        return n


class Encoder:
    def __init__(self, path: str, check: bool = True):
        model = Model(path)
        rows = list(zip(model.pieces, model.scores, model.kinds))
        self.n = len(rows)  # larger symbols are characters that are no piece
        self.ids = {p: i for i, (p, _, k) in enumerate(rows) if k == _NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(rows) if k == _BYTE}
        self.pairs = PairTable([p if k == _NORMAL else "" for p, _, k in rows])
        # place of every piece's score, the highest first; pieces may share one
        scores, self.group = np.unique(-np.array(model.scores), return_inverse=True)
        self.shared = np.bincount(self.group[list(self.ids.values())], minlength=len(scores)) > 1
        self.group = np.append(self.group, len(scores))  # the last: no piece
        self.group = self.group.astype(np.uint16 if len(scores) < 1 << 16 else np.int64)  # sorts faster
        longer = [p for p in self.ids if len(p) > 1]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in longer)
        self.by_line = not any("\n" in p for p in longer)
        ends = SPACE + ("\n" if self.by_line else "")
        line = "|\n" if self.by_line else ""
        self.units = (re.compile(f"{SPACE}+[^{ends}]*{line}|[^{ends}]+").findall if self.by_word
                      else lambda t: [t])
        self.library = sentencepiece.SentencePieceProcessor(model_file=path) if check else None
        self._forget()

    def _forget(self):
        self.index = Index()
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _pair(self, left, right):
        """The piece of two symbols, n where there is none."""
        piece = self.pairs.ranks(left, right)
        return np.where(piece == NONE, self.n, piece)

    def _merge(self, units: list[str]):
        """The ids of each unit as (size of each, all ids).

        One agenda serves all units: the scores that wait, the highest first, and
        for each the places of pairs with it.  Units are independent, so all
        places of a score are merged in one step, within a unit from the left.
        """
        size = np.array([len(u) for u in units], np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        symbol = np.zeros(0x110000, np.int32)
        symbol[chars] = 1
        for c in np.flatnonzero(symbol).tolist():
            symbol[c] = self.ids.get(chr(c), self.n + 1 + c)
        symbol = symbol[chars]
        n = len(symbol)
        unit = np.repeat(np.arange(len(units), dtype=np.int32), size)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(size)
        after[ends[size > 0] - 1] = -1
        before[(ends - size)[size > 0]] = -1
        pair = np.full(n + 1, self.n, np.int32)  # piece of the pair that begins here
        agenda, waiting = [], {}

        def enter(places):
            right = after[places]
            places, right = places[right >= 0], right[right >= 0]
            pair[places] = self._pair(symbol[places], symbol[right])
            places = places[pair[places] < self.n]
            groups = self.group[pair[places]]
            order = np.argsort(groups, kind="stable")
            groups, places = groups[order], places[order]
            cuts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else groups
            for g, a, e in zip(groups[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(groups)]):
                if g not in waiting:
                    waiting[g] = []
                    heapq.heappush(agenda, g)
                waiting[g].append(places[a:e])

        enter(np.arange(n, dtype=np.int32))
        while agenda:
            g = heapq.heappop(agenda)
            left = _distinct(np.concatenate(waiting.pop(g)))
            left = left[self.group[pair[left]] == g]  # others lost a symbol meanwhile
            if not len(left):
                continue
            right, new = after[left], pair[left]
            first = np.diff(unit[left], prepend=-1) > 0  # of its unit
            if not first.all():
                # Several places of a unit: together, every other one where they
                # overlap, unless a merge makes a pair that would come before
                # the next place; then one by one.
                wait = np.zeros(len(left), bool)
                if self.shared[g]:
                    wait = ~first
                else:
                    linked = np.append(False, right[:-1] == left[1:])
                    run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(left))))
                    odd = (np.arange(len(left)) - run) % 2 == 1
                    p, q = before[left], after[right]
                    ahead = np.full(len(left), False)
                    for a, b, ok in ((symbol[p], new, p >= 0), (new, symbol[q], q >= 0), (new, new, q >= 0)):
                        ahead[ok] |= self.group[self._pair(a[ok], b[ok])] <= g
                    slow = np.isin(unit[left], unit[left[ahead]])
                    wait = np.where(slow, ~first, odd)
                if wait.any():
                    waiting[g] = [left[wait]]
                    heapq.heappush(agenda, g)
                    left, right, new = left[~wait], right[~wait], new[~wait]
            symbol[left], symbol[right] = new, -1
            pair[left] = pair[right] = self.n
            behind = after[right]
            after[left] = behind
            before[behind[behind >= 0]] = left[behind >= 0]
            ahead = before[left]
            ahead = ahead[ahead >= 0]
            pair[ahead] = self.n
            enter(_distinct(np.concatenate([left, ahead])))
        live = symbol >= 0
        symbol, unit = symbol[live], unit[live]
        place = np.zeros(self.n + 1 + 0x110000, np.int32)
        place[symbol] = 1
        kinds = np.flatnonzero(place)
        place[kinds] = np.arange(len(kinds))
        symbol = place[symbol]
        ids = [[k] if k < self.n else [self.byte_ids[c] for c in chr(k - self.n - 1).encode()]
               for k in kinds.tolist()]
        width = np.array([len(x) for x in ids], np.int64)
        flat = _gather((np.cumsum(width) - width)[symbol], width[symbol],
                       np.array([i for x in ids for i in x], np.int32))
        return np.bincount(unit, width[symbol], len(units)).astype(np.int64), flat

    def _learn(self, units: list[str]) -> None:
        """Merge units that are not known.  A unit that begins with ``▁`` is
        known without it; a line feed and what follows it is one."""
        sizes, flat = self._merge([u if u[:1] == "\n" and self.by_line else SPACE + u for u in units])
        if self.library:
            self._compare(units, sizes, flat)
        self.starts = np.append(self.starts, np.cumsum(sizes) - sizes + len(self.flat))
        self.sizes, self.flat = np.append(self.sizes, sizes), np.append(self.flat, flat)

    def _compare(self, units, sizes, flat) -> None:
        """The library must give the same ids.  Units are handed to it many at a
        time, as one text: with spaces between them, or line by line."""
        lead = self.library.encode("a", num_threads=1)  # stands before the first line feed
        ends = np.cumsum(sizes)
        starts = (ends - sizes).tolist()
        whole, lines, alone = [], [], []
        for i, u in enumerate(units):
            if not self.by_word or not u.strip(SPACE):
                alone += [i] if u else []  # the library has no text of one ▁
            else:
                (lines if u[0] == "\n" and self.by_line else whole).append(i)
        step = 1000
        groups = [(whole[a:a + step], " ", []) for a in range(0, len(whole), step)]
        groups += [(lines[a:a + step], "", lead) for a in range(0, len(lines), step)]
        groups += [([i], "", []) for i in alone]
        want = self.library.encode([("a" if first else "") + gap.join([units[i] for i in part]).replace(SPACE, " ")
                                    for part, gap, first in groups], num_threads=1)
        for (part, _, first), ids in zip(groups, want):
            mine = _gather((ends - sizes)[part], sizes[part], flat)
            if not np.array_equal(np.append(first, mine), ids):
                for i in part:
                    text = units[i].replace(SPACE, " ")
                    ids = self.library.encode(("a" if first else "") + text, num_threads=1)[len(first):]
                    if flat[starts[i]:starts[i] + sizes[i]].tolist() != ids:
                        raise ValueError(f"the sentencepiece library encodes {units[i][:80]!r} otherwise")
                raise ValueError("the sentencepiece library encodes some units otherwise")

    def _keys(self, text: str) -> list[str]:
        """The units of a text."""
        if not text:
            return []
        if self.by_word:
            if SPACE in text:
                text = text.replace(SPACE, " ")
            keys = (text.replace("\n", " \n") if self.by_line else text).split(" ")
            if "" not in keys:
                return keys
        # runs of spaces, or no cuts: each unit with its own ▁, less the first
        keys = []
        for u in self.units(SPACE + text.replace(" ", SPACE)):
            if u[0] == SPACE:
                tail = u[1:]
                if tail.endswith("\n") and self.by_line:
                    keys += [tail[:-1], "\n"]
                else:
                    keys.append(tail)
            elif u == "\n" and self.by_line:
                keys.append(u)
            else:  # follows a line feed
                keys[-1] += u
        return keys

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.index) > CACHE_UNITS:
            self._forget()
        met, number = len(self.index), self.index.__getitem__
        found = [np.array(array("i", map(number, self._keys(t)))) for t in texts]
        if len(self.index) > met:
            self._learn(list(islice(self.index, met, None)))
        unit = np.concatenate(found) if found else np.zeros(0, np.int32)
        flat = _gather(self.starts[unit], self.sizes[unit], self.flat)
        ends = np.concatenate([[0], np.cumsum(self.sizes[unit])])[np.cumsum([0] + [len(f) for f in found])]
        return [flat[a:e] for a, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


class Decoder:
    def __init__(self, path: str):
        model = Model(path)
        parts, self.kind = [], np.array(model.kinds)
        for p, k in zip(model.pieces, model.kinds):
            if k == _BYTE:
                parts.append(bytes([int(p[3:5], 16)]))
            else:
                parts.append({_CONTROL: "", _UNKNOWN: " ⁇ "}.get(k, p.replace(SPACE, " ")).encode())
        self.parts = parts
        self.leads = np.array([p[:1] == SPACE and k == _NORMAL for p, k in zip(model.pieces, model.kinds)])

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.parts)):
            raise ValueError("a piece id is out of range")
        raw = b"".join(map(self.parts.__getitem__, ids.tolist()))
        kinds = self.kind[ids]
        try:
            text = "".join(self._runs(ids)) if (kinds == _CONTROL).any() else raw.decode()
        except UnicodeDecodeError:
            text = "".join(self._runs(ids))
        # the ▁ put before the text goes; control pieces may stand before it
        first = ids[np.argmax(kinds != _CONTROL)] if len(ids) else 0
        return text[1:] if len(ids) and self.leads[first] else text

    def _runs(self, ids):
        """Parts of a text whose byte pieces are not all valid UTF-8: every byte
        that belongs to no character becomes U+FFFD."""
        run = b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.kind[i] == _BYTE:
                run += self.parts[i]
                continue
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        yield run[at:at + n].decode()
                        at += n
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    yield "�"
                    at += 1
            run = b""
            if i is not None:
                yield self.parts[i].decode()


def _slices(batch: pa.RecordBatch, column: int):
    """The batch in slices of some SLICE bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    a, ends = 0, np.cumsum(sizes)
    while a < len(sizes):
        e = max(a + 1, int(np.searchsorted(ends, SLICE + (ends[a - 1] if a else 0), "right")))
        yield batch.slice(a, e - a)
        a = e


_WORKER: dict[tuple, Encoder | Decoder] = {}  # built once per Python worker


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
           check: bool = True) -> DataFrame:
    """``df`` with ``ids_col`` (array<int>) in place of ``text_col``.
    ``model_path`` must be readable on every executor."""
    keep = [c for c in df.columns if c not in (text_col, ids_col)]

    def run(batches):
        key = ("encode", model_path, check)
        if key not in _WORKER:
            _WORKER[key] = Encoder(model_path, check)
        enc = _WORKER[key]
        for b in batches:
            for part in _slices(b, len(keep)):
                ids = enc.encode([t or "" for t in part.column(len(keep)).to_pylist()])
                ends = np.cumsum([0] + [len(x) for x in ids])
                flat = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                    names=[*keep, ids_col])

    out = df.select(*keep, F.lit(None).cast("array<int>").alias(ids_col)).schema
    return df.select(*keep, text_col).mapInArrow(tidy(run), out)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the text that the ids stand for."""
    keep = [c for c in df.columns if c != out_col]
    at = keep.index(ids_col)

    def run(batches):
        key = ("decode", model_path)
        if key not in _WORKER:
            _WORKER[key] = Decoder(model_path)
        dec = _WORKER[key]
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                ids = part.column(at)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum([0] + [x or 0 for x in ids.value_lengths().to_pylist()])
                texts = [dec.decode(flat[x:y]) for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*keep, out_col])

    schema = df.select(*keep, F.lit(None).cast("string").alias(out_col)).schema
    return df.select(*keep).mapInArrow(tidy(run), schema)
