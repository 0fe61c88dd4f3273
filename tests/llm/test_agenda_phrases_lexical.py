"""SentencePiece agenda, collocations and lexical search against the library and
brute force: nulls, empty and long texts, ties, repeated rows, empty tables,
clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from civiclens.llm import agenda, lexical, phrases

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "t", "h", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", ".", "\r", "\x00", "01", "<s>", "</s>",
         "<0x0A>", "<unk>", "the", " the", "�", "é", "foo.", " "]
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# SentencePiece ------------------------------------------------------------
def test_encoder_equals_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    texts += ["", " ", "\n", "\n\n", " \n ", "▁", "  a", "a  ", "x" * 5000, "\n".join(["ab cd"] * 300)]
    lib, enc, dec = sentencepiece.SentencePieceProcessor(model_file=MODEL), agenda.Encoder(MODEL), agenda.Decoder(MODEL)
    for t, got in zip(texts, enc.encode(texts)):
        assert got.tolist() == lib.encode(t), t
        assert dec.decode(got) == lib.decode(got.tolist()), t


def test_decoder_equals_the_library_on_any_ids():
    rng = random.Random(6)
    lib, dec = sentencepiece.SentencePieceProcessor(model_file=MODEL), agenda.Decoder(MODEL)
    for _ in range(6000):
        ids = [rng.choice([rng.randint(0, 2), rng.randint(3, 258), rng.randint(131, 258), rng.randint(259, 31999), 259])
               for _ in range(rng.randint(0, 12))]
        assert dec.decode(np.array(ids, np.int32)) == lib.decode(ids), ids
    with pytest.raises(ValueError):
        dec.decode(np.array([32000], np.int32))


def test_known_units_are_forgotten_in_halves(monkeypatch):
    monkeypatch.setattr(agenda, "CACHE_UNITS", 40)
    lib, enc = sentencepiece.SentencePieceProcessor(model_file=MODEL), agenda.Encoder(MODEL)
    rng = random.Random(7)
    for _ in range(60):
        texts = [" ".join(f"w{rng.randrange(60)}." for _ in range(20)) for _ in range(4)]
        assert [x.tolist() for x in enc.encode(texts)] == lib.encode(texts)


def test_a_wrong_merge_is_reported(monkeypatch):
    enc = agenda.Encoder(MODEL)
    monkeypatch.setattr(enc, "_merge", lambda units: (np.ones(len(units), np.int64), np.full(len(units), 5, np.int32)))
    with pytest.raises(ValueError, match="encodes 'hello' otherwise"):
        enc.encode(["hello"])


def test_pieces_in_spark(spark):
    rows = [(1, "The cat", "x"), (2, None, "x"), (3, "", "y"), (1, "The cat", "x"), (None, "é" * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = agenda.decode(agenda.encode(df, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in out) == sorted(
        (i or 0, lib.encode(t or ""), t or "") for i, t, _ in rows)
    assert agenda.encode(df.limit(0), MODEL).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert agenda.decode(null, MODEL).first().decoded == ""


def test_other_models_are_refused(tmp_path):
    with open(MODEL, "rb") as f:
        body = f.read()
    (tmp_path / "m").write_bytes(body + bytes([0x12, 2, 0x18, 1]))  # trainer: the unigram type
    with pytest.raises(ValueError, match="another type than BPE"):
        agenda.Model(str(tmp_path / "m"))


# Collocations ---------------------------------------------------------------
def collocations(rows, order, least, inside, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(A_TO_Z)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, order + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rank = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in found.items()):
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top])]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "new", "york", "city", "é", "漢字", "a'b", "x\x1cy", "x\xa0z", "Ä"]
    gaps = [" "] * 12 + ["  ", "\t", " \t ", ". ", ",", "\n", "!", "\r\n"]
    rows = [("".join(rng.choice(vocab) + rng.choice(gaps) for _ in range(rng.randint(0, 40))),
             rng.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [(None, "en"), ("", "xx"), ("...", "en")] + [("new york city of light", "en")] * 40


@pytest.mark.parametrize("least,inside,top,order", [(4, 80, 2000, 4), (9, 40, 7, 4), (3, 80, 50, 3)])
def test_collocations_equal_brute_force(spark, least, inside, top, order):
    rows = corpus(least)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, n int, k int").repartition(3)
    out = phrases.collocations(df, order=order, min_count=least, inside=inside, top=top).collect()
    assert sorted(tuple(r) for r in out) == collocations(rows, order, least, inside, top)
    assert len(out) > 10


def test_collocations_in_small_blocks(spark, monkeypatch):
    """Blocks that end between pieces, within documents and within no piece."""
    import pyarrow as pa
    monkeypatch.setattr(phrases, "BLOCK", 23)
    rows = corpus(2) + [("w" * 100 + " tail", "en")]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t for t, _ in rows], pa.string()),
                                        "lang": pa.array([x for _, x in rows], pa.string())})
    blocks = list(phrases._blocks(batch))
    assert b"".join(b.tobytes() for b, _, _ in blocks) == "".join(t or "" for t, _ in rows).encode()
    bits = np.full(phrases.CELLS // 8, 255, np.uint8)
    got = Counter()
    for b in phrases._count_windows(type("B", (), {"value": bits}), 4)([batch]):
        for lang, w, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            got[lang, w] += n
    got = Counter({k: n for k, n in got.items() if n})
    want = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(A_TO_Z)):
            w = re.findall("[^\x20\x09]+", piece)
            want.update(("und" if lang is None else lang, " ".join(w[i:i + 4])) for i in range(len(w)))
    assert got == want


def test_windows_end_before_rare_runs():
    """With the bits of some runs only: the window ends where a run of one to four
    words is not among them."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a b c d a b x b c. d e"], pa.string()),
                                        "lang": pa.array([None], pa.string())})
    (block,) = phrases._blocks(batch)
    w = phrases.Words(*block)
    names = "a b c d a b x b c d e".split()
    bits = np.zeros(phrases.CELLS // 8, np.uint8)
    for k, (first, cell) in enumerate(w.cells(4), 1):
        for i, c in zip(first.tolist(), cell.tolist()):
            if " ".join(names[i:i + k]) in {"a", "b", "c", "d", "a b", "b c", "c d", "a b c", "d a", "b x"}:
                bits[c >> 3] |= 128 >> (c & 7)
    assert phrases._window_sizes(w, bits, 4).tolist() == [3, 2, 2, 2, 2, 1, 0, 2, 1, 1, 0]


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


# Lexical search ----------------------------------------------------------------
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked(docs, items, k):
    own = [(i, Counter(TERM.findall((t or "").translate(A_TO_Z)))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    total = sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    terms = defaultdict(set)
    for item, t in items:
        terms[item].update(TERM.findall((t or "").translate(A_TO_Z)))
    out = []
    for item, ts in terms.items():
        scores = []
        for i, c, n in own:
            m = 50 + 50 * n * len(own) // total
            s = sum(math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[t] + 1)))
                    * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return out


def told(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, str(r[0]), r[1]))


@pytest.mark.parametrize("seed,k,block", [(1, 50, 1 << 20), (2, 5, 40), (3, 1, 1 << 20)])
def test_search_equals_brute_force(spark, seed, k, block):
    rng = random.Random(seed)
    vocab = [f"t{i}" for i in range(60)] + ["É", "漢字", "Zoo", "zoo", "9a"]
    weights = [1 / (i + 1) for i in range(len(vocab))]

    def text(n):
        return "".join(w + rng.choice([" ", "-", "\n", "_", " (", "'"]) for w in rng.choices(vocab, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 20, 200]))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(120)] + [docs[3], (None, docs[7][1]), (2000, None), (2001, ""), (2002, "-- !")]
    items = [(str(i), text(rng.choice([1, 4, 12]))) for i in range(12)]
    items += [("3", "t50 zoo"), (None, "t1 t2"), ("empty", None), ("none", "unheard")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n int, score int").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, rank int")
    assert told(lexical.search(d, q, k, block).collect()) == told(ranked(docs, items, k))


def test_search_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(d.limit(0), q).count() == 0
    assert lexical.search(d, q.limit(0)).count() == 0
    assert lexical.search(d.where(F.lit(False)), q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"Word{i % 7}-x" for i in range(500))
    want = [w.encode() for w in TERM.findall(text.lower())]
    monkeypatch.setattr(lexical, "PART", 50)
    parts = list(lexical._terms(text))
    assert [w for p in parts for w in p] == want and len(parts) > 20


def test_subtrees_are_left_out():
    """Bound and search on a large tree: right, and far fewer leaves than all."""
    rng = np.random.default_rng(1)
    n = 4000
    size = rng.integers(1, 12, n)
    ends = np.concatenate([[0], np.cumsum(size)])
    terms = np.concatenate([rng.choice(200, s, replace=False, p=np.arange(200, 0, -1) / 20100) for s in size])
    tfs, m = rng.integers(1, 9, len(terms)), rng.integers(50, 400, n)
    tree = lexical.Tree(np.arange(n), m, ends, terms, tfs)
    weight = np.zeros(200, np.int64)
    weight[[3, 150, 180, 199]] = [10, 4000, 5000, 6000]
    scores = np.add.reduceat(weight[terms] * lexical._part(tfs, np.repeat(m, size)), ends[:-1])
    best, seen = lexical.Best(10), []
    add = best.add
    best.add = lambda s, i: (seen.append(len(i)), add(s, i))
    tree.search(weight, best)
    order = np.lexsort((np.arange(n), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert sum(seen) < n // 4
