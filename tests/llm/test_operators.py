"""The operators against brute force on small cases: nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from civiclens.llm import (
    bpe, chat, decontaminate, langid, linededup, minhash, multiindex, sharding, suffixes, warc)
from civiclens.llm.common import shared_path
from civiclens.llm.queries import PATTERN, RANKS

DOC = "doc_id long, text string, shard string, n string, key string"  # clashing extra columns


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOC)


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


# 1 ---------------------------------------------------------------------------
def test_multiindex_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)).round(3)
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    rows += [(2000 + i, rows[100][1]) for i in range(30)] + [rows[7]]  # copies, a repeated row
    bad = [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] + [1.0] * 15), (3300, [1.0]),
           (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, q int")
    out = multiindex.search(df, F.col("vec_id") % 100 == 0, k=10, centroids=8, probe=0.6)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    pool = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    hits = 0
    queries = [i for i in pool if i % 100 == 0]
    assert set(got) == set(queries)
    for q in queries:
        true = sorted((float(np.sqrt(((pool[q] - v) ** 2).sum())), i) for i, v in pool.items() if i != q)[:10]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hits += len({i for _, i in true} & {i for _, i, _ in mine})
    assert hits >= 9 * len(queries)
    assert [i for _, i, s in sorted(got[100])] == list(range(2000, 2010))  # ties: smaller ids


def test_multiindex_few_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [4.0, 2.0])], "vec_id long, embedding array<double>")
    out = multiindex.search(df, F.col("vec_id") == 0)
    assert [(r.vec_id, r.score) for r in out.orderBy("rank").collect()] == [(1, 1.0), (2, 3.0)]
    assert multiindex.search(df.limit(0), F.col("vec_id") == 0).count() == 0


# 2 ---------------------------------------------------------------------------
def test_patience_alignment():
    a, b = list("abcxyzd"), list("qabcwyzd")
    assert linededup.patience(a, b) == [(0, 1), (1, 2), (2, 3), (4, 5), (5, 6), (6, 7)]
    assert linededup.aligned_blocks(a, b, [1] * 8, 3) == [(1, 4), (5, 8)]
    assert linededup.patience([], b) == []


def test_line_dedup(spark):
    rng = random.Random(1)
    block = "\n".join(words(rng, 6) for _ in range(4))
    own = [words(rng, 9) for _ in range(12)]
    rows = [(1, own[0] + "\n" + block), (2, own[1] + "\n" + block + "\n" + own[2]), (3, None), (4, ""),
            (5, block), (6, "short line\n" + own[3]), (7, "short line\n" + own[4]), (None, block)]
    rows += [(10 + i, block + "\n" + words(rng, 9)) for i in range(6)]  # more than `rare`
    rows += [(2, rows[1][1])]
    out = {}
    for r in linededup.dedup_lines(docs(spark, rows)).collect():
        out.setdefault(r.doc_id, []).append((r.text, r.n_removed, r.shard))
    assert out[1] == [(rows[0][1], 0, "x")]
    assert out[2] == [(own[1] + "\n" + own[2], 4, "x")] * 2
    assert out[3] == [(None, 0, "x")] and out[4] == [("", 0, "x")] and out[5] == [("", 4, "x")]
    assert out[6][0][1] == out[7][0][1] == 0 and out[None][0][0] == block
    assert all(out[10 + i][0][1] == 4 for i in range(6))
    assert linededup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_runs_of_short_lines(spark):
    """Blocks of short lines, and blocks of lines that first stand apart in
    other documents, each held by more than ``rare`` documents."""
    rng = random.Random(4)
    short = ["a b", "c d e", "", "f", "g h i", "j"]
    x, y = "one two three four five", "six seven eight nine"
    rows = [(1, "\n".join([words(rng, 9), *short])), (2, "\n".join([*short, words(rng, 9)]))]
    rows += [(10 + i, x + "\n" + words(rng, 9)) for i in range(5)]
    rows += [(20 + i, words(rng, 9) + "\n" + y) for i in range(5)]
    rows += [(30 + i, words(rng, 9) + "\n" + x + "\n" + y + "\n" + words(rng, 9)) for i in range(6)]
    out = {r.doc_id: r for r in linededup.dedup_lines(docs(spark, rows)).collect()}
    texts = dict(rows)
    assert out[2].text == texts[2].split("\n")[-1] and out[2].n_removed == 6
    assert all(out[i].text == texts[i] for i in [1, *range(10, 15), *range(20, 25), 30])
    for i in range(31, 36):
        first, *_, last = texts[i].split("\n")
        assert out[i].text == first + "\n" + last and out[i].n_removed == 2


def test_line_dedup_run_keys():
    def plain(lines, sizes, need):
        """Runs that are too short without their first or without their last line."""
        places = [(s, e) for s in range(len(lines)) for e in range(s, len(lines))]
        total = {(s, e): sum(sizes[s:e + 1]) for s, e in places}
        return {tuple(lines[s:e + 1]) for s, e in places
                if sizes[s] and sizes[e] and total[s, e] >= need
                and (total[s, e] - sizes[s] < need or total[s, e] - sizes[e] < need)}

    rng = random.Random(9)
    for _ in range(200):
        n = rng.randrange(1, 25)
        lines = [rng.randrange(1, 6) for _ in range(n)]
        sizes = [(0, 2, 3, 9, 1)[v - 1] for v in lines]
        hashes = np.array([hash((v, "x")) & (2**64 - 1) for v in lines], np.uint64)
        got = linededup.run_keys(hashes, np.array(sizes, np.int32), 8)
        assert len(got) == len(plain(lines, sizes, 8))
        # equal runs have equal keys wherever they stand
        moved = linededup.run_keys(np.r_[np.uint64(7), hashes], np.r_[np.int32(0), sizes], 8)
        assert set(got) == set(moved)


def test_line_dedup_leaves_no_shared_run(spark):
    """Blocks that stand twice, in crossing order, and with empty lines, held by
    more than ``rare`` documents, against every run of the earlier documents."""
    def brute(rows):
        left = {}
        for i, lines in rows:
            gone, earlier = set(), [x for j, x in rows if j < i]
            places = [(s, e) for s in range(len(lines)) for e in range(s + 1, len(lines) + 1)]
            for s, e in places:
                if (sum(len(x.split()) for x in lines[s:e]) >= 8
                        and any(lines[s:e] == x[k:k + e - s] for x in earlier for k in range(len(x)))):
                    gone.update(range(s, e))
            left[i] = [x for k, x in enumerate(lines) if k not in gone], len(gone)
        return left

    rng = random.Random(7)
    own = iter(f"o{i} own line of more than eight words o{i} here" for i in range(1000))
    p, q = "p one two three four five six seven eight", "q one two three four five six seven eight"
    rows = [(1, [next(own), p, next(own), p, next(own)]), (2, [next(own), p, next(own)]),
            (3, [q, p, "", next(own)]), (4, [next(own), p, q]), (5, [p, "", q]), (6, [q, p, q, p])]
    rows += [(10 + i, [next(own), p, "", q, next(own)]) for i in range(6)]
    pool = ["a b c d", "e f g", "h i j k l", "", "m", p, q]
    rows += [(100 + i, [rng.choice(pool) if rng.random() < 0.8 else next(own) for _ in range(rng.randrange(1, 9))])
             for i in range(60)]
    want = brute(rows)
    assert want[2][1] == 1 and want[4][1] == 2
    got = {r.doc_id: r for r in linededup.dedup_lines(docs(spark, [(i, "\n".join(x)) for i, x in rows])).collect()}
    for i, (lines, n) in want.items():
        assert (got[i].text, got[i].n_removed) == ("\n".join(lines), n), i


# 3 ---------------------------------------------------------------------------
def test_warc_round_trip(spark):
    big = "é" * 3_000_000
    rows = [(1, "http://a/ b\n", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", big), (6, "u", "WARC/1.1\r\n\r\nx")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, refers_to int")
    folder = shared_path(spark, "warc")
    listing = warc.write_archives(warc.mark_revisits(df), folder)
    chunks = warc.read_chunks(listing, folder, chunk_bytes=1 << 16)
    got = {r.page_id: r for r in warc.records(chunks).collect()}
    for i, _, html in rows:
        b = (html or "").encode()
        assert got[i].payload_bytes == len(b) and got[i].digest_ok
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None),
        5: ("response", None), 6: ("response", None)}
    parts = chunks.where("record_id = 'urn:x-page:5'").orderBy("chunk_no").collect()
    assert len(parts) == -(-6_000_000 // (1 << 16)) and b"".join(p.chunk for p in parts).decode() == big
    sha = hashlib.sha1()
    for p in parts:  # every chunk carries the digest of all bytes so far
        sha.update(p.chunk)
        assert p.digest_so_far == base64.b32encode(sha.digest()).decode()
    assert warc.round_trip(spark, df.limit(0), shared_path(spark, "warc")).count() == 0


# 4 ---------------------------------------------------------------------------
def test_bpe_equals_tiktoken(spark):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["", "a" * 2000, "ab" * 700 + "é" * 300, "日本語テキスト" * 40, "<|endoftext|> x", "\x00 \n\n\t x", "🙂" * 99,
             " ".join(words(rng, 50)), "".join(chr(rng.choice([32, 97, 98, 233, 20013, 128512])) for _ in range(4000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None), (1, texts[1])]
    out = bpe.decode(bpe.encode(docs(spark, rows), RANKS, PATTERN), RANKS)
    assert "shard" in out.columns
    for r in out.collect():
        text = texts[r.doc_id] if r.doc_id < 99 else ""
        assert r.ids == enc.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    assert bpe.encode(docs(spark, []), RANKS, PATTERN).count() == 0


# 5 ---------------------------------------------------------------------------
def test_decontamination(spark):
    rng = random.Random(2)
    item, short = words(rng, 14), "Only Three words"
    bench = spark.createDataFrame([(7, item), (8, short), (8, short), (9, None), (10, "...")],
                                  "item_id long, text string")
    rows = [(1, "Start here. " + item.upper().replace(" ", " - ") + " tail."), (2, " ".join(item.split()[:9]) + " end"),
            (3, "so: only three WORDS! only three words"), (4, None), (5, ""), (1, "a b c")]
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.scan(docs(spark, rows), bench).collect())
    assert got == [(1, 3, 0, []), (1, 17, 14, ["7"]), (2, 10, 0, []), (3, 7, 6, ["8"]), (4, 0, 0, []), (5, 0, 0, [])]
    kept = sorted((r.doc_id, r.text) for r in decontaminate.remove_documents(docs(spark, rows[1:]), bench).collect() if r.text)
    assert kept == [(1, "a b c"), (2, rows[1][1])]
    cut = {(r.doc_id, r.text) for r in decontaminate.remove_spans(docs(spark, rows), bench).collect()}
    assert cut == {(1, "Start here.  tail."), (2, rows[1][1]), (3, "so: "), (4, None), (5, ""), (1, "a b c")}
    none = decontaminate.scan(docs(spark, rows), bench.limit(0)).collect()
    assert len(none) == 6 and not any(r.n_hit for r in none)


# 6 ---------------------------------------------------------------------------
def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|x"), (1, 2, "bob", None), (1, 2, "ann", "yo"), (1, 1, "ann", "hi <|x"),
            (2, 0, None, "q"), (None, 0, "ann", "n")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, speaker string")
    got = {(r.conv_id, r.speaker): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, "ann")}
    r = got[(1, "ann")]
    assert r.text == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |x<|end|>\n<|assistant|>\nyo<|end|>\n"
                      "<|user bob|>\n<|end|>\n") and r.n_turns == 4
    assert [r.text[s.start:s.end] for s in r.loss] == ["hi < |x<|end|>", "yo<|end|>"]
    long = spark.createDataFrame([(1, i, "ab"[i % 2], str(i)) for i in range(150)], "conv_id long, turn long, role string, text string")
    assert sorted((r.segment, r.speaker, r.n_turns) for r in chat.rotate(long).collect()) == [
        (s, p, n) for s, n in ((0, 64), (1, 64), (2, 22)) for p in "ab"]
    assert chat.rotate(df.limit(0)).count() == 0


def test_perspectives_add_up_to_the_whole_dialogue(spark):
    """A late speaker, one who falls silent, a segment of narration only."""
    def role(i):
        return "system" if i == 0 or 64 <= i < 128 else "cy" if i >= 140 else "ab"[i % 2]
    turns = [(c, i, role(i), f"t{i}") for c in (1, None) for i in range(150)] + [(2, 0, "ann", "x"), (3, 0, "system", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.speaker, r.segment): r for r in chat.rotate(df).collect()}
    assert set(got) == {(c, p, s) for c in (1, None) for p in ("a", "b", "cy") for s in range(3)} | {(2, "ann", 0)}
    for c in (1, None):
        for p in ("a", "b", "cy"):
            parts = [got[c, p, s] for s in range(3)]
            assert [r.n_turns for r in parts] == [64, 64, 22]
            assert "".join(r.text for r in parts) == "".join(
                f"<|{'assistant' if role(i) == p else 'system' if role(i) == 'system' else 'user ' + role(i)}|>\n"
                f"t{i}<|end|>\n" for i in range(150))
            assert [r.text[s.start:s.end] for r in parts for s in r.loss] == [
                f"t{i}<|end|>" for i in range(150) if role(i) == p]


# 7 ---------------------------------------------------------------------------
def brute_repeats(rows, width):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[p:p + width] for p in range(len(b) - width + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] > 1:
                gone[p:p + width] = True
        edge = np.diff(np.r_[0, gone.astype(int), 0])
        out.append((i, len(b), int(gone.sum()), int((edge == 1).sum()),
                    bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


@pytest.mark.parametrize("crowd", [2000, 3])
def test_repeated_strings(spark, crowd):
    rng = random.Random(4)
    base = words(rng, 160, 10**6)
    rows = [(1, base), (2, base[100:]), (3, None), (4, ""), (5, "a" * 700), (6, "ab" * 300), (7, base), (7, base),
            (8, words(rng, 40, 10**6) + base[50:249]), (9, "é" * 150 + base[300:620])]
    rows += [(20 + k, words(rng, 20, 10**6) + base[200:430 + k] + words(rng, 20, 10**6)) for k in range(12)]
    out = suffixes.remove_repeats(docs(spark, rows), 200, crowd)
    got = sorted((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.runs), len(r.runs), bytes(r.kept)) for r in out.collect())
    assert got == brute_repeats(rows, 200)
    assert suffixes.remove_repeats(docs(spark, [])).count() == 0


# 8 ---------------------------------------------------------------------------
def brute_components(rows, n):
    sets = []
    for i, t in rows:
        w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
             .replace("\t", " ").replace("\n", " ").split(" ") if x]
        k = min(n, len(w))
        sets.append((i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()))
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(a), find(i)) for i, a in sets)


def test_near_duplicates(spark):
    rng = random.Random(6)
    rows, at = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "ONE two"), (6, "É x"), (7, "é x")], 100
    for _ in range(6):  # dense groups around the threshold, and chains
        base = words(rng, 80, 10**6).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(1, 9)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
            rows.append((at, " ".join(w)))
            at += 1
    rows += [(at + i, rows[60][1]) for i in range(30)]
    for n in (2, 5):
        out = minhash.near_duplicates(docs(spark, rows), words=n)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
        assert got == brute_components(rows, n)
    kept = minhash.keep_one(docs(spark, rows + [rows[20]]), words=5)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, c in brute_components(rows, 5) if i == c]
    assert kept.columns == ["doc_id", "text", "shard", "n", "key"]
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


# 9 ---------------------------------------------------------------------------
def test_language_id_held_out_accuracy(spark):
    from conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    out = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 150 and sum(r.lang_pred == r.lang for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_id_edges(spark):
    rows = [(i, t, lang, "src") for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20
        + [(None, "en"), ("", "de"), ("123 !!", "en"), ("the dog" * 200_000, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows)
    for i, t, lang, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        want = "und" if i in (40, 41, 42) else "en" if i == 43 else lang
        assert got[i].lang_pred == want, i
    assert langid.identify(df.limit(0)).count() == 0
    alone = langid.identify(df.where("lang is null")).collect()
    assert [(r.lang_pred, r.score) for r in alone] == [("und", 0.0)]


def test_ngrams_do_not_depend_on_blocks(monkeypatch):
    texts = ["abc déf " * 50, None, "x", "", "long text " * 80]

    def counts():
        out = collections.Counter()
        for who, what in langid.ngram_buckets(texts):
            out.update(zip(who.tolist(), what.tolist()))
        return out
    whole = counts()
    monkeypatch.setattr(langid, "BLOCK", 37)
    assert counts() == whole


# 10 --------------------------------------------------------------------------
def test_sharding(spark):
    rng = random.Random(8)
    rows = [(i, words(rng, 3)) for i in range(700)] + [(5, "same")] * 400 + [(None, "n"), (9, None), (10, "")]
    out = sharding.shard_rows(docs(spark, rows), n_shards=7).collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(7)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sharding.shard_rows(docs(spark, [])).count() == 0


def test_ring_walk_equals_one_key_at_a_time():
    rng = random.Random(9)
    points = sharding.ring_points(5, vnodes=4, slots=64)
    counts = {s: rng.randrange(1, 30) for s in rng.sample(range(64), 30)}
    parts = sharding.walk_ring(counts, points, 5)
    home = collections.Counter()
    ring = [p for p, _ in points]
    start = {s: next((i for i, p in enumerate(ring) if p >= s), 0) for s in counts}
    for s, n in counts.items():
        home[points[start[s]][1]] += n
    cap = sharding.capacities(sum(counts.values()), [home[i] for i in range(5)])
    load, want, late = [0] * 5, {}, []
    for s in sorted(counts):
        for k in range(counts[s]):
            shard = points[start[s]][1]
            if load[shard] < cap[shard]:
                want[s, k], load[shard] = shard, load[shard] + 1
            else:
                late.append((s, k))
    for s, k in late:
        i = start[s]
        while load[points[i % len(points)][1]] >= cap[points[i % len(points)][1]]:
            i += 1
        want[s, k] = points[i % len(points)][1]
        load[want[s, k]] += 1
    assert {(s, k): shard for s, a, b, shard, _ in parts for k in range(a, b)} == want
    more = sharding.walk_ring(counts, sharding.ring_points(6, vnodes=4, slots=64), 6)
    moved = sum(want[s, k] != shard for s, a, b, shard, _ in more for k in range(a, b))
    assert moved < 0.6 * sum(counts.values())
