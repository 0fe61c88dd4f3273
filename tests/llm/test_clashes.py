"""Extra columns with the names that operators and stages use inside, the
alignment of line dedup, candidate pairs of near-duplicates, scratch tables."""

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from civiclens.llm import common, decontaminate, linededup, minhash

INNER = ["row", "lines", "gone", "spans", "id", "h", "_h", "n", "s", "_n", "_s", "_kid", "_kh", "_lines", "_gone", "_spans",
         "_bid", "_bh", "_bad_id", "_bad_h", "_t", "key", "m", "n_lines", "n_removed", "n_cut", "n_lines_", "a.b"]


def wide(spark, rows):
    cols = ", ".join(f"`{c}` string" for c in INNER)
    return spark.createDataFrame([(i, t, *INNER) for i, t in rows], f"doc_id long, text string, {cols}")


def words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_no_name_of_a_column_clashes(spark, tmp_path):
    rng = random.Random(1)
    block, item = words(rng, 9), words(rng, 12)
    rows = [(1, block + "\nx"), (2, "y\n" + block), (3, words(rng, 30)), (5, item + " z"), (6, None), (7, ""), (5, item + " z")]
    rows += [(4, rows[2][1] + " end")]
    df = wide(spark, rows)
    bench = spark.createDataFrame([(1, item, "x")], "item_id long, text string, spans string")
    out = linededup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines__", "n_removed_"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "y" and got[2]["n_lines__"] == 2 and got[2]["n_removed_"] == 1 and got[2]["n_lines"] == "n_lines"
    assert sorted(r.doc_id for r in minhash.keep_one(df).collect()) == [1, 2, 3, 5, 6, 7]
    assert sorted(r.doc_id for r in decontaminate.remove_documents(df, bench).collect()) == [1, 2, 3, 4, 6, 7]
    cut = {r.doc_id: r for r in decontaminate.remove_spans(df, bench).collect()}
    assert cut[5].text == " z" and cut[3].text == rows[2][1] and all(cut[5][c] == c for c in INNER)
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.decontamination):
        kept = stage(spark, df, str(tmp_path))
        assert kept.columns == df.columns and all(r[c] == c for r in kept.collect() for c in INNER)


def by_rule(a, b, wa, wb, least):
    """The lines of b in a run of neighbouring lines with enough words that a has."""
    held = set()
    for i in range(len(a)):
        for j in range(i, len(a)):
            if sum(wa[i:j + 1]) >= least:
                held.add(tuple(a[i:j + 1]))
                break
        for j in range(i, -1, -1):
            if sum(wa[j:i + 1]) >= least:
                held.add(tuple(a[j:i + 1]))
                break
    gone = set()
    for i in range(len(b)):
        for j in range(i, len(b)):
            if sum(wb[i:j + 1]) >= least:
                if tuple(b[i:j + 1]) in held or any(b[i:j + 1] == a[k:k + j - i + 1] for k in range(len(a))):
                    gone.update(range(i, j + 1))
                break
        for j in range(i, -1, -1):
            if sum(wb[j:i + 1]) >= least:
                if any(b[j:i + 1] == a[k:k + i - j + 1] for k in range(len(a))):
                    gone.update(range(j, i + 1))
                break
    return gone


def pairs_of_lines(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        vocab = rng.sample(range(1, 10**6), 7)
        n_words = {v: rng.choice([0, 1, 3, 5, 9]) for v in vocab}
        a, b = ([rng.choice(vocab) for _ in range(rng.randrange(14))] for _ in range(2))
        yield a, b, [n_words[x] for x in a], [n_words[x] for x in b]


def test_alignment_leaves_no_shared_run():
    for a, b, wa, wb in pairs_of_lines(3, 1500):
        got = {i for s, e in linededup.common_spans(a, b, wa, wb, 8) for i in range(s, e)}
        assert got == by_rule(a, b, wa, wb, 8), (a, b, wa, wb)


def test_the_alignments_decide(monkeypatch):
    """Without them nothing is deleted; with the first only, repeated and
    crossing blocks stay."""
    cases = list(pairs_of_lines(4, 300))
    full = [linededup.common_spans(*c, 8) for c in cases]
    monkeypatch.setattr(linededup, "_seeded", lambda *a: [])
    first = [linededup.common_spans(*c, 8) for c in cases]
    monkeypatch.setattr(linededup, "aligned_blocks", lambda *a: [])
    assert not any(linededup.common_spans(*c, 8) for c in cases)
    assert any(first) and first != full


def test_pairs_of_a_passage_that_many_texts_share(spark, monkeypatch):
    """Texts that are not linked but share a passage: candidate pairs stay in
    proportion to the texts."""
    rng = random.Random(5)
    passage = words(rng, 60)
    n = 3000
    rows = [(i, passage + " " + words(rng, 60)) for i in range(n)]
    rows += [(n + i, passage + " " + words(rng, 8)) for i in range(60)]  # linked with one another by chance
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    new = minhash._new
    monkeypatch.setattr(minhash, "_new", lambda pairs, *a: (seen.append(pairs.distinct().count()), new(pairs, *a))[1])
    out = minhash.near_duplicates(df, 2, 80).where("not kept").count()
    assert sum(seen) < 40 * n and out < 200


def test_near_duplicates_leave_their_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "ensure_checkpoint_dir", lambda s: str(tmp_path))
    rng = random.Random(6)
    base = words(rng, 50)
    df = spark.createDataFrame([(i, base + f" {i}") for i in range(9)] + [(20, words(rng, 20))], "doc_id long, text string")
    out = minhash.near_duplicates(df, 2, 80)
    assert out.where("kept").count() == 2
    assert sorted(f.rsplit("-", 1)[0] for f in os.listdir(tmp_path)) == ["classes", "labels", "minmax"]
    linededup.dedup_lines(df).count()
    assert sorted(f.rsplit("-", 1)[0] for f in os.listdir(tmp_path)) == ["classes", "labels", "minmax", "spans"]


def test_repeated_lines_as_arrays():
    a = np.array([1, 2, 1, 2, 3], np.int64).tolist()
    assert linededup.common_spans(a, a, [9] * 5, [9] * 5, 8) == [(0, 5)]
