"""The pipeline's stages on planted cases, and its guard."""

import random

import corpus_pipeline
from civiclens.llm import bpe
from civiclens.llm.queries import RANKS


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)

    def text(n, lines=1):
        return "\n".join(" ".join(rng.choice(["the", "and", "of"]) + f"x{rng.randrange(10**5)}" for _ in range(n))
                         for _ in range(lines))
    leak, base, block = text(20), text(60), text(8, 3)
    edit = base.split()
    edit[30] = "changed"
    rows = [(i, text(30), "en") for i in range(1, 41)]
    rows += [(50, None, "en"), (51, "123 ...", "en"), (60, base, "en"), (61, " ".join(edit), "en"), (62, base, "de"),
             (70, block + "\n" + text(30), "en"), (71, text(30) + "\n" + block, "en"), (80, text(9) + " " + leak, "en"),
             (90, text(30), None), (90, None, "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, n int")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), out.schema)
        left[name] = {r.doc_id: r.text for r in out.collect()}
        now = out
    clean = set(range(1, 41)) | {70, 90}
    assert set(left["language_id"]) == clean | {60, 61, 62, 71, 80}
    assert 62 not in left["line_dedup"] and block not in left["line_dedup"][71] and block in left["line_dedup"][70]
    assert set(left["near_dedup"]) == clean | {60, 71, 80}
    assert set(left["decontamination"]) == clean | {60, 71}
    tokens = bpe.read_ranks(RANKS)
    for r in now.collect():
        assert b"".join(tokens[i] for i in r["ids"]).decode() == left["decontamination"][r.doc_id] == r.text
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
