"""Language scores against a plain dictionary naive Bayes, and the sample."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from civiclens.llm import langid


def grams(text):
    return [int(b) for _, what in langid.ngram_buckets([text]) for b in what]


def corpus(rng, n):
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["str", "och", "ing"], "cc": ["ka", "och", "é"]}
    rows = [(i, " ".join(rng.choice(sounds[lang]) + rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 9))), lang)
            for i, lang in enumerate(rng.choices(list(sounds), [6, 3, 1], k=n))]
    return rows + [(n, None, "aa"), (n + 1, "12 !", "bb"), (n + 2, "kato", None)]


def test_predictions_equal_plain_naive_bayes(spark):
    rows = corpus(random.Random(1), 300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    held = {r.doc_id for r in df.where(langid.is_held_out(F.col("doc_id"))).collect()}
    counts, docs = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang and i not in held and text and any(c.isalpha() for c in text):
            docs[lang] += 1
            counts[lang].update(grams(text))
    langs = sorted(docs)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        score = {}
        for lang in langs:
            total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
            score[lang] = math.log(docs[lang] / sum(docs.values())) + sum(
                math.log((counts[lang][b] + 0.5) / total) for b in grams(text))
        best = max(langs, key=lambda x: (score[x], -langs.index(x)))
        p = 1 / sum(math.exp(score[x] - score[best]) for x in langs)
        assert abs(got[i].score - p) < 1e-4, (text, score)
        assert got[i].lang_pred == best or p < 0.5001


def test_sample_is_bounded_and_large_enough(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"),
        F.when(F.col("id") % 10 == 0, "aa").otherwise("bb").alias("lang"))
    seen = []
    model = langid.fit(df, max_docs=200)
    assert model.langs == ["aa", "bb"]
    # the share of hashes leaves no fewer than max_docs of either language
    own = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    for lang, n in (("aa", 6000), ("bb", 54000)):
        top = int((200 + 8 * 200 ** 0.5 + 20) / n * (1 << 64)) - (1 << 63)
        seen.append(df.where((F.col("lang") == lang) & (own <= top)).count())
    assert all(200 <= k < 500 for k in seen), seen


def test_foreign_scripts_and_noise_are_not_recognised(spark):
    """Fitted on the invented prose of the smallest tables."""
    import base64

    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng, row = random.Random(1), docs.where("lang = 'en'").first().asDict()
    odd = {"Greek": "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί " * 3,
           "Chinese": "敏捷的棕色狐狸跳过了懒狗。今天天气很好" * 3, "Russian": "Быстрая коричневая лиса прыгает через собаку " * 3,
           "base64": base64.b64encode(rng.randbytes(600)).decode(), "hex": rng.randbytes(300).hex(), "digits": "12 345 " * 9,
           "null": None, "empty": ""}
    more = spark.createDataFrame([{**row, "doc_id": 10**6 + i, "text": t, "lang": None} for i, t in enumerate(odd.values())], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(more), sf).collect()}
    assert not [n for i, n in enumerate(odd) if 10**6 + i in kept]
    gone = [r.text for r in docs.collect() if r.doc_id not in kept]
    assert len(gone) <= 2 and all(sum(c.isalpha() for c in t or "") < 0.6 * len(t or "") for t in gone)
