"""Text classifier, explanations and clean-up on a toy corpus."""

from pyspark.sql import functions as F

from civiclens.operators import textml


def _corpus(spark):
    good = ["God bless the church and prayer", "faith church prayer Jesus", "the church of faith",
            "prayer and faith in God", "Jesus church prayer faith"]
    bad = ["atheism argument logic proof", "no god logic argument", "proof logic atheism claim",
           "argument atheism logic", "logic proof argument claim"]
    rows = [("christian", t, i) for i, t in enumerate(good * 4)]
    rows += [("atheism", t, 100 + i) for i, t in enumerate(bad * 4)]
    return spark.createDataFrame(rows, "category string, text string, id long").repartition(3)


def test_split_is_deterministic_and_complete(spark):
    df = _corpus(spark)
    a, b = textml.split_train_test(df, 0.6)
    ids_a = {r.id for r in a.collect()}
    ids_b = {r.id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 40
    assert ids_a == {r.id for r in textml.split_train_test(df.repartition(7), 0.6)[0].collect()}


def test_fit_predict_explain(spark):
    df = _corpus(spark)
    model = textml.fit(df)
    pred = textml.predict(model, df)
    rows = pred.select("label", "prediction", "conf").collect()
    assert sum(r.label == r.prediction for r in rows) >= 36
    assert all(0.0 <= r.conf <= 1.0 for r in rows)
    exp = textml.explain(model, df.filter(F.col("id").isin(0, 100)).select("id", "text"),
                         num_features=3, num_samples=64).collect()
    by_doc = {}
    for r in exp:
        by_doc.setdefault(r.id, []).append(r)
    assert set(by_doc) == {0, 100} and all(len(v) == 3 for v in by_doc.values())
    words0 = {r.word for r in by_doc[0]}
    assert words0 <= set("God bless the church and prayer".split())
    ranks = [r.rank for r in sorted(by_doc[0], key=lambda r: r.rank)]
    assert ranks == [1, 2, 3]
    ww = {r.word: (r.frequency, r.weight) for r in textml.word_weights(textml.explain(
        model, df.filter(F.col("id").isin(0, 100)).select("id", "text"), 3, 64)).collect()}
    assert sum(f for f, _ in ww.values()) == 6


def test_remove_words_and_corrected(spark):
    df = spark.createDataFrame([("Carl said Carlos", 1)], "text string, id long")
    assert textml.remove_words(df, ["Carl", "said"]).first().text == "  os"
    old = spark.createDataFrame([(1, 1.0, 0.0, 0.5), (2, 1.0, 0.0, 0.05), (3, 0.0, 0.0, 0.9)],
                                "id long, label double, prediction double, conf double")
    new = spark.createDataFrame([(1, 1.0, 1.0, 0.5), (2, 1.0, 1.0, 0.5), (3, 0.0, 0.0, 0.9)],
                                "id long, label double, prediction double, conf double")
    assert [r.id for r in textml.corrected(old, new, 0.1).collect()] == [1]


def test_forward_selection_matches_brute_force():
    import itertools

    import numpy as np

    from civiclens.operators.textml import _forward_selection

    rng = np.random.default_rng(0)
    X = (rng.random((60, 7)) > 0.5).astype(float)
    y = X @ np.array([0.5, -1.0, 0.0, 2.0, 0.1, 0.0, -0.3]) + rng.normal(0, 0.1, 60)
    w = rng.random(60) + 0.1

    def wr2(cols):
        A = np.column_stack([np.ones(60), X[:, cols]]) * np.sqrt(w)[:, None]
        b = y * np.sqrt(w)
        beta, *_ = np.linalg.lstsq(A, b, rcond=None)
        return -np.sum((b - A @ beta) ** 2)

    chosen = []
    for _ in range(3):
        best = max((j for j in range(7) if j not in chosen), key=lambda j: (wr2(chosen + [j]), -j))
        chosen.append(best)
    assert list(_forward_selection(X, y, w, 3)) == chosen


def test_perturbation_removes_exactly_k_words(spark):
    from civiclens.operators.textml import perturbations
    df = spark.createDataFrame([(1, "a b c d e f g h a b")], "id long, text string")
    rows = perturbations(df, num_samples=40).collect()
    assert len(rows) == 40
    orig = [r for r in rows if r.s == 0][0]
    assert all(orig.kept) and orig.text == "a b c d e f g h a b"
    for r in rows:
        if r.s:
            removed = {w for w, k in zip("abcdefgh", r.kept) if not k}
            assert 1 <= len(removed) <= 8
            assert set(r.text.split()) == set("abcdefgh") - removed


def test_clean_and_refit_and_evaluate(spark):
    df = _corpus(spark)
    model, pred = textml.clean_and_refit(df, df, ["church", "logic"])
    m = {r.label: r for r in textml.evaluate(pred).collect()}
    assert set(m) == {0.0, 1.0} and 0.0 <= m[0.0].accuracy <= 1.0
    assert "church" not in " ".join(r.text for r in textml.remove_words(df, ["church"]).collect())


def test_two_labels_give_a_binary_model(spark):
    from civiclens.operators import textml
    rows = [(i, "a" if i % 2 else "b", "x y" if i % 2 else "z w") for i in range(20)]
    model = textml.fit(spark.createDataFrame(rows, "id int, category string, text string"))
    assert model.stages[-1].numClasses == 2


def test_explanations_equal_a_dense_fit(spark):
    import numpy as np
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    df = _corpus(spark)
    model = textml.fit(df)
    text = "prayer logic church, logic of claim and God: argument proof Jesus logic"
    doc = spark.createDataFrame([(7, text)], "id long, text string")
    copies = PipelineModel(stages=model.stages[1:]).transform(textml.perturbations(doc, num_samples=400))
    rows = copies.select("s", "kept", "vocab", "weight", vector_to_array("probability").alias("p")).collect()
    rows.sort(key=lambda r: r.s)
    X = np.array([r.kept for r in rows], float)
    y, w = np.array([r.p[1] for r in rows]), np.array([r.weight for r in rows])
    for k in (4, 7):
        sw = w / w.sum()
        Xc, yc = (X - sw @ X) * np.sqrt(w)[:, None], (y - sw @ y) * np.sqrt(w)
        if k <= 6:
            chosen = textml._forward_selection(X, y, w, k)
        else:
            beta = np.linalg.solve(Xc.T @ Xc + 0.01 * np.eye(X.shape[1]), Xc.T @ yc)
            chosen = np.argsort(-np.abs(beta), kind="stable")[:k]
        A = Xc[:, chosen]
        final = np.linalg.solve(A.T @ A + np.eye(k), A.T @ yc)
        want = sorted(zip((rows[0].vocab[j] for j in chosen), final), key=lambda x: -abs(x[1]))
        got = textml.explain(model, doc, num_features=k, num_samples=400).orderBy("rank").collect()
        assert [r.word for r in got] == [x for x, _ in want]
        assert max(abs(r.weight - x) for r, (_, x) in zip(got, want)) < 1e-6
    assert textml.explain(model, spark.createDataFrame([(1, "?!"), (2, None)], "id long, text string")).count() == 0


def test_explanation_of_three_classes(spark):
    rows = [(i, "abc"[i % 3], ["red sun", "blue sea", "green tree"][i % 3] + " and") for i in range(30)]
    model = textml.fit(spark.createDataFrame(rows, "id long, category string, text string"))
    doc = spark.createDataFrame([(1, "red sea and tree")], "id long, text string")
    got = textml.explain(model, doc, 2, 300, target_class=2).collect()
    assert got[0].word == "tree" and got[0].weight > 0


def test_memory_of_a_long_document():
    """20,000 distinct words, 5,000 copies: bits and one block, not 0.8 GB."""
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(1)
    seeds, effects = rng.integers(0, 1 << 63, 20000).astype(np.uint64), rng.normal(size=(20000, 2)) / 100
    tracemalloc.start()
    sums = textml.copy_sums(seeds, effects, np.zeros(2), 5, 5000, 1)
    chosen, final = textml.explain_copies(sums, 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20 and len(set(chosen.tolist())) == 6 and np.abs(final).min() > 0


def test_sums_do_not_depend_on_blocks(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(2)
    seeds, effects = rng.integers(0, 1 << 63, 50).astype(np.uint64), rng.normal(size=(50, 2))
    a = textml.copy_sums(seeds, effects, np.zeros(2), 5, 700, 1)
    monkeypatch.setattr(textml, "CELLS", 1000)
    b = textml.copy_sums(seeds, effects, np.zeros(2), 5, 700, 1)
    assert len(b.bits) > len(a.bits) and (a.x == b.x).all() and np.allclose(a.cov_y, b.cov_y, atol=1e-9)


def test_fit_equals_newton(spark):
    """TF-IDF weights and converged coefficients against numpy: weighted L2 on
    standardised features, solved by Newton steps."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF

    df = _corpus(spark).withColumn("text", F.concat("text", F.lit(" "), F.col("id").cast("string")))
    noisy = df.withColumn("category", F.when(F.col("id") % 7 == 0, "atheism").otherwise(F.col("category")))
    stages = textml.classifier_stages(max_iter=2000, reg_param=0.01)
    lr = [s for s in stages.getStages() if isinstance(s, LogisticRegression)][0]
    lr.setTol(1e-14)
    model = stages.fit(noisy)
    rows = model.transform(noisy).select("label", "words", "rawFeatures", "features", "probability").collect()
    used = np.array(sorted({int(i) for r in rows for i in r.features.indices}))
    X = np.array([r.features.toArray()[used] for r in rows])
    y = np.array([r.label for r in rows])
    tf = np.array([r.rawFeatures.toArray()[used] for r in rows])
    index = HashingTF(numFeatures=1 << 18)
    for r in rows[:3]:  # term counts by the hash of each word
        want = {}
        for w in r.words:
            want[index.indexOf(w)] = want.get(index.indexOf(w), 0) + 1
        assert {int(i): v for i, v in zip(r.rawFeatures.indices, r.rawFeatures.values)} == want
    assert np.allclose(X, tf * np.log((len(rows) + 1) / ((tf > 0).sum(axis=0) + 1)))
    n, sd = len(rows), X.std(axis=0, ddof=1)
    Z, b = np.column_stack([np.ones(n), X / sd]), np.zeros(len(used) + 1)
    penalty = np.r_[0.0, np.full(len(used), 0.01)]
    for _ in range(60):
        p = 1 / (1 + np.exp(-Z @ b))
        grad = Z.T @ (p - y) / n + penalty * b
        hess = (Z * (p * (1 - p))[:, None]).T @ Z / n + np.diag(penalty)
        b -= np.linalg.solve(hess, grad)
    fitted = model.stages[-1]
    assert np.abs(fitted.coefficients.toArray()[used] - b[1:] / sd).max() < 1e-5
    assert abs(fitted.intercept - b[0]) < 1e-5
    assert np.abs(np.array([r.probability[1] for r in rows]) - 1 / (1 + np.exp(-Z @ b))).max() < 1e-6


def test_texts_are_tokenised_once_a_fit(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = _corpus(spark)
    same = textml.fit(df)
    model = textml.fit(df.mapInArrow(noted, df.schema))
    # one pass for the labels, one for the term counts of the texts
    assert seen.value == 80
    assert [type(s) for s in model.stages] == [type(s) for s in same.stages]
    kept = model.stages[-1].summary.predictions.columns
    assert "text" not in kept and "words" not in kept


def test_explanations_are_spread_over_all_tasks(spark):
    """Few bytes, much work: the documents are not left in a few partitions."""
    df = _corpus(spark)
    parts = textml.explain(textml.fit(df), df.select("id", "text"), 3, 64).withColumn(
        "p", F.spark_partition_id()).agg(F.countDistinct("p")).first()[0]
    assert parts >= 3


def test_refit_predicts_once(spark, monkeypatch, tmp_path):
    """The new model's predictions are written down before they are read twice."""
    from civiclens.plans import catalog
    _corpus(spark).selectExpr("id AS doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    _corpus(spark).selectExpr("id AS doc_id", "CAST(category = 'atheism' AND id % 7 > 0 AS INT) AS quality").write.parquet(
        f"{tmp_path}/labels.parquet")
    plans = []
    corrected = textml.corrected
    monkeypatch.setattr(textml, "corrected", lambda old, new, c: plans.append(new) or corrected(old, new, c))
    out = catalog.QUERIES["clean_and_refit"](spark, str(tmp_path))
    assert out.count() == 5
    assert "FileScan" not in plans[0]._jdf.queryExecution().executedPlan().toString()
