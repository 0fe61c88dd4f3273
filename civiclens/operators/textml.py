"""Text classification, word-level explanations and feature clean-up.

* The classifier is the reference's Spark ML pipeline: label index →
  ``\\W+`` tokens (case kept) → hashed term frequencies → IDF → logistic
  regression (20 iterations, regularisation 0.001).
* ``explain`` re-aims the single-machine LIME library (Ribeiro et al.,
  2016) as one distributed job.  The classifier is linear in the word counts,
  so what a word adds to the model's raw score is found once per distinct word
  of all documents, by one ``model.transform``; the score of a perturbed copy is
  then the sum over the words it keeps, and no copy is written out or tokenised.
* Perturbation, as in the method: copy ``s`` of a document with ``D``
  distinct words removes exactly ``k`` of them, ``k`` uniform in 1..D, the
  ``k`` words being those with the smallest ``u(word, doc, s)`` (``u`` = a
  hash-based uniform number: copies are reproducible and independent of
  partitioning).  Every occurrence of a removed word goes.  Copy 0 is the
  original.  :func:`perturbations` gives the same copies as texts, for models
  that are not linear.
* Per document, the copies are made in blocks of at most ``CELLS`` draws and kept
  as one bit per (copy, word); the regression sees them through weighted sums
  only (:class:`_Sums`), so a document of 20,000 distinct words takes some 13 MB
  of bits and one block, not a matrix of copies x words.  Weights and targets
  are rounded to fixed-point numbers whose sums are exact, so they do not
  depend on the order of the copies or of the blocks.
* Word choice: forward selection on weighted least squares when at most 6
  words are asked for (the method's "auto" rule), otherwise the largest
  coefficients of a lightly regularised ridge; then a ridge (alpha 1) on
  the chosen words gives the reported weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.functions.text import remove_substrings, word_tokens
from civiclens.operators._plan import task_count

_U_SCALE = float(1 << 53)
# Copies of a document that are made in one place.
COPIES_PER_BLOCK = 64
# Draws (copies x distinct words) of a block of an explanation: 1 MB of 64-bit
# numbers, so that the passes over a block stay in the processor's cache.
CELLS = 1 << 17


def _uniform(*cols: Column) -> Column:
    """Reproducible uniform number in [0, 1) from a hash of the columns."""
    h = F.xxhash64(*cols)
    return F.shiftright(h, 11).bitwiseAND((1 << 53) - 1).cast("double") / F.lit(_U_SCALE)


def split_train_test(df: DataFrame, train_fraction: float = 0.6, key: str = "id",
                     seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by a hash of the key (no shuffle, no driver)."""
    u = _uniform(F.col(key), F.lit(seed))
    return df.filter(u < train_fraction), df.filter(u >= train_fraction)


def classifier_stages(max_iter: int = 20, reg_param: float = 0.001,
                        num_features: int = 1 << 18) -> Pipeline:
    return Pipeline(stages=[
        # No extra class for unknown labels: two categories give a binary fit.
        StringIndexer(inputCol="category", outputCol="label", stringOrderType="alphabetAsc"),
        RegexTokenizer(pattern="\\W+", inputCol="text", outputCol="words", toLowercase=False),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
        LogisticRegression(maxIter=max_iter, regParam=reg_param),
    ])


def fit(train: DataFrame, max_iter: int = 20, reg_param: float = 0.001,
        partitions: int | None = None) -> PipelineModel:
    """Fit the stages.  The training rows are spread over ``partitions``
    (default: the shuffle partitions, at least one per core).  A text is tokenised
    and hashed once: labels and term counts, not texts, are kept for the fit — IDF
    and the regression read them again."""
    n = partitions or task_count(train)
    indexer, tokenizer, counter, idf, regression = classifier_stages(max_iter, reg_param).getStages()
    labels = indexer.fit(train)
    data = PipelineModel(stages=[labels, tokenizer, counter]).transform(train.repartition(n))
    data = data.select("label", "rawFeatures").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = idf.fit(data)
        model = regression.fit(weights.transform(data))
    finally:
        data.unpersist()
    return PipelineModel(stages=[labels, tokenizer, counter, weights, model])


def predict(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """Predictions with ``conf = |p(class 0) - p(class 1)|``."""
    p = vector_to_array(F.col("probability"))
    return model.transform(docs).withColumn(
        "conf", F.abs(F.element_at(p, 1) - F.element_at(p, 2)))


def misclassified(pred: DataFrame) -> DataFrame:
    return pred.filter(F.col("label") != F.col("prediction"))


def remove_words(docs: DataFrame, words: Sequence[str], text: str = "text") -> DataFrame:
    """Feature clean-up: remove each word everywhere (inside other words
    too, case-sensitive), as the reference's ``str.replace`` loop."""
    return docs.withColumn(text, remove_substrings(F.col(text), words))


def perturbations(docs: DataFrame, num_samples: int = 5000, kernel_width: float = 25.0,
                  key: str = "id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Perturbed copies: ``(id, s, text, kept ARRAY<BOOLEAN>, vocab, weight)``.

    ``kept[j]`` tells whether distinct word j (first-appearance order) is
    kept; ``weight`` is LIME's kernel on the cosine distance to the original.
    """
    toks = docs.select(F.col(key).alias("id"), word_tokens(F.col(text)).alias("tokens"))
    toks = toks.withColumn("vocab", F.array_distinct("tokens"))
    # The fan-out is the heavy part: blocks of copies of every document are
    # spread over all tasks, so one long document does not load a single task;
    # the copies themselves are made behind the shuffle.
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = (num_samples - 1) // COPIES_PER_BLOCK
    blocks = toks.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_block"))
    first = F.col("_block") * COPIES_PER_BLOCK
    copies = blocks.repartition(n, "id", "_block").select(
        "id", "tokens", "vocab",
        F.explode(F.sequence(first, F.least(first + (COPIES_PER_BLOCK - 1), F.lit(num_samples - 1))))
         .alias("s"))
    # k words to remove, uniform in 1..D; the threshold is the k-th smallest
    # word draw of this copy, so exactly k distinct words fall at or below it
    d = F.size("vocab")
    k = F.least(F.floor(_uniform(F.col("id"), F.col("s")) * d).cast("int") + 1, d)
    draws = F.array_sort(F.transform("vocab", lambda w: _uniform(w, F.col("id"), F.col("s"))))
    cut = F.when((F.col("s") == 0) | (d == 0), F.lit(-1.0)).otherwise(F.element_at(draws, k))
    copies = copies.withColumn("cut", cut)
    keep = lambda w: _uniform(w, F.col("id"), F.col("s")) > F.col("cut")
    copies = copies.select(
        "id", "s",
        F.array_join(F.filter("tokens", keep), " ").alias(text),
        F.transform("vocab", keep).alias("kept"),
        F.size("vocab").alias("d"),
        # the word list travels once per document, on the original copy
        F.when(F.col("s") == 0, F.col("vocab")).alias("vocab"))
    n_kept = F.size(F.filter("kept", lambda b: b))
    dist = (F.lit(1.0) - F.sqrt(n_kept / F.greatest(F.col("d"), F.lit(1)))) * 100.0
    weight = F.sqrt(F.exp(-(dist * dist) / F.lit(kernel_width * kernel_width)))
    return copies.withColumn("weight", weight).drop("d")


# Fixed values of the published xxHash-64 algorithm, as Spark's xxhash64 has it.
_P1, _P2, _P3, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _hash_int(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """``xxhash64`` of an INT column behind columns whose hash is ``seed``."""
    h = (seed + _P5 + np.uint64(4)) ^ (value * _P1)
    part = h >> np.uint64(41)
    h <<= np.uint64(23)
    h |= part
    h *= _P2
    h += _P3
    for shift, factor in ((33, _P2), (29, _P3), (32, None)):
        np.right_shift(h, np.uint64(shift), out=part)
        h ^= part
        if factor is not None:
            h *= factor
    return h


class _Sums:
    """Weighted sums over 0/1 rows that are kept as bits: what the regressions
    need to know of the copies."""

    def __init__(self, n_words: int, n_rows: int):
        self.n, self.bits, self.w, self.y = n_words, [], [], []
        # sums of so many fixed-point numbers below 1 are exact doubles
        self.unit = 2.0 ** (52 - max(1, int(n_rows)).bit_length())

    def add(self, kept: np.ndarray, weight: np.ndarray, target: np.ndarray) -> None:
        self.bits.append(np.packbits(kept, axis=1))
        self.w.append(np.rint(weight * self.unit))
        self.y.append(np.rint(weight * target * self.unit))

    def blocks(self):
        for bits, w, y in zip(self.bits, self.w, self.y):
            yield np.unpackbits(bits, axis=1, count=self.n), w, y

    def close(self) -> None:
        """Sums of w, w y, and per word of w x and w x y; then the weighted
        (co)variances of the words with themselves and with the target."""
        self.total = sum(w.sum() for w in self.w)
        self.mean_y = sum(y.sum() for y in self.y) / self.total
        x, xy = np.zeros(self.n), np.zeros(self.n)
        for kept, w, y in self.blocks():
            x += w @ kept
            xy += y @ kept
        self.x = x
        self.var = (x - x * x / self.total) / self.unit
        self.cov_y = (xy - x * self.mean_y) / self.unit

    def cov(self, j: int) -> np.ndarray:
        """Weighted covariances of word j with all words."""
        both = np.zeros(self.n)
        for bits, w in zip(self.bits, self.w):
            # only the copies that keep the word, found in the packed bits
            has = ((bits[:, j >> 3] >> (7 - (j & 7))) & 1).astype(bool)
            both += w[has] @ np.unpackbits(bits[has], axis=1, count=self.n)
        return (both - self.x * (self.x[j] / self.total)) / self.unit

    def cov_times(self, v: np.ndarray) -> np.ndarray:
        """The matrix of covariances times a vector."""
        out, mean = np.zeros(self.n), self.x @ v / self.total
        for kept, w, _ in self.blocks():
            out += (w * (kept @ v - mean)) @ kept
        return out / self.unit


def _select(var: np.ndarray, cov_y: np.ndarray, cov, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy choice of k words maximising the weighted R^2 of a least squares
    fit with intercept (first word wins ties), and the covariances of the chosen.

    A row of covariances is asked for per chosen word; with the rows so far the
    remaining words are kept orthogonal to the chosen ones (a Cholesky
    factorisation that grows by its best pivot), so the gain of word j is
    ``cov_y[j]^2 / var[j]`` for all j at once.
    """
    var, cov_y = var.copy(), cov_y.copy()
    least = 1e-12 * max(1.0, float(var.max(initial=0.0)))
    chosen, rows, factor = [], [], []
    for _ in range(min(k, len(var))):
        gain = np.where(var > least, cov_y ** 2 / np.maximum(var, 1e-300), 0.0)
        gain[chosen] = -1.0
        j = int(np.argmax(gain))
        chosen.append(j)
        rows.append(cov(j))
        if var[j] > least:
            q = (rows[-1] - sum((f[j] * f for f in factor), np.zeros(len(var)))) / np.sqrt(var[j])
            factor.append(q)
            cov_y = cov_y - q * (cov_y[j] / np.sqrt(var[j]))
            var = var - q * q
    return np.array(chosen, dtype=int), np.array([r[chosen] for r in rows])


def _forward_selection(X: np.ndarray, y: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """:func:`_select` for rows that are at hand."""
    w = w / w.sum()
    Xc, yc = X - w @ X, y - w @ y
    return _select(w @ Xc ** 2, (w * yc) @ Xc, lambda j: (w * Xc[:, j]) @ Xc, k)[0]


def _ridge_of_all(sums: _Sums, alpha: float) -> np.ndarray:
    """Weighted ridge on all words, by conjugate gradients: it needs products
    with the covariances only, no matrix."""
    beta = np.zeros(sums.n)
    r = sums.cov_y.copy()
    p, size = r.copy(), r @ r
    first = size
    for _ in range(20 * sums.n):
        if size <= 1e-24 * first:
            break
        q = sums.cov_times(p) + alpha * p
        step = size / (p @ q)
        beta += step * p
        r -= step * q
        size, before = r @ r, size
        p = r + (size / before) * p
    return beta


def _probability(raw: np.ndarray, target: int) -> np.ndarray:
    """The model's probability of a class from its raw scores (rows)."""
    if raw.shape[1] == 2:
        return 1.0 / (1.0 + np.exp(-raw[:, target]))
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e[:, target] / e.sum(axis=1)


def copy_sums(seeds: np.ndarray, effects: np.ndarray, base: np.ndarray, doc_seed: int,
              num_samples: int, target: int, kernel_width: float = 25.0) -> _Sums:
    """The copies of one document as :class:`_Sums`.  ``seeds``: ``xxhash64(word,
    id)`` of its distinct words, ``effects``: what each adds to the raw scores
    ``base`` of a text without words."""
    d = len(seeds)
    sums, step = _Sums(d, num_samples), max(1, CELLS // d)
    for a in range(0, num_samples, step):
        s = np.arange(a, min(a + step, num_samples)).astype(np.uint64)
        draws = _hash_int(s[:, None], seeds[None, :])
        draws >>= np.uint64(11)
        u = (_hash_int(s, np.array([doc_seed], np.uint64)) >> np.uint64(11)).astype(float) / _U_SCALE
        k = np.minimum(np.floor(u * d).astype(int) + 1, d)
        cut = np.sort(draws, axis=1)[np.arange(len(s)), k - 1]
        kept = draws > cut[:, None]
        if a == 0:
            kept[0] = True
        apart = (1.0 - np.sqrt(np.count_nonzero(kept, axis=1) / d)) * 100.0
        weight = np.sqrt(np.exp(-(apart * apart) / (kernel_width * kernel_width)))
        sums.add(kept, weight, _probability(base + kept @ effects, target))
    sums.close()
    return sums


def explain_copies(sums: _Sums, num_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chosen words and their weights, the heaviest first."""
    k = min(num_features, sums.n)
    if num_features <= 6:
        chosen, cov = _select(sums.var, sums.cov_y, sums.cov, k)
    else:
        chosen = np.argsort(-np.abs(_ridge_of_all(sums, 0.01)), kind="stable")[:k]
        cov = np.array([sums.cov(j)[chosen] for j in chosen])
    final = np.linalg.solve(cov + np.eye(k), sums.cov_y[chosen])
    order = np.argsort(-np.abs(final), kind="stable")
    return chosen[order], final[order]


def _explain_rows(base: list[float], num_features: int, num_samples: int, target: int):
    def run(batches):
        for batch in batches:
            ids, words, weights, ranks = [], [], [], []
            for row in range(batch.num_rows):
                w = batch.column("words")[row].values
                effects = np.stack(w.field("effect").to_numpy(zero_copy_only=False))
                sums = copy_sums(w.field("seed").to_numpy().view(np.uint64), effects, np.array(base),
                                 batch.column("seed")[row].as_py() % (1 << 64), num_samples, target)
                chosen, final = explain_copies(sums, num_features)
                names = w.field("word")
                ids += [batch.column("id")[row].as_py()] * len(chosen)
                words += [names[int(j)].as_py() for j in chosen]
                weights += final.tolist()
                ranks += range(1, len(chosen) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(weights, pa.float64()),
                 pa.array(ranks, pa.int32())], names=["id", "word", "weight", "rank"])
    return run


def word_effects(model: PipelineModel, words: DataFrame) -> tuple[DataFrame, list[float]]:
    """``word, effect``: what one occurrence of each distinct ``word`` adds to the
    raw scores of the classes; and the raw scores of a text without words.  The
    last stage must be linear in the features, as logistic regression is."""
    linear = PipelineModel(stages=model.stages[2:])
    raw = vector_to_array(F.col("rawPrediction"))
    nothing = words.sparkSession.range(1).select(F.array().cast("array<string>").alias("words"))
    base = list(linear.transform(nothing).select(raw.alias("raw")).first()["raw"])
    scored = linear.transform(words.select("word").distinct().withColumn("words", F.array("word")))
    start = F.array(*[F.lit(b) for b in base])
    return scored.select("word", F.zip_with(raw, start, lambda x, b: x - b).alias("effect")), base


def explain(model: PipelineModel, docs: DataFrame, num_features: int = 6,
            num_samples: int = 5000, target_class: int = 1, key: str = "id",
            text: str = "text") -> DataFrame:
    """Word-level explanations ``(id, word, weight, rank)`` of the model's
    probability for ``target_class``, ``num_features`` words per document
    (``key`` a whole number, unique).  A document without words has none."""
    tokens = docs.select(F.col(key).cast("long").alias("id"),
                         F.posexplode(word_tokens(F.col(text))).alias("place", "word"))
    words = tokens.groupBy("id", "word").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    effects, base = word_effects(model, words)
    words = words.join(effects, "word").select("id", F.struct(
        "place", "word", F.xxhash64("word", "id").alias("seed"),
        F.transform("effect", lambda e: e * F.col("n")).alias("effect")).alias("w"))
    rows = words.groupBy("id").agg(F.array_sort(F.collect_list("w")).alias("words"))
    # few bytes, much work: one row per document, spread over all tasks.  Dealt by
    # "id" itself, the rows would stay in the aggregation's partitions, of which
    # few are left where they hold few bytes.
    seed = F.xxhash64("id")
    rows = rows.repartition(task_count(docs), seed).select("id", seed.alias("seed"), "words")
    return rows.mapInArrow(_explain_rows(base, num_features, num_samples, target_class),
                           "id long, word string, weight double, rank int")


def word_weights(explanations: DataFrame) -> DataFrame:
    """Per word: how many explanations name it and the sum of |weight|."""
    return (explanations.groupBy("word")
            .agg(F.count(F.lit(1)).alias("frequency"),
                 F.sum(F.abs("weight")).alias("weight")))


def corrected(old_pred: DataFrame, new_pred: DataFrame, min_conf: float = 0.1) -> DataFrame:
    """Documents misclassified before with ``conf >= min_conf`` that the new
    model classifies correctly (``left_semi`` on the ids, no collect)."""
    targets = misclassified(old_pred).filter(F.col("conf") >= min_conf).select("id")
    return (new_pred.filter(F.col("label") == F.col("prediction"))
                    .join(targets, "id", "left_semi"))


def evaluate(pred: DataFrame) -> DataFrame:
    """Accuracy (the reference's "F1"), per-class precision/recall/F1 and
    weighted F1 of a prediction frame (``label``, ``prediction``)."""
    from civiclens.operators.semantic import classification_metrics
    return classification_metrics(pred)


def clean_and_refit(train: DataFrame, test: DataFrame, words: Sequence[str],
                    max_iter: int = 20, reg_param: float = 0.001) -> tuple[PipelineModel, DataFrame]:
    """Feature clean-up: remove ``words`` from the training texts, refit,
    and predict the unchanged test set.  Returns the new model and its
    predictions (compare with :func:`evaluate`, find fixed documents with
    :func:`corrected`)."""
    model = fit(remove_words(train, words), max_iter, reg_param)
    return model, predict(model, test)


text_classifier = fit
