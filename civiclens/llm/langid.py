"""Language identification: multinomial naive Bayes over hashed character
n-grams (orders 1 to 3), scored in numpy from a broadcast log-probability
matrix.

Training uses at most ``max_docs`` rows of every language (those with the
smallest hash of their doc_id), whole texts; class priors are counted over all
training rows.  Lower-casing is Unicode's; runs of white space count as one.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when there is nothing to learn from; ties go to the
language that sorts first; rows with a null language train nothing; more than
``MAX_LANGS`` distinct languages among the training rows raise a ValueError, as
the matrix has a column for each; an empty table gives an empty result; only doc_id, text and (for training) lang are
read, so other columns cannot clash.  The score is the posterior probability
of the predicted language.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.llm.common import tidy


ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
BLOCK = 1 << 17  # code points handled at a time
MAX_LANGS = 512
_SPACE = re.compile(r"\s+")


def _points(text: str) -> np.ndarray:
    text = f" {_SPACE.sub(' ', text.lower())} "
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def _pieces(texts: list[str | None]):
    """(row, code points) in pieces of at most BLOCK that overlap by the
    longest order less one, so every n-gram is in exactly one piece."""
    back = max(ORDERS) - 1
    for row, text in enumerate(texts):
        if text:
            p = _points(text)
            if len(p) <= BLOCK:
                yield row, p, 0
            else:
                for a in range(0, len(p), BLOCK):
                    yield row, p[max(0, a - back):a + BLOCK], min(a, back)


def _blocks(texts):
    rows, parts, skips, size = [], [], [], 0
    for row, p, skip in _pieces(texts):
        if size and size + len(p) > BLOCK:
            yield rows, parts, skips
            rows, parts, skips, size = [], [], [], 0
        rows.append(row)
        parts.append(p)
        skips.append(skip)
        size += len(p)
    if rows:
        yield rows, parts, skips


def ngram_buckets(texts: list[str | None]):
    """Yields (row of each n-gram in rising order, bucket of each n-gram)."""
    for rows, parts, skips in _blocks(texts):
        u = np.concatenate(parts).astype(np.uint64)
        sizes = np.array([len(p) for p in parts])
        piece = np.repeat(np.arange(len(parts)), sizes)
        # code points before `fresh` belong to the piece before: an n-gram
        # is counted where it ends
        fresh = np.repeat(np.cumsum(sizes) - sizes + np.array(skips), sizes)
        who, what = [], []
        for n in ORDERS:
            if len(u) < n:
                continue
            h = np.full(len(u) - n + 1, n * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
            for j in range(n):
                h = (h ^ u[j:len(u) - n + 1 + j]) * np.uint64(0xFF51AFD7ED558CCD)
                h ^= h >> np.uint64(32)
            end = np.arange(n - 1, len(u))
            ok = (piece[:len(h)] == piece[n - 1:]) & (end >= fresh[n - 1:])
            who.append(piece[:len(h)][ok])
            what.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
        who, what = np.concatenate(who), np.concatenate(what)
        order = np.argsort(who, kind="stable")
        yield np.array(rows)[who[order]], what[order]


def is_held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _count(batches):
    """Per language and bucket: how often it occurs in these batches."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs = b.column("lang").to_pylist()
        texts = b.column("text").to_pylist()
        for who, what in ngram_buckets(texts):
            for lang in {langs[i] for i in np.unique(who)}:
                mine = np.array([x == lang for x in langs])[who]
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += np.bincount(what[mine], minlength=BUCKETS)
    for lang, c in total.items():
        i = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(c[i])],
            names=["lang", "bucket", "n"])


class Model:
    """Languages in sorted order, log priors and log probabilities
    (bucket x language)."""

    def __init__(self, langs, log_prior, log_prob):
        self.langs, self.log_prior, self.log_prob = langs, log_prior, log_prob

    def _sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log joint probability of each text and language, and the number of
        n-grams of each text."""
        out, n = np.tile(self.log_prior, (len(texts), 1)), np.zeros(len(texts), np.int64)
        step = max(1, (1 << 22) // max(1, len(self.langs)))
        for who, what in ngram_buckets(texts):
            n += np.bincount(who, minlength=len(texts))
            for a in range(0, len(who), step):
                w = who[a:a + step]
                starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                out[w[starts]] += np.add.reduceat(self.log_prob[what[a:a + step]], starts, axis=0)
        return out, n

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self._sums(texts)[0]

    def recognised(self, texts: list[str | None], noise: float = 0.55) -> np.ndarray:
        """Whether a text is more like its best language than like noise: by its mean
        log probability per n-gram, on the way from that of the language's own
        n-grams (0) to that of buckets drawn at random (1), it stands before
        ``noise``.  Both ends follow from the learned counts."""
        if not self.langs or not texts:
            return np.zeros(len(texts), bool)
        s, n = self._sums(texts)
        best = s.argmax(axis=1)
        mean = (s[np.arange(len(texts)), best] - self.log_prior[best]) / np.maximum(n, 1)
        own = (np.exp(self.log_prob) * self.log_prob).sum(axis=0)
        bound = own + noise * (self.log_prob.mean(axis=0) - own)
        return (n > 0) & (mean >= bound[best])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts))
        s = self.scores(texts)
        best = s.argmax(axis=1)
        p = 1.0 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[i] for i in best], p


def fit(rows: DataFrame, max_docs: int = 2000, alpha: float = 0.5) -> Model:
    """Train on rows (doc_id, text, lang).  ``max_docs`` bounds the sampled
    rows of each language; the sample, not the corpus, is read in full."""
    rows = rows.where(F.col("lang").isNotNull() & _has_letter(F.col("text")))
    # rows without a doc_id go by their text
    own = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    rows = rows.select("doc_id", "text", "lang", own.alias("_h"))
    priors = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LANGS + 1).collect()}
    if len(priors) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the matrix would not be small")
    langs = sorted(priors)
    if not langs:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0)))
    # From the counts follows the share of hashes that leaves each language a few
    # more rows than are kept: only those meet in the window, whatever the corpus.
    near = F.lit(False)
    for lang in langs:
        share = min(1.0, (max_docs + 8 * max_docs ** 0.5 + 20) / priors[lang])
        top = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
        near = near | ((F.col("lang") == lang) & (F.col("_h") <= top))
    w = Window.partitionBy("lang").orderBy("_h", F.xxhash64("text"))
    sample = (rows.where(near).withColumn("_r", F.row_number().over(w))
                  .where(F.col("_r") <= max_docs).select("lang", "text"))
    sample = sample.repartition(max(2, rows.sparkSession.sparkContext.defaultParallelism))
    counts = (sample.mapInArrow(tidy(_count), "lang string, bucket int, n long")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    table = np.full((BUCKETS, len(langs)), alpha)
    where = {x: i for i, x in enumerate(langs)}
    table[counts["bucket"].to_numpy(), counts["lang"].map(where).to_numpy()] += counts["n"].to_numpy()
    prior = np.array([priors[x] for x in langs], dtype=float)
    return Model(langs, np.log(prior / prior.sum()), np.log(table / table.sum(axis=0)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (which must have doc_id and text) with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for b in batches:
            texts = [t if ok else None for t, ok in
                     zip(b.column("text").to_pylist(), b.column("_ok").to_pylist())]
            langs, p = m.predict(texts)
            langs = [x if t is not None else "und" for x, t in zip(langs, texts)]
            p = [float(x) if t is not None and lang != "und" else 0.0
                 for x, t, lang in zip(p, texts, langs)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(p, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    held = is_held_out(F.col("doc_id"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text", _has_letter(F.col("text")).alias("_ok"),
                        F.coalesce(held, F.lit(False)).alias("held_out"))
                .mapInArrow(tidy(score), f"doc_id {kind}, held_out boolean, lang_pred string, score double"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with a letter in the text whose language is recognised
    (:meth:`Model.recognised`).  The posterior cannot tell: it says which learned
    language fits best, not whether it fits."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        m = shared.value
        for b in batches:
            yield b.filter(pa.array(m.recognised(b.column(at).to_pylist()), pa.bool_()))

    at = docs.columns.index("text")
    return docs.where(_has_letter(F.col("text"))).mapInArrow(tidy(keep), docs.schema)


def identify(docs: DataFrame, max_docs: int = 2000) -> DataFrame:
    """Learn from the labelled rows that are not held out, then predict all."""
    train = docs.where(~F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)))
    return predict(docs, fit(train, max_docs))
