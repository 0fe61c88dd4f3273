"""Corpus pipeline: stages that each apply one operator of ``civiclens.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All stages but the last return the columns of ``documents``.

Defined results: rows without text go in the first stage (they have no
language); repeated rows are left once by the near-duplicate stage; extra
columns are carried to the last stage but one; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm import bpe, decontaminate, langid, linededup, minhash
from civiclens.llm.common import drop_written, free_name, scratch, small_batches, written
from civiclens.llm.queries import PATTERN, RANKS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose language is not recognised:
    foreign scripts, random letters (``langid.Model.recognised``)."""
    held = F.coalesce(langid.is_held_out(docs["doc_id"]), F.lit(False))
    return langid.accepted(docs, langid.fit(docs.where(~held)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds go; a document of which
    nothing but white space is left goes as a whole."""
    n_lines, n_cut = (free_name(c, docs.columns) for c in ("n_lines", "n_cut"))
    out = linededup.dedup_lines(docs, counts=(n_lines, n_cut))
    cut = F.col(n_cut) > 0
    out = out.where(~cut | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word shingles,
    similarity 0.8 or more) stays: that with the smallest doc_id."""
    return minhash.keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.remove_documents(docs, benchmark, n=10)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text decoded from them."""
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS, PATTERN)
    both = bpe.decode(ids, RANKS)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
                       "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

# The classifier and the alignment have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    with small_batches(spark):
        for i, (name, stage) in enumerate(STAGES):
            with scratch(spark):
                after = written(stage(spark, docs, sf_dir), name, keep=True)
            if i:
                drop_written(docs)
            docs = after
    return docs
