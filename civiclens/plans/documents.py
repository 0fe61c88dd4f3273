"""Queries over nested result documents, flattened again, and over word tokens."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civiclens.functions.text import word_tokens
from civiclens.operators import profile as prof
from civiclens.operators import semantic as sem
from civiclens.plans import catalog
from civiclens.plans.catalog import _CELLS_SQL, profile_cells, register, semantic_labelled
from civiclens.session import ensure_checkpoint_dir
from civiclens.sources import readers, writers
from civiclens.sources.tables import Tables


@register("word_tokens", r"""
SELECT token, count(*) AS num
FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{M}\p{N}\p{Pc}]+')) AS token FROM documents)
GROUP BY token
""")
def q_word_tokens(spark, sf_dir):
    """tokens between runs of non-word characters, case kept."""
    docs = Tables(spark, sf_dir).documents
    return (docs.select(F.explode(word_tokens("text")).alias("token"))
                .groupBy("token").agg(F.count(F.lit(1)).alias("num")))


@register("profile_document_rows", _CELLS_SQL + """
, freq AS (SELECT dataset_name, column_name, value, count(*) AS n FROM typed GROUP BY ALL),
top AS (
  SELECT dataset_name, column_name, string_agg(value, '|' ORDER BY n DESC, value) AS top_values
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset_name, column_name ORDER BY n DESC, value) AS r FROM freq)
  WHERE r <= 5 GROUP BY ALL),
kinds AS (
  SELECT dataset_name, column_name, string_agg(label || '=' || n, ';' ORDER BY label) AS types
  FROM (SELECT dataset_name, column_name, count(*) AS n,
               CASE cell_type WHEN 'int' THEN 'INTEGER (LONG)' WHEN 'real' THEN 'REAL'
                              WHEN 'date' THEN 'DATE/TIME' ELSE 'TEXT' END AS label
        FROM typed WHERE cell_type <> 'empty' GROUP BY ALL)
  GROUP BY ALL),
c AS (
  SELECT dataset_name, column_name, count(*) FILTER (WHERE cell_type <> 'empty') AS filled,
         count(*) FILTER (WHERE cell_type = 'empty') AS empty, count(DISTINCT value) AS n_values
  FROM typed GROUP BY ALL)
SELECT c.dataset_name, c.column_name, filled, empty, n_values, top_values, coalesce(types, '') AS types,
       TRUE AS candidate, empty = 0 AND n_values = filled AS is_unique
FROM c JOIN top ON top.dataset_name = c.dataset_name AND top.column_name = c.column_name
LEFT JOIN kinds ON kinds.dataset_name = c.dataset_name AND kinds.column_name = c.column_name
""")
def q_profile_document_rows(spark, sf_dir):
    """The nested profile documents, flattened to a row a column."""
    docs = prof.profile_documents(profile_cells(spark, sf_dir))
    c = docs.select("dataset_name", "key_column_candidates", "unique_columns", F.explode("columns").alias("c"))
    types = F.transform("c.data_types", lambda t: F.concat(t["type"], F.lit("="), t["count"].cast("string")))
    return c.select(
        "dataset_name", "c.column_name", F.col("c.number_non_empty_cells").alias("filled"),
        F.col("c.number_empty_cells").alias("empty"), F.col("c.number_distinct_values").alias("n_values"),
        F.array_join("c.frequent_values", "|").alias("top_values"),
        F.array_join(F.array_sort(types), ";").alias("types"),
        F.array_contains("key_column_candidates", F.col("c.column_name")).alias("candidate"),
        F.array_contains("unique_columns", F.col("c.column_name")).alias("is_unique"))


@register("semantic_document_rows", catalog.ORACLES["semantic_labels"])
def q_semantic_document_rows(spark, sf_dir):
    """The nested label documents, written one to a dataset, read
    back by the reader of documents and flattened."""
    docs = sem.semantic_documents(sem.count_labels(semantic_labelled(spark, sf_dir)))
    path = f"{ensure_checkpoint_dir(spark)}/documents-{uuid.uuid4().hex}"
    writers.write_documents(docs, path)
    back = readers.read_documents(spark, path, docs.schema)
    c = back.select("dataset_name", F.explode("columns").alias("c"))
    return (c.select("dataset_name", "c.column_name", F.explode("c.semantic_types").alias("s"))
             .select("dataset_name", "column_name", "s.*"))
