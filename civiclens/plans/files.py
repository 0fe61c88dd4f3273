"""Queries over the readers and sinks: rows of the driver tables are written
to the session's shared folder in one of the reference's file layouts and
read back, so the oracle is the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civiclens.functions.text import path_part
from civiclens.operators import relational as rel
from civiclens.operators import semantic as sem
from civiclens.plans import drivers
from civiclens.plans.catalog import QUALITY_MIN_CHARS, register, _doc_predictions, _doc_truth
from civiclens.session import ensure_checkpoint_dir
from civiclens.sources import readers, writers
from civiclens.sources.tables import Tables


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _write_csv(df, path, sep=",", header=False):
    (df.write.option("sep", sep).option("quote", '"').option("escape", '"')
       .option("header", header).csv(path))
    return path


@register("formatted_rows", """
SELECT o_orderpriority || ',' || o_custkey || ',100%,'
       || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE printf('%.2f', o_totalprice) END AS line
FROM orders
""")
def q_formatted_rows(spark, sf_dir):
    """Formatted text rows, a NULL number printed as ``null``."""
    orders = Tables(spark, sf_dir).orders.select(
        "o_orderpriority", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    path = _folder(spark)
    writers.write_text(writers.format_rows(orders, "%s,%d,100%%,%.2f",
                                           ["o_orderpriority", "o_custkey", "price"]), path)
    return readers.read_lines(spark, path)


@register("tab_joined_rows", """
SELECT o_custkey || chr(9) || o_orderstatus || chr(9) || count(*) AS line
FROM orders GROUP BY o_custkey, o_orderstatus
""")
def q_tab_joined_rows(spark, sf_dir):
    """K2: key and value joined by tabs."""
    path = _folder(spark)
    writers.write_tab_joined(rel.count_by(Tables(spark, sf_dir).orders, ["o_custkey", "o_orderstatus"]),
                             path, ["o_custkey", "o_orderstatus", "num"])
    return readers.read_lines(spark, path)


_QUOTED = """p_partkey, '"' || p_name || '", ' || p_brand AS remark"""


@register("csv_rows", f"SELECT {_QUOTED}, p_size FROM part")
def q_csv_rows(spark, sf_dir):
    """Header and schema, cells with commas and doubled quotes."""
    part = Tables(spark, sf_dir).part.selectExpr(*_QUOTED.split(", ", 1), "p_size")
    path = _write_csv(part, _folder(spark), header=True)
    return readers.read_csv(spark, path, schema=part.schema)


@register("csv_inferred", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_csv_inferred(spark, sf_dir):
    """Header names, types inferred from the cells."""
    customer = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    df = readers.read_csv(spark, _write_csv(customer, _folder(spark), header=True), infer=True)
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@register("csv_by_position", """
SELECT p_partkey AS uid, p_brand AS attr, TRY_CAST(p_type AS INTEGER) AS val FROM part
""")
def q_csv_by_position(spark, sf_dir):
    """Columns 0, 2 and 3 of a file without header; a cell that is no
    number is NULL."""
    part = Tables(spark, sf_dir).part.selectExpr(*_QUOTED.split(", ", 1), "p_brand", "p_type")
    return readers.read_positional_csv(
        spark, _write_csv(part, _folder(spark)),
        {0: ("uid", "long"), 2: ("attr", "string"), 3: ("val", "int")})


@register("tsv_rows", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || chr(9) || '"' || p_brand || '"' AS remark,
       CAST(p_size AS VARCHAR) AS p_size
FROM part
""")
def q_tsv_rows(spark, sf_dir):
    """Tab-separated strings, a cell that holds a tab and quotes."""
    part = Tables(spark, sf_dir).part.select(
        "p_partkey", F.concat("p_name", F.lit('\t"'), "p_brand", F.lit('"')).alias("remark"), "p_size")
    return readers.read_tsv_strings(spark, _write_csv(part, _folder(spark), sep="\t", header=True))


@register("labelled_files", """
SELECT 'region=' || n_regionkey AS category, CAST(sum(length(n_name) + 1) AS BIGINT) AS n_chars
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def q_labelled_files(spark, sf_dir):
    """Whole files, labelled by their folder."""
    t = Tables(spark, sf_dir)
    path = _folder(spark)
    (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
     .select(F.col("n_regionkey").alias("region"), "n_name")
     .write.partitionBy("region").text(path))
    return (readers.read_labelled_text(spark, path).groupBy("category")
            .agg(F.sum(F.length("text")).alias("n_chars")))


@register("tagged_files", """
SELECT 'customer' AS source, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
""")
def q_tagged_files(spark, sf_dir):
    """Two inputs in one frame, told apart."""
    t = Tables(spark, sf_dir)
    paths = {"customer": _write_csv(t.customer.select("c_custkey", "c_name"), _folder(spark)),
             "supplier": _write_csv(t.supplier.select("s_suppkey", "s_name"), _folder(spark))}
    return readers.read_tagged(spark, paths).select(
        "source", F.col("_c0").alias("id"), F.col("_c1").alias("name"))


@register("lookup_file", """
SELECT CAST(c_custkey AS VARCHAR) AS zip,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'STATEN ISLAND' ELSE c_mktsegment END AS borough
FROM customer
""")
def q_lookup_file(spark, sf_dir):
    """The key/value map, its values normalised."""
    rows = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Staten"))
                      .otherwise(F.initcap("c_mktsegment")))
    return readers.read_lookup(spark, _write_csv(rows, _folder(spark)))


@register("manifest_lines", """
SELECT CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) ELSE '' END
         || '/data/' || o_orderstatus || '/' || o_orderkey || '.tsv.gz' AS path,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS size,
       o_orderkey || '.tsv.gz' AS dataset_name,
       o_orderstatus = 'F' AS valid
FROM orders
""")
def q_manifest_lines(spark, sf_dir):
    """Paths with a number glued in front and sizes that are no number
    are marked."""
    status = F.col("o_orderstatus")
    line = F.concat(
        F.when(status == "P", F.col("o_custkey").cast("string")).otherwise(""), F.lit("/data/"), status,
        F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".tsv.gz  "),
        F.when(status == "O", "unknown").otherwise(F.col("o_custkey").cast("string")))
    path = _folder(spark)
    writers.write_text(Tables(spark, sf_dir).orders.select(line.alias("value")), path)
    return readers.read_manifest(spark, path)


@register("label_table", """
SELECT DISTINCT p_type AS label, 'p' || p_size AS dataset_name, p_brand AS column_name FROM part
""")
def q_label_table(spark, sf_dir):
    """The ground truth, one row per labelled column."""
    part = Tables(spark, sf_dir).part
    rows = part.select(
        F.concat(F.lit("'p"), F.col("p_size").cast("string"), F.lit("."), "p_brand",
                 F.lit(".txt.gz'")).alias("Dataset"),
        F.col("p_type").alias("Label"))
    return readers.read_label_table(spark, _write_csv(rows, _folder(spark), header=True))


def _segment_documents(spark, sf_dir):
    """A document per market segment: its nations and their customers."""
    counts = rel.count_by(Tables(spark, sf_dir).customer, ["c_mktsegment", "c_nationkey"])
    return counts.groupBy(F.col("c_mktsegment").alias("dataset_name")).agg(
        F.array_sort(F.collect_list(F.struct("c_nationkey", "num"))).alias("nations"))


_SEGMENT_NATIONS = """
SELECT c_mktsegment AS dataset_name, c_nationkey, count(*) AS num FROM customer GROUP BY ALL
"""


@register("document_files", _SEGMENT_NATIONS)
def q_document_files(spark, sf_dir):
    """One JSON document per dataset, read back and flattened."""
    docs = _segment_documents(spark, sf_dir)
    path = _folder(spark)
    writers.write_documents(docs, path)
    back = spark.read.schema(docs.schema).json(path)
    return back.select("dataset_name", F.explode("nations").alias("n")).select("dataset_name", "n.*")


@register("merged_documents", _SEGMENT_NATIONS)
def q_merged_documents(spark, sf_dir):
    """All documents under one root key in one file, read back by the
    reader of documents."""
    docs, path = _segment_documents(spark, sf_dir), _folder(spark)
    kind = docs.schema.simpleString()
    writers.write_merged_documents(docs, path, ["dataset_name"])
    return (readers.read_documents(spark, path, f"datasets array<{kind}>")
            .select(F.explode("datasets").alias("d"))
            .select("d.dataset_name", F.explode("d.nations").alias("n")).select("dataset_name", "n.*"))


@register("sorted_file", """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS line_number,
       o_orderkey || ',' || o_orderstatus AS line
FROM orders
""")
def q_sorted_file(spark, sf_dir):
    """A result as one sorted file, its lines numbered by their place."""
    path = _folder(spark)
    orders = Tables(spark, sf_dir).orders.select(
        F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value"), "o_totalprice", "o_orderkey")
    writers.write_sorted_single(orders, path, [F.col("o_totalprice").desc(), "o_orderkey"])
    lines = spark.read.text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    return rel.row_index(lines, ["block", "row"], "line_number").select(
        "line_number", F.col("value").alias("line"))


@register("sample_rows", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('10|' || o_orderkey), o_orderkey LIMIT 100
""")
def q_sample_rows(spark, sf_dir):
    """A random sample that depends on the keys only (the limit is the
    feature)."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    return rel.sample_rows(orders, 100, ["o_orderkey"])


@register("skip_finished", """
SELECT DISTINCT c_mktsegment AS dataset_name, c_nationkey AS column_id FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer d WHERE d.c_mktsegment = c.c_mktsegment
                  AND d.c_nationkey = c.c_nationkey AND d.c_acctbal < 0)
""")
def q_skip_finished(spark, sf_dir):
    """Targets without a finished result."""
    t = Tables(spark, sf_dir).customer.select(
        F.col("c_mktsegment").alias("dataset_name"), F.col("c_nationkey").alias("column_id"), "c_acctbal")
    keys = ["dataset_name", "column_id"]
    return writers.skip_finished(t.select(*keys).distinct(), t.filter(F.col("c_acctbal") < 0), keys)


@register("key_length", """
SELECT lang_source, round(sum(n_chars), 2) AS total, round(avg(n_chars), 2) AS average
FROM (SELECT lang || CASE WHEN n_chars >= 1000 THEN 'x' ELSE '' END AS lang_source, n_chars FROM documents)
WHERE length(lang_source) = 3 GROUP BY 1
""")
def q_key_length(spark, sf_dir):
    """Only keys of three characters are summed."""
    docs = Tables(spark, sf_dir).documents.select(
        F.concat("lang", F.when(F.col("n_chars") >= 1000, "x").otherwise("")).alias("lang_source"),
        "n_chars")
    return rel.sum_avg_by(docs, "lang_source", "n_chars", key_length=3)


@register("path_parts", """
SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS name,
       split_part(url, '/', -2) AS folder
FROM pages
""")
def q_path_parts(spark, sf_dir):
    """parts of a path from the left and from the right."""
    return Tables(spark, sf_dir).pages.select(
        "page_id", path_part("url", 2).alias("host"), path_part("url", -1).alias("name"),
        path_part("url", -2).alias("folder"))


@register("score_document", f"""
WITH p AS (SELECT doc_id, CASE WHEN n_chars >= {QUALITY_MIN_CHARS} THEN 'quality' ELSE 'low_quality' END AS label
           FROM documents),
t AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'quality' ELSE 'low_quality' END AS label FROM labels
      UNION SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
hit AS (SELECT t.label, count(p.doc_id) AS ok, count(*) AS n
        FROM t LEFT JOIN (SELECT DISTINCT doc_id, label FROM p) p ON p.doc_id = t.doc_id AND p.label = t.label
        GROUP BY t.label)
SELECT label, round(ok / (SELECT nullif(count(DISTINCT doc_id), 0) FROM p WHERE p.label = hit.label), 9) AS precision,
       round(ok / n, 9) AS recall
FROM hit
""")
def q_score_document(spark, sf_dir):
    """K7: the precision/recall document, written, read back and flattened."""
    t = Tables(spark, sf_dir)
    path = _folder(spark)
    writers.write_score_document(sem.score_labels(_doc_predictions(t), _doc_truth(t), ["doc_id"]), path)
    results = F.from_json("value", "results array<map<string,array<map<string,double>>>>")["results"]
    one = spark.read.text(path).select(F.explode(results).alias("r")).select(F.explode("r"))
    return one.select(F.col("key").alias("label"),
                      F.round(F.col("value")[0]["precision"], 9).alias("precision"),
                      F.round(F.col("value")[1]["recall"], 9).alias("recall"))


def _cut_files(spark, source: str, target: str) -> str:
    """Copies of the part files of ``source`` that end half-way."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(conf)
    for status in fs.listStatus(path(source)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            src, dst = fs.open(status.getPath()), fs.create(path(f"{target}/{name}"))
            jvm.org.apache.commons.io.IOUtils.copyLarge(src, dst, 0, status.getLen() // 2)
            src.close()
            dst.close()
    return target


@register("manifest_profiles", """
WITH c AS (
  SELECT 'customer.tsv' AS dataset_name, 'key' AS column_name, CAST(c_custkey AS VARCHAR) AS v FROM customer
  UNION ALL SELECT 'customer.tsv', 'segment', nullif(c_mktsegment, 'BUILDING') FROM customer
  UNION ALL SELECT 'orders.tsv', 'key', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT 'orders.tsv', 'status', o_orderstatus FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT dataset_name, column_name, count(v) AS filled, count(*) - count(v) AS empty,
       count(DISTINCT coalesce(v, '')) AS n_values, CAST(NULL AS BIGINT) AS quarantined
FROM c GROUP BY dataset_name, column_name
UNION ALL SELECT 'orders.tsv', NULL, NULL, NULL, NULL, count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'events.tsv', NULL, NULL, NULL, NULL, 0
UNION ALL SELECT 'glued.tsv', NULL, NULL, NULL, NULL, 0
UNION ALL SELECT 'gone.tsv', NULL, NULL, NULL, NULL, 0
""")
def q_manifest_profiles(spark, sf_dir):
    """K5, S11 and the reference's manifest run: good datasets are profiled in
    one job; a dataset that breaks after its header, one that is missing, a
    malformed manifest line and records with too many cells are quarantined."""
    t, path = Tables(spark, sf_dir), _folder(spark)
    _write_csv(t.customer.select(F.col("c_custkey").alias("key"), F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment")),
               f"{path}/customer.tsv", "\t", True)
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("\tcell"))
    # the lines are one column, its name the header: no cell is quoted
    _write_csv(t.orders.select(F.concat("o_orderkey", F.lit("\t"), "o_orderstatus", F.coalesce(urgent, F.lit("")))
                                .alias("key\tstatus")), f"{path}/orders.tsv", "\x01", True)
    t.events.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(f"{path}/whole.tsv")
    _cut_files(spark, f"{path}/whole.tsv", f"{path}/events.tsv")
    names = ["customer.tsv", "orders.tsv", "events.tsv", "gone.tsv"]
    lines = [(f"{path}/{n} 1",) for n in names] + [("x/glued.tsv 1",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{path}/manifest")
    docs, quarantine = drivers.profile_manifest(spark, f"{path}/manifest")
    c = docs.select("dataset_name", F.explode("columns").alias("c")).select(
        "dataset_name", "c.column_name", F.col("c.number_non_empty_cells").alias("filled"),
        F.col("c.number_empty_cells").alias("empty"), F.col("c.number_distinct_values").alias("n_values"),
        F.lit(None).cast("long").alias("quarantined"))
    q = quarantine.groupBy("dataset_name").agg(F.coalesce(F.sum("num"), F.lit(0)).alias("quarantined"))
    return c.unionByName(q, allowMissingColumns=True)


@register("target_columns", """
SELECT 'nation' AS dataset_name, 'n_name' AS column_name, count(*) AS num FROM nation
UNION ALL SELECT 'customer', 'c_mktsegment', count(*) FROM customer
""")
def q_target_columns(spark, sf_dir):
    """S12, T3 and the reference's target run: a target list is read, each name
    resolved to the closest header of its dataset, the column labelled; a
    target of a missing dataset is quarantined."""
    t, path = Tables(spark, sf_dir), _folder(spark)
    _write_csv(t.nation, f"{path}/nation.tsv", "\t", True)
    _write_csv(t.customer, f"{path}/customer.tsv", "\t", True)
    targets = "['nation.nname.txt.gz', 'customer.mktsegment.txt.gz', 'nation.nname.txt.gz', 'gone.x.txt.gz']"
    spark.createDataFrame([(targets,)], "value string").coalesce(1).write.text(f"{path}/targets")
    labels, bad = drivers.label_target_columns(spark, f"{path}/targets", path, suffix=".tsv")
    assert [r.dataset_name for r in bad.collect()] == ["gone"]
    return labels.groupBy("dataset_name", "column_name").agg(F.sum("count").alias("num"))
