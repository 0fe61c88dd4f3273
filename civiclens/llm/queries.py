"""The queries of this subpackage over the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm import (
    agenda, bpe, chat, decontaminate, langid, lexical, linededup, minhash, multiindex, phrases,
    sharding, suffixes, warc)
from civiclens.llm.common import shared_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _read(spark, sf_dir, "pages"), shared_path(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
best AS (SELECT body, max(page_id) AS best FROM p GROUP BY body),
bits AS (
  SELECT page_id, body, best,
         list_transform(range(0, 8), lambda k: CAST('0x' || substr(hex, 5 * k + 1, 5) AS INTEGER)) AS d
  FROM p JOIN best USING (body))
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(d, lambda x: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((x >> s) & 31) + 1]), '')), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM bits
"""


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, PATTERN)
    both = bpe.decode(ids, RANKS)
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(text, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n,
         array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM w, sizes WHERE len(ws) >= n)),
h AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM h))
  GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN its ON its.doc_id = w.doc_id
"""


def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(_read(spark, sf_dir, "conversations"))
    loss = F.transform("loss", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return out.withColumn("loss", F.array_join(loss, ","))


OP6_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM t),
who AS (SELECT DISTINCT conv_id, role AS speaker FROM r WHERE role <> 'system'),
p AS (
  SELECT r.conv_id, pos // 64 AS segment, speaker, pos, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|assistant|>' || chr(10)
              WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user ' || replace(role, '<|', '< |') || '|>' || chr(10) END AS head,
         replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM r JOIN who ON who.conv_id IS NOT DISTINCT FROM r.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (
              PARTITION BY conv_id, segment, speaker ORDER BY pos) AS fin FROM p)
SELECT conv_id, segment, speaker, count(*) AS n_turns,
       string_agg(head || body, '' ORDER BY pos) AS text,
       string_agg(CASE WHEN own THEN CAST(fin - length(body) AS BIGINT) || '-' || CAST(fin - 1 AS BIGINT) END,
                  ',' ORDER BY pos) AS loss
FROM o GROUP BY conv_id, segment, speaker
"""


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(_read(spark, sf_dir, "documents"))
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"),
                      F.size("runs").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(_read(spark, sf_dir, "documents"), words=2, percent=80)
    return out.drop("_h")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{20}\x{09}-\x{0D}]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws
           ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op10_consistent_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(_read(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                      F.col("shard").cast("int").alias("shard"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = agenda.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    both = agenda.decode(ids, PIECES)
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(text, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_read(spark, sf_dir, "documents"), order=4, min_count=30, inside=80, top=2000)


OP12_SQL = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p), (SELECT unnest([1, 2, 3, 4]) AS k)
  WHERE i + k - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM g WHERE k >= 2 AND f >= 30),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS b
  FROM (SELECT lang, k, w, a, s, unnest(range(1, k - s + 2)) AS i
        FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < k)
  GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN inner_ USING (lang, phrase)
  WHERE b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a),
cuts AS (
  SELECT kept.lang, kept.phrase, a, j, l.f AS l, r.f AS r,
         CAST((2000000::HUGEINT * a) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) kept
  JOIN g l ON l.lang = kept.lang AND l.phrase = array_to_string(kept.w[1:j], ' ')
  JOIN g r ON r.lang = kept.lang AND r.phrase = array_to_string(kept.w[j + 1:kept.k], ' ')),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
top AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best)
SELECT top.lang, rank, phrase, a, l, r, n, score FROM top JOIN n ON n.lang = top.lang WHERE rank <= 2000
"""


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=50)


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS ws
  FROM documents),
st AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS t
  FROM benchmark),
tf AS (
  SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), st),
m AS (SELECT doc_id, 50 + (50 * len(ws) * n_docs) // n_terms AS m FROM d, st WHERE len(ws) > 0),
s AS (
  SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf ON tf.t = q.t JOIN w ON w.t = q.t JOIN m ON m.doc_id = tf.doc_id
  GROUP BY item_id, tf.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


QUERIES = {f.__name__: f for f in (
    op1_inverted_multi_index, op2_line_dedup, op3_warc_chunks, op4_byte_bpe,
    op5_benchmark_decontamination, op6_perspective_rotation, op7_repeated_strings,
    op8_minmax_near_dedup, op9_language_id, op10_consistent_hash_sharding,
    op11_sentencepiece_bpe, op12_collocations, op13_ranked_lexical_search)}

ORACLES = {"op3_warc_chunks": OP3_SQL, "op5_benchmark_decontamination": OP5_SQL,
           "op6_perspective_rotation": OP6_SQL, "op8_minmax_near_dedup": OP8_SQL,
           "op12_collocations": OP12_SQL, "op13_ranked_lexical_search": OP13_SQL}
