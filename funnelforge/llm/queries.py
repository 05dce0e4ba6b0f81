"""The queries op1..op10 and the pipeline, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, conversation_repair, decontam, html_extract, jaccard_join, language_id, license_scan, packing, pii, toxicity, url_filter, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return language_id.identify(_table(spark, sf_dir, "documents")).drop("row_key")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and statements in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the similarity of their word 5-grams."""
    return jaccard_join.join(_table(spark, sf_dir, "documents")).drop("key", "text_hash")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words found in every document."""
    found = decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("n_near_items", "near_items")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, and what they decode to, as digests."""
    found = byte_bpe.round_trip(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 leading whitened components of the distinct vectors."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation's faults and cheapest repair."""
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_nearest_neighbours, op3_html_extract, op4_license_scan, op5_toxicity, op6_url_filter, op7_packing, op8_jaccard_join, op9_personal_data, op10_decontamination,
                                   op11_byte_bpe, op12_whitening, op13_conversation_repair)}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{pattern}')"


ORACLE_SQL: dict[str, str] = {
    "op8_jaccard_join": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words(r"[^\x20\x09-\x0D]+")} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: w[i:i + 4])) AS s
  FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY ALL),
links AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b USING (s) GROUP BY ALL)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY ALL)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.y, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.x = d.doc_id""",
    "op10_decontamination": f"""
WITH docs AS (SELECT doc_id, {_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM documents),
items AS (SELECT item_id, {_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, s, len(s) AS n FROM (
  SELECT item_id, unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda i: w[i:i + 9])) AS s
  FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2),
                                                   lambda i: {{'p': i, 's': w[i:i + n - 1]}})) AS spot
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, spot.p AS p, n FROM places JOIN windows USING (n) WHERE spot.s = windows.s),
spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY ALL),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY ALL)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN spots USING (doc_id) LEFT JOIN named USING (doc_id)""",
}


# crc32 bit by bit; then, row by row, the best (cost, audit) for each role state:
# at most two insertions before a row, the row's own edit, and the same at the end.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_INSERTED = "CASE WHEN q = 'u' THEN 'a' ELSE 'u' END"
_LINE = "CASE WHEN q = 'u' THEN 'assistant:' ELSE 'user:' END"


def _inserted(source: str) -> str:
    """``source`` and, from each of its ways, one more insertion."""
    return f"""SELECT *, FALSE AS fresh FROM {source}
  UNION ALL SELECT conv_id, i, {_INSERTED} AS q, cost + 2, audit || 'I', list_append(lines, {_LINE}), TRUE FROM {source}"""


ORACLE_SQL["op13_conversation_repair"] = f"""
WITH RECURSIVE coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen(k) + 1), lambda p: ascii(substr(k, p, 1)))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS code
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)),
rows_ AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy,
  CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM coded WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, rtrim(text, {_BLANKS}) AS body FROM rows_),
seen AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  substr(role, 1, 1) AS k, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS came FROM placed),
counted AS (SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE came IS NOT NULL AND came || k NOT IN ('su', 'ua', 'au')) AS illegal, count(i) AS n
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN seen s ON s.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY ALL),
best AS (SELECT conv_id, 0::BIGINT AS i, '' AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counted
  UNION ALL
  (WITH once AS ({_inserted("best")}),
   twice AS (SELECT conv_id, i, q, cost, audit, lines FROM once UNION ALL
     SELECT conv_id, i, {_INSERTED}, cost + 2, audit || 'I', list_append(lines, {_LINE}) FROM once WHERE fresh),
   ways AS (SELECT w.*, s.role, s.text, s.k, s.fault, (s.fault = 'truncated')::BIGINT AS open FROM twice w JOIN seen s
     ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1),
   moves AS (SELECT conv_id, i + 1 AS i, q, cost + 3 AS cost, audit || 'D' AS audit, lines FROM ways
     UNION ALL SELECT conv_id, i + 1, k, cost + open, audit || 'K', list_append(lines, role || ':' || text) FROM ways
       WHERE fault NOT IN ('blank', 'duplicate') AND ((k = 's' AND q = '') OR (k = 'u' AND q <> 'u') OR (k = 'a' AND q = 'u'))
     UNION ALL SELECT conv_id, i + 1, {_INSERTED}, cost + open + 2, audit || 'R', list_append(lines, {_LINE} || text) FROM ways
       WHERE fault NOT IN ('blank', 'duplicate'))
   SELECT conv_id, i, q, m.cost, m.audit, m.lines FROM (SELECT conv_id, i, q, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS m FROM moves GROUP BY ALL))),
ended AS (SELECT b.conv_id, b.q, b.cost, b.audit, b.lines FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i),
closed AS (SELECT conv_id, min({{'cost': cost + CASE q WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END, 'audit': audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END,
  'lines': list_concat(lines, CASE q WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE [] END)}}) AS m FROM ended GROUP BY ALL)
SELECT c.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, m.cost AS cost, m.audit AS audit,
       sha256(coalesce(array_to_string(m.lines, chr(10)), '')) AS repaired_sha256
FROM counted c JOIN closed m ON m.conv_id IS NOT DISTINCT FROM c.conv_id"""


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
