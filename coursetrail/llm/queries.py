"""The operators as named queries over the given tables, with SQL checks where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetrail.llm import contamination, conversations, digest, hnsw, main_text, mixing, pieces, ppm, repair, runs, simhash, substrings, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quartile_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.digests(table(spark, folder, "documents"))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"), entropy=0.97, repeat=4.0)


OP2_SQL = r"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS BIGINT) AS n_tokens FROM documents),
numbered AS (
  SELECT *, CAST('0x' || substr(md5('0|' || key || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS number FROM rows_),
dealt AS (SELECT *, CAST(number % 4096 AS INTEGER) AS block FROM numbered),
sizes AS (SELECT key, block, CAST(sum(n_tokens) AS BIGINT) AS n FROM dealt GROUP BY key, block),
sources AS (SELECT key, CAST(sum(n) AS BIGINT) AS n FROM sizes GROUP BY key),
all_ AS (SELECT list(CAST(n AS DOUBLE) ORDER BY key) AS ns, CAST(sum(n) AS DOUBLE) AS total, ln(count(*)) AS most FROM sources),
halving(i, e_low, e_high, r_low, r_high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN e_ok THEN e_mid ELSE e_low END, CASE WHEN e_ok THEN e_high ELSE e_mid END,
         CASE WHEN r_ok THEN r_low ELSE r_mid END, CASE WHEN r_ok THEN r_mid ELSE r_high END
  FROM (SELECT h.*, (e_low + e_high) / 2 AS e_mid, (r_low + r_high) / 2 AS r_mid,
               list_sum(list_transform(ns, lambda x: pow(x / total, (e_low + e_high) / 2))) AS s,
               list_sum(list_transform(ns, lambda x: pow(x / total, (e_low + e_high) / 2) * ln(pow(x / total, (e_low + e_high) / 2)))) AS l,
               ln(s) - l / s >= 0.97 * most - 1e-12 AS e_ok,
               list_max(list_transform(ns, lambda x: pow(x / total, (r_low + r_high) / 2) / x))
                 / list_sum(list_transform(ns, lambda x: pow(x / total, (r_low + r_high) / 2))) * total <= 4 + 1e-12 AS r_ok
        FROM halving h, all_ WHERE i < 30)),
chosen AS (SELECT round(greatest(e_low, r_high), 6) AS a FROM halving WHERE i = 30),
shares AS (
  SELECT key, n AS source_tokens, CAST(floor(pow(n / total, a) / list_sum(list_transform(ns, lambda x: pow(x / total, a))) * total + 0.5) AS BIGINT) AS share
  FROM sources, all_, chosen),
ordered AS (
  SELECT * FROM (
    SELECT key, block, epoch, share, epoch * source_tokens + coalesce(sum(n) OVER (
             PARTITION BY key, epoch ORDER BY CAST('0x' || substr(md5('0|' || epoch || '|' || key || '|' || block), 1, 15) AS BIGINT), block
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_start
    FROM sizes JOIN shares USING (key),
         unnest(range(CAST(greatest(ceil(share / source_tokens), 1) AS BIGINT))) AS t(epoch))
  WHERE block_start < share),
placed AS (
  SELECT d.doc_id, d.source, d.n_tokens, o.epoch, d.block, o.share, o.block_start + d.inner_ AS start
  FROM (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY key, block ORDER BY number, doc_id, n_tokens
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inner_ FROM dealt) d
  JOIN ordered o USING (key, block) WHERE o.block_start + d.inner_ < o.share)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, block, CAST(start AS BIGINT) AS start,
       CAST((CAST(start AS HUGEINT) * greatest(1, ((SELECT CAST(total AS BIGINT) FROM all_) + 1048575) // 1048576)) // share AS BIGINT) AS mix_block
FROM placed
"""


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return repair.round_trip(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), end=2)


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removals(table(spark, folder, "documents"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS g
         FROM windows SEMI JOIN repeated USING (s), unnest(range(35)) AS o(k) GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
                CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END AS k
         FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.identify(table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first_ FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> (15 - i % 4 * 5)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_ THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_ THEN first_ END AS refers_to
FROM f
"""


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extracted(table(spark, folder, "pages"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repairs(conversations.damaged(table(spark, folder, "conversations")))


def _plus(parse: str, cost: str, letters: str) -> str:
    """A parse (nine digits of cost, then the audit) with an edit more."""
    return f"lpad(CAST(CAST(substr({parse}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({parse}, 10) || '{letters}'"


def _taken(parse: str, initial: str) -> str:
    """A parse with a row that is kept if it has the initial, else gets another role."""
    return f"CASE WHEN x = '{initial}' THEN {_plus(parse, 'cut', 'K')} ELSE {_plus(parse, '2 + cut', 'R')} END"


OP11_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (
  SELECT *, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, (v & 1) * 3988292384)))) % 20 AS kind
  FROM given),
numbers AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds k JOIN numbers n ON k.conv_id IS NOT DISTINCT FROM n.conv_id, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS t(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
faults AS (
  SELECT *, substr(role, 1, 1) AS x, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         CAST(NOT regexp_matches(text, '[.!?][ 	-
]*$') AS INT) AS cut,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
parses(conv, i, s0, s1, s2, s3) AS (
  SELECT conv, 0::BIGINT, '000000000', NULL::VARCHAR, '000000002I', '000000004II' FROM numbers
  UNION ALL
  SELECT conv, i, t0, t1, least(t2, {_plus('t0', '2', 'I')}, {_plus('t1', '2', 'I')}, {_plus('t3', '2', 'I')}),
         least(t3, {_plus('t2', '2', 'I')}, {_plus('t0', '4', 'II')}, {_plus('t1', '4', 'II')})
  FROM (SELECT f.conv, f.i, {_plus('s0', '3', 'D')} AS t0,
               least({_plus('s1', '3', 'D')}, CASE WHEN stays AND x = 's' THEN {_plus('s0', 'cut', 'K')} END) AS t1,
               least({_plus('s2', '3', 'D')}, CASE WHEN stays THEN least({_taken('s0', 'u')}, {_taken('s1', 'u')}, {_taken('s3', 'u')}) END) AS t2,
               least({_plus('s3', '3', 'D')}, CASE WHEN stays THEN {_taken('s2', 'a')} END) AS t3
        FROM parses p JOIN (SELECT *, NOT blank AND NOT again AS stays FROM faults) f ON f.conv = p.conv AND f.i = p.i + 1)),
counts AS (
  SELECT conv, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND cut = 1) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv),
best AS (
  SELECT p.conv, CAST(substr(least(s0, s3), 1, 9) AS BIGINT) AS cost, substr(least(s0, s3), 10) AS audit
  FROM parses p LEFT JOIN counts c USING (conv) WHERE p.i = coalesce(c.n, 0)),
letters AS (
  SELECT conv, j, letter, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o
  FROM (SELECT conv, j, substr(audit, CAST(j AS INT), 1) AS letter FROM best, unnest(range(1, length(audit) + 1)) AS t(j))
  WINDOW w AS (PARTITION BY conv ORDER BY j)),
written AS (
  SELECT l.*, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
         bool_or(o = 1 AND letter = 'K' AND f.x = 's') OVER (PARTITION BY l.conv) AS led
  FROM letters l LEFT JOIN faults f ON f.conv = l.conv AND f.i = l.i AND l.letter <> 'I' WHERE letter <> 'D'),
texts AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - CAST(led AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS whole
  FROM written GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM numbers JOIN best USING (conv) LEFT JOIN counts USING (conv) LEFT JOIN texts USING (conv)
"""


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.periodic_runs(table(spark, folder, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = r"""
WITH plain AS (
  SELECT * REPLACE (regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS text)
  FROM (SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, text FROM documents
        UNION ALL SELECT 'i', item_id, 0, text FROM benchmark)),
windows AS (
  SELECT DISTINCT coalesce(CAST(id AS VARCHAR), '') AS item, least(len(text), 10) AS size, array_to_string(text[k:k + least(len(text), 10) - 1], ' ') AS words
  FROM plain, unnest(range(1, len(text) - least(len(text), 10) + 2)) AS t(k) WHERE kind = 'i' AND len(text) > 0),
hits AS (
  SELECT r, k, size, words
  FROM (SELECT r, k, size, array_to_string(text[k:k + size - 1], ' ') AS words
        FROM plain, (SELECT DISTINCT size FROM windows) s, unnest(range(1, len(text) - size + 2)) AS t(k) WHERE kind = 'd')
  SEMI JOIN windows USING (size, words)),
covered AS (SELECT r, count(DISTINCT k + j) AS n FROM hits, unnest(range(size)) AS t(j) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hits JOIN windows USING (words)) GROUP BY r)
SELECT id AS doc_id, CAST(len(text) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM plain LEFT JOIN covered c USING (r) LEFT JOIN items i USING (r) WHERE kind = 'd'
"""


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quartile_digest, op2_source_mixing, op3_nearest_neighbours, op4_sentencepiece, op5_token_output, op6_substring_dedup, op7_language_id, op8_warc, op9_simhash_near_dedup, op10_main_text,
                                   op11_conversation_repair, op12_periodic_runs, op13_benchmark_decontamination)}


def all_sql() -> dict[str, str]:
    return {"op2_source_mixing": OP2_SQL, "op6_substring_dedup": OP6_SQL, "op8_warc": OP8_SQL, "op11_conversation_repair": OP11_SQL,
            "op13_benchmark_decontamination": OP13_SQL}
