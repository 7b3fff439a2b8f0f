"""Registered queries of the operators: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import (bpe, chat, decontaminate, divergence, filter_audit, language_id, near_dup, pii, quality, secrets,
                        token_counts, top_k, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")


def registered(query):
    QUERIES[query.__name__] = query
    return query


def checked(sql: str):
    """Register a query with its SQL."""
    def register(query):
        ORACLES[query.__name__] = sql
        return registered(query)
    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@registered
def op6_byte_bpe(spark, folder):
    return bpe.encoded(spark, read(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN).drop("ids")


@registered
def op7_token_counts(spark, folder):
    return token_counts.token_counts(spark, read(spark, folder, "documents"), COUNTED, public_tokenizers.PATTERN)


@registered
def op10_near_duplicates(spark, folder):
    return near_dup.near_duplicates(read(spark, folder, "documents"))


#: All windows of all items looked up at every place of every document.
CONTAMINATION_SQL = r"""
WITH item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS phrase
  FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM item_words WHERE len(words) > 0)),
doc_words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT DISTINCT doc_id, item, i, p.size AS size
         FROM places p JOIN windows w ON p.phrase = w.phrase AND p.size = w.size),
by_word AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
by_item AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
            FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN by_word h ON d.doc_id = h.doc_id LEFT JOIN by_item t ON d.doc_id = t.doc_id
"""


@checked(CONTAMINATION_SQL)
def op1_decontamination(spark, folder):
    documents, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return decontaminate.decontaminated(spark, documents, benchmark).drop("items")


@registered
def op2_language_id(spark, folder):
    return language_id.identified(spark, read(spark, folder, "documents"))


#: Base 32 of a digest: each five hexadecimal digits are four letters.
ARCHIVE_SQL = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS first FROM rows),
letters AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS INTEGER)) AS parts
            FROM digests)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((parts[1 + i // 4] >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM letters
"""


@checked(ARCHIVE_SQL)
def op4_warc(spark, folder):
    return warc.archived(spark, read(spark, folder, "pages"))


@registered
def op8_secrets(spark, folder):
    return secrets.secrets(spark, read(spark, folder, "documents")).drop("found")


#: Every beginning of every conversation as a string of its turns' digests.
CHAT_SQL = """
WITH d AS (SELECT DISTINCT conv_id, turn, role, text,
             sha256(concat(coalesce(CAST(octet_length(encode(role)) AS VARCHAR), '-'), ':', coalesce(role, ''),
                           CASE WHEN text IS NULL THEN '-' ELSE '+' END, coalesce(text, ''))) AS digest
           FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS seq,
                    count(*) OVER (PARTITION BY conv_id) AS n_turns FROM d),
prefixes AS (SELECT *, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY seq
                                                    ROWS UNBOUNDED PRECEDING) AS prefix FROM numbered),
whole AS (SELECT prefix, min(conv_id) AS conv_id FROM prefixes WHERE seq = n_turns GROUP BY prefix),
kept AS (SELECT conv_id FROM whole WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE seq < n_turns))
SELECT conv_id, seq, n_turns,
       concat('<|', coalesce(role, 'unknown'), '|>', chr(10), coalesce(text, ''), '<|end|>', chr(10)) AS rendered
FROM prefixes WHERE conv_id IN (SELECT conv_id FROM kept)
"""


@checked(CHAT_SQL)
def op5_chat(spark, folder):
    return chat.formatted(read(spark, folder, "conversations"))


@registered
def op9_personal_data(spark, folder):
    return pii.personal_data(read(spark, folder, "documents")).drop("found")


@registered
def op3_quality(spark, folder):
    return quality.judged(read(spark, folder, "documents"))


#: Every kept term of a language in every one of its groups.
DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
words AS (SELECT r, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(u.n, 0) + 2 * coalesce(v, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM used GROUP BY lang, source) u ON g.lang = u.lang AND g.source = u.source
  LEFT JOIN langs l ON g.lang = l.lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(u.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(u.c, 0) + 2) // total AS p,
         1 + 1000000000::HUGEINT * (k.c + 2) // (l.n + 2 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY x.lang, x.source, y.source) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE c > 0 AND p > q),
every AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                        ORDER BY value DESC, encode(item)) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@checked(DIVERGENCE_SQL)
def op11_source_divergence(spark, folder):
    return divergence.audited(read(spark, folder, "documents"))


NEAREST_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.parts, c.parts) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""


@checked(NEAREST_SQL)
def op12_top_k(spark, folder):
    return top_k.nearest(read(spark, folder, "embeddings"))


AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
                 min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
fails AS (
  SELECT part, doc_id, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * capitals > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN first < doc_id THEN 16 ELSE 0 END AS mask FROM split),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counters AS (SELECT part, mask, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n
             FROM fails LEFT JOIN marks ON fails.doc_id = marks.doc_id GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS own,
                 CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS before
          FROM (SELECT *, unnest(range(1, 6)) AS i FROM orders)),
told AS (
  SELECT part, filter_order, step, own, CAST(sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM counters, steps GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE own, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM told
"""


@checked(AUDIT_SQL)
def op13_filter_audit(spark, folder):
    return filter_audit.audited(spark, f"{folder}/documents.parquet", read(spark, folder, "labels"))
