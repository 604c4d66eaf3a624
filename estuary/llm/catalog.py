"""Registered queries of the training-data operators and their DuckDB oracles.

Each ``opN_<name>`` query applies its operator, with production parameters, to
its whole table and derives the checked columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm import (ann, host_rules, mixing, pieces, quality, sharding, simhash, token_counts, token_store, toxicity,
                         trie, url_rules, whitening)
from estuary.llm.common import table

WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def op1_mixing(spark: SparkSession, d: str) -> DataFrame:
    sizes = mixing.document_sizes(table(spark, d, "documents"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {WORDS_SQL} AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
           FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS z,
             [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
      FROM d GROUP BY source),
-- share the rest by weight as long as a source is above twice its size
r(source, z, w, capped, step) AS (
  SELECT source, z, w, false, 0 FROM s
  UNION ALL
  SELECT source, z, w, capped OR 2 * z < w * (1.5 * sum(z) OVER () - 2 * coalesce(sum(z) FILTER (capped) OVER (), 0))
                                         / sum(w) FILTER (NOT capped) OVER (), step + 1
  FROM r WHERE step < (SELECT count(*) FROM s)),
f AS (SELECT *, sum(z) OVER () AS total, coalesce(sum(z) FILTER (capped) OVER (), 0) AS zc,
             sum(w) FILTER (NOT capped) OVER () AS wo
      FROM r WHERE step = (SELECT count(*) FROM s)),
t AS (SELECT source, z, CASE WHEN capped THEN 2 * z ELSE w * (1.5 * total - 2 * zc) / wo END AS target FROM f),
p AS (SELECT d.*, t.z, t.target, round(t.target)::BIGINT AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS prior
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, z::BIGINT AS source_size, target,
       (CASE WHEN z = 0 THEN 0 ELSE floor(budget / z) * size
        + least(size, greatest(budget - floor(budget / z) * z - prior, 0)) END)::BIGINT AS taken
FROM p
"""

def op2_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    """Number and hash of the sampled pieces, and the crc32 of the text before
    encoding and after decoding (equal: the round trip is lossless)."""
    docs = table(spark, d, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    back = pieces.decode(pieces.encode(docs, keep=["doc_id", "text_crc32"]))
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                       "text_crc32", F.crc32("text").alias("decoded_crc32"))


def op3_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents")).select(
        "doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, d, "labels")))


def op5_ann(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_host_rules(spark: SparkSession, d: str) -> DataFrame:
    return host_rules.judge_documents(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT r, i, ws[i:i+4] AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
g2 AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g2) GROUP BY r),
l AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY r),
b AS (SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS x FROM f GROUP BY source),
p AS (SELECT sum(x) / sum(n) AS m, count(*) AS k, sum(n) AS nn, sum(n * (x / n) * (x / n)) / sum(n) AS q FROM h),
v AS (SELECT m, m * (1 - m) AS noise, q - m * m - m * (1 - m) * k / nn AS spread FROM p),
s AS (SELECT m, CASE WHEN spread * 1e6 <= noise THEN 1e6 ELSE greatest(noise / spread - 1, 1.0) END AS s FROM v),
hv AS (SELECT source, (x + m * s) / (n + s) <= 0.5 AS host_kept FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_kept AS kept
FROM f JOIN hv ON f.source IS NOT DISTINCT FROM hv.source
"""


def op7_url_rules(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, d, "pages"))


# Every subset of a labelled URL's tokens is counted, so no mining order matters.
OP7_SQL = r"""
WITH r AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://')
                  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h0 FROM r),
q AS (SELECT *, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(rest, length(h0) + 1) AS tail FROM p),
u AS (SELECT *, regexp_extract(tail, '^[^?#]*') AS path, regexp_extract(tail, '^[^?#]*\?([^#]*)', 1) AS query,
             regexp_extract(tail, '#(.*)$', 1) AS frag FROM q),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT r, arg_max(verdict, length(rh || rp)) AS given, arg_max(rh || rp, length(rh || rp)) AS rule
        FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r),
fl AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS file FROM u),
lab AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
               list_transform(list_filter(string_split(left(path, length(path) - length(file)), '/'), lambda x: x <> ''),
                              lambda x: regexp_replace(x, '^[0-9]+$', '#')) AS folders,
               regexp_replace(regexp_replace(file, '\.[A-Za-z][A-Za-z0-9]*$', ''), '^[0-9]+$', '#') AS name FROM fl),
tok AS (SELECT r, page_id, host, path, list_sort(list_distinct(
    list_concat(list_transform(labels, lambda x: 'h:' || x),
    list_transform(list_filter(flatten(list_transform(list_filter(labels, lambda x: contains(x, '-')),
                   lambda x: string_split(x, '-'))), lambda x: x <> ''), lambda x: 'w:' || x),
    list_transform(folders, lambda x: 'd:' || x), list_filter(['p:' || name], lambda x: x <> 'p:'),
    list_filter(['x:' || lower(regexp_extract(file, '\.([A-Za-z][A-Za-z0-9]*)$', 1))], lambda x: x <> 'x:'),
    list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: regexp_extract(x, '^([^=]*)', 1)),
                   lambda x: x <> ''), lambda x: 'q:' || x),
    list_transform(list_filter(string_split(query, '&'), lambda x: regexp_matches(x, '^[^=]+=.')),
                   lambda x: 'v:' || regexp_extract(x, '^([^=]*=)', 1)
                             || regexp_replace(regexp_extract(x, '^[^=]*=(.*)', 1), '^[0-9]+$', '#')),
    CASE WHEN frag <> '' THEN ['f:'] ELSE [] END))) AS tokens FROM lab),
t AS (SELECT tok.*, rule, given FROM tok LEFT JOIN fit USING (r)),
n AS (SELECT count(*) AS n FROM t WHERE given IS NOT NULL),
sub AS (SELECT given, m.a AS a FROM (SELECT given, unnest(list_transform(range(1, (1 << len(tokens))::BIGINT),
          lambda b: {'a': list_filter(tokens, lambda x, i: (b >> (i - 1)) & 1 = 1)})) AS m
        FROM t WHERE given IS NOT NULL)),
c AS (SELECT a, given AS verdict, count(*) AS f FROM sub GROUP BY ALL),
tot AS (SELECT a, sum(f) AS fa FROM c GROUP BY a),
rl AS (SELECT a, verdict, f::DOUBLE / fa::DOUBLE AS conf, f AS sup FROM c JOIN tot USING (a), n
       WHERE f >= ceil(0.01 * n.n) AND f::DOUBLE / fa::DOUBLE >= 0.8),
open AS (SELECT DISTINCT tokens FROM t WHERE given IS NULL),
best AS (SELECT tokens, arg_max(verdict, (conf, sup, verdict = 'allow')) AS found
         FROM open JOIN rl ON list_has_all(tokens, a) GROUP BY tokens)
SELECT page_id, host, path, rule, coalesce(given, found, 'allow') AS verdict
FROM t LEFT JOIN best USING (tokens)
"""


def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, d, "labels")))


def op9_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_documents(table(spark, d, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


OP9_SQL = r"""
WITH RECURSIVE k(i, v, s) AS (SELECT i, i::BIGINT, 0 FROM range(256) x(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, s + 1 FROM k WHERE s < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM k WHERE s = 8),
b AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS key,
             string_split(regexp_replace(hex(coalesce(text, '')), '(..)', '\1 ', 'g'), ' ')[:-2] AS h FROM documents),
d AS (SELECT r, doc_id, key, len(h)::BIGINT + 1 AS size,
             xor(4294967295, list_reduce(list_transform(h, lambda x: ('0x' || x)::BIGINT),
                 lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]), 4294967295::BIGINT))::BIGINT AS text_crc32
      FROM b, crc),
leaf AS (SELECT n, s // 8 AS region, s // 4 % 2 AS rack, s AS shard FROM range(16) x(s), (VALUES (16), (17)) y(n)
         UNION ALL SELECT 17, 2, 0, 16),
w AS (SELECT n, region, rack, shard, count(*) OVER (PARTITION BY n, region) AS wr,
             count(*) OVER (PARTITION BY n, region, rack) AS wk FROM leaf),
c1 AS (SELECT DISTINCT n, region, wr FROM w), c2 AS (SELECT DISTINCT n, region, rack, wk FROM w),
s1 AS (SELECT r, key, n, arg_min(region, (-ln((('0x' || substr(md5(key || ':' || region), 1, 13))::BIGINT + 0.5)
              / 4503599627370496.0) / wr, region)) AS region FROM d, c1 GROUP BY ALL),
s2 AS (SELECT r, key, n, region, arg_min(rack, (-ln((('0x' || substr(md5(key || ':' || region || '/' || rack), 1, 13))
              ::BIGINT + 0.5) / 4503599627370496.0) / wk, rack)) AS rack FROM s1 JOIN c2 USING (n, region) GROUP BY ALL),
s3 AS (SELECT r, n, arg_min(shard, (-ln((('0x' || substr(md5(key || ':' || region || '/' || rack || '/' || shard), 1, 13))
              ::BIGINT + 0.5) / 4503599627370496.0), shard)) AS shard FROM s2 JOIN w USING (n, region, rack) GROUP BY r, n)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard::INT AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY md5('slot:' || key || ':' || size || ':' || text_crc32),
                          doc_id, size, text_crc32) - 1 AS slot, g.shard::INT AS grown_shard
FROM d JOIN s3 a ON d.r = a.r AND a.n = 16 JOIN s3 g ON d.r = g.r AND g.n = 17
"""


def op10_tokens(spark: SparkSession, d: str) -> DataFrame:
    return token_store.token_digests(table(spark, d, "documents"))


def op11_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.prefix_trie(table(spark, d, "conversations"))


OP11_SQL = r"""
WITH RECURSIVE k(i, v, s) AS (SELECT i, i::BIGINT, 0 FROM range(256) x(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, s + 1 FROM k WHERE s < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM k WHERE s = 8),
own AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, (xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''),
                    lambda c: ascii(c)::BIGINT), lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]), 4294967295::BIGINT)) % 6)::INT AS h
      FROM own, crc),
c AS (SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS turns
      FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, d, turns[1:d] AS path, d = len(turns) AS last FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
      FROM p GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(path[d].text) END AS saved
      FROM n LEFT JOIN kids USING (path)),
up AS (SELECT path[1:a] AS path, sum((k = 0)::INT) AS leaves, sum(saved) AS saved
       FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.k::BIGINT AS n_children,
       up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN up USING (path) LEFT JOIN n q ON f.d > 0 AND q.path = f.path[1:f.d - 1]
"""


def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"))


def op13_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, d, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_ann": op5_ann,
    "op6_host_rules": op6_host_rules,
    "op7_url_rules": op7_url_rules,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_tokens": op10_tokens,
    "op11_trie": op11_trie,
    "op12_whitening": op12_whitening,
    "op13_counts": op13_counts,
}
ORACLE = {
    "op1_mixing": OP1_SQL,
    "op6_host_rules": OP6_SQL,
    "op7_url_rules": OP7_SQL,
    "op9_sharding": OP9_SQL,
    "op11_trie": OP11_SQL,
}
