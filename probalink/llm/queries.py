"""The queries of this subpackage's operators over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probalink.llm import alignment, ann, bpe, decontaminate, packing, pii, prefix_trie, quality_model, quality_rules, simhash, substrings, token_counts, warc
from probalink.llm.common import table

PATTERN = public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.with_bytes(bpe.with_ids(table(spark, sf_dir, "documents"), path, PATTERN), path, PATTERN))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.scored(docs, quality_model.learned(docs, table(spark, sf_dir, "labels")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), PATTERN)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.rated(table(spark, sf_dir, "documents"), ["doc_id"])
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line", "start", "end", "n_words", F.col("kept_id").alias("kept_doc_id"), "kept_start", "class")


#: The second replica of the audit's query: the pages of these remainders have a byte that differs, or are missing.
DAMAGED, DAMAGE, LOST, LOSS = 211, 7, 307, 11


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    damaged = pages.withColumn("html", F.when(F.col("page_id") % DAMAGED == DAMAGE, F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    return warc.audited(warc.records(pages), warc.records(damaged.where(F.col("page_id") % LOST != LOSS)))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), PATTERN)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), PATTERN)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.branched(prefix_trie.turn_arrays(table(spark, sf_dir, "conversations"))))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality_model": op2_quality_model,
    "op3_pii": op3_pii,
    "op4_pack": op4_pack,
    "op5_quality_rules": op5_quality_rules,
    "op6_substrings": op6_substrings,
    "op7_warc": op7_warc,
    "op8_simhash": op8_simhash,
    "op9_ann": op9_ann,
    "op10_token_counts": op10_token_counts,
    "op11_alignment": op11_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_decontaminate": op13_decontaminate,
}
LINE_END = "chr(13) || chr(10)"
#: Both replicas are hashed, and their records compared by file, id and hash; the roots are those of the first, level by level.
OP7_SQL = f"""WITH e AS (SELECT {LINE_END} AS e),
p AS (SELECT 0 AS side, page_id, url, html FROM pages UNION ALL SELECT 1, page_id, url, CASE WHEN page_id % {DAMAGED} = {DAMAGE} THEN '?' || substr(html, 2) ELSE html END FROM pages WHERE page_id % {LOST} <> {LOSS}),
r AS (SELECT side, page_id AS id, page_id // 1024 AS file, 'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e
  || 'Content-Type: application/http; msgtype=response' || e || 'Content-Length: ' || strlen(body) || e || e || body AS record
  FROM (SELECT *, 'HTTP/1.1 200 OK' || e || 'Content-Type: text/html; charset=utf-8' || e || e || coalesce(html, '') AS body FROM p, e)),
h AS (SELECT side, file, id, hash, substr(hash, 1, 3) AS bucket, unit, CAST(count(*) AS BIGINT) AS n FROM (SELECT *, sha256(record) AS hash, strlen(record) + 4 AS unit FROM r) GROUP BY ALL),
l AS (SELECT *, CAST(sum(unit * n) OVER (PARTITION BY file, id, bucket ORDER BY hash) - unit * n AS BIGINT) AS o, unit * n AS len FROM h WHERE side = 0),
b AS (SELECT *, CAST(sum(len) OVER (PARTITION BY file, id ORDER BY bucket) - len AS BIGINT) AS o FROM (SELECT file, id, bucket, sum(len) AS len, sha256(string_agg(o || ':' || o + len || ':' || hash, ',' ORDER BY o)) AS hash FROM l GROUP BY ALL)),
i AS (SELECT *, CAST(sum(len) OVER (PARTITION BY file, id // 32 ORDER BY id) - len AS BIGINT) AS o FROM (SELECT file, id, sum(len) AS len, sha256(string_agg(o || ':' || CAST(o + len AS BIGINT) || ':' || hash, ',' ORDER BY o)) AS hash FROM b GROUP BY ALL)),
g AS (SELECT *, CAST(sum(len) OVER (PARTITION BY file ORDER BY part) - len AS BIGINT) AS o FROM (SELECT file, id // 32 AS part, sum(len) AS len, sha256(string_agg(o || ':' || CAST(o + len AS BIGINT) || ':' || hash, ',' ORDER BY o)) AS hash FROM i GROUP BY ALL)),
f AS (SELECT file, sha256(string_agg(o || ':' || CAST(o + len AS BIGINT) || ':' || hash, ',' ORDER BY o)) AS root FROM g GROUP BY file),
c AS (SELECT file, id, hash, unit, unnest(range(n)) AS copy FROM h WHERE side = 0)
SELECT file, id AS page_id, row_number() OVER w - 1 AS number, CAST(sum(c.unit) OVER w - c.unit AS BIGINT) AS "offset", c.unit AS length, hash, root, copy >= coalesce(o.n, 0) AS corrupt
FROM c JOIN f USING (file) LEFT JOIN (SELECT * FROM h WHERE side = 1) o USING (file, id, hash) WINDOW w AS (PARTITION BY file ORDER BY id, hash, copy ROWS UNBOUNDED PRECEDING)"""
OP9_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
#: CRC-32 bit by bit; every prefix of every conversation as a list, grouped.
OP12_SQL = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, CAST(xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda crc, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(crc, x)), CAST(4294967295 AS BIGINT))) % 4 AS INTEGER) AS h FROM own),
r AS (SELECT h.conv_id, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, turns[1:d] AS prefix, d, d = len(turns) AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM p GROUP BY prefix, d),
k AS (SELECT n.*, coalesce(c.children, 0) AS children, CASE WHEN d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL) c USING (prefix, d)),
s AS (SELECT prefix[1:a] AS prefix, a AS d, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM k) GROUP BY ALL)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n AS n_convs, k.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN s USING (prefix, d) LEFT JOIN n u ON u.d = k.d - 1 AND u.prefix = k.prefix[1:k.d - 1]"""
#: Windows as strings of their words, joined by equality for each length that occurs.
OP13_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
dw AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw))),
o AS (SELECT r, k, n, item FROM dw JOIN bw USING (n, win)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM o)) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""
#: The others have no SQL: DuckDB has neither their tokenizers, nor XXH64, look-behind in patterns, or what their methods estimate.
SQL: dict[str, str] = {"op7_warc": OP7_SQL, "op9_ann": OP9_SQL, "op12_prefix_trie": OP12_SQL, "op13_decontaminate": OP13_SQL}
