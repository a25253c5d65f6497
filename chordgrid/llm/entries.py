"""The subpackage's registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession

from chordgrid.llm import (conversation_trie, exact_dedup, fingerprints, license_scan, line_dedup, mixing, ngram_join, pii_surrogates, quality_classifier,
                           quality_rules, sentencepiece_codec, spelling, substring_dedup)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("n_chunks")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).drop("n_left", "th")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_words(documents(spark, sf_dir))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(documents(spark, sf_dir))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encoded(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(documents(spark, sf_dir))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the session's key; where it has none, with a key that is forgotten after this run."""
    key = spark.conf.get(pii_surrogates.KEY_SETTING, None) or secrets.token_hex(16)
    return pii_surrogates.surrogate_texts(documents(spark, sf_dir), key=key)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir), spoil=spelling.SPOIL)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


QUERIES = {"op12_fingerprints": op12_fingerprints, "op11_spelling": op11_spelling, "op13_conversation_trie": op13_conversation_trie, "op2_license_scan": op2_license_scan, "op4_pii_surrogates": op4_pii_surrogates, "op5_quality_classifier": op5_quality_classifier, "op1_sentencepiece": op1_sentencepiece, "op7_ngram_join": op7_ngram_join, "op9_substring_dedup": op9_substring_dedup, "op3_line_dedup": op3_line_dedup, "op6_quality_rules": op6_quality_rules, "op8_mixing": op8_mixing, "op10_exact_dedup": op10_exact_dedup}

ORACLES = {
    "op11_spelling": r"""
WITH RECURSIVE run AS (
  SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL
), crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS tab
), coded AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
         lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 | (ord(c) >> 6))::BIGINT, (128 | (ord(c) & 63))::BIGINT] END))),
         lambda x, y: xor(x >> 8, tab[1 + (xor(x, y) & 255)])), 4294967295) AS h FROM run, crc
), word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM coded)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT word.word, cut.word, cut.n FROM word JOIN cut ON cut.v = word.word
  UNION SELECT cut.word, word.word, word.n FROM word JOIN cut ON cut.v = word.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM near GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM word LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS root FROM formed UNION SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL
), ends AS (
  SELECT way.word, way.root FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""",
    "op13_conversation_trie": r"""
WITH turns AS (
  SELECT conv_id, list(key ORDER BY turn IS NOT NULL, turn, md5(key)) AS t, list(size ORDER BY turn IS NOT NULL, turn, md5(key)) AS s
  FROM (SELECT conv_id, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS key, length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), h AS (
  SELECT conv_id, t, s, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
         lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295) % 6 AS h FROM turns
), built AS (
  SELECT h.conv_id, list_transform(coalesce(b.t[1:h], []) || h.t[h + 1:], lambda x: md5(x)) AS t, coalesce(b.s[1:h], []) || h.s[h + 1:] AS s
  FROM h LEFT JOIN turns b ON b.conv_id = h.conv_id - h.conv_id % 100
), pre AS (
  SELECT conv_id, d, array_to_string(t[1:d], '') AS k, CASE WHEN d = 0 THEN 0 ELSE s[d] END AS size, d = len(t) AS ends FROM (SELECT conv_id, t, s, unnest(range(0, len(t) + 1)) AS d FROM built)
), node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM pre GROUP BY d, k
), kids AS (
  SELECT left(k, 32 * (d - 1)::INT) AS k, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
), sub AS (
  SELECT up AS d, left(k, 32 * up::INT) AS k, sum(saved) AS saved, count(*) FILTER (WHERE n IS NULL) AS leaves
  FROM (SELECT node.d, node.k, saved, n, unnest(range(0, node.d + 1)) AS up FROM node LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k) GROUP BY ALL
)
SELECT node.conv_id, node.d AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children, sub.leaves AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN sub ON sub.d = node.d AND sub.k = node.k LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k LEFT JOIN node p ON p.d = node.d - 1 AND p.k = left(node.k, 32 * (node.d - 1)::INT)""",
    "op7_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i+4], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY ALL""",
    "op9_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS f FROM win) WHERE f < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit
), word AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS x FROM w
), kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY word.doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op3_line_dedup": r"""
WITH ln AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS l FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))
), rep AS (
  SELECT k, max(doc_id) AS last_doc FROM ln WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last_doc IS NOT NULL AND last_doc <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE last_doc IS NULL OR last_doc = doc_id), '')) AS kept_sha256
FROM ln LEFT JOIN rep USING (k) GROUP BY doc_id""",
    "op6_quality_rules": r"""
WITH t AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS x FROM documents
), w AS (
  SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws FROM t
), win AS (
  SELECT doc_id, i, ws[i:i+7] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT doc_id, sum(least(8, i - prev)) AS n FROM (SELECT doc_id, i, lag(i, 1, -8) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM twice) GROUP BY doc_id
), ln AS (
  SELECT doc_id, host, x, line, lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS c
  FROM (SELECT doc_id, host, x, unnest(string_split(x, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY doc_id
), freq AS (
  SELECT host, k, min(doc_id) AS keeper FROM ln JOIN (SELECT host, count(DISTINCT doc_id) AS docs FROM t GROUP BY host) USING (host)
  GROUP BY host, k, docs HAVING count(DISTINCT doc_id) > 10 AND 100 * count(DISTINCT doc_id) > 10 * docs
), lost AS (
  SELECT ln.doc_id, sum(c) AS n FROM ln JOIN freq USING (host, k) WHERE ln.doc_id <> keeper GROUP BY ln.doc_id
), b AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(x, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost.n, 0) AS lost
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - lost) >= 30 * n_words AS kept
FROM b""",
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t""",
}
