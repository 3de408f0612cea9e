"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import (
    automaton,
    langid,
    lengths,
    linefreq,
    logbilinear,
    mixing,
    oddsketch,
    planes,
    prefixtrie,
    simhash,
    spelling,
    urls,
    warc,
)
from forecourt.llm.common import corpus_table

TOKENIZER = "byte_bpe_50k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_round_trip(spark, corpus_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), r AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p
), t AS (
    SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest
              AND largest IS NOT NULL AS again
    FROM r
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN largest END AS refers_to
FROM t
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(corpus_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(corpus_table(spark, sf_dir, "documents"))


def op4_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    return planes.token_files(spark, docs, public_tokenizers.path(TOKENIZER))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.judge(corpus_table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), wins AS (
    SELECT row_no, i, w[i : i + 4] AS win
    FROM (SELECT row_no, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
    SELECT row_no, i FROM (
        SELECT row_no, i, count(*) OVER (PARTITION BY row_no, win) AS n FROM wins) WHERE n > 1
), covered AS (
    SELECT row_no, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT row_no, unnest(range(i, i + 5)) AS place FROM twice) GROUP BY row_no
), lines AS (
    SELECT row_no, source, document, translate(trim(regexp_replace(line,
               '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')
               AS line,
           len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
    FROM (SELECT row_no, source, coalesce(CAST(doc_id AS VARCHAR), 'text ' || text) AS document,
                 unnest(lines) AS line FROM d)
), hosts AS (
    SELECT source, count(DISTINCT document) AS total FROM lines GROUP BY source
), hot AS (
    SELECT c.source, c.line FROM (
        SELECT source, line, count(DISTINCT document) AS n FROM lines GROUP BY source, line) AS c
    JOIN hosts AS h ON c.source IS NOT DISTINCT FROM h.source
    WHERE c.n > 10 OR (h.total < 200 AND 100 * c.n > 5 * h.total AND c.n > 2)
), lost AS (
    SELECT row_no, CAST(sum(n) AS BIGINT) AS removed_words
    FROM lines JOIN hot ON lines.line = hot.line AND lines.source IS NOT DISTINCT FROM hot.source
    GROUP BY row_no
), m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT)
               AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(removed_words, 0) AS removed_words,
           len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS base_failed
    FROM d LEFT JOIN covered USING (row_no) LEFT JOIN lost USING (row_no)
)
SELECT *, NOT base_failed AND n_words - removed_words >= 10
          AND n_words - removed_words >= n_words * 0.2 AS kept
FROM m
"""


def op6_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logbilinear.scores(corpus_table(spark, sf_dir, "documents"))


def op8_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judge(corpus_table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict", "ratio")


OP8_SQL = """
WITH cut AS (
    SELECT row_number() OVER () AS row_no, page_id, coalesce(url, '') AS key,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                ELSE '' END AS rest
    FROM pages
), rows_ AS (
    SELECT row_no, page_id, key,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule, domain, start, label) AS (
    VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
           ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
           ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
    SELECT row_no, arg_max(rule, length(rule)) AS rule, arg_max(label, length(rule)) AS label
    FROM rows_ JOIN rules
      ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
    GROUP BY row_no
), urls AS (
    SELECT key, label, CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 5 AS fold, count(*) AS n
    FROM rows_ LEFT JOIN fits USING (row_no) GROUP BY ALL
), marked AS (
    SELECT *, '^^' || regexp_replace(translate(key,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
        '[^a-z0:/.?#&=%_+\\-,;@!$''()*]', '~', 'g') || '|' AS t
    FROM urls
), places AS (
    SELECT key, label, fold, n, substr(t, i, 3) AS gram
    FROM (SELECT *, unnest(range(1, length(t) - 1)) AS i FROM marked)
), grams AS (
    SELECT gram, coalesce(sum(n) FILTER (label = 'allow' AND fold <> 0), 0) AS allowed,
           coalesce(sum(n) FILTER (label = 'block' AND fold <> 0), 0) AS blocked
    FROM places GROUP BY gram
), models AS (
    SELECT gram, kind, ln((n + 4.0::DOUBLE * (
               (sum(n) OVER (PARTITION BY kind, substr(gram, 2, 2)) + 4.0::DOUBLE * (
                   (sum(n) OVER (PARTITION BY kind, substr(gram, 3, 1)) + 4.0::DOUBLE / 49)
                   / (sum(n) OVER (PARTITION BY kind) + 4.0::DOUBLE)))
               / (sum(n) OVER (PARTITION BY kind, substr(gram, 2, 1)) + 4.0::DOUBLE)))
           / (sum(n) OVER (PARTITION BY kind, substr(gram, 1, 2)) + 4.0::DOUBLE)) AS logp
    FROM (SELECT gram, 'good' AS kind, CAST(allowed AS DOUBLE) AS n FROM grams
          UNION ALL SELECT gram, 'bad', CAST(blocked AS DOUBLE) FROM grams)
), learned AS (
    SELECT coalesce(sum(allowed), 0) > 0 AND coalesce(sum(blocked), 0) > 0 AS ok FROM grams
), weights AS (
    SELECT gram, CASE WHEN ok THEN CAST(round((max(logp) FILTER (kind = 'good')
        - max(logp) FILTER (kind = 'bad')) * 1000000) AS BIGINT) ELSE 0 END AS weight
    FROM models, learned GROUP BY gram, ok
), scores AS (
    SELECT key, CAST(floor(CAST(sum(weight) AS DOUBLE) / (count(*) * 100)) AS BIGINT) AS ratio
    FROM (SELECT DISTINCT key, t FROM marked) AS m,
         unnest(range(1, length(t) - 1)) AS u(i) JOIN weights ON gram = substr(t, i, 3)
    GROUP BY key
), ranked AS (
    SELECT ratio, sum(sum(n)) OVER (ORDER BY ratio) AS up_to, sum(sum(n)) OVER () AS total
    FROM urls JOIN scores USING (key) WHERE label = 'allow' AND fold = 0 GROUP BY ratio
), least AS (
    SELECT coalesce(min(ratio), 0) AS least FROM ranked WHERE up_to > total * (1 - 0.95::DOUBLE)
)
SELECT page_id, host, path, rule,
       coalesce(label, CASE WHEN NOT ok OR ratio >= least THEN 'allow' ELSE 'block' END)
           AS verdict, ratio
FROM rows_ LEFT JOIN fits USING (row_no) JOIN scores USING (key), least, learned
"""


def op9_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    return automaton.overlap_report(docs, corpus_table(spark, sf_dir, "benchmark"))


OP9_SQL = """
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
          FROM items WHERE len(w) > 0)
), docs AS (
    SELECT doc_id, row_number() OVER () AS row_no,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), places AS (
    SELECT row_no, s.size, i, w[i : i + s.size - 1] AS win
    FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size) AS s
), found AS (
    SELECT p.row_no, p.size, p.i, x.item_id
    FROM places AS p JOIN windows AS x ON p.size = x.size AND p.win = x.win
), hits AS (
    SELECT row_no, count(DISTINCT place) AS n_hit
    FROM (SELECT row_no, unnest(range(i, i + size)) AS place FROM found) GROUP BY row_no
), ids AS (
    SELECT row_no, count(DISTINCT item_id) AS n_items,
           sha256(array_to_string(list_sort(list(DISTINCT item_id)), ',')) AS digest
    FROM found GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN ids USING (row_no)
"""


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    path = public_tokenizers.path(TOKENIZER)
    return lengths.suffix_sums(lengths.length_histogram(docs, path))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(corpus_table(spark, sf_dir, "conversations"))


# The table of the cyclic redundancy check, and the check of a column of hex digits with it.
_CRC_TABLE = """
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: xor(c // 2, 3988292384 * (c & 1)))) AS tbl
"""
_CRC = """xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(length(hexed) // 2),
            lambda i: CAST('0x' || substr(hexed, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(tbl[(xor(c, b) & 255) + 1], c // 256)))"""

OP11_SQL = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), turns AS (
    SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list(turn ORDER BY place) AS own FROM turns GROUP BY conv_id
), heads AS (
    SELECT conv_id, own, {_CRC} % 4 AS h
    FROM (SELECT *, hex(CAST(conv_id AS VARCHAR)) AS hexed FROM lists), crc
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own[1 : c.h], []), c.own[c.h + 1 :]) AS line
    FROM heads AS c LEFT JOIN lists AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
    SELECT conv_id, d AS depth, line[1 : d] AS path, d = len(line) AS ends
    FROM (SELECT *, unnest(range(len(line) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
               FILTER (ends), '')) AS ends_sha256,
           (count(*) - 1) * CASE WHEN any_value(depth) = 0 THEN 0 ELSE
               len(regexp_extract_all(path[-1].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM prefixes GROUP BY path
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id
    FROM nodes AS n LEFT JOIN nodes AS p
      ON p.depth = n.depth - 1 AND p.path = n.path[1 : len(n.path) - 1]
), children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children
    FROM linked WHERE depth > 0 GROUP BY ALL
), under AS (
    SELECT conv_id, depth, conv_id AS c, depth AS d, saved,
           (conv_id, depth) NOT IN (SELECT (conv_id, depth) FROM children) AS leaf
    FROM linked
    UNION ALL
    SELECT l.parent_conv_id, l.depth - 1, u.c, u.d, u.saved, u.leaf
    FROM under AS u JOIN linked AS l ON l.conv_id = u.conv_id AND l.depth = u.depth
    WHERE l.depth > 0
), totals AS (
    SELECT conv_id, depth, CAST(sum(saved) AS BIGINT) AS saved_tokens,
           CAST(count(*) FILTER (leaf) AS BIGINT) AS n_leaves
    FROM under GROUP BY ALL
)
SELECT l.conv_id, l.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, ends_sha256
FROM linked AS l JOIN totals USING (conv_id, depth) LEFT JOIN children USING (conv_id, depth)
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(corpus_table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents WHERE text IS NOT NULL
), hashed AS (
    SELECT run, times, {_CRC} AS h
    FROM (SELECT run, count(*) AS times, hex(id || run) AS hexed FROM runs GROUP BY id, run), crc
), words AS (
    SELECT CASE WHEN h % 199 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
    FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), gaps AS (
    SELECT word, n, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS gap,
           substr(word, 1, i - 1) || substr(word, i + 1) AS shorter
    FROM places
), near AS (
    SELECT a.word, b.word AS other, b.n FROM gaps AS a JOIN gaps AS b USING (gap) WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM gaps AS a JOIN words AS b ON a.shorter = b.word
    UNION SELECT b.word, a.word, a.n FROM gaps AS a JOIN words AS b ON a.shorter = b.word
), best AS (
    SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS other_n,
           row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place
    FROM near
), forms AS (
    SELECT word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= 5 * words.n THEN other END AS form,
           CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (word)
), ways AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT w.word, f.form FROM ways AS w JOIN forms AS f ON f.word = w.root
    WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM forms AS f JOIN (
    SELECT w.word, w.root FROM ways AS w JOIN forms AS l ON l.word = w.root WHERE l.form IS NULL
) AS w ON w.word = f.word
"""


def op13_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_copies(corpus_table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT r, doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM d
), grams AS (
    SELECT r, len(s) AS size, hash(unnest(s)) AS g FROM sets
), links AS (
    SELECT a.r AS a, b.r AS b FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.r <> b.r
    WHERE 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
    GROUP BY a.r, b.r, a.size, b.size
    HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
), reach AS (
    SELECT r, r AS other FROM sets
    UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other
), roots AS (
    SELECT reach.r, min(sets.doc_id) AS component_id
    FROM reach JOIN sets ON sets.r = reach.other GROUP BY reach.r
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
       coalesce(doc_id = component_id, false) AS kept
FROM sets JOIN roots USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_sainte_lague": op3_sainte_lague,
    "op4_bit_planes": op4_bit_planes,
    "op5_line_frequency": op5_line_frequency,
    "op6_subword_language": op6_subword_language,
    "op7_log_bilinear": op7_log_bilinear,
    "op8_url_models": op8_url_models,
    "op9_suffix_automaton": op9_suffix_automaton,
    "op10_length_histogram": op10_length_histogram,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_odd_sketches": op13_odd_sketches,
}
ORACLES: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op5_line_frequency": OP5_SQL,
    "op8_url_models": OP8_SQL,
    "op9_suffix_automaton": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op13_odd_sketches": OP13_SQL,
}
