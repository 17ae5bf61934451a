"""DuckDB twins of the corpus operators that SQL can express, written from their contracts and not from the Spark code."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

NGRAM_JACCARD_JOIN = rf"""
WITH RECURSIVE
read AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
                {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p, len(w) AS n FROM read),
runs AS (SELECT r, p, n, list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS run FROM words),
shingles AS (SELECT DISTINCT r, array_to_string(run, ' ') AS g FROM runs WHERE len(run) = 5 OR (p = 1 AND n < 5)),
sets AS (SELECT r, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS s FROM shingles GROUP BY r),
texts AS (SELECT min(r) AS r, s FROM sets GROUP BY s),
held AS (SELECT r, n, g FROM shingles JOIN sets USING (r) WHERE r IN (SELECT r FROM texts)),
several AS (SELECT r, n, g, count(*) OVER (PARTITION BY g) AS holders FROM held QUALIFY holders > 1),
pairs AS (SELECT a.r AS x, b.r AS y FROM several a JOIN several b ON a.g = b.g AND a.r < b.r AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
          GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
equal AS (SELECT sets.r AS x, texts.r AS y FROM sets JOIN texts USING (s)),
either AS (SELECT x, y FROM pairs UNION SELECT x, y FROM equal),
links AS (SELECT x, y FROM either UNION SELECT y, x FROM either),
reach AS (SELECT r AS x, r AS y FROM read UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT reach.x AS r, min(read.doc_id) AS component_id FROM reach JOIN read ON reach.y = read.r GROUP BY reach.x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM read JOIN least USING (r) LEFT JOIN sets USING (r)
"""

WARC = """
WITH read AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
known AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS latest FROM read)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> latest THEN latest END AS refers_to
FROM known
"""

SUBSTRING_DEDUP = rf"""
WITH
read AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM read),
runs AS (SELECT r, doc_id, p, list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS run FROM words),
windows AS (SELECT r, doc_id, p, md5(array_to_string(run, ' ')) AS held FROM runs WHERE len(run) = 50),
judged AS (SELECT r, p, min(doc_id) OVER (PARTITION BY held) < doc_id AS repeats FROM windows),
marked AS (SELECT words.r, words.word, words.p, coalesce(bool_or(judged.repeats) OVER (
                      PARTITION BY words.r ORDER BY words.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
           FROM words LEFT JOIN judged ON words.r = judged.r AND words.p = judged.p),
kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS text FROM marked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM read LEFT JOIN kept ON read.r = kept.r
"""

# crc32 bit by bit: a code below 0 stands for one shift, others are exclusive-ored in
PREFIX_TRIE = """
WITH
own AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''),
               sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
               [[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')])),
               lambda crc, code: CASE WHEN code >= 0 THEN xor(crc, code) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) % 9 AS h FROM own),
rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
            FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
paths AS (SELECT conv_id, len(turns) AS total, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
steps AS (SELECT conv_id, total, depth, sha256(turns[1:depth]::JSON::VARCHAR) AS node, sha256(turns[1:depth - 1]::JSON::VARCHAR) AS above,
                 octet_length(encode(turns[depth].text)) AS bytes FROM paths),
nodes AS (SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
                 CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * any_value(bytes) END AS saved,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
          FROM steps GROUP BY depth, node),
children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)),
below AS (SELECT steps.depth, steps.node, sum(counted.saved) AS saved, count(*) FILTER (counted.n_children = 0) AS leaves
          FROM counted JOIN steps ON steps.conv_id = counted.conv_id AND steps.depth <= counted.depth GROUP BY steps.depth, steps.node)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b USING (depth, node) LEFT JOIN counted p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.node = c.above
"""

ORACLE_SQL = {
    "op6_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
    "op7_warc": WARC,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op12_prefix_trie": PREFIX_TRIE,
}
