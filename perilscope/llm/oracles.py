"""The same rows in SQL, for the operators that SQL can state."""

from __future__ import annotations

from perilscope.llm import decontaminate, line_dedup, line_rules, sharding, url_filter

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
FOLDED_WORDS = rf"regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+')"


def shingles(id_column: str, table: str, words_each: int) -> str:
    return f"""
        SELECT DISTINCT {id_column}, CASE WHEN len(ws) < {words_each} THEN array_to_string(ws, ' ')
            ELSE array_to_string(list_slice(ws, i, i + {words_each - 1}), ' ') END AS shingle, len(ws) < {words_each} AS whole
        FROM (SELECT {id_column}, ws, unnest(range(1, greatest(len(ws) - {words_each - 1}, 1) + 1)) AS i
              FROM (SELECT {id_column}, {FOLDED_WORDS} AS ws FROM {table}) WHERE len(ws) > 0)"""


NEAR_DUPS = f"""
WITH RECURSIVE s AS ({shingles("doc_id", "documents", 3)}),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM s x JOIN s y ON x.shingle = y.shingle AND x.whole = y.whole AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes m ON m.doc_id = a JOIN sizes k ON k.doc_id = b
          WHERE 100 * c >= 85 * (m.n + k.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""


def term_hits(terms: tuple[str, ...]) -> str:
    tests = [f"CAST(regexp_matches(low, '(^|[^a-z]){term}([^a-z]|$)') AS BIGINT)" for term in terms]
    return " + ".join(tests)


def fitting(rules) -> list[tuple[str, str, str]]:
    found = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, path = rule.split("/", 1)
        test = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        found.append((test, rule, verdict))
    return found


URL_FILTER = f"""
WITH parts AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
counted AS (SELECT *, {term_hits(url_filter.STRICT)} AS n_strict, {term_hits(url_filter.SOFT)} AS heavy, {term_hits(url_filter.WEAK)} AS light FROM parts)
SELECT page_id, host, path, n_strict, heavy + light AS n_soft, 2 * heavy + light AS soft_weight,
    CASE {" ".join(f"WHEN {test} THEN '{rule}'" for test, rule, _ in fitting(url_filter.RULES))} END AS rule,
    CASE {" ".join(f"WHEN {test} THEN '{verdict}'" for test, _, verdict in fitting(url_filter.RULES))}
        WHEN n_strict >= 1 OR 2 * heavy + light >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM counted
"""

DECONTAMINATE = f"""
WITH d AS ({shingles("doc_id", "documents", decontaminate.SHINGLE)}),
b AS ({shingles("item_id", "benchmark", decontaminate.SHINGLE)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (shingle, whole) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id)
WHERE 1000 * n_shared >= {round(1000 * decontaminate.CONTAINMENT)} * n_item
"""

# CRC-32 byte by byte: one entry of the table is eight halvings of its number, with the reversed polynomial.
CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
    "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
)
SHARDS = f"""
WITH crc_table AS (SELECT {CRC_TABLE} AS t),
bytes AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents),
rows AS (
    SELECT doc_id, source, len(h) // 2 + 1 AS size,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1]))) AS text_crc32
    FROM bytes, crc_table),
keyed AS (SELECT *, md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, 'null:' || (text_crc32 * 2147483648 + size))) AS key FROM rows),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, text_crc32, size) - 1 AS r,
        count(*) OVER (PARTITION BY source) AS n FROM keyed),
sources AS (SELECT source, count(*) AS n, md5('{sharding.SEED}:' || coalesce(source, 'null')) AS k FROM rows GROUP BY source),
ahead AS (SELECT source, coalesce(sum(n) OVER (ORDER BY k, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
          FROM sources),
cut AS (
    SELECT ranked.*, (r + 0.5::DOUBLE) / n AS fraction,
        len(list_filter(range(1, {sharding.SHARDS} + 1), lambda j: (a + n) * j // {sharding.SHARDS} - a * j // {sharding.SHARDS} <= r)) AS s
    FROM ranked JOIN ahead ON ranked.source IS NOT DISTINCT FROM ahead.source)
SELECT doc_id, size, text_crc32, 'rows' AS law, s::INTEGER AS shard,
    row_number() OVER (PARTITION BY s ORDER BY fraction, source NULLS LAST) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
wins AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS win
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM placed ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

LINE_RULES = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS h, {WORDS} AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
wins AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS win
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, h, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM (SELECT doc_id, source, h, unnest(ls) AS l FROM w)),
hosts AS (SELECT source, count(DISTINCT h) AS texts FROM w GROUP BY source),
often AS (SELECT l.source, line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source GROUP BY l.source, line, texts
          HAVING count(DISTINCT h) >= {line_rules.LEAST_DOCUMENTS} AND count(DISTINCT h) > {line_rules.HOST_SHARE} * texts),
gone AS (SELECT doc_id, sum(len(string_split(l.line, ' '))) AS n, count(*) AS lines FROM lines l JOIN often o
         ON l.line = o.line AND l.source IS NOT DISTINCT FROM o.source GROUP BY doc_id),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.lines, 0)::BIGINT AS n_frequent_lines FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN gone g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED_PERCENT} * n_words AS base_failed,
    NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED_PERCENT} * n_words)
        AND n_words - n_removed >= {line_rules.DEPLETED} * n_words AND n_words - n_removed >= {line_rules.MIN_WORDS} AS kept,
    n_removed, n_frequent_lines
FROM base
"""

LINE_DEDUP = rf"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM cut),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= {line_dedup.KEY_POINTS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}),
judged AS (SELECT k.doc_id, line, pos, coalesce(owner <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN owners o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES = {
    "op2_near_dups": NEAR_DUPS,
    "op3_url_filter": URL_FILTER,
    "op4_decontaminate": DECONTAMINATE,
    "op5_shards": SHARDS,
    "op7_substrings": SUBSTRINGS,
    "op9_line_rules": LINE_RULES,
    "op12_line_dedup": LINE_DEDUP,
}
