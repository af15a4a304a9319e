"""What the queries return, as SQL for DuckDB, where SQL can say it."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LINES = f"""
WITH line AS (
    SELECT doc_id, part[i] AS line, i AS place,
           translate(trim(part[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM (SELECT doc_id, part, unnest(range(1, len(part) + 1)) AS i
          FROM (SELECT doc_id, string_split(ifnull(text, ''), chr(10)) AS part FROM documents))),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper IS NOT NULL) AS n_dropped,
       sha256(ifnull(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE keeper IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN shared ON line.key = shared.key AND doc_id < keeper
GROUP BY doc_id"""

PASSAGES = rf"""
WITH item AS (SELECT item_id, regexp_extract_all(translate(ifnull(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
doc AS (SELECT doc_id, regexp_extract_all(translate(ifnull(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
probe AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM item WHERE len(w) > 0))),
gram AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM probe))),
found AS (SELECT doc_id, i, n, item_id FROM gram JOIN probe USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, ifnull(n_hit, 0) AS n_hit, ifnull(n_items, 0) AS n_items,
       sha256(ifnull(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

URLS = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
page AS (
    SELECT page_id, translate(ifnull(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
           ifnull(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages)
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       ifnull(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM page LEFT JOIN rules ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
GROUP BY page_id"""

CHATS = r"""
WITH said AS (
    SELECT conv_id, turn, ifnull(role, '') AS role, ifnull(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
           len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0D\x20]')) + 4 AS tokens,
           10 + length(role) + len(regexp_extract_all(role, '[\\|<\[]'))
              + length(text) + len(regexp_extract_all(text, '[<\[]\\*(\||/s>|s>|/?INST\])')) AS chars
    FROM said),
placed AS (
    SELECT s.*, first.tokens AS rules_tokens, first.chars AS rules_chars,
           sum(s.tokens) OVER (PARTITION BY s.conv_id ORDER BY s.nth) - s.tokens AS before,
           greatest(1536 - ifnull(first.tokens, 0), 512) AS span
    FROM sized s LEFT JOIN (FROM sized WHERE nth = 1 AND role = 'system') first ON s.conv_id IS NOT DISTINCT FROM first.conv_id),
dealt AS (
    SELECT *, 2 * (before // span) + CAST(before % span > 0 AND before % span + tokens > span AS INTEGER) AS part FROM placed),
part AS (
    SELECT conv_id, part, min(before) AS start, min(nth) AS head, any_value(rules_chars) AS rules_chars FROM dealt GROUP BY ALL),
length_ AS (
    SELECT conv_id, sum(chars) AS n FROM (
        SELECT conv_id, chars FROM dealt
        UNION ALL SELECT conv_id, 3 FROM part
        UNION ALL SELECT conv_id, rules_chars FROM part WHERE head > 1 AND rules_chars IS NOT NULL
        UNION ALL SELECT d.conv_id, d.chars FROM dealt d JOIN part p ON d.conv_id IS NOT DISTINCT FROM p.conv_id
            AND d.nth < p.head AND d.before >= p.start - 512 AND NOT (d.nth = 1 AND d.role = 'system'))
    GROUP BY conv_id)
SELECT s.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(ifnull(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(ifnull(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(any_value(n) AS BIGINT) AS formatted_chars
FROM sized s JOIN length_ l ON s.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY s.conv_id"""

NEIGHBOURS = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = f"""
WITH doc AS (SELECT row_number() OVER () AS nth, doc_id, text FROM documents),
term AS (SELECT nth, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM doc),
long AS (SELECT nth, doc_id, count(*) AS n FROM term GROUP BY nth, doc_id),
corpus AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM long),
item AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
tf AS (SELECT nth, term, count(*) AS tf FROM term WHERE term IN (SELECT term FROM item) GROUP BY nth, term),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, corpus GROUP BY term),
part AS (
    SELECT nth, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))) AS part
    FROM tf JOIN long USING (nth) JOIN weight USING (term), corpus),
scored AS (SELECT item_id, nth, CAST(sum(part) AS BIGINT) AS score FROM part JOIN item USING (term) GROUP BY item_id, nth)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scored JOIN long USING (nth) WHERE score > 0)
WHERE rank <= 10"""

COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(ifnull(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY ifnull(text, ''))"""


def statements() -> dict[str, str]:
    return {
        "op1_line_dedup": LINES,
        "op2_decontamination": PASSAGES,
        "op3_url_filter": URLS,
        "op4_chat_format": CHATS,
        "op10_top_k": NEIGHBOURS,
        "op11_lexical_search": LEXICAL,
        "op12_exact_dedup": COPIES,
    }
