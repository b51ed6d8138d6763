"""The operators in SQL, where SQL can express them."""

from __future__ import annotations

from marketpulse.llm.quality_votes import (
    ITERATIONS, PRIOR, RULES, START_ACCURACY, START_SHARE, THRESHOLD,
)

_PERSPECTIVES = r"""
WITH t AS (
  SELECT conv_id, turn, role, text, coalesce(floor(turn / 256.0)::BIGINT, -1) AS part,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS body
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id AS c, role AS participant FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), x AS (
  SELECT t.*, participant,
         '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' WHEN role IS NULL THEN 'user'
           WHEN role = 'system' THEN role ELSE 'user name=' || regexp_replace(role, '[\x20\x09-\x0D<>|]', '_', 'g') END
           || chr(10) AS head
  FROM t LEFT JOIN s ON t.conv_id IS NOT DISTINCT FROM s.c
), y AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS line,
         row_number() OVER w AS k,
         coalesce(sum(length(head) + length(body) + 11) OVER (
           PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM x
  WINDOW w AS (PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
)
SELECT conv_id, participant, part, count(*)::INTEGER AS n_turns, string_agg(line, '' ORDER BY k) AS text,
       coalesce(string_agg((before + length(head))::VARCHAR || '-' || (before + length(head) + length(body))::VARCHAR, ','
         ORDER BY k) FILTER (WHERE role = participant), '') AS mask
FROM y GROUP BY conv_id, participant, part
"""

_URL_RULES = r"""
WITH r(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), m AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS k
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.k = 1
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_COMPONENTS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
    lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) AS shingle
  FROM d WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * same >= 85 * (a.n + b.n - same)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT x AS doc_id, x AS reached FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.low, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(reached) AS low FROM r GROUP BY doc_id) c USING (doc_id)
"""

_CONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_ITEM_WORDS}) AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_ITEM_WORDS}) AS v FROM benchmark
), q AS (
  SELECT item_id, least(len(v), 10) AS size, unnest(list_transform(range(1, greatest(len(v) - 9, 1) + 1),
    lambda k: array_to_string(list_slice(v, k, k + 9), ' '))) AS phrase
  FROM i WHERE len(v) > 0
), z AS (
  SELECT DISTINCT size FROM q
), c AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS place, w FROM d, z WHERE len(w) >= size
), h AS (
  SELECT c.doc_id, c.place, c.size, q.item_id FROM c JOIN q
  ON c.size = q.size AND array_to_string(list_slice(c.w, c.place, c.place + c.size - 1), ' ') = q.phrase
), k AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM h) GROUP BY doc_id
), m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def _quality_sql() -> str:
    """The metrics, the ballots, and one pair of steps for each iteration of EM, written out one below the other."""
    rules = list(RULES.values())
    ballot = ", ".join(
        f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}" for j, (good, bad) in enumerate(rules)
    )
    names = ", ".join(f"v{j}" for j in range(len(rules)))
    evidence = " + ".join(["ln(share / (1 - share))", *(
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in range(len(rules))
    )])

    def learned(j: int, right: int, weight: str, name: str) -> str:
        return f"""(sum(CASE v{j} WHEN {right} THEN {weight} ELSE 0 END) + {PRIOR} * sum(n) * {START_ACCURACY})
        / (sum(CASE v{j} WHEN 0 THEN 0 ELSE {weight} END) + {PRIOR} * sum(n)) AS {name}{j}"""

    both = ", ".join(f"{learned(j, 1, 'n * p', 'g')}, {learned(j, -1, 'n * (1 - p)', 'b')}" for j in range(len(rules)))
    start = ", ".join(f"{START_ACCURACY}::DOUBLE AS g{j}, {START_ACCURACY}::DOUBLE AS b{j}" for j in range(len(rules)))
    steps = [f"m0 AS MATERIALIZED (SELECT {START_SHARE}::DOUBLE AS share, {start})"]
    for t in range(1, ITERATIONS + 1):
        steps.append(f"e{t} AS (SELECT *, 1 / (1 + exp(-({evidence}))) AS p FROM b, m{t - 1})")
        steps.append(
            f"m{t} AS MATERIALIZED (SELECT (sum(n * p) + {PRIOR} * sum(n) * {START_SHARE}) / (sum(n) * (1 + {PRIOR})) AS share, {both} FROM e{t})"
        )
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS place, w FROM d WHERE len(w) >= 8
), named AS (
  SELECT doc_id, place, array_to_string(list_slice(w, place, place + 7), ' ') AS phrase FROM win
), twice AS (
  SELECT doc_id, place FROM named QUALIFY count(*) OVER (PARTITION BY doc_id, phrase) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(place, place + 8)) AS word FROM twice) GROUP BY doc_id
), x AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(regexp_replace(text, '[!?]', '', 'g')))::BIGINT AS n_marks,
         (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         len(list_distinct(w))::BIGINT AS n_distinct,
         len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]$')))::BIGINT AS n_ends,
         len(list_filter(w, lambda x: length(x) <= 3))::BIGINT AS n_short
  FROM d LEFT JOIN rep USING (doc_id)
), y AS (
  SELECT *, {ballot} FROM x
), b AS (
  SELECT {names}, count(*)::DOUBLE AS n FROM y GROUP BY {names}
), {", ".join(steps)}, f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM y, m{ITERATIONS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-({evidence}))) >= {THRESHOLD} AS kept
FROM f
"""


_TRIE = """
WITH z AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) AS v FROM range(256) r(i))
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''),
           lambda x: ord(x)::BIGINT)), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT conv_id, max(place) AS own FROM t GROUP BY conv_id), z
), c AS (
  SELECT l.conv_id, l.own, l.h, f.conv_id AS first, least(l.h, coalesce(f.own, 0)) AS taken
  FROM l LEFT JOIN l f ON f.conv_id = l.conv_id - l.conv_id % 5
), r AS (
  SELECT conv_id, place - h + taken AS depth, role, text FROM t JOIN c USING (conv_id) WHERE place > h
  UNION ALL SELECT c.conv_id, t.place, role, text FROM c JOIN t ON t.conv_id = c.first AND t.place <= c.taken
), p AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
         string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (
  SELECT node, depth, min(conv_id) AS low, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY node, depth
), k AS (
  SELECT left(node, length(node) - 64) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)
), s AS (
  SELECT left(node, 64 * d) AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM w) GROUP BY 1
), e AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p JOIN c USING (conv_id)
  WHERE depth = taken + greatest(own - h, 0) GROUP BY node
)
SELECT w.low AS conv_id, w.depth, u.low AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM w JOIN s USING (node) LEFT JOIN e USING (node) LEFT JOIN n u ON w.depth > 0 AND u.node = left(w.node, length(w.node) - 64)
"""

_HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (
  SELECT * FROM e WHERE vec_id % 100 = 0
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
  FROM a JOIN e ON a.vec_id <> e.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {
    "op2_perspectives": _PERSPECTIVES, "op4_url_rules": _URL_RULES, "op6_quality_votes": _quality_sql(),
    "op7_jaccard_join": _COMPONENTS, "op10_positional": _CONTAMINATION,
    "op11_prefix_trie": _TRIE, "op12_hard_negatives": _HARD_NEGATIVES,
}
