"""SQL for the queries that SQL can express.

Not here: layout, learnt models, tokens, components and searches, and what needs the CRC-32 that
the SQL at hand lacks (sharding, and the held-out URLs). Their tests compare them with brute force.
"""

from __future__ import annotations

import string

from dimflow.llm import licences, line_rules

_LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licence_sql() -> str:
    known = ", ".join(f"({_text(licences.plain(s))}, '{i}')" for i, s in licences.SENTENCES.items())
    rules = [*licences.RULES, (licences.UNKNOWN, (licences.UNKNOWN,))]
    wanted = ["".join(f"<{i}>" for i in ids) for _, ids in rules]
    steps = "".join(
        f", step{k + 1} AS (SELECT *, replace(left{k}, '{w}', '<.>') AS left{k + 1} FROM step{k})"
        for k, w in enumerate(wanted)
    )
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{licence}' AS licence, '{'+'.join(ids)}' AS rule,"
        f" CAST((length(left{k}) - length(left{k + 1})) // {len(wanted[k]) - 3} AS INT) AS matches FROM step{len(rules)}"
        for k, (licence, ids) in enumerate(rules)
    )
    plain = f"trim(regexp_replace({_LOWER.format('s')}, '{licences.NOT_PLAIN}', ' ', 'g'))"
    wrapped, end = (p.replace("\\\\", "\\") for p in (licences.WRAPPED, licences.SENTENCE_END))
    return f"""WITH known(sentence, id) AS (VALUES {known}),
 texts AS (SELECT row_number() OVER () AS r, doc_id,
  [x FOR x IN [{plain} FOR s IN
   string_split_regex(regexp_replace(text, {_text(wrapped)}, ' \\1', 'g'), {_text(end)})] IF x <> ''] AS sentences FROM documents),
 parts AS (SELECT r, doc_id, generate_subscripts(sentences, 1) AS pos, unnest(sentences) AS sentence FROM texts),
 hits AS (SELECT r, doc_id, pos, coalesce(id, '{licences.UNKNOWN}') AS id FROM parts LEFT JOIN known USING (sentence)
  WHERE id IS NOT NULL OR regexp_matches(sentence, '{licences.SPEAKS_OF}')),
 marked AS (SELECT *, coalesce(lag(pos) OVER (PARTITION BY r ORDER BY pos) + 1 = pos, false) AS follows FROM hits),
 step0 AS (SELECT r, doc_id, string_agg(CASE WHEN follows THEN '' ELSE '<.>' END || '<' || id || '>', '' ORDER BY pos)
  AS left0 FROM marked GROUP BY r, doc_id){steps}
SELECT * FROM ({found}) WHERE matches > 0"""


CHAT_SQL = """WITH speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL),
 heard AS (SELECT t.conv_id, s.perspective, t.turn, t.role, coalesce(t.role = s.perspective, false) AS train,
  CASE WHEN t.role = s.perspective THEN '<|assistant|>'
   ELSE '<|user name=' || replace(coalesce(t.role, 'unknown'), '<|', '< |') || '|>' END || chr(10) AS header,
  replace(coalesce(t.text, ''), '<|', '< |') AS body
  FROM conversations t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
 rendered AS (SELECT *, header || body || '<|end|>' || chr(10) AS segment FROM heard),
 placed AS (SELECT *, row_number() OVER so_far - 1 AS position, CAST(sum(length(segment)) OVER so_far AS BIGINT) AS stop
  FROM rendered WINDOW so_far AS (PARTITION BY conv_id, perspective
   ORDER BY turn NULLS FIRST, role NULLS FIRST, segment ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, role, segment, stop - length(segment) AS start, stop, train,
 CASE WHEN train THEN stop - length(segment) + length(header) END AS mask_start,
 CASE WHEN train THEN stop - 1 END AS mask_stop FROM placed"""


def _letters(text: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in text)


def _isin(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def line_rules_sql() -> str:
    rules, words = line_rules, r"'[^\x20\x09-\x0D]+'"
    gone = f"translate({{}}, {_letters(rules.SPACES + rules.CLOSING)}, '{' ' * len(rules.SPACES)}')"
    return f"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
 spoken AS (SELECT r, t, regexp_extract_all(t, {words}) AS ws FROM texts),
 starts AS (SELECT r, ws, unnest(range(1, len(ws) - {rules.WINDOW - 2})) AS i FROM spoken WHERE len(ws) >= {rules.WINDOW}),
 windows AS (SELECT r, i, array_to_string(ws[i:i + {rules.WINDOW - 1}], ' ') AS w FROM starts),
 twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
 covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest(range({rules.WINDOW})) AS k) GROUP BY r),
 parts AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts),
 counted AS (SELECT r, line, regexp_extract_all(line, {words}) AS ws, len(regexp_extract_all(line, {words})) AS n,
  length(line) - length(translate(line, {_text(rules.MARKS)}, '')) AS marks,
  right(rtrim({gone.format('line')}), 1) IN {_isin(rules.SENTENCE_END)} AS closed FROM parts),
 judged AS (SELECT r, line, n, (marks >= 3 AND 2 * marks > n)
   OR (len(list_filter(ws, lambda x: x IN {_isin(rules.SEPARATORS)})) >= 2
    AND 4 * len(list_filter(ws, lambda x: x IN {_isin(rules.SEPARATORS)})) >= n)
   OR (n < 3 AND NOT closed)
   OR (n <= {rules.BOILERPLATE_WORDS} AND regexp_matches(lower(line), {_text('|'.join(rules.PHRASES))})) AS failed
  FROM counted WHERE n > 0),
 lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines,
  coalesce(sum(n) FILTER (failed), 0) AS lost FROM judged GROUP BY r),
 facts AS (SELECT doc_id, len(ws) AS n_words,
  length(t) - (length(t) - length(translate(t, {_letters(rules.SPACES)}, ''))) AS word_chars,
  length(t) - length(translate(t, {_text(rules.SYMBOLS)}, '')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM texts JOIN spoken USING (r, t) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
 based AS (SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed
  FROM facts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
 CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 NOT base_failed AND 100 * lost <= {rules.MOST_LOST} * n_words AS kept FROM based"""


HARD_NEGATIVES_SQL = """WITH whole AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.vec_id, b.uid, a.label = b.label AS same,
   CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.uid <> b.uid AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
 positives AS (SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) <= 5),
 fitting AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
   n.score AS negative_score,
   row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id, n.uid) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM fitting WHERE rank <= 10"""

ORACLES = {"op3_licences": licence_sql(), "op5_chat": CHAT_SQL, "op12_line_rules": line_rules_sql(),
           "op13_hard_negatives": HARD_NEGATIVES_SQL}
