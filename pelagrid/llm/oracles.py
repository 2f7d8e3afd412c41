"""DuckDB statements with the results of the text queries that SQL can express."""

from __future__ import annotations

import re

from pelagrid.llm import licences

OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '<null>') AS host, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT r, i, array_to_string(list_slice(words, i, i + 4), ' ') AS five
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT r, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
), ln AS (
  SELECT r, host, text, raw,
         trim(regexp_replace(regexp_replace(lower(raw),
              '[1-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT r, host, text, unnest(lines) AS raw FROM w)
), freq AS (
  SELECT host, line FROM (
    SELECT host, line, max(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) AS words, count(DISTINCT text) AS n
    FROM ln GROUP BY host, line)
  JOIN (SELECT host, count(DISTINCT text) AS size FROM d GROUP BY host) USING (host)
  WHERE n > 20 AND (words >= 4 OR n > 0.05 * size)
), gone AS (
  SELECT r, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')))::BIGINT AS n
  FROM ln SEMI JOIN freq USING (host, line) GROUP BY r
), c AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS boilerplate_words
  FROM w LEFT JOIN cov USING (r) LEFT JOIN gone USING (r)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
)
SELECT *, NOT base_failed AND NOT (boilerplate_words > 0 AND
  (n_words - boilerplate_words < 10 OR n_words - boilerplate_words < 0.3 * n_words)) AS kept
FROM f
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][place % 3 + 1] AS weight, 2.0 * source_size AS cap FROM s
), ranked AS (
  SELECT *, sum(cap) OVER q - cap AS caps_before, sum(weight) OVER () - sum(weight) OVER q + weight AS weight_left,
         row_number() OVER q AS k
  FROM w WINDOW q AS (ORDER BY cap / weight, place ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT k, (1.5 * (SELECT sum(source_size) FROM s) - caps_before) / weight_left AS level, cap / weight AS ratio FROM ranked
), level AS (
  SELECT coalesce(arg_min(level, k) FILTER (WHERE ratio >= level), max(ratio)) AS level
  FROM levels
), t AS (
  SELECT source, source_size, place % 3 AS kind, least(cap, weight * level) AS target FROM w, level
), o AS (
  SELECT d.*, t.source_size, t.kind, t.target, round(t.target)::BIGINT AS words,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT doc_id, size, source_size, target, kind, before / target AS q,
         (CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
               + greatest(0, least(size, words % source_size - before)) END)::BIGINT AS taken
  FROM o
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE
         WHEN kind = 0 THEN 2 * q / (1.5 + sqrt(greatest(2.25 - 2 * q, 0)))
         WHEN kind = 1 THEN q
         WHEN q <= 0.375 THEN 2 * q / (0.5 + sqrt(0.25 + 2 * q))
         ELSE 0.5 + 2 * (q - 0.375) / (1 + sqrt(1 + 2 * (q - 0.375))) END, 9) END AS first_position
FROM p
"""

OP1 = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS k
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id AS c, speaker AS assistant FROM t WHERE speaker <> 'system'
), v AS (
  SELECT conv_id, assistant, k // 256 AS part, k, speaker = assistant AS own,
         CASE WHEN speaker = assistant THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
              ELSE '<|user name=' || replace(speaker, '<|', '<' || chr(8203) || '|') || '|>' END || chr(10) AS head,
         replace(text, '<|', '<' || chr(8203) || '|') AS body
  FROM t JOIN s ON conv_id IS NOT DISTINCT FROM c
), o AS (
  SELECT *, (sum(length(head) + length(body) + 8) OVER (PARTITION BY conv_id, assistant, part ORDER BY k)
             - length(body) - 8)::BIGINT AS b FROM v
)
SELECT conv_id, assistant, part, count(*) AS n_turns,
       string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(b || '-' || b + length(body) + 8, ',' ORDER BY k) FILTER (WHERE own), '') AS mask,
       coalesce(sum(length(body) + 8) FILTER (WHERE own), 0)::BIGINT AS n_masked_in
FROM o GROUP BY conv_id, assistant, part
"""


def _licence_sql() -> str:
    """Words as rows' lists: every place after a bound is tried with every sentence of its length."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    plain = lambda x: " ".join(re.findall("[a-z0-9]+", x.lower()))
    listed = lambda table: ", ".join(
        f"({quoted(plain(form))}, {quoted(name)}, {len(plain(form).split())})" for name, forms in table.items() for form in forms
    )
    rules = ", ".join(
        f"({i}, {quoted(name)}, {quoted(kind)}, {quoted('.*'.join(f' {x} ' for x in ids))})"
        for i, (name, kind, ids) in enumerate(licences.RULES)
    )
    return rf"""
WITH known(form, id, n) AS (VALUES {listed(licences.SENTENCES)}), spdx(form, id, n) AS (VALUES {listed(licences.SPDX)}),
rules(rank, name, kind, pattern) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS text FROM documents),
piece AS (
  SELECT r, piece, k FROM (
    SELECT r, unnest(pieces) AS piece, unnest(range(len(pieces))) AS k FROM (
      SELECT r, string_split(regexp_replace(text, '[.;:!?]["'')\]]*([ \t\n\f\r]|$)|\n', chr(1), 'g'), chr(1)) AS pieces FROM d
      WHERE regexp_matches(text, 'licen|permi|copyright|warrant|redistribut|reserved|cc0|software'))
  )
), w AS (
  SELECT r, k, unnest(words) AS word, unnest(range(len(words))) AS j, len(words) AS size
  FROM (SELECT r, k, regexp_extract_all(piece, '[a-z0-9]+') AS words FROM piece)
), t AS (
  SELECT r, list(word ORDER BY k, j) AS words, list(j = 0 ORDER BY k, j) AS firsts, list(j = size - 1 ORDER BY k, j) AS lasts
  FROM w GROUP BY r
), s AS (
  SELECT r, i, words, firsts, lasts FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM t) WHERE firsts[i]
), sentence AS (
  SELECT r, i, i + n - 1 AS last, [id] AS ids FROM s JOIN known
  ON split_part(form, ' ', 1) = words[i] AND lasts[i + n - 1] AND array_to_string(words[i:i + n - 1], ' ') = form
), tag AS (
  SELECT r, i, i + 2 + list_position(lasts[i + 3:], true) AS last,
         array_to_string(words[i + 3:i + 2 + list_position(lasts[i + 3:], true)], ' ') AS expression
  FROM s WHERE words[i:i + 2] = ['spdx', 'license', 'identifier'] AND len(words) > i + 2
), named AS (
  SELECT r, i, name, place FROM (
    SELECT r, i, unnest(names) AS name, unnest(range(len(names))) AS place FROM (
      SELECT r, i, string_split(regexp_replace(replace(expression, ' or later', '-or-later'), ' (and|or|with) ', '|', 'g'), '|') AS names
      FROM tag))
), tagged AS (
  SELECT r, i, list(id ORDER BY place) AS ids FROM named JOIN spdx ON replace(name, '-or-later', ' or later') = form GROUP BY r, i
), f AS (
  SELECT r, i, max(last) AS last, arg_max(ids, last) AS ids FROM (
    SELECT r, i, last, ids FROM sentence
    UNION ALL SELECT tag.r, tag.i, last, coalesce(ids, []) FROM tag LEFT JOIN tagged ON tag.r = tagged.r AND tag.i = tagged.i
  ) GROUP BY r, i
), best AS (
  SELECT r, flatten(list(ids ORDER BY i)) AS ids FROM f
  WHERE NOT EXISTS (SELECT 1 FROM f AS e WHERE e.r = f.r AND e.i < f.i AND f.i <= e.last) GROUP BY r
), h AS (
  SELECT r, rank, name, kind FROM best, rules
  WHERE regexp_matches(' ' || array_to_string(ids, '  ') || ' ', pattern)
), g AS (
  SELECT r, arg_min(name, rank) AS licence, arg_min(kind, rank) AS kind FROM h GROUP BY r
), n AS (
  SELECT r, string_agg(name, ',' ORDER BY rank) AS licences
  FROM (SELECT r, name, min(rank) AS rank FROM h GROUP BY r, name) GROUP BY r
)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, licence, kind, coalesce(licences, '') AS licences
FROM d LEFT JOIN best USING (r) LEFT JOIN g USING (r) LEFT JOIN n USING (r)
"""


OP3 = _licence_sql()

OP12 = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), d AS (
  SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0
), size AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), c AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM c GROUP BY term), size
), m AS (
  SELECT r, doc_id, 100 - 50 + (50 * n * docs) // total AS figure FROM d, size
), s AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * figure)))::BIGINT AS score
  FROM asked JOIN c USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
) WHERE rank <= 50
"""

ORACLES: dict[str, str] = {
    "op1_perspective_rotation": OP1,
    "op3_licence_rules": OP3,
    "op7_curriculum_mix": OP7,
    "op10_line_frequency_rules": OP10,
    "op12_fp_tree_search": OP12,
}
