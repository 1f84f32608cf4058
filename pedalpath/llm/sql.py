"""SQL twins, in DuckDB's dialect, of the corpus queries that SQL can express."""

from __future__ import annotations

from itertools import permutations

from .licenses import TEMPLATES


def _license_scan() -> str:
    """The templates as a table, and their words joined by relative position."""
    rows = ", ".join(f"('{w}', {n}, '{t.label}', {str(t.base).lower()}, {at}, {str(k).lower()})"
                     for n, t in enumerate(TEMPLATES) for w, at, k in t.postings())
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH template(word, template, label, base, spot, key) AS (VALUES {rows}),
split AS (SELECT doc_id, {words} AS words FROM documents),
hits AS (
  SELECT doc_id, word, pos - 1 AS pos
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split)
  WHERE word IN (SELECT word FROM template)),
total AS (SELECT count(*) AS n FROM documents),
vocabulary AS (SELECT DISTINCT word FROM template),
weights AS (
  SELECT v.word, ln((SELECT n FROM total) + 1) - ln(count(DISTINCT h.doc_id) + 1) AS weight
  FROM vocabulary v LEFT JOIN hits h ON v.word = h.word GROUP BY v.word),
wholes AS (
  SELECT template, sum(weight) AS whole, count(*) FILTER (key) AS keys
  FROM template JOIN weights USING (word) GROUP BY template),
places AS (
  SELECT doc_id, template, label, base, pos - spot AS origin, count(*) FILTER (key) AS found, sum(weight) AS weight
  FROM hits JOIN template USING (word) JOIN weights USING (word) GROUP BY ALL),
held AS (
  SELECT doc_id, label, base, origin, CASE WHEN whole > 0 THEN round(least(weight / whole, 1.0), 6) ELSE 1.0 END AS score
  FROM places JOIN wholes USING (template) WHERE found = keys),
per AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(origin) FILTER (base) AS first_word,
         max(origin) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM held GROUP BY doc_id)
SELECT s.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM split s LEFT JOIN per ON s.doc_id IS NOT DISTINCT FROM per.doc_id
"""


def _prefix_trie() -> str:
    """Every prefix by name, and every node met with the prefixes of its smallest member."""
    step = "xor(a >> 1, 3988292384 * (a & 1))"
    byte = f"list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: {step}, i))"
    crc = ("xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)), "
           "lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)]), 4294967295))")
    return f"""
WITH bytes AS (SELECT {byte} AS crcs),
src AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sig,
         strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sig) AS pos FROM src),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {crc} % 9 AS h FROM (SELECT DISTINCT conv_id FROM src), bytes),
joined AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.sig, o.size FROM convs c JOIN own o ON o.conv_id = c.base WHERE o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.sig, o.size FROM convs c JOIN own o USING (conv_id) WHERE o.pos > c.h),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM joined),
named AS (
  SELECT conv_id, depth, size, md5(string_agg(sig, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS name FROM placed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
prefixes AS (
  SELECT *, lag(name) OVER path AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM named WINDOW path AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
  SELECT depth, name, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ending
  FROM prefixes GROUP BY depth, name),
kids AS (SELECT depth - 1 AS depth, above AS name, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, name)),
totals AS (
  SELECT p.depth, p.name, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.size) AS saved
  FROM counted v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY ALL)
SELECT v.conv_id::BIGINT AS conv_id, v.depth::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
       v.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens,
       sha256(v.ending) AS ends_sha256
FROM counted v JOIN totals t USING (depth, name) LEFT JOIN nodes u ON u.depth = v.depth - 1 AND u.name = v.above
"""


def _filter_audit() -> str:
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words
  FROM documents),
marks AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM docs),
marked AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marks LEFT JOIN marked USING (doc_id) GROUP BY ALL),
plans AS (
  SELECT filter_order, step, filter_order[step] AS letter, CASE WHEN step > 1 THEN filter_order[1:step - 1] ELSE '' END AS before
  FROM (VALUES {orders}) o(filter_order), generate_series(1, 5) s(step)),
cases AS (
  SELECT s.*, filter_order, step, letter, contains(fails, letter) AS now,
         len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND before <> '' AND fails <> '' AS earlier
  FROM sets s, plans),
per AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (now AND NOT earlier), 0) AS removed, coalesce(sum(n) FILTER (now AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
         coalesce(sum(good) FILTER (now AND NOT earlier), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (now AND NOT earlier), 0) AS toxic_lost
  FROM cases GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM per
"""


SQL = {
    "op13_filter_audit": _filter_audit(),
    "op11_prefix_trie": _prefix_trie(),
    "op2_license_scan": _license_scan(),
    # Water-filling in closed form: with sources in the order of cap / weight, those before the first one whose cap
    # is not reached at the level of the rest are clamped.
    "op8_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         left(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 12) AS place
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
total AS (SELECT sum(source_size)::BIGINT AS words FROM per),
levels AS (
  SELECT per.*, coalesce(sum(cap) OVER before, 0) AS held, (sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0) AS open
  FROM per WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (words - held)::DOUBLE AS free, open FROM levels, total
  WHERE weight * (words - held)::DOUBLE / open <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
aimed AS (
  SELECT source, source_size, CASE WHEN weight * free / open > cap THEN cap::DOUBLE ELSE weight * free / open END AS target
  FROM per, level),
wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM aimed),
units AS (
  SELECT s.source, place, sum(size)::BIGINT AS words, target - whole * source_size AS rest
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source GROUP BY ALL),
run AS (
  SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY place))::BIGINT - words AS before FROM units),
cut AS (
  SELECT source, place, rest - before AS room FROM run WHERE rest > 0 AND before <= rest AND before + words > rest),
turn AS (
  SELECT *, (sum(size) OVER (PARTITION BY source, place ORDER BY size, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - size AS upto FROM sized)
SELECT doc_id, size::BIGINT AS size, w.source_size, w.target, repetitions, repetitions * size AS taken FROM (
  SELECT s.*, w.source_size, w.target, w.whole + CASE WHEN s.place < c.place
         OR (s.place = c.place AND size > 0 AND 2 * (room - upto) >= size) THEN 1 ELSE 0 END AS repetitions
  FROM turn s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source
  LEFT JOIN cut c ON s.source IS NOT DISTINCT FROM c.source) w
""",
}
