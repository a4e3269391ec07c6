"""SQL for the queries that it can state."""

from __future__ import annotations

from quaymart.llm.quality import STOP_WORDS

_STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(l) AS line, unnest(range(len(l))) AS position
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), trimmed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM lines
), common AS (
  SELECT t, min((doc_id, position)) AS first FROM trimmed
  WHERE len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= 3
  GROUP BY t HAVING count(DISTINCT site) >= 5
), marked AS (
  SELECT doc_id, position, line, first IS NOT NULL AND (doc_id, position) <> first AS removed
  FROM trimmed LEFT JOIN common USING (t)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT removed), '') AS text
FROM marked GROUP BY doc_id
"""

QUALITY = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM t
), repeated AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM windows)
  WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, p + unnest([0, 1, 2]) AS q FROM repeated)
  GROUP BY doc_id
), f AS (
  SELECT t.doc_id, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '!')) AS n_exclamations,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop_words,
    len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•·]'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS n_ellipsis_lines
  FROM t LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
    OR 10 * word_chars < 20 * n_words OR 10 * word_chars > 150 * n_words
    OR 100 * n_symbols > 30 * n_words OR 100 * n_exclamations > 50 * n_words
    OR 100 * n_stop_words < n_words OR 100 * n_dup_lines > 50 * n_lines
    OR 100 * n_bullet_lines > 90 * n_lines OR 100 * n_ellipsis_lines > 50 * n_lines) AS kept
FROM f
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SEARCH = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT count(*) FILTER (len(w) > 0)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM d
), tf AS (
  SELECT doc_id, r, len(w) AS n, t, count(*) AS tf
  FROM (SELECT doc_id, r, w, unnest(w) AS t FROM d) GROUP BY ALL
), df AS (
  SELECT t, count(*) AS df FROM tf GROUP BY t
), q AS (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, r,
    sum(floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * s.docs) // s.terms))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t), s
  GROUP BY item_id, doc_id, r
), placed AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

_BYTE = "('0x' || hex(encode(x))[2 * i + 1 : 2 * i + 2])::BIGINT"
SPELLING = rf"""
WITH RECURSIVE bits AS (
  SELECT list(c ORDER BY b) AS table_of FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))
), runs AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS x, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(octet_length(encode(x))), lambda i: {_BYTE})),
    lambda c, b: xor(c >> 8, table_of[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, bits
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0
      THEN run[1 : h % length(run)] || run[h % length(run) + 2 : length(run)] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT DISTINCT word, word[1 : i - 1] || word[i + 1 : length(word)] AS rest, i
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS word, b.word AS near FROM less a JOIN less b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT p.word, count(*) AS n_near, min((-o.n, near)) AS first
  FROM pairs p JOIN words o ON o.word = p.near GROUP BY p.word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -first[1] >= 2 * w.n THEN first[2] END AS form,
    CASE WHEN -first[1] >= 2 * w.n THEN -first[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM judged WHERE form IS NULL
  UNION ALL SELECT j.word, c.root FROM judged j JOIN chain c ON j.form = c.word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN chain USING (word)
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
), own AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM d, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)
), found AS (
  SELECT r, i, size, item_id FROM own JOIN windows USING (size, win)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r
), met AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN met USING (r)
"""

SQL = {
    "op1_line_dedup": LINE_DEDUP,
    "op10_quality": QUALITY,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_spelling_variants": SPELLING,
    "op13_decontamination": DECONTAMINATION,
}
