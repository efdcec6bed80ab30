"""SQL twins of operators with an exact answer, for an independent engine on the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def similar(n: int, percent: int, kept: bool = False) -> str:
    """Components of documents linked by similar sets of word n-grams, by joining the sets."""
    return rf"""
WITH RECURSIVE dw AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' ')) END)) AS g FROM dw),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (g)
           WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * common.n >= {percent} * (x.n + y.n - common.n)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON a = other)
SELECT doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
       {", doc_id = min(other) AS kept" if kept else ""}
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


def phrases(min_count: int = 100, most: int = 5, top: int = 2000) -> str:
    """Collocations from counts of all phrases."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pw AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pw GROUP BY lang),
f AS (SELECT lang, p, k, count(*) AS a FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p
        FROM pw CROSS JOIN (SELECT k::BIGINT AS k FROM range(1, {most + 1}) r(k)) WHERE len(w) >= k)
      GROUP BY ALL HAVING count(*) >= {min_count}),
split AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE k > 1),
inner_ AS (SELECT lang, p, max(a) AS a FROM (
             SELECT lang, array_to_string(w[i:i + k - 2], ' ') AS p, a FROM split CROSS JOIN (VALUES (1), (2)) v(i) WHERE k > 2)
           GROUP BY ALL),
cuts AS (SELECT s.lang, s.p, s.a, x.a AS l, y.a AS r, t.n, c, (1000::HUGEINT * s.a * t.n) // (x.a::HUGEINT * y.a) AS score
         FROM split s JOIN totals t USING (lang) CROSS JOIN range(1, {most}) u(c)
         JOIN f x ON x.lang = s.lang AND x.p = array_to_string(s.w[1:c], ' ')
         JOIN f y ON y.lang = s.lang AND y.p = array_to_string(s.w[c + 1:], ' ')
         WHERE c < s.k),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.p) AS rank,
       best.p AS phrase, best.a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN inner_ ON inner_.lang = best.lang AND inner_.p = best.p
WHERE inner_.a IS NULL OR inner_.a < best.a
QUALIFY rank <= {top}"""


def spelling(min_length: int = 5, min_count: int = 3, ratio: int = 2, slip_every: int = 97) -> str:
    """Spelling variants by joining words with one letter left out; crc32 by its byte table."""
    return rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT i::BIGINT AS i FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      range(1, length(name) + 1), lambda i: CASE WHEN ord(name[i]) < 128 THEN [ord(name[i])::BIGINT]
      ELSE [(192 + (ord(name[i]) >> 6))::BIGINT, (128 + (ord(name[i]) & 63))::BIGINT] END))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS name FROM runs) CROSS JOIN crc_table),
slipped AS (
  SELECT CASE WHEN h % {slip_every} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {min_length}
          GROUP BY word HAVING sum(n) >= {min_count}),
cut AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
         UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = rest
         UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = rest),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS b, max(w.n) AS best_n
         FROM near JOIN words w ON w.word = b GROUP BY a),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {ratio} * n THEN b END AS form,
                 CASE WHEN best_n >= {ratio} * n THEN best_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS here FROM forms
          UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = here WHERE forms.form IS NOT NULL)
SELECT forms.word, form, here AS root, n, n_near::BIGINT AS n_near, form_n
FROM forms JOIN chain USING (word) WHERE NOT EXISTS (SELECT 1 FROM forms g WHERE g.word = here AND g.form IS NOT NULL)"""
