"""Oracles of the operators that SQL can express."""

COLLOCATIONS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^ \t]+') AS w FROM (
    SELECT doc, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
words AS (SELECT piece, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM pieces),
rows AS (
  SELECT lang, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c, lead(a, 3) OVER p AS d FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)),
grams AS (
  SELECT lang, 1 AS size, a AS phrase FROM rows UNION ALL SELECT lang, 2, a || ' ' || b FROM rows WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM rows WHERE c IS NOT NULL
  UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM rows WHERE d IS NOT NULL),
counts AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, size, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f, k, array_to_string(c.w[1:k], ' ') AS head, array_to_string(c.w[k + 1:c.size], ' ') AS tail
  FROM candidates c, (VALUES (1), (2), (3)) AS v(k) WHERE k < c.size),
scored AS (
  SELECT c.lang, c.phrase, c.f, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1),
inside AS (
  SELECT c.lang, array_to_string(c.w[i:i + s.size - 1], ' ') AS phrase, max(c.f) AS longer
  FROM candidates c, (VALUES (2), (3)) AS s(size), (VALUES (1), (2), (3)) AS v(i)
  WHERE s.size < c.size AND i + s.size - 1 <= c.size GROUP BY 1, 2),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, f AS a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

RANKED = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
queries AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
stats AS (SELECT count(*)::BIGINT AS total, sum(len(w))::BIGINT AS length FROM docs WHERE len(w) > 0),
postings AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM queries) GROUP BY doc_id, n, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, stats GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // length))) AS impact
  FROM postings JOIN weights USING (term), stats),
scores AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM queries JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
