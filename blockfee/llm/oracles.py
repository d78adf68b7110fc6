"""Reference SQL of the dealt operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op7_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, line, place, last IS NOT NULL AND last <> doc_id AS gone FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op9_mixture"] = r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source IS NULL, source) AS rank
    FROM sizes GROUP BY source)
), filled AS (
  SELECT *, most::DOUBLE / weight AS fills_at,
         coalesce(sum(most) OVER before, 0) AS most_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left,
         sum(source_size) OVER () AS budget
  FROM sources
  WINDOW before AS (ORDER BY most::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT fills_at AS from_at, rank AS from_rank, (budget - most_before)::DOUBLE AS left_over, weight_left AS left_weight
  FROM filled WHERE fills_at * weight_left > (budget - most_before)::DOUBLE
  ORDER BY fills_at, rank LIMIT 1
), targets AS (
  SELECT source, rank, source_size,
         CASE WHEN (fills_at, rank) >= (from_at, from_rank) THEN weight * left_over / left_weight
              ELSE most::DOUBLE END AS target
  FROM filled LEFT JOIN level ON true
), queued AS (
  SELECT doc_id, size, rank, source_size, target,
         sum(size) OVER (PARTITION BY rank ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
), copies AS (
  SELECT *, CASE WHEN target > 0 THEN (copy * source_size + upto)::DOUBLE / target END AS finish
  FROM queued CROSS JOIN range(3) AS r(copy)
), spent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, copy, upto ROWS UNBOUNDED PRECEDING)
            <= (SELECT sum(size) FROM sizes) AS paid
  FROM copies WHERE finish IS NOT NULL
), used AS (
  SELECT doc_id, rank, upto, sum(size) AS words FROM spent WHERE paid GROUP BY ALL
)
SELECT doc_id, size, source_size, target, coalesce(words, 0)::BIGINT AS taken
FROM queued LEFT JOIN used USING (doc_id, rank, upto)
"""

ORACLES["op4_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id,
         unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reached AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT b, root FROM reached JOIN links ON node = a
)
SELECT node AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM reached LEFT JOIN sizes ON doc_id = node GROUP BY node
"""

ORACLES["op10_exact_top_k"] = r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 5
"""

ORACLES["op11_near_vectors"] = r"""
WITH RECURSIVE whole AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM whole a JOIN whole b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), reached AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT b, root FROM reached JOIN links ON node = a
), components AS (
  SELECT node, min(root) AS component_id FROM reached GROUP BY node
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM components JOIN embeddings ON node = vec_id LEFT JOIN counts USING (vec_id)
"""

ORACLES["op12_fill_middle"] = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), hashed AS (
  SELECT *, len(units)::BIGINT AS n,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM split
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), cut AS (
  SELECT *, coalesce(array_to_string(units[:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
  FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM cut
"""
