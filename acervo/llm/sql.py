"""SQL texts of the registered queries, for DuckDB."""

MIX = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
),
kinds AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
    FROM sized GROUP BY source
),
-- round by round: the words and weights that are still shared out after the stops of the round before
levels(n, remaining, open_weight) AS (
    SELECT 0, CAST(sum(source_size) AS DOUBLE), CAST(sum(weight) AS DOUBLE) FROM kinds
    UNION ALL
    SELECT l.n + 1,
           (SELECT CAST(sum(source_size) AS DOUBLE) - CAST(coalesce(sum(CASE WHEN weight * l.remaining > 3 * source_size * l.open_weight THEN 3 * source_size END), 0) AS DOUBLE) FROM kinds),
           (SELECT CAST(coalesce(sum(CASE WHEN weight * l.remaining > 3 * source_size * l.open_weight THEN 0 ELSE weight END), 0) AS DOUBLE) FROM kinds)
    FROM levels l WHERE l.n < 60 AND l.open_weight > 0
),
level AS (SELECT remaining, open_weight FROM levels WHERE open_weight > 0 ORDER BY n DESC LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN weight * remaining > 3 * source_size * open_weight THEN CAST(3 * source_size AS DOUBLE)
           ELSE CAST(weight AS DOUBLE) * remaining / open_weight END AS target
    FROM kinds, level
),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
           CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((budget // greatest(source_size, 1)) * size
            + least(size, greatest(0, budget - (budget // greatest(source_size, 1)) * source_size - before)) AS BIGINT) AS taken
FROM placed
"""

LINES = r"""
WITH split AS (
    SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
),
spots AS (
    SELECT doc_id, text, i AS start, array_to_string(lines[i:i + 2], chr(10)) AS body
    FROM (SELECT doc_id, text, lines, unnest(range(1, len(lines) - 1)) AS i FROM split)
),
later AS (
    SELECT doc_id, text, start FROM (
        SELECT doc_id, text, start, row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, start) AS place
        FROM spots WHERE regexp_matches(body, '[^\x20\x09-\x0D]')
    ) WHERE place > 1
),
gone AS (
    SELECT DISTINCT doc_id, text, start + k AS line FROM later, (SELECT unnest([0, 1, 2]) AS k)
),
kept AS (
    SELECT s.doc_id, s.text, count(*) FILTER (WHERE g.line IS NOT NULL) AS n_removed,
           coalesce(string_agg(s.lines[s.line], chr(10) ORDER BY s.line) FILTER (WHERE g.line IS NULL), '') AS body
    FROM (SELECT doc_id, text, lines, unnest(range(1, len(lines) + 1)) AS line FROM split) s
    LEFT JOIN gone g ON g.doc_id IS NOT DISTINCT FROM s.doc_id AND g.text = s.text AND g.line = s.line
    GROUP BY s.doc_id, s.text
)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, md5(k.body) AS text_md5
FROM documents d LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id AND k.text = d.text
"""

URLS = r"""
WITH RECURSIVE parts AS (
    SELECT page_id, translate(CASE WHEN pos > 0 THEN regexp_extract(rest, '^([^/?#]*)', 1) ELSE '' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           CASE WHEN pos > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM (SELECT page_id, coalesce(strpos(url, '://'), 0) AS pos, substr(url, strpos(url, '://') + 3) AS rest FROM pages)
),
ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
        list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
            lambda s: CASE WHEN regexp_matches(s, '^[0-9]+$') OR (regexp_matches(s, '[0-9]') AND length(s) >= 8) THEN '*' ELSE s END) AS segments
    FROM parts
),
judged AS (
    SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict,
           array_to_string(segments, '/') AS route FROM ruled
),
routes AS (
    SELECT host, route, any_value(segments) AS segments, count(*) AS n, count(verdict) AS lab, count(*) FILTER (WHERE verdict = 'block') AS bad
    FROM judged GROUP BY host, route
),
walk(host, route, segments, n, lab, bad, depth, template, purity) AS (
    SELECT r.host, r.route, r.segments, r.n, r.lab, r.bad, 0, r.host, (h.bad + 2 * w.p) / (h.lab + 2)
    FROM routes r JOIN (SELECT host, sum(lab)::DOUBLE AS lab, sum(bad)::DOUBLE AS bad FROM routes GROUP BY host) h USING (host),
         (SELECT (sum(bad) + 1)::DOUBLE / (sum(lab) + 2)::DOUBLE AS p FROM routes) w
    UNION ALL
    SELECT host, route, segments, n, lab, bad, depth + 1, template || '/' || name,
           (sum(bad) OVER (PARTITION BY host, template, name) + 2 * purity)::DOUBLE / (sum(lab) OVER (PARTITION BY host, template, name) + 2)::DOUBLE
    FROM (
        SELECT *, CASE WHEN (children > 8 AND child_n < 0.02::DOUBLE * all_n) OR child_lab = 0
                  OR abs(child_bad - child_lab * (all_bad / all_lab::DOUBLE)) <= 1.96::DOUBLE * sqrt(child_lab * (all_bad / all_lab::DOUBLE) * (1 - all_bad / all_lab::DOUBLE))
                  THEN '*' ELSE child END AS name
        FROM (
            SELECT *, count(DISTINCT child) OVER node AS children, sum(n) OVER node AS all_n, sum(lab) OVER node AS all_lab, sum(bad) OVER node AS all_bad,
                   sum(n) OVER branch AS child_n, sum(lab) OVER branch AS child_lab, sum(bad) OVER branch AS child_bad
            FROM (SELECT *, segments[depth + 1] AS child FROM walk WHERE len(segments) > depth)
            WINDOW node AS (PARTITION BY host, template), branch AS (PARTITION BY host, template, child)
        )
    )
),
ends AS (SELECT host, route, template, purity FROM walk WHERE depth = len(segments))
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.verdict, CASE WHEN e.purity >= 0.6 THEN 'block' ELSE 'allow' END) AS verdict, e.template
FROM judged j JOIN ends e ON e.host = j.host AND e.route = j.route
"""

TOP = r"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM whole),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10
"""

SEARCH = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
),
asked AS (
    SELECT item_id, any_value(i) AS i, term, count(*) AS times FROM (
        SELECT item_id, i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT item_id, text, row_number() OVER () AS i FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
    ) GROUP BY item_id, i, term
),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM words WHERE len(terms) > 0),
postings AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY d, term
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM postings, whole GROUP BY term, n_docs
),
scored AS (
    SELECT a.i, a.item_id, p.d, CAST(sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * len(t.terms) * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked a JOIN weights w USING (term) JOIN postings p USING (term) JOIN words t USING (d), whole GROUP BY a.i, a.item_id, p.d
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT s.item_id, t.doc_id, s.score, row_number() OVER (PARTITION BY s.i ORDER BY s.score DESC, t.doc_id NULLS LAST) AS rank
    FROM scored s JOIN words t USING (d) WHERE s.score > 0
) WHERE rank <= 20
"""
