"""SQL that gives the same results as the corpus queries on the same tables."""

from epitally.llm.licenses import templates

ORACLE: dict[str, str] = {}

ORACLE["op5_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS hash,
           ('0x' || substr(hash, 1, 6))::INT AS draw, ('0x' || substr(hash, 7, 6))::INT AS draw2
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight FROM sources
), levels AS (
    SELECT a.source,
           (sum(b.source_size) - coalesce(sum(3 * b.source_size) FILTER (3 * b.source_size / b.weight < 3 * a.source_size / a.weight), 0))::DOUBLE
           / sum(b.weight) FILTER (3 * b.source_size / b.weight >= 3 * a.source_size / a.weight) AS level,
           any_value(3 * a.source_size / a.weight) AS own
    FROM weighted a CROSS JOIN weighted b GROUP BY a.source
), top AS (
    SELECT coalesce((SELECT level FROM levels WHERE own >= level ORDER BY own LIMIT 1), (SELECT max(own) FROM levels)) AS level
), targets AS (
    SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * level) AS target,
           CASE WHEN source_size > 0 THEN floor(least((3 * source_size)::DOUBLE, weight * level) / source_size)::BIGINT ELSE 0 END AS whole
    FROM weighted, top
), first AS (
    SELECT s.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS need,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw RANGE UNBOUNDED PRECEDING) AS upto,
           sum(s.size) OVER (PARTITION BY s.source, s.draw) AS here
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
    SELECT * EXCLUDE (upto, here), need > 0 AND 2 * upto - here <= 2 * need AS chosen FROM first
), rests AS (
    SELECT *, need - sum(CASE WHEN chosen THEN size ELSE 0 END) OVER (PARTITION BY source) AS rest FROM taken
), able AS (
    SELECT *, chosen = (rest < 0) AND size <= abs(rest) AND size > 0 AS able FROM rests
), second AS (
    SELECT *, able AND 2 * sum(CASE WHEN able THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY draw2 RANGE UNBOUNDED PRECEDING)
                      - sum(CASE WHEN able THEN size ELSE 0 END) OVER (PARTITION BY source, draw2) <= 2 * abs(rest) AS changes
    FROM able
)
SELECT doc_id, size, source_size, target, (size * (whole + (chosen <> changes)::BIGINT))::BIGINT AS taken FROM second
"""

ORACLE["op2_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'))
              + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'))
              + length('<turn role=""></turn>') + 1 AS chars
    FROM turns
), running AS (
    SELECT *, sum(chars) OVER (in_order ROWS UNBOUNDED PRECEDING) AS upto,
           row_number() OVER (in_order) = count(*) OVER (PARTITION BY conv_id) AS last
    FROM sized WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR last THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""

ORACLE["op7_url_filter"] = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
        WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '(casino|poker|betting|viagra|porn|xxx)') THEN 'block'
            WHEN regexp_matches(path, '^/(login|login/.*|wp-admin/.*)$') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLE["op9_license_scan"] = r"""
WITH known(license, pairs) AS (VALUES {known}),
plain AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_replace(lower(text), '[^\p{L}\p{N}\n]+', ' ', 'g') AS plain
    FROM documents
), lines AS (
    SELECT doc, doc_id, 'line' AS unit, unnest(string_split(plain, chr(10))) AS body, generate_subscripts(string_split(plain, chr(10)), 1) - 1 AS passage FROM plain
), paragraphs AS (
    SELECT doc, doc_id, 'paragraph' AS unit, unnest(regexp_split_to_array(plain, '\n ?\n[ \n]*')) AS body,
           generate_subscripts(regexp_split_to_array(plain, '\n ?\n[ \n]*'), 1) - 1 AS passage
    FROM plain
), passages AS (
    SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(body, chr(10))
    UNION ALL SELECT doc, doc_id, 'text', plain, 0 FROM plain WHERE len(regexp_split_to_array(plain, '\n ?\n[ \n]*')) > 1
), worded AS (
    SELECT doc, doc_id, unit, passage, list_filter(regexp_split_to_array(body, '[ \n]'), lambda w: w <> '') AS words FROM passages
), paired AS (
    SELECT doc, doc_id, unit, passage, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS pairs
    FROM worded WHERE len(words) > 1
), scored AS (
    SELECT doc, doc_id, unit, passage, license, len(paired.pairs) AS n_bigrams, len(list_intersect(paired.pairs, known.pairs)) AS shared,
           2.0::DOUBLE * len(list_intersect(paired.pairs, known.pairs)) / (len(paired.pairs) + len(known.pairs)) AS dice
    FROM paired JOIN known ON list_has_any(paired.pairs, known.pairs)
)
SELECT doc_id, unit, passage::INT AS passage, license, n_bigrams::INT AS n_bigrams, shared::INT AS shared, dice FROM scored WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc, unit, passage ORDER BY dice DESC, license) = 1
""".replace("{known}", ", ".join(f"('{name}', {pairs})" for name, pairs in templates()))

ORACLE["op3_topk_search"] = r"""
WITH vectors AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.vector, c.vec_id, list_inner_product(q.vector::DOUBLE[], c.vector::DOUBLE[])::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id, vector ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

ORACLE["op10_minhash_neardup"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * common >= 85 * (s.n + t.n - common)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
    SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), components AS (
    SELECT doc_id, least(doc_id, min(other)) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM worded LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
"""


def _lloyd_rounds(rounds: int) -> str:
    """Tables c0, a0, c1, a1, ...: centroids (cluster, centre) and assignments (vec, vec_id, v, cluster, distance)."""
    parts = ["""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS cluster, v AS centre
    FROM vectors QUALIFY cluster < 8
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT vec, vec_id, v, cluster, list_sum(list_transform(list_zip(v, centre), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM vectors, c{i} QUALIFY row_number() OVER (PARTITION BY vec ORDER BY distance, cluster) = 1
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
    SELECT cluster, place, sum(x)::BIGINT AS total, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY ALL
), m{i} AS (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place) AS centre FROM s{i} GROUP BY cluster
), c{i + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.centre, c.centre) AS centre FROM c{i} c LEFT JOIN m{i} m USING (cluster)
)""")
    return ", ".join(parts)


ORACLE["op11_centroid_clusters"] = f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS vec, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), {_lloyd_rounds(10)}
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.centre, ',')) AS centroid_sha256
FROM a10 a JOIN c10 c USING (cluster)
"""

ORACLE["op13_substring_dedup"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), starts AS (
    SELECT doc, unnest(range(1, len(words) - 33)) AS pos, words FROM texts WHERE len(words) >= 35
), windows AS (
    SELECT doc, pos, count(*) OVER (PARTITION BY array_to_string(words[pos:pos + 34], ' ')) > 1 AS again FROM starts
), covered AS (
    SELECT DISTINCT doc, pos + unnest(range(0, 35)) AS pos FROM windows WHERE again
), gone AS (
    SELECT doc, list(pos) AS places, count(*)::BIGINT AS n FROM covered GROUP BY doc
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(words, lambda w, i: places IS NULL OR NOT list_contains(places, i)), ' '), '')) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc)
"""

ORACLE["op12_lexical_search"] = r"""
WITH worded AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), sized AS (
    SELECT doc, doc_id, terms, len(terms) AS n FROM worded WHERE len(terms) > 0
), items AS (
    SELECT row_number() OVER () AS item, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), asked AS (
    SELECT item, item_id, term, count(*) AS q FROM items GROUP BY ALL
), held AS (
    SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), totals AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM sized
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, totals GROUP BY term, documents
), scored AS (
    SELECT item, item_id, doc, doc_id,
           sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // totals.terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sized USING (doc), totals GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
