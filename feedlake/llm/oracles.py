"""DuckDB SQL for the queries of this subpackage that SQL can express."""

# md5 gives the same uniform value in both engines; the distribution function is summed
# over the same 0, 1, 2, ... from log probabilities.
OP7 = """
WITH counts AS (
  SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source, weight * ((SELECT sum(n) FROM counts) / (SELECT sum(weight) FROM counts)) / n AS rate FROM counts
), steps AS (
  SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates
), cdf AS (
  SELECT source, k, sum(exp(CASE WHEN k = 0 THEN 0 ELSE k * ln(rate) END - rate - lgamma(k + 1)))
                    OVER (PARTITION BY source ORDER BY k) AS c FROM steps
), drawn AS (
  SELECT *, CAST(concat('0x', substr(md5(concat('7:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 13)) AS BIGINT)
            / 4503599627370496.0 AS u FROM documents
), times AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u) AS times FROM drawn d
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy_no AS INTEGER) AS copy_no,
       md5(concat('7-order:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', CAST(copy_no AS VARCHAR))) AS shuffle_key
FROM (SELECT *, unnest(range(1, times + 1)) AS copy_no FROM times WHERE times > 0)
"""

# Exact sets and all pairs that share a shingle; components by repeated smallest neighbour.
OP8 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), component AS (
  SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN component USING (doc_id)
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""

OP10 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), last AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM last
"""

# Scores in 64-bit integers; only the weights pass through doubles.
OP11 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), corpus AS (
  SELECT count(*) FILTER (WHERE len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS total FROM words
), posts AS (
  SELECT doc_id, any_value(len(w)) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM words) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT n FROM corpus) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posts GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * corpus.n) // corpus.total)))) AS BIGINT) AS score
  FROM asked JOIN posts p USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""

OP12 = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS d FROM documents
), drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST(concat('0x', substr(d, 1, 8)) AS BIGINT) AS h1, CAST(concat('0x', substr(d, 9, 8)) AS BIGINT) AS h2,
         CAST(concat('0x', substr(d, 17, 8)) AS BIGINT) AS h3, CAST(concat('0x', substr(d, 25, 8)) AS BIGINT) AS h4 FROM units
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) WHEN 'spm' THEN concat('<S>', s, '<P>', p, '<M>', m) ELSE t END)
         AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

ORACLES = {"op11_ranked_search": OP11, "op12_fill_in_middle": OP12,
           "op6_exact_top_k": OP6, "op10_warc": OP10, "op8_near_dedup": OP8, "op7_mixing": OP7}
