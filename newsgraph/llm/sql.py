"""Checking SQL (DuckDB) of the training-data queries, written from what they should return, not from how they do it."""

from __future__ import annotations

WARC = """
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM (SELECT *, CASE WHEN strlen(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS original
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))
"""


def poisson_mix(seed: int) -> str:
    """Equal shares of all sources; valid while no source's rate is above 32, where draws are not split."""
    return f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (SELECT source, (SELECT sum(n) FROM n) / ((SELECT count(*) FROM n) * n)::DOUBLE AS rate FROM n),
term AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rate, range(0, 121) t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM term),
drawn AS (SELECT *, ('0x' || substr(md5('{seed}:' || doc_id || ':0'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(c.k) AS copies
            FROM drawn d LEFT JOIN cdf c ON c.source IS NOT DISTINCT FROM d.source AND c.c <= d.u
            GROUP BY d.doc_id, d.text, d.lang, d.source, d.n_chars)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted
"""


SUBSTRING = """
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM words, unnest(range(1, len(w) - 11)) t(i)),
low AS (SELECT win, min(doc_id) AS low FROM wins GROUP BY win),
bad AS (SELECT doc_id, list(i) AS places FROM wins JOIN low USING (win) WHERE low < doc_id GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten([range(a, a + 13) for a in places])) AS gone FROM bad),
cut AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed,
       sha256(CASE WHEN len(gone) = 0 THEN array_to_string(w, ' ')
              ELSE array_to_string([w[j] for j in range(1, len(w) + 1) if NOT list_contains(gone, j)], ' ') END) AS kept_sha256
FROM cut
"""

COVER_TREE = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
         WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reached r JOIN link l ON r.b = l.a),
found AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(f.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(f.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN found f ON f.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

# The table of the checksum comes from its rule: eight shifts of each byte under the reversed polynomial.
SPELLING_VARIANTS = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
           SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[a-zÀ-ÿ]+')) AS run FROM documents)
         GROUP BY doc_id, run),
bytes AS (SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                                 lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS b FROM runs),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS h
           FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) u(i)),
pairs AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN words w ON h.rest = w.word),
near AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
         UNION ALL SELECT x.word, y.word FROM holes x JOIN holes y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
ranked AS (SELECT a, b, w.n AS other, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r
           FROM near JOIN words w ON w.word = near.b),
found AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other >= 2 * w.n THEN r.b END AS form,
                 CASE WHEN r.other >= 2 * w.n THEN r.other END AS form_n
          FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.r = 1),
walk AS (SELECT word, word AS at FROM found UNION ALL SELECT walk.word, f.form FROM walk JOIN found f ON f.word = walk.at WHERE f.form IS NOT NULL),
roots AS (SELECT walk.word, walk.at AS root FROM walk JOIN found f ON f.word = walk.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM found JOIN roots USING (word)
"""
