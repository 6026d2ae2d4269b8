"""DuckDB SQL of the queries that SQL can express.

Fingerprints (a hash function of Spark's), draws, learned models and
tokenizers are beyond it; their queries are tested against plain Python.
"""

from __future__ import annotations

SPACES = r"[\x20\x09-\x0D]"

_WORDS = rf"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}+'), lambda x: x <> '') AS ws
      FROM documents)"""

OP4 = rf"""
WITH {_WORDS},
win AS (SELECT doc_id, i AS first, array_to_string(ws[i:i + 49], ' ') AS run
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
least AS (SELECT run, min(doc_id) AS least FROM win GROUP BY run),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, first + 50)) AS pos
         FROM win JOIN least USING (run) WHERE least < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept
         FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP5 = rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '{SPACES}', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

OP9 = rf"""
WITH RECURSIVE {_WORDS},
gram AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g
         FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM gram a JOIN gram b USING (g)
         WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b, shared = x.n AND shared = y.n AS equal FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE CAST(shared AS DOUBLE) / (x.n + y.n - shared) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
own AS (SELECT a AS doc_id, count(*) AS n_links, count(*) FILTER (equal) AS n_equal FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_equal, 0) + 1 AS n_equal
FROM class LEFT JOIN own USING (doc_id)
"""

# Kind, pattern, tested group, least length; the order of kinds is that of ties.
_ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
_RULES = [
    ("assign", _ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
    ("forge", "(ghp|gho|ghs|ghu)_[A-Za-z0-9]+", 0, 40),
    ("chat", "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
]


def _spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    """The rule's spans, a row each: a match starts after all pieces up to it
    and all matches before it."""
    return f"""
    SELECT doc_id, {place} AS place, '{kind}' AS kind, start, start + size AS "end" FROM (
      SELECT doc_id, size, tested, sum(before + size) OVER (PARTITION BY doc_id ORDER BY nth) - size AS start FROM (
        SELECT doc_id, generate_subscripts(found, 1) AS nth, length(unnest(found)) AS size,
               length(unnest(part)) AS tested, length(unnest(pieces[1:len(found)])) AS before
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found,
                     regexp_extract_all(text, '{pattern}', {group}) AS part,
                     regexp_split_to_array(text, '{pattern}') AS pieces
              FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))))
    WHERE tested >= {least}"""


OP10 = f"""
WITH span AS ({" UNION ALL ".join(_spans(i, *rule) for i, rule in enumerate(_RULES))}),
printed AS (SELECT *, kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST("end" AS BIGINT) AS VARCHAR) AS p
            FROM span),
own AS (SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
               count(*) FILTER (place = 2) AS n_hex,
               string_agg(p, ',' ORDER BY start, place) FILTER (place < 3) AS base,
               string_agg(p, ',' ORDER BY start, place) AS spans
        FROM printed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN own USING (doc_id)
"""

def _vectors(scale: int) -> str:
    """Rows that take part, with integer vectors."""
    return f"""
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
      FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


_PRODUCT = "CAST(list_inner_product(CAST(a.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[])) AS BIGINT)"

OP11 = f"""
WITH {_vectors(256)},
m AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, vector FROM v WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, {_PRODUCT} AS score
      FROM m a JOIN m b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER own AS INTEGER) AS rank, other_id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW own AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER own <= 10
"""


def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds, a pair of tables each: assignments ``a`` and codebooks ``b``."""
    width = f"(len(vector) // {parts})"
    steps = [f"""
comp AS MATERIALIZED (
  SELECT vec_id, p, j, vector[p * {width} + j + 1] AS x
  FROM v, range({parts}) AS ps(p), range(1000) AS js(j) WHERE j < {width}),
b0 AS MATERIALIZED (
  SELECT p, nth - 1 AS e, j, x AS c FROM comp JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS nth FROM v) USING (vec_id) WHERE nth <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d FROM (
    SELECT vec_id, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM comp JOIN b{r} USING (p, j) GROUP BY vec_id, p, e)
  GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
b{r + 1} AS MATERIALIZED (
  SELECT p, e, j, CAST(coalesce(floor(CAST(total AS DOUBLE) / n), c) AS BIGINT) AS c FROM b{r} LEFT JOIN (
    SELECT p, e, j, sum(x) AS total, count(*) AS n FROM comp JOIN a{r} USING (vec_id, p) GROUP BY p, e, j) USING (p, e, j))""")
    return f"""
WITH {_vectors(4096)},{",".join(steps)},
coded AS (SELECT vec_id, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), book
"""


OP13 = f"""
WITH {_vectors(64)},
s AS (SELECT a.vec_id AS query_id, b.vec_id, {_PRODUCT} AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER own AS INTEGER) AS rank, vec_id, score FROM s
WINDOW own AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER own <= 20
"""

ORACLE = {
    "op4_substring_dedup": OP4,
    "op5_exact_dedup": OP5,
    "op9_jaccard_join": OP9,
    "op10_secret_scan": OP10,
    "op11_hard_negatives": OP11,
    "op12_vector_codes": _op12(),
    "op13_exact_search": OP13,
}
