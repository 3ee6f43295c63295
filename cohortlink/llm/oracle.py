"""DuckDB SQL of the queries of this package that plain SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op13_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k"""


def _rounds(rounds: int = 4, entries: int = 256) -> str:
    """One part per (vector, dimension); each round two tables: assignment ``a<i>`` and codebook ``c<i>``."""
    steps = [f"""
kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT max(len(v)) // 4 AS w FROM kept),
x AS MATERIALIZED (SELECT vec_id, p, list_slice(v, p * w + 1, p * w + w) AS s FROM kept, dims, range(4) t(p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, s AS c FROM x
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT vec_id, x.p, min((list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e)) AS b
  FROM x JOIN c{i} USING (p) GROUP BY vec_id, x.p)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT p, e, list(f ORDER BY pos) AS c FROM (
    SELECT x.p, b[2] AS e, pos, floor(sum(s[pos]) / count(*))::BIGINT AS f FROM a{i} JOIN x USING (vec_id, p), dims, range(1, w + 1) r(pos)
    GROUP BY x.p, b[2], pos) GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT c{i}.p, c{i}.e, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (p, e))""")
    last = rounds
    return "WITH " + ",".join(steps) + f""",
r AS (SELECT vec_id, string_agg(printf('%02x', b[2]), '' ORDER BY p) AS code, sum(b[1])::BIGINT AS error FROM a{last} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c{last}) AS codebooks_sha256
FROM r JOIN kept USING (vec_id)"""


ORACLE["op12_vector_codes"] = _rounds()

# CRC-32 by bytes (reflected polynomial 0xEDB88320); near words by equal masks ("one letter blanked") and deletions.
ORACLE["op11_spelling_variants"] = r"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, list_transform(range(0, strlen(doc_id || ':' || run)),
    lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 2))::BIGINT) AS bytes FROM runs WHERE length(run) >= 5),
keyed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM hashed, tab),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM keyed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
spots AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
masks AS (SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM spots),
dels AS (SELECT DISTINCT s.word AS more, w.word AS less FROM spots s JOIN words w ON w.word = substr(s.word, 1, i - 1) || substr(s.word, i + 1)),
pairs AS (SELECT a.word, b.word AS other FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT more, less FROM dels UNION ALL SELECT less, more FROM dels),
best AS (SELECT p.word, count(*) AS n_near, max(o.n) AS top, min((-o.n, other))[2] AS pick
  FROM pairs p JOIN words o ON o.word = p.other GROUP BY p.word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN pick END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT walk.word, walk.next, f.form FROM walk JOIN forms f ON f.word = walk.next)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN (SELECT word, root FROM walk WHERE next IS NULL) w USING (word)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(name: str, table: str, key: str) -> str:
    """CTEs <name>_w (row, key, words) and <name>_s (row, shingle), distinct per row: five words, or all of fewer."""
    return f"""{name}_w AS MATERIALIZED (SELECT row_number() OVER () AS row, {key}, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
{name}_s AS MATERIALIZED (SELECT DISTINCT row, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM {name}_w WHERE len(w) > 0))"""


# Links by counting common shingles, components by walking the links from every document that has one.
ORACLE["op4_ngram_jaccard_join"] = f"""WITH RECURSIVE {_shingles('d', 'documents', 'doc_id')},
n AS MATERIALIZED (SELECT row, count(*) AS n FROM d_s GROUP BY row),
common AS (SELECT a.row AS x, b.row AS y, count(*) AS c FROM d_s a JOIN d_s b ON a.s = b.s AND a.row < b.row GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM common JOIN n a ON a.row = x JOIN n b ON b.row = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
way AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT DISTINCT x AS row, x AS there FROM way UNION SELECT reach.row, way.y FROM reach JOIN way ON way.x = reach.there),
least AS (SELECT reach.row, min(doc_id) AS component_id FROM reach JOIN d_w ON d_w.row = reach.there GROUP BY reach.row)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d_w LEFT JOIN n USING (row) LEFT JOIN least USING (row)"""

ORACLE["op9_benchmark_decontamination"] = f"""WITH {_shingles('d', 'documents', 'doc_id')},
{_shingles('q', 'benchmark', 'item_id')},
n AS (SELECT row, count(*) AS n_item FROM q_s GROUP BY row),
hit AS (SELECT d.row AS dr, q.row AS qr, count(*) AS n_shared FROM d_s d JOIN q_s q USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM hit JOIN n ON n.row = qr JOIN d_w ON d_w.row = dr JOIN q_w ON q_w.row = qr WHERE 100 * n_shared >= 75 * n_item"""

# Hexadecimal bytes; starts of repeated 50-byte strings are merged into runs, and what lies between them is kept.
ORACLE["op6_suffix_array_dedup"] = """WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents),
spots AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 100)) AS k FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 49)) AS p FROM d)),
early AS (SELECT k, min(doc_id) AS f FROM spots GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, p FROM spots JOIN early USING (k) WHERE f < doc_id),
marked AS (SELECT doc_id, p, coalesce(p > lag(p) OVER w + 50, true)::INT AS new FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM marked) GROUP BY doc_id, r),
gaps AS (SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, a AS z FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(z), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(z, n_bytes) - a)), '' ORDER BY a) AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""
