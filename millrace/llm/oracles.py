"""SQL that gives the same rows as the queries, by plain comparison of everything."""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("lower(text)")} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS.format("lower(text)")} AS w FROM benchmark),
     ds AS (SELECT doc_id, n, p, array_to_string(w[p + 1:p + 5], ' ') AS s
            FROM (SELECT doc_id, w, len(w) - 4 AS n, unnest(range(0, len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
     bs AS (SELECT item_id, len(w) AS size, array_to_string(w[p + 1:p + 5], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(0, len(w) - 4)) AS p FROM b WHERE len(w) >= 5)),
     bc AS (SELECT item_id, size, s, count(*) AS c FROM bs GROUP BY ALL),
     hit AS (SELECT doc_id, n, item_id, size, p, ds.s, c FROM ds JOIN bc ON ds.s = bc.s),
     st AS (SELECT DISTINCT doc_id, n, item_id, size, least(size - 4, n) AS held,
                   unnest(range(greatest(p - size + 5, 0), p + 1)) AS start FROM hit),
     k AS (SELECT st.doc_id, st.item_id, st.size, held, st.start, hit.s, least(count(*), any_value(c)) AS least
           FROM st JOIN hit ON st.doc_id = hit.doc_id AND st.item_id = hit.item_id
             AND hit.p BETWEEN st.start AND st.start + st.size - 5
           WHERE st.start + held <= st.n GROUP BY ALL),
     t AS (SELECT doc_id, item_id, held, held + size - 4 AS together, start, sum(least) AS shared FROM k GROUP BY ALL)
SELECT doc_id, item_id, start, CAST(held + 4 AS BIGINT) AS n_words, CAST(shared AS BIGINT) AS shared,
       CAST(shared AS DOUBLE) / (together - shared) AS similarity
FROM t WHERE 180 * shared >= 80 * together
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared DESC, start) = 1
"""

OP6 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
     g AS (SELECT doc_id, p, x[2 * p + 1:2 * p + 100] AS s
           FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS p FROM d WHERE length(x) >= 100)),
     f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
     hit AS (SELECT doc_id, p FROM g JOIN f ON g.s = f.s WHERE first < doc_id),
     run AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER w + 50 THEN 0 ELSE 1 END AS fresh
             FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
     num AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM run),
     span AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM num GROUP BY ALL),
     edge AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM span),
     cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
                    string_agg(x[2 * prev + 1:2 * a], '' ORDER BY a) AS head
             FROM edge JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN tail IS NULL THEN x ELSE head || x[2 * tail + 1:] END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP10 = rf"""
WITH RECURSIVE
     d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w
           FROM documents),
     s AS (SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS g
           FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
              FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
     link AS (SELECT a, b FROM pair JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
              WHERE 100 * k >= 85 * (na.n + nb.n - k)),
     edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
     reach AS (SELECT doc_id AS node, doc_id AS root FROM documents
               UNION SELECT edge.b, reach.root FROM reach JOIN edge ON edge.a = reach.node),
     c AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

# Unsigned CRC-32 of a short text, bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(c::VARCHAR, ''),
    lambda ch: list_transform(range(0, 8), lambda b: (ascii(ch)::BIGINT >> b) & 1))),
    lambda a, b: xor(a >> 1, (xor(a, b) & 1) * 3988292384)))"""
OP11 = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT c, c - c % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
     own AS (SELECT c, list(struct_pack(r := r, x := x) ORDER BY p) AS s FROM t GROUP BY c),
     whole AS (SELECT c.c, coalesce(b.s[1:h], []) || o.s[h + 1:] AS s
               FROM c JOIN own AS o ON o.c = c.c LEFT JOIN own AS b ON b.c = c.base),
     pre AS (SELECT c, len(s) AS size, d, s[1:d] AS k FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM whole)),
     node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n,
                     coalesce(string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends,
                     CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(k[d].x) END AS cost
              FROM pre GROUP BY d, k),
     kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
     full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children
                   FROM node LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k),
     up AS (SELECT a AS d, k[1:a] AS k, cost, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf
            FROM (SELECT k, cost, n_children, unnest(range(0, d + 1)) AS a FROM full_node)),
     sub AS (SELECT d, k, sum(leaf) AS n_leaves, sum(cost) AS saved FROM up GROUP BY d, k)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, par.conv_id AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256,
       CAST(CASE WHEN f.ends = '' THEN 0 ELSE len(string_split(f.ends, ',')) END AS BIGINT) AS n_ends
FROM full_node AS f JOIN sub ON sub.d = f.d AND sub.k = f.k
LEFT JOIN node AS par ON par.d = f.d - 1 AND par.k = f.k[1:f.d - 1]
"""


def _rounds(rounds: int) -> str:
    """SQL for k-means: the centroids ``c0`` are given; assigns all points and takes whole means, so often."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
     d{i} AS (SELECT e.row, k, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{i} AS c USING (i) GROUP BY ALL),
     a{i} AS (SELECT row, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)""")
        if i < rounds:
            steps.append(f"""
     m{i} AS (SELECT k, i, sum(e.x) AS s, count(*) AS n FROM e JOIN a{i} USING (row) GROUP BY k, i),
     c{i + 1} AS (SELECT k, i, CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
                  FROM c{i} LEFT JOIN m{i} USING (k, i))""")
    return ",".join(steps)


OP13 = f"""
WITH kept AS (SELECT row_number() OVER () AS row, vec_id, embedding AS v FROM embeddings
              WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     e AS (SELECT row, i, CAST(floor(1024 * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x
           FROM (SELECT row, v, unnest(range(1, 65)) AS i FROM kept)),
     first AS (SELECT row, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept
               ORDER BY sha256('3:' || vec_id) LIMIT 8),
     c0 AS (SELECT k, i, x FROM e JOIN first USING (row)),{_rounds(10)},
     h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a10 JOIN h USING (k) JOIN kept USING (row)
"""
