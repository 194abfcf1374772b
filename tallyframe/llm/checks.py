"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':4'), 1, 8)) AS BIGINT) AS draw
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW below AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole,
         CAST(round(p.target) AS BIGINT) - p.whole * p.source_size
         - (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size) AS room
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(size, greatest(room, 0)) AS BIGINT) AS taken FROM placed
"""

EXACT = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
ranked AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM plain)
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM ranked
"""

TRIE = r"""
WITH turns AS (
  SELECT conv_id AS c, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest, turn,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos FROM turns),
sizes AS (
  SELECT c, count(*) AS n, c - c % 20 AS base,
         list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda k: CAST(ascii(substr(CAST(c AS VARCHAR), k, 1)) AS BIGINT)) AS bytes
  FROM turns GROUP BY c),
hashed AS (
  SELECT c, n, base, (4294967295 - list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bytes), lambda r, b:
    list_reduce(list_concat([xor(r, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT))))) % 4 AS h
  FROM sizes),
convs AS (SELECT s.c, s.n, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS taken FROM hashed s LEFT JOIN hashed b ON b.c = s.base),
rebuilt AS (
  SELECT v.c, p.pos AS depth, p.digest, p.words FROM convs v JOIN placed p ON p.c = v.base AND p.pos <= v.taken
  UNION ALL
  SELECT v.c, p.pos - v.h + v.taken, p.digest, p.words FROM convs v JOIN placed p ON p.c = v.c AND p.pos > v.h),
keyed AS (
  SELECT c, depth, words, sha256(array_to_string(list(digest) OVER (PARTITION BY c ORDER BY depth), ',')) AS own FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
linked AS (
  SELECT *, lag(own) OVER path AS parent, depth = max(depth) OVER (PARTITION BY c) AS ends
  FROM keyed WINDOW path AS (PARTITION BY c ORDER BY depth)),
nodes AS (
  SELECT depth, own, min(c) AS conv_id, count(*) AS n_convs, min(parent) AS parent, (count(*) - 1) * min(words) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM linked GROUP BY depth, own),
counted AS (
  SELECT n.*, coalesce(k.kids, 0) AS n_children
  FROM nodes n LEFT JOIN (SELECT depth - 1 AS depth, parent AS own, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY ALL) k USING (depth, own)),
totals AS (
  SELECT p.depth, p.own, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves
  FROM counted n JOIN keyed p ON p.c = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.own)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(n.n_children AS BIGINT) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t USING (depth, own) LEFT JOIN nodes a ON a.depth = n.depth - 1 AND a.own = n.parent
"""


def centroids_sql(clusters: int = 40, rounds: int = 5, seed: int = 2, size: int = 64, scale: int = 256) -> str:
    """The rounds of the clustering one after the other, every distance computed."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS drawn,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY drawn, v) - 1 AS j, v FROM kept ORDER BY drawn, v LIMIT {clusters})"""]
    for at in range(rounds + 1):
        parts.append(f"""
near{at} AS MATERIALIZED (
  SELECT k.rid, min(struct_pack(d := CAST(list_sum(list_transform(range(1, {size} + 1), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS BIGINT), j := c.j)) AS best
  FROM kept k, c{at} c GROUP BY k.rid)""")
        if at < rounds:
            parts.append(f"""
sums{at} AS (
  SELECT n.best.j AS j, i, CAST(sum(k.v[i]) AS BIGINT) AS s, count(*) AS n
  FROM near{at} n JOIN kept k USING (rid), range(1, {size} + 1) places(i) GROUP BY ALL),
c{at + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.v, c.v) AS v
  FROM c{at} c LEFT JOIN (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums{at} GROUP BY j) m USING (j))""")
    return "WITH" + ",".join(parts) + f"""
SELECT k.vec_id, CAST(n.best.j AS INTEGER) AS cluster, n.best.d AS distance,
       CAST(sum(n.best.d) OVER (PARTITION BY n.best.j) AS BIGINT) AS cluster_inertia, CAST(sum(n.best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept k JOIN near{rounds} n USING (rid) JOIN c{rounds} c ON c.j = n.best.j
"""


ORACLES: dict[str, str] = {"op4_mixing": MIXING, "op10_exact_dedup": EXACT, "op11_centroids": centroids_sql(), "op13_prefix_trie": TRIE}
