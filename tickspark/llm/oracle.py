"""SQL for DuckDB with the results of the registered queries of this subpackage, where SQL can express them."""

ORACLE: dict[str, str] = {}

_SIZES = """
rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
)"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

ORACLE["op2_warc"] = f"""
WITH {_SIZES},
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM rows)
SELECT page_id,
       payload_bytes,
       list_aggregate(
         list_transform(range(32), lambda i: substr({_LETTERS}, 1 + cast(
           list_sum(list_transform(range(5), lambda b:
             ((('0x' || substr(hex, cast((5 * i + b) // 4 + 1 AS INT), 1))::INT >> cast(3 - (5 * i + b) % 4 AS INT)) & 1)
             << cast(4 - b AS INT))) AS INT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN first_id END AS refers_to
FROM firsts
"""


def _clusters(count: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Rounds written out one after the other, over integers of any size."""
    near = """
near{r} AS MATERIALIZED (
  SELECT row_no, vec_id, v, list_min(list_transform(cs, lambda x: [
           list_sum(list_transform(range(1, {dims} + 1), lambda i: (v[i] - x.w[i]) * (v[i] - x.w[i])))::HUGEINT, x.c::HUGEINT])) AS best
  FROM kept, (SELECT list({{'c': c, 'w': w}} ORDER BY c) AS cs FROM centres{r}))"""
    moved = """
parts{r} AS (
  SELECT best[2]::INT AS c, i, sum(v[i]::HUGEINT)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM near{p}, range(1, {dims} + 1) AS t(i) GROUP BY ALL),
centres{r} AS MATERIALIZED (
  SELECT o.c, coalesce(m.w, o.w) AS w FROM centres{p} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM parts{r} GROUP BY c) m ON o.c = m.c)"""
    steps = [near.format(r=0, dims=dims)]
    for r in range(1, rounds + 1):
        steps += [moved.format(r=r, p=r - 1, dims=dims), near.format(r=r, dims=dims)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, embedding
  FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
centres0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY name, embedding) - 1 AS c, v AS w FROM (
    SELECT v, embedding, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS name FROM kept) ORDER BY c LIMIT {count}),
{','.join(steps)},
own AS (SELECT best[2] AS c, sum(best[1]) AS inertia FROM near{rounds} GROUP BY ALL)
SELECT vec_id, best[2]::INT AS cluster, best[1]::BIGINT AS distance, own.inertia::BIGINT AS cluster_inertia,
       (SELECT sum(inertia) FROM own)::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM near{rounds} JOIN own ON own.c = best[2] JOIN centres{rounds} z ON z.c = best[2]
"""


ORACLE["op13_clusters"] = _clusters()


# Texts as hex digits, so that bytes are pairs of characters: all windows of 200 bytes, those found twice or
# more, and the runs of bytes they cover.
ORACLE["op12_suffix_dedup"] = """
WITH rows AS (
  SELECT row_number() OVER () AS row_no, doc_id, lower(hex(encode(coalesce(text, '')))) AS bytes FROM documents),
windows AS (
  SELECT row_no, i, md5(substr(bytes, 2 * i + 1, 400)) AS name
  FROM (SELECT row_no, bytes, unnest(range(length(bytes) // 2 - 199)) AS i FROM rows WHERE length(bytes) >= 400)),
often AS MATERIALIZED (SELECT name FROM windows GROUP BY name HAVING count(*) > 1),
hits AS (SELECT row_no, i FROM windows SEMI JOIN often USING (name)),
edges AS (SELECT *, i > lag(i, 1, -1000) OVER (PARTITION BY row_no ORDER BY i) + 200 AS opens FROM hits),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY row_no ORDER BY i) AS span FROM edges),
spans AS (SELECT row_no, span, min(i) AS first, max(i) + 200 AS last FROM numbered GROUP BY ALL),
gaps AS (
  SELECT row_no, span, lag(last, 1, 0) OVER (PARTITION BY row_no ORDER BY span) AS first, first AS last FROM spans
  UNION ALL
  SELECT row_no, max(span) + 1, max(last), NULL FROM spans GROUP BY row_no),
kept AS (
  SELECT row_no, string_agg(substr(bytes, 2 * first + 1, 2 * (coalesce(last, length(bytes) // 2) - first)), '' ORDER BY span) AS bytes
  FROM gaps JOIN rows USING (row_no) GROUP BY row_no),
sums AS (SELECT row_no, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row_no)
SELECT doc_id, length(r.bytes) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.bytes, r.bytes))) AS kept_sha256
FROM rows r LEFT JOIN kept k USING (row_no) LEFT JOIN sums USING (row_no)
"""
