"""DuckDB twins of the operator queries that SQL can state."""

from __future__ import annotations

_PAGES = """(SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages)"""


def _lloyd(rounds: int = 3) -> str:
    """Lloyd rounds as one chain of tables: every vector against every centroid, component by component."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
near{t} AS (
  SELECT row, arg_min(c, d * 16 + c)::INTEGER AS c, min(d)::BIGINT AS d FROM (
    SELECT x.row, m.c, sum((x.v - m.v) * (x.v - m.v)) AS d
    FROM parts x JOIN means{t} m USING (dim) GROUP BY x.row, m.c) AS q GROUP BY row)""")
        if t < rounds:
            steps.append(f"""
means{t + 1} AS (
  SELECT m.c, m.dim, coalesce(s.v, m.v) AS v FROM means{t} m LEFT JOIN (
    SELECT n.c, x.dim, ((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
    FROM parts x JOIN near{t} n USING (row) GROUP BY n.c, x.dim) AS s USING (c, dim))""")
    return ",".join(steps)


_FILTER_WORDS = "regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')"

ORACLE = {
    "op1_warc": f"""
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM {_PAGES} AS p) AS q""",
    "op11_centroids": f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT row, generate_subscripts(v, 1) AS dim, unnest(v) AS v FROM kept),
chosen AS (
  SELECT row, (row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1)::INTEGER AS c FROM kept
  QUALIFY c < 16),
means0 AS (SELECT c, dim, v FROM parts JOIN chosen USING (row)),{_lloyd()},
digests AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM means3 GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN near3 USING (row) JOIN digests USING (c)""",
    "op12_filter_audit": f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
told AS (
  SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len({_FILTER_WORDS}) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct({_FILTER_WORDS})) < 65 * len({_FILTER_WORDS}) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 5 * length(body) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM docs LEFT JOIN told USING (doc_id)),
bits AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS line
  FROM bits a, bits b, bits c, bits d, bits e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
  AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, line[step] AS bit,
    coalesce(list_sum(line[1:step - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) AS r(step)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
told_steps AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told_steps""",
    "op13_mixing": """
WITH sized AS (
  SELECT row_number() OVER () AS row, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2 * source_size AS most,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER + 1] AS weight FROM sources),
levelled AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT * 3 / 2
      - coalesce(sum(most) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM weighed WINDOW line AS (ORDER BY most / weight, source NULLS LAST)),
goals AS (
  SELECT source, source_size, CASE WHEN most <= level * weight THEN most::DOUBLE
    ELSE max(CASE WHEN most > level * weight THEN level END) OVER () * weight END AS target FROM levelled),
queued AS (
  SELECT s.*, g.source_size, g.target, sum(size) OVER (
      PARTITION BY s.source ORDER BY place, doc_id NULLS FIRST, size, row ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
pieces AS (
  SELECT q.*, least(1024, size - 1024 * piece) AS words, epoch * source_size + start + 1024 * piece AS begin
  FROM (SELECT *, unnest(range(0, (size + 1023) // 1024)) AS piece FROM queued) AS q, range(0, 2) AS e(epoch)),
ranked AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY (begin + words) / target,
      CASE WHEN source IS NULL THEN '' ELSE '=' || source END, begin
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS served,
    (SELECT sum(size)::BIGINT * 3 // 2 FROM sized) AS budget FROM pieces),
taken AS (SELECT row, sum(greatest(0, least(words, budget - served)))::BIGINT AS taken FROM ranked GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM queued LEFT JOIN taken USING (row)""",
}
