"""CRC-32 in SQL: common table expressions from ``features`` (f) to ``crc`` (f, c), for the reference SQL of queries.

A byte's share of the CRC depends on its value and distance from the end only, so the CRC of
a string is a ``bit_xor`` over its bytes and a constant of its length.
"""

CRC_CTES = """
step(i, b, c) AS (
  SELECT 0, b::BIGINT, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT i + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE i < 8
),
single AS MATERIALIZED (SELECT b, c FROM step WHERE i = 8),
bytes AS (
  SELECT f, strlen(f) AS n, unnest(range(strlen(f))) AS p FROM (SELECT DISTINCT f FROM features)
),
spread AS MATERIALIZED (
  SELECT f, n, n - 1 - p AS d, ('0x' || hex(encode(f))[2 * p + 1 : 2 * p + 2])::BIGINT AS b FROM bytes
),
top AS (SELECT max(n) AS n FROM spread),
position(d, b, c) AS (
  SELECT 0::BIGINT, b, c FROM single
  UNION ALL
  SELECT d + 1, p.b, xor(p.c >> 8, s.c) FROM position p JOIN single s ON s.b = p.c & 255 WHERE d < (SELECT n FROM top)
),
constant(n, c) AS (
  SELECT 0::BIGINT, 4294967295::BIGINT
  UNION ALL
  SELECT k.n + 1, xor(k.c >> 8, s.c) FROM constant k JOIN single s ON s.b = k.c & 255 WHERE k.n < (SELECT n FROM top)
),
crc AS MATERIALIZED (
  SELECT x.f, xor(xor(x.c, k.c), 4294967295) AS c
  FROM (SELECT f, n, bit_xor(p.c) AS c FROM spread JOIN position p USING (d, b) GROUP BY f, n) x JOIN constant k ON k.n = x.n
)"""
