"""DuckDB SQL for the corpus queries that SQL can express, written from their contracts."""

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Equal sets are compared once; two sets at 0.8 share one of their rarest fifths; components grow from links between different sets.
NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w FROM documents
), s AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s FROM w
), r AS (
  SELECT *, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS rep FROM s
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM r WHERE doc_id = rep
), f AS (
  SELECT g, count(*) AS df FROM e GROUP BY g HAVING count(*) > 1
), o AS (
  SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(df, 1), g) AS k FROM e LEFT JOIN f USING (g)
), p AS (
  SELECT doc_id, n, g FROM o WHERE k <= n - (8 * n + 9) // 10 + 1
), l AS (
  SELECT x, y FROM (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)) t
  JOIN r a ON a.doc_id = x JOIN r b ON b.doc_id = y
  WHERE 100 * len(list_intersect(a.s, b.s)) >= 80 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s)))
), c AS (
  SELECT rep AS x, rep AS y FROM r
  UNION
  SELECT c.x, t.y FROM c JOIN (SELECT x, y FROM l UNION ALL SELECT y, x FROM l) t ON t.x = c.y
), m AS (
  SELECT x AS rep, min(y) AS component_id FROM c GROUP BY x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM r JOIN m USING (rep)
"""

#: Texts as hexadecimal digits in overlapping blocks, so that a window is cut from a short string; a window is known by its MD5.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), b AS (
  SELECT doc_id, n, pos, substring(h, 2 * pos + 1, 2 * (1000 + 99)) AS part FROM (SELECT *, unnest(range(0, n, 1000)) AS pos FROM d)
), w AS (
  SELECT doc_id, pos + i AS start, md5_number(substring(part, 2 * i + 1, 200)) AS k FROM (SELECT *, unnest(range(0, least(1000, n - 99 - pos))) AS i FROM b)
), again AS (
  SELECT doc_id, start FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, start) > 1
), runs AS (
  SELECT doc_id, lo, max(start) + 100 AS hi FROM (
    SELECT *, max(lo_here) OVER (PARTITION BY doc_id ORDER BY start) AS lo FROM (
      SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) <= 100 THEN NULL ELSE start END AS lo_here FROM again))
  GROUP BY ALL
), k AS (
  SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS kept_from FROM (SELECT * FROM runs UNION ALL SELECT doc_id, n, n FROM d)
)
SELECT d.doc_id, any_value(n) AS n_bytes, CAST(sum(hi - lo) AS BIGINT) AS n_removed, CAST(count(*) - 1 AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(string_agg(substring(h, 2 * kept_from + 1, 2 * (lo - kept_from)), '' ORDER BY kept_from, lo), ''))) AS kept_sha256
FROM d JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id
"""

ORACLES = {"op1_fast_sketch_near_dedup": NEAR_DEDUP, "op10_suffix_merge_dedup": SUFFIX_DEDUP}
