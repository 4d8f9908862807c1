"""The similarity joins in DuckDB SQL: every pair of sets that shares a shingle is counted."""

from __future__ import annotations


def _runs(width: int) -> str:
    return " || ' ' || ".join(f"w[i + {k}]" for k in range(width))


def links_sql(width: int, num: int, den: int, columns: str) -> str:
    """``columns`` of each document from n (its row: doc_id, n), c (component) and g (links of its set)."""
    return rf"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingled AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE
           WHEN len(w) >= {width} THEN [{_runs(width)} FOR i IN range(1, len(w) - {width - 2})]
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM worded),
named AS (SELECT r, doc_id, CAST(len(s) AS BIGINT) AS n, s, md5(array_to_string(s, chr(10))) AS class FROM shingled),
classes AS (
  SELECT class, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS low, count(*) AS copies
  FROM named WHERE n > 0 GROUP BY class),
one AS (SELECT class, n, unnest(s) AS g FROM classes),
shared AS (
  SELECT a.class AS x, b.class AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS k
  FROM one a JOIN one b ON a.g = b.g AND a.class < b.class AND {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)
  GROUP BY a.class, b.class),
links AS (SELECT x, y FROM shared WHERE {den} * k >= {num} * (nx + ny - k)),
paired AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT class AS x, class AS y FROM classes
  UNION
  SELECT reach.x, paired.y FROM reach JOIN paired ON paired.x = reach.y),
c AS (SELECT reach.x AS class, min(low) AS component FROM reach JOIN classes ON classes.class = reach.y GROUP BY reach.x),
g AS (
  SELECT classes.class, CAST(any_value(classes.copies) - 1 + coalesce(sum(o.copies), 0) AS BIGINT) AS links
  FROM classes LEFT JOIN paired ON paired.x = classes.class LEFT JOIN classes o ON o.class = paired.y
  GROUP BY classes.class)
SELECT {columns}
FROM named n LEFT JOIN c ON n.n > 0 AND c.class = n.class LEFT JOIN g ON n.n > 0 AND g.class = n.class
"""
