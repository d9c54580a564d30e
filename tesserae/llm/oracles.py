"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

from .exact_dedup import OP11_SQL
from .impact_search import OP12_SQL
from .license_scan import OP5_SQL
from .maxscore import OP4_SQL

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, md5(array_to_string(ws, ' ')) FROM w WHERE len(ws) BETWEEN 1 AND 4),
n AS MATERIALIZED (SELECT doc_id, count(*) AS k FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met.k >= 75 * (x.k + y.k - met.k)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
part AS (SELECT doc_id AS node, doc_id AS label FROM w UNION SELECT e.b, p.label FROM part p JOIN edge e ON e.a = p.node)
SELECT w.doc_id, coalesce(k, 0) AS n_shingles, p.label AS component_id, w.doc_id = p.label AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(label) AS label FROM part GROUP BY node) p ON p.node = w.doc_id
"""

OP3_SQL = f"""
WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text="text")} AS ws FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS m FROM win GROUP BY s) USING (s) WHERE m < doc_id),
run AS (SELECT doc_id, i, coalesce(lag(i) OVER o + 50, 1) AS free, least(50, lead(i) OVER o - i) AS gone FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
cut AS (SELECT r.doc_id, max(i) + 50 AS tail, sum(coalesce(gone, 50)) AS gone, flatten(list(ws[free : i - 1] ORDER BY i) FILTER (WHERE i > free)) AS kept FROM run r JOIN w USING (doc_id) GROUP BY r.doc_id)
SELECT w.doc_id, len(ws) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_concat(coalesce(kept, []), ws[tail : len(ws)]) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""

OP10_SQL = """
WITH w AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 100)) AS s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM w WHERE len(x) >= 100)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS m FROM win GROUP BY s) USING (s) WHERE m < doc_id),
run AS (SELECT doc_id, i, coalesce(lag(i) OVER o + 50, 0) AS free, lag(i) OVER o IS NULL OR i > lag(i) OVER o + 50 AS new, least(50, lead(i) OVER o - i) AS gone FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
cut AS (SELECT r.doc_id, max(i) + 50 AS tail, sum(coalesce(gone, 50)) AS gone, count(*) FILTER (WHERE new) AS spans, string_agg(substr(x, 2 * free + 1, 2 * (i - free)), '' ORDER BY i) FILTER (WHERE i > free) AS kept FROM run r JOIN w USING (doc_id) GROUP BY r.doc_id)
SELECT w.doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN gone IS NULL THEN x ELSE coalesce(kept, '') || substr(x, 2 * tail + 1) END)) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""

ALL = {"op1_minhash_dedup": OP1_SQL, "op3_substring_dedup": OP3_SQL, "op4_maxscore": OP4_SQL, "op5_license_scan": OP5_SQL, "op10_suffix_dedup": OP10_SQL, "op11_exact_dedup": OP11_SQL, "op12_impact_search": OP12_SQL}
