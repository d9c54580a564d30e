"""DuckDB text of the registered queries, written apart from the DataFrame code."""

from __future__ import annotations

_BASE = """
ev AS (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 5.0) AS INTEGER) AS file_i, date_trunc('hour', ts) AS h FROM events),
hours AS MATERIALIZED (SELECT DISTINCT file_i, h FROM ev),
f0 AS (SELECT file_i, CAST(count(*) AS INTEGER) AS nt FROM hours GROUP BY file_i),
files AS MATERIALIZED (SELECT file_i, nt, CAST(coalesce(sum(nt) OVER (ORDER BY file_i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS file_start,
  substr(sha256('{"mtime":' || (1700000000 + file_i) || ',"path":"block_' || file_i || '.nd2","size":' || (nt * 1000) || '}'), 1, 16) AS file_key FROM f0),
nf AS (SELECT CAST(count(*) AS INTEGER) AS n, CAST(sum(nt) AS INTEGER) AS nt FROM files),
times AS MATERIALIZED (SELECT CAST(file_start + r.i AS INTEGER) AS t, file_i, CAST(r.i AS INTEGER) AS local_t FROM files, LATERAL (SELECT unnest(range(nt)) AS i) r),
hour_t AS MATERIALIZED (SELECT h, CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS t FROM hours),
pos AS MATERIALIZED (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS name, CAST(s_suppkey AS INTEGER) AS key, CAST(s_suppkey % 3 AS INTEGER) AS start_file, CAST(s_suppkey % 5 AS INTEGER) AS start_t,
  CASE WHEN s_suppkey % 4 = 0 THEN (SELECT n FROM nf) - 1 END AS end_file,
  55.0 * (s_suppkey % 10) + (((CAST(round(s_acctbal * 100) AS BIGINT) % 7) + 7) % 7 - 3) AS x, 55.0 * (s_suppkey // 10) AS y FROM supplier),
tiles AS MATERIALIZED (SELECT name, CAST(s.file_start + start_t AS INTEGER) AS first_t, CASE WHEN end_file IS NULL THEN (SELECT nt FROM nf) ELSE e.file_start + e.nt END AS last_t
  FROM pos JOIN files s ON s.file_i = start_file LEFT JOIN files e ON e.file_i = end_file - 1),
refs AS MATERIALIZED (SELECT name, file_i FROM pos, files WHERE (key + file_i) % 7 = 0),
ovr AS MATERIALIZED (SELECT DISTINCT t, CASE event_type WHEN 'error' THEN 'drop' WHEN 'click' THEN 'unanchor' WHEN 'signup' THEN 'anchor' WHEN 'purchase' THEN 'realign' END AS verb,
  lpad(CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR), 6, '0') AS name FROM ev JOIN hour_t USING (h) WHERE event_type IN ('error', 'click', 'signup', 'purchase')),
alive AS MATERIALIZED (SELECT t.t, name, file_i, local_t FROM tiles JOIN times t ON t.t >= first_t AND t.t < last_t
  WHERE NOT EXISTS (SELECT 1 FROM ovr o WHERE o.verb = 'drop' AND o.t = t.t AND o.name = tiles.name)),
state AS MATERIALIZED (SELECT a.t, a.name, a.file_i, a.local_t, (n.name IS NOT NULL OR (r.name IS NOT NULL AND u.name IS NULL)) AS anchor FROM alive a
  LEFT JOIN refs r ON r.name = a.name AND r.file_i = a.file_i
  LEFT JOIN (SELECT * FROM ovr WHERE verb = 'unanchor') u ON u.t = a.t AND u.name = a.name
  LEFT JOIN (SELECT * FROM ovr WHERE verb = 'anchor') n ON n.t = a.t AND n.name = a.name),
near AS (SELECT i.name AS ni, j.name AS nj, i.x - j.x AS dx, i.y - j.y AS dy FROM pos i JOIN pos j ON i.name < j.name AND abs(i.x - j.x) < 60 AND abs(i.y - j.y) < 60),
pairs AS MATERIALIZED (SELECT CASE WHEN dy > 0 THEN ni ELSE nj END AS a, CASE WHEN dy > 0 THEN nj ELSE ni END AS b, 1 AS axis FROM near WHERE abs(dx) < 5 AND abs(dy) > 50 AND abs(dy) < 60
  UNION SELECT CASE WHEN dx > 0 THEN ni ELSE nj END, CASE WHEN dx > 0 THEN nj ELSE ni END, 2 FROM near WHERE abs(dy) < 5 AND abs(dx) > 50 AND abs(dx) < 60),
pairs_at AS MATERIALIZED (SELECT x.t, a, b, axis FROM pairs JOIN alive x ON x.name = a JOIN alive y ON y.name = b AND y.t = x.t),
vols AS MATERIALIZED (SELECT t, name, file_key AS file, CAST(name AS INTEGER) AS pos, local_t, '["' || file_key || '",' || CAST(name AS INTEGER) || ',' || local_t || ',4]' AS js FROM alive JOIN files USING (file_i)),
tt AS MATERIALIZED (SELECT s.t, s.name, r.name IS NOT NULL AS realign, p.js AS sjs, v.js AS djs, p.file AS sf, p.pos AS sp, p.local_t AS sl, v.file AS df, v.pos AS dp, v.local_t AS dl FROM state s JOIN vols v ON v.t = s.t AND v.name = s.name JOIN vols p ON p.t = s.t - 1 AND p.name = s.name
  LEFT JOIN (SELECT * FROM ovr WHERE verb = 'realign') r ON r.t = s.t AND r.name = s.name WHERE s.anchor AND s.t >= 1),
tasks AS MATERIALIZED (
  SELECT t, 'time' AS kind, 0 AS kind_rank, name AS a, NULL AS b, 0 AS axis, realign, sf, sp, sl, df, dp, dl,
    substr(sha256('["time",' || sjs || ',' || djs || ',' || CASE WHEN realign THEN '[[1,3],[null,null],[null,null]]' ELSE '[[0,4],[null,null],[1,3]]' END || ',"float32"]'), 1, 16) AS key,
    'time ' || name || ' ' || (t - 1) || '->' || t || CASE WHEN realign THEN ' (realign)' ELSE '' END AS what FROM tt
  UNION ALL
  SELECT p.t, 'pair', 1, a, b, axis, false, s.file, s.pos, s.local_t, d.file, d.pos, d.local_t,
    substr(sha256('["pair",' || s.js || ',' || d.js || ',' || axis || ',550,' || CASE WHEN axis = 2 THEN '[[0,4],[null,null],[null,null]]' ELSE '[[0,4],[null,null],[1,3]]' END || ',"float32"]'), 1, 16),
    'pair ' || a || '|' || b || ' axis=' || axis || ' t=' || p.t FROM pairs_at p JOIN vols s ON s.t = p.t AND s.name = a JOIN vols d ON d.t = p.t AND d.name = b),
done AS MATERIALIZED (SELECT key FROM tasks WHERE CAST('0x' || substr(key, 1, 4) AS INTEGER) % 7 <> 0)
"""

_ROWS = (
    _BASE
    + """,
rs AS MATERIALIZED (SELECT t, name, name = '000000' AS anchor FROM state),
rp AS MATERIALIZED (SELECT t, a, b FROM pairs_at WHERE axis = 2),
edge AS MATERIALIZED (SELECT t, a AS x, b AS y FROM rp UNION SELECT t, b, a FROM rp),
part AS (SELECT t, name, name AS label FROM rs UNION SELECT p.t, e.y, p.label FROM part p JOIN edge e ON e.t = p.t AND e.x = p.name),
comp AS MATERIALIZED (SELECT t, name, min(label) AS component FROM part GROUP BY t, name),
first_tile AS (SELECT t, min(name) AS lo, min(name) FILTER (WHERE anchor) AS lead FROM rs GROUP BY t),
drifting AS (SELECT s.t, s.name FROM rs s JOIN rs p ON p.t = s.t - 1 AND p.name = s.name WHERE s.anchor AND s.t > 0),
seed AS MATERIALIZED (SELECT t, name, 'drift' AS kind FROM drifting
  UNION ALL SELECT t, coalesce(lead, lo), 'origin' FROM first_tile WHERE t = 0
  UNION ALL SELECT t, lo, 'origin' FROM first_tile WHERE t > 0 AND t NOT IN (SELECT t FROM drifting)),
step AS (SELECT t, name AS tile, kind, CAST(NULL AS VARCHAR) AS via, 0 AS axis FROM seed
  UNION SELECT s.t, e.y, 'pair', s.tile, 2 FROM step s JOIN edge e ON e.t = s.t AND e.x = s.tile AND e.y IS DISTINCT FROM s.via),
node AS MATERIALIZED (SELECT t, tile AS name, kind, CASE kind WHEN 'drift' THEN t - 1 WHEN 'pair' THEN t END AS pt, CASE kind WHEN 'drift' THEN tile ELSE via END AS pname,
  CASE WHEN NOT (CASE WHEN kind = 'pair' THEN (t * 31 + CAST(tile AS INTEGER)) % 97 = 0 ELSE t % 401 = 400 END) THEN (t * 7 + CAST(tile AS INTEGER) * 3) % 5 - 2 END AS dz,
  CASE WHEN NOT (CASE WHEN kind = 'pair' THEN (t * 31 + CAST(tile AS INTEGER)) % 97 = 0 ELSE t % 401 = 400 END) THEN (t * 5 + CAST(tile AS INTEGER) * 11) % 7 - 3 END AS dy,
  CASE WHEN NOT (CASE WHEN kind = 'pair' THEN (t * 31 + CAST(tile AS INTEGER)) % 97 = 0 ELSE t % 401 = 400 END) THEN (t * 3 + CAST(tile AS INTEGER) * 5) % 9 - 4 END AS dx FROM step),
placed AS (SELECT t, name, 0.0::DOUBLE AS z, 0.0::DOUBLE AS y, 0.0::DOUBLE AS x FROM node WHERE kind = 'origin'
  UNION ALL SELECT n.t, n.name, p.z + n.dz, p.y + n.dy, p.x + n.dx FROM placed p JOIN node n ON n.pt = p.t AND n.pname = p.name WHERE n.dz IS NOT NULL),
ext AS (SELECT min(z) AS z0, max(z) + 4 AS z1, min(y) AS y0, max(y) + 64 AS y1, min(x) AS x0, max(x) + 64 AS x1 FROM placed),
geo AS (SELECT CAST(floor(z0) AS INTEGER) AS oz, CAST(floor(y0 - 8) AS INTEGER) AS oy, CAST(floor(x0 - 8) AS INTEGER) AS ox, 0 AS nt, CAST(ceil(z1 - z0) AS INTEGER) AS nz, CAST(ceil(y1 - y0 + 16) AS INTEGER) AS ny, CAST(ceil(x1 - x0 + 16) AS INTEGER) AS nx FROM ext),
box AS MATERIALIZED (SELECT t, name, CAST(trunc(z - oz) AS INTEGER) AS z_lo, CAST(trunc(z - oz) AS INTEGER) + 4 AS z_hi, CAST(trunc(y - oy) AS INTEGER) AS y_lo, CAST(trunc(y - oy) AS INTEGER) + 64 AS y_hi,
  CAST(trunc(x - ox) AS INTEGER) AS x_lo, CAST(trunc(x - ox) AS INTEGER) + 64 AS x_hi FROM placed, geo),
bb AS (SELECT t, min(z_lo) AS z_lo, max(z_hi) AS z_hi, min(y_lo) AS y_lo, max(y_hi) AS y_hi, min(x_lo) AS x_lo, max(x_hi) AS x_hi FROM box GROUP BY t)
"""
)

_VOXELS = """
e AS (SELECT vec_id, embedding AS v FROM embeddings WHERE len(embedding) = 64),
vox AS (SELECT vec_id, CAST(i // 16 AS INTEGER) AS z, CAST((i // 4) % 4 AS INTEGER) AS y, CAST(i % 4 AS INTEGER) AS x, v[i + 1]::DOUBLE AS v FROM e, (SELECT unnest(range(64)) AS i))
"""


def _correlation(nx: int, src: str, dst: str, add: int) -> str:
    """Phase correlation as sums of sines and cosines over a 4 x 4 x nx volume."""
    n = 16 * nx
    phase = f"2 * pi() * ((k // {4 * nx}) * z / 4.0 + ((k // {nx}) % 4) * y / 4.0 + (k % {nx}) * x / {nx}.0)"
    shift = f"2 * pi() * ((k // {4 * nx}) * (s // {4 * nx}) / 4.0 + ((k // {nx}) % 4) * ((s // {nx}) % 4) / 4.0 + (k % {nx}) * (s % {nx}) / {nx}.0)"
    return f"""WITH {_VOXELS},
ks AS (SELECT unnest(range({n})) AS k), ss AS (SELECT unnest(range({n})) AS s),
a AS ({src}), b AS ({dst}),
fa AS (SELECT vec_id, k, sum(v * cos({phase})) AS re, -sum(v * sin({phase})) AS im FROM a, ks GROUP BY 1, 2),
fb AS (SELECT vec_id, k, sum(v * cos({phase})) AS re, -sum(v * sin({phase})) AS im FROM b, ks GROUP BY 1, 2),
m AS (SELECT vec_id, k, (fa.re * fb.re + fa.im * fb.im) AS re, (fa.im * fb.re - fa.re * fb.im) AS im FROM fa JOIN fb USING (vec_id, k)),
u AS (SELECT vec_id, k, re / sqrt(re * re + im * im) AS re, im / sqrt(re * re + im * im) AS im FROM m),
r AS (SELECT vec_id, s, sum(re * cos({shift}) - im * sin({shift})) AS v FROM u, ss GROUP BY 1, 2),
p AS (SELECT vec_id, s, row_number() OVER (PARTITION BY vec_id ORDER BY round(v, 9) DESC, s) AS rn FROM r)
SELECT vec_id, CAST((s // {4 * nx} + 2) % 4 - 2 AS INTEGER) AS dz, CAST(((s // {nx}) % 4 + 2) % 4 - 2 AS INTEGER) AS dy, CAST((s % {nx} + {nx // 2}) % {nx} - {nx // 2} + {add} AS INTEGER) AS dx FROM p WHERE rn = 1"""


def base(select: str) -> str:
    """A query over the virtual acquisition."""
    return f"WITH {_BASE} {select}"


def _rows(select: str) -> str:
    return f"WITH RECURSIVE {_ROWS} {select}"


#: Routing of cyclic graphs: ``spot`` is the sweep and the pair (numbered from 1) by which a tile is placed; seeds come before the first.
_SWEEPS = (
    _BASE
    + """,
first2 AS (SELECT t, min(name) AS lo, min(name) FILTER (WHERE anchor) AS lead FROM state GROUP BY t),
drift2 AS (SELECT s.t, s.name FROM state s JOIN state p ON p.t = s.t - 1 AND p.name = s.name WHERE s.anchor AND s.t > 0),
seed2 AS MATERIALIZED (SELECT t, name FROM drift2 UNION ALL SELECT t, coalesce(lead, lo) FROM first2 WHERE t = 0 UNION ALL SELECT t, lo FROM first2 WHERE t > 0 AND t NOT IN (SELECT t FROM drift2)),
pr AS MATERIALIZED (SELECT t, a, b, row_number() OVER (PARTITION BY t ORDER BY a, b, axis) AS i FROM pairs_at),
en AS MATERIALIZED (SELECT t, a AS u, b AS v, i FROM pr UNION ALL SELECT t, b, a, i FROM pr),
lab(t, tile, spot) USING KEY (t, tile) AS (SELECT t, name, 1000000::BIGINT FROM seed2
  UNION SELECT c.t, c.v, c.spot FROM (SELECT l.t, e.v, min((l.spot // 1000000 + CASE WHEN e.i <= l.spot % 1000000 THEN 1 ELSE 0 END) * 1000000 + e.i) AS spot FROM lab l JOIN en e ON e.t = l.t AND e.u = l.tile GROUP BY l.t, e.v) c
  LEFT JOIN recurring.lab r ON r.t = c.t AND r.tile = c.v WHERE r.spot IS NULL OR c.spot < r.spot),
part2(t, name, label) USING KEY (t, name) AS (SELECT t, name, name FROM alive
  UNION SELECT c.t, c.v, c.label FROM (SELECT p.t, e.v, min(p.label) AS label FROM part2 p JOIN en e ON e.t = p.t AND e.u = p.name GROUP BY p.t, e.v) c JOIN recurring.part2 r ON r.t = c.t AND r.name = c.v WHERE c.label < r.label),
placed2 AS MATERIALIZED (SELECT * FROM lab),
over2 AS (SELECT t, count(*) AS n FROM (SELECT t, label FROM part2 JOIN seed2 USING (t, name) GROUP BY t, label HAVING count(*) > 1) GROUP BY t),
met AS (SELECT e.t, e.i, min(l.spot // 1000000 + CASE WHEN e.i <= l.spot % 1000000 THEN 1 ELSE 0 END) AS s FROM placed2 l JOIN en e ON e.t = l.t AND e.u = l.tile GROUP BY e.t, e.i),
pd AS MATERIALIZED (SELECT pr.t, pr.i, met.s, l.tile IS NOT NULL AS tree, count(*) OVER (PARTITION BY pr.t) AS n, coalesce(max(met.s) OVER (PARTITION BY pr.t), 0) AS most
  FROM pr LEFT JOIN met ON met.t = pr.t AND met.i = pr.i LEFT JOIN placed2 l ON l.t = pr.t AND l.spot % 1000000 = pr.i),
visit AS (SELECT t, i, n, unnest(range(1, coalesce(s, most + 2) + 1)) AS k, s, tree FROM pd),
told AS (SELECT t, i, k, n, coalesce(k = s AND tree, false) AS placed, coalesce(sum(CASE WHEN k = s THEN 1 ELSE 0 END) OVER b, 0) AS ended, coalesce(sum(CASE WHEN k = s AND tree THEN 0 ELSE 1 END) OVER b, 0) AS idle
  FROM visit WINDOW b AS (PARTITION BY t ORDER BY k, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
since AS (SELECT t, i, k, n - ended AS rest, idle - coalesce(max(CASE WHEN placed THEN idle END) OVER (PARTITION BY t ORDER BY k, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fruitless FROM told),
stop AS (SELECT t, min(k * 1000000 + i) AS spot FROM since WHERE fruitless > rest GROUP BY t)
"""
)

_ISLES = "isles AS (SELECT {key}, min(t) AS a, max(t) AS b FROM (SELECT {key}, t, t - row_number() OVER (PARTITION BY {key} ORDER BY t) AS g FROM (SELECT DISTINCT {key}, t FROM {src})) GROUP BY {key}, g) SELECT {key}, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ts FROM isles GROUP BY {key}"

_SERIES = "ser AS (SELECT * FROM (SELECT user_id, event_id, ts, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events) WHERE step IS NOT NULL)"

ALL: dict[str, str] = {
    "timeline_prefix_sum": base("SELECT file_i, nt, file_start FROM files"),
    "locate_asof": base("SELECT p.t, f.file_i, CAST(p.t - f.file_start AS INTEGER) AS local_t FROM (SELECT DISTINCT CAST(o_orderkey % (SELECT nt FROM nf) AS INTEGER) AS t FROM orders) p ASOF JOIN files f ON p.t >= f.file_start"),
    "tile_lifetime": base("SELECT name, first_t, CAST(last_t AS INTEGER) AS last_t FROM tiles"),
    "tile_index": base("SELECT name, row_number() OVER (ORDER BY name) - 1 AS i FROM tiles"),
    "alive_mask": base("SELECT t, name FROM alive"),
    "anchor_mask_overrides": base("SELECT t, name, file_i FROM state WHERE anchor"),
    "override_lookup": base("SELECT t, verb, string_agg(name, ',' ORDER BY name) AS names FROM ovr GROUP BY t, verb"),
    "tile_files": base("SELECT name, file_i, key AS pos_i FROM pos, files, nf WHERE file_i >= start_file AND file_i < coalesce(end_file, n)"),
    "show_tasks": base("SELECT what, CASE WHEN d.key IS NOT NULL THEN CAST('0x' || substr(tasks.key, 5, 1) AS INTEGER) - 8 END AS dz, CASE WHEN d.key IS NOT NULL THEN CAST('0x' || substr(tasks.key, 6, 1) AS INTEGER) - 8 END AS dy, CASE WHEN d.key IS NOT NULL THEN CAST('0x' || substr(tasks.key, 7, 1) AS INTEGER) - 8 END AS dx FROM tasks LEFT JOIN (SELECT DISTINCT key FROM done) d USING (key) WHERE t = 100"),
    "step_labels": _rows("SELECT t, tile, CASE kind WHEN 'origin' THEN 'origin' WHEN 'drift' THEN 'own place at t-1' ELSE 'x neighbour of ' || via END AS label FROM step"),
    "frame_index": base("SELECT t, name, file, pos, local_t FROM vols"),
    "neighbour_pairs": base("SELECT * FROM pairs"),
    "neighbour_pairs_flipped": base("SELECT b AS a, a AS b, axis FROM pairs"),
    "pair_alive": base("SELECT * FROM pairs_at"),
    "layout_stats": base("SELECT CAST(sum(nt) AS INTEGER) AS nt, CAST(min(4 + file_i) AS INTEGER) AS nz, 64 AS ny, 64 AS nx FROM files"),
    "default_shift": base("SELECT file_i, 550 AS shift_px FROM files"),
    "timeline_report": base("SELECT f.file_i, f.file_start AS first_t, CAST(f.file_start + f.nt AS INTEGER) AS end_t, f.nt, count(s.name) AS n_alive, count(s.name) FILTER (WHERE s.anchor) AS n_anchors FROM files f LEFT JOIN state s ON s.t = f.file_start GROUP BY ALL"),
    "plan_time_tasks": base("SELECT t, a AS name, realign, key, what FROM tasks WHERE kind = 'time'"),
    "plan_pair_tasks": base("SELECT t, a, b, axis, key, what FROM tasks WHERE kind = 'pair'"),
    "plan_between": base("SELECT t, kind, count(*) AS n FROM tasks WHERE t >= 100 AND t < 200 GROUP BY t, kind"),
    "plan_order_limit": base("SELECT t, kind, what FROM tasks ANTI JOIN done USING (key) ORDER BY t, kind_rank, a, b, axis LIMIT 500"),
    "volume_uses": base("SELECT file, pos, local_t, count(*) AS uses FROM (SELECT sf AS file, sp AS pos, sl AS local_t FROM tasks UNION ALL SELECT df, dp, dl FROM tasks) GROUP BY ALL"),
    "spectrum_uses": base("SELECT file, pos, local_t, axis, realign, side, count(*) AS uses FROM (SELECT sf AS file, sp AS pos, sl AS local_t, axis, realign, CASE kind WHEN 'pair' THEN 'parent' ELSE '' END AS side FROM tasks UNION ALL SELECT df, dp, dl, axis, realign, CASE kind WHEN 'pair' THEN 'child' ELSE '' END FROM tasks) GROUP BY ALL"),
    "content_keys": base("SELECT file_i, file_key FROM files"),
    "pending_tasks": base("SELECT key, t, kind FROM tasks LEFT JOIN (SELECT DISTINCT key AS k FROM done) d ON d.k = key WHERE k IS NULL"),
    "status_summary": base("SELECT kind, count(*) AS n_tasks, count(d.key) AS n_cached, count(*) - count(d.key) AS n_pending, round(100.0::DOUBLE * count(d.key) / count(*), 1) AS percent, min(t) FILTER (WHERE d.key IS NULL) AS next_t FROM tasks LEFT JOIN (SELECT DISTINCT key FROM done) d USING (key) GROUP BY kind"),
    "memo_last_wins": "SELECT l_orderkey AS key, l_partkey % 5 - 2 AS dz, l_suppkey % 21 - 10 AS dy, CAST(l_linenumber % 21 - 10 AS BIGINT) AS dx FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1",
    "offset_log": "SELECT CAST(l_orderkey AS VARCHAR) AS key, 'time' AS kind, 'line ' || l_linenumber AS what, CAST(l_partkey % 5 - 2 AS INTEGER) AS dz, CAST(l_suppkey % 21 - 10 AS INTEGER) AS dy, CAST(l_linenumber % 21 - 10 AS INTEGER) AS dx FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1",
    "blend_keys": _rows(""", w AS (SELECT t, string_agg('["' || name || '",[' || CAST(z AS INTEGER) || ',' || CAST(y AS INTEGER) || ',' || CAST(x AS INTEGER) || ']]', ',' ORDER BY name) AS c FROM placed GROUP BY t)
SELECT t, substr(sha256('{"coords":[' || c || '],"dtype":"uint16","origin":[0,-8,-8]}'), 1, 16) AS key FROM w"""),
    "memo_compact_count": "SELECT count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_keys, count(*) - count(DISTINCT l_orderkey) AS n_superseded FROM lineitem",
    "phase_correlation_time": _correlation(4, "SELECT vec_id, z, y, x, v FROM vox WHERE vec_id + 1 IN (SELECT vec_id FROM e)", "SELECT vec_id - 1 AS vec_id, z, y, x, v FROM vox WHERE vec_id - 1 IN (SELECT vec_id FROM e)", 0),
    "task_blocks": base("""
, low AS (SELECT min(x) AS x0, min(y) AS y0 FROM pos), cell AS (SELECT name, CAST(floor((x - x0) / 55) AS BIGINT) AS gx, CAST(floor((y - y0) / 55) AS BIGINT) AS gy FROM pos, low),
code AS (SELECT name, CAST(sum((((gx >> i) & 1) << (2 * i)) + (((gy >> i) & 1) << (2 * i + 1))) AS BIGINT) AS c FROM cell, (SELECT unnest(range(20)) AS i) GROUP BY name),
block AS MATERIALIZED (SELECT name, (row_number() OVER (ORDER BY c, name) - 1) // 4 AS block FROM code),
p AS (SELECT t // 8 AS span, least(x.block, y.block) AS block, sf, sp, sl, df, dp, dl FROM tasks JOIN block x ON x.name = a LEFT JOIN block y ON y.name = b),
v AS (SELECT block, span, sf AS file, sp AS pos, sl AS local_t FROM p UNION ALL SELECT block, span, df, dp, dl FROM p)
SELECT file, pos, local_t, count(*) AS readers, CAST(sum(n) AS BIGINT) AS uses FROM (SELECT file, pos, local_t, block, span, count(*) AS n FROM v GROUP BY ALL) GROUP BY ALL"""),
    "phase_correlation_pair_shift": _correlation(2, "SELECT vec_id, z, y, x - 2 AS x, v FROM vox WHERE x >= 2 AND vec_id + 1 IN (SELECT vec_id FROM e)", "SELECT vec_id - 1 AS vec_id, z, y, x, v FROM vox WHERE x < 2 AND vec_id - 1 IN (SELECT vec_id FROM e)", 2),
    "overlap_trim": f"WITH {_VOXELS} SELECT vec_id, 'parent' AS side, z, y, x - 1 AS x, v FROM vox WHERE x >= 1 UNION ALL SELECT vec_id, 'child', z, y, x, v FROM vox WHERE x < 3",
    "max_projection": f"WITH {_VOXELS} SELECT vec_id, y, x, max(v) AS v FROM vox GROUP BY ALL",
    "centre_crop": f"WITH {_VOXELS} SELECT vec_id, z, y - 1 AS y, x - 1 AS x, v FROM vox WHERE y BETWEEN 1 AND 2 AND x BETWEEN 1 AND 2",
    "connected_components": _rows("SELECT t, name, component FROM comp"),
    "over_anchored": _rows(""", first2 AS (SELECT t, min(name) AS lo, min(name) FILTER (WHERE anchor) AS lead FROM state GROUP BY t),
drift2 AS (SELECT s.t, s.name FROM state s JOIN state p ON p.t = s.t - 1 AND p.name = s.name WHERE s.anchor AND s.t > 0),
seed2 AS (SELECT t, name FROM drift2 UNION ALL SELECT t, coalesce(lead, lo) FROM first2 WHERE t = 0 UNION ALL SELECT t, lo FROM first2 WHERE t > 0 AND t NOT IN (SELECT t FROM drift2))
SELECT t, component, string_agg(name, ',' ORDER BY name) AS anchors FROM comp JOIN seed2 USING (t, name) GROUP BY t, component HAVING count(*) > 1"""),
    "unanchored_components": _rows(", bare AS (SELECT c.t, string_agg(c.name, ',' ORDER BY c.name) AS tiles FROM comp c JOIN rs USING (t, name) GROUP BY c.t, component HAVING NOT bool_or(anchor)), " + _ISLES.format(key="tiles", src="bare")),
    "placement_steps": _rows("SELECT t, tile, kind, via, axis FROM step"),
    "placement_flags_cyclic": f"""WITH RECURSIVE {_SWEEPS}
SELECT a.t, st.n AS n_steps, coalesce(re.n, 0) AS n_redundant, a.n - st.n AS n_unplaced, coalesce(o.n, 0) AS n_over_anchored FROM (SELECT t, count(*) AS n FROM alive GROUP BY t) a
JOIN (SELECT l.t, count(*) AS n FROM placed2 l LEFT JOIN stop USING (t) WHERE stop.spot IS NULL OR l.spot < stop.spot GROUP BY l.t) st ON st.t = a.t
LEFT JOIN (SELECT pd.t, count(*) AS n FROM pd LEFT JOIN stop USING (t) WHERE NOT tree AND s IS NOT NULL AND (stop.spot IS NULL OR s * 1000000 + i < stop.spot) GROUP BY pd.t) re ON re.t = a.t
LEFT JOIN over2 o ON o.t = a.t""",
    "placement_by_joins": f"""WITH RECURSIVE {_SWEEPS}
SELECT st.t, st.n AS n_steps, st.m AS n_pairs, coalesce(re.n, 0) AS n_redundant FROM (SELECT l.t, count(*) AS n, count(*) FILTER (WHERE l.spot > 1000000) AS m FROM placed2 l LEFT JOIN stop USING (t) WHERE stop.spot IS NULL OR l.spot < stop.spot GROUP BY l.t) st
LEFT JOIN (SELECT pd.t, count(*) AS n FROM pd LEFT JOIN stop USING (t) WHERE NOT tree AND s IS NOT NULL AND (stop.spot IS NULL OR s * 1000000 + i < stop.spot) GROUP BY pd.t) re ON re.t = st.t""",
    "topology_runs": _rows(", sig AS (SELECT t, coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE anchor), '') AS s FROM rs GROUP BY t), ch AS (SELECT t, CASE WHEN lag(s) OVER (ORDER BY t) = s AND lag(t) OVER (ORDER BY t) = t - 1 THEN 0 ELSE 1 END AS new FROM sig), run AS (SELECT t, sum(new) OVER (ORDER BY t) AS r FROM ch) SELECT min(t) AS first_t, max(t) AS last_t, count(*) AS n_t FROM run GROUP BY r"),
    "range_format": base(", dropped AS (SELECT name, t FROM ovr WHERE verb = 'drop'), " + _ISLES.format(key="name", src="dropped")),
    "skeleton_tiles": _rows(""", wanted AS (SELECT t, name FROM rs WHERE anchor UNION SELECT t - 1, name FROM rs WHERE anchor AND t - 1 IN (SELECT t FROM rs)),
route AS (SELECT w.t, s.tile, s.via FROM wanted w JOIN step s ON s.t = w.t AND s.tile = w.name UNION SELECT r.t, s.tile, s.via FROM route r JOIN step s ON s.t = r.t AND s.tile = r.via)
SELECT DISTINCT t, tile AS name FROM route UNION SELECT t, min(name) FROM seed WHERE t NOT IN (SELECT t FROM route) GROUP BY t"""),
    "coordinates_path_sum": _rows("SELECT t, name, z, y, x FROM placed"),
    "coordinates_missing": _rows("SELECT n.t, n.name, n.kind FROM node n JOIN placed p ON p.t = n.pt AND p.name = n.pname WHERE n.dz IS NULL AND (n.kind = 'drift' OR n.t >= 100)"),
    "coordinates_restricted": _rows(""", wanted AS (SELECT t, name FROM rs WHERE anchor UNION SELECT t - 1, name FROM rs WHERE anchor AND t - 1 IN (SELECT t FROM rs)),
route AS (SELECT w.t, s.tile, s.via FROM wanted w JOIN step s ON s.t = w.t AND s.tile = w.name UNION SELECT r.t, s.tile, s.via FROM route r JOIN step s ON s.t = r.t AND s.tile = r.via),
skel AS (SELECT DISTINCT t, tile AS name FROM route UNION SELECT t, min(name) FROM seed WHERE t NOT IN (SELECT t FROM route) GROUP BY t)
SELECT t, name, z, y, x FROM placed SEMI JOIN skel USING (t, name)"""),
    "pair_offset_signs": _rows(""", signed AS (SELECT s.t, s.tile AS name, s.via AS pname, 1 AS sign, p.a FROM step s JOIN rp p ON p.t = s.t AND p.b = s.tile AND p.a = s.via UNION ALL SELECT s.t, s.tile, s.via, -1, p.a FROM step s JOIN rp p ON p.t = s.t AND p.a = s.tile AND p.b = s.via)
SELECT t, name, pname, sign * ((t * 3 + CAST(a AS INTEGER)) % 5 - 2) AS dz, sign * ((t * 5 + CAST(a AS INTEGER)) % 7 - 3) AS dy, sign * ((t * 7 + CAST(a AS INTEGER)) % 9 - 4) AS dx FROM signed"""),
    "routes": _rows(", way AS (SELECT t, tile, tile AS seed, 1 AS n FROM step WHERE via IS NULL UNION ALL SELECT s.t, s.tile, w.seed, w.n + 1 FROM way w JOIN step s ON s.t = w.t AND s.via = w.tile) SELECT t, tile AS name, seed, n AS n_steps FROM way"),
    "blend_unfinished": _rows("SELECT DISTINCT t FROM placed WHERE t % 3 = 0 OR t % 5 = 0"),
    "blend_chunks": """WITH e AS (SELECT vec_id // 2 AS t, vec_id % 2 AS s, list_transform(embedding, lambda v: CAST(floor(abs(v::DOUBLE) * 1000) AS INTEGER)) AS v FROM embeddings),
g AS (SELECT unnest(range(4)) AS z), h AS (SELECT unnest(range(4)) AS y), i AS (SELECT unnest(range(6)) AS x),
p AS (SELECT DISTINCT t FROM e),
c AS (SELECT p.t, z, y, x, CAST(a.v[z * 16 + y * 4 + x + 1] AS FLOAT) AS va, CAST(b.v[z * 16 + y * 4 + x - 1] AS FLOAT) AS vb,
  CAST(CASE WHEN a.t IS NULL OR x > 3 THEN 0 WHEN x = 3 THEN 0.01 WHEN x = 2 THEN 0.99 ELSE 1 END AS FLOAT) AS wa, CAST(CASE WHEN b.t IS NULL OR x < 2 THEN 0 WHEN x = 2 THEN 0.01 WHEN x = 3 THEN 0.99 ELSE 1 END AS FLOAT) AS wb
  FROM p CROSS JOIN g CROSS JOIN h CROSS JOIN i LEFT JOIN e a ON a.t = p.t AND a.s = 0 LEFT JOIN e b ON b.t = p.t AND b.s = 1),
o AS (SELECT t, z, x, CASE WHEN wa + wb = 0 THEN 0 ELSE trunc((CASE WHEN wa = 0 THEN CAST(0 AS FLOAT) ELSE va * wa END + CASE WHEN wb = 0 THEN CAST(0 AS FLOAT) ELSE vb * wb END) / (wa + wb + CAST(1e-12 AS FLOAT))) END AS v,
  x // 3 AS cx FROM c),
k AS (SELECT t, bool_or(s = 0) AS one, bool_or(s = 1) AS two FROM e GROUP BY t)
SELECT t, CAST(z // 2 AS INTEGER) AS cz, CAST(cx AS INTEGER) AS cx, CAST(count(*) AS INTEGER) AS n_voxels, CAST(sum(v) AS BIGINT) AS total FROM o JOIN k USING (t) WHERE one OR cx = 1 OR two GROUP BY ALL""",
    "stored_volume_steps": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(abs(v::DOUBLE) * 1000) AS BIGINT) % 65536) AS v FROM embeddings WHERE len(embedding) = 64)
SELECT 'block_' || n.vec_id // 64 AS file, CAST(n.vec_id % 8 AS INTEGER) AS pos, CAST(n.vec_id // 8 % 8 AS INTEGER) AS local_t, CAST(list_sum(n.v) AS BIGINT) AS total,
  CAST(list_sum(list_transform(range(1, 65), lambda i: abs(n.v[i] - o.v[i]))) AS BIGINT) AS change FROM e n JOIN e o ON o.vec_id = n.vec_id - 8 AND n.vec_id // 64 = o.vec_id // 64""",
    "extent": _rows("SELECT z0 AS z_lo, z1 AS z_hi, y0 AS y_lo, y1 AS y_hi, x0 AS x_lo, x1 AS x_hi FROM ext"),
    "canvas_required_pad": _rows("SELECT * FROM geo"),
    "tile_boxes": _rows("SELECT * FROM box"),
    "violations": _rows(", b2 AS (SELECT t, name, z_lo, z_hi, CAST(y_lo - 12 AS INTEGER) AS y_lo, CAST(y_hi - 12 AS INTEGER) AS y_hi, CAST(x_lo - 12 AS INTEGER) AS x_lo, CAST(x_hi - 12 AS INTEGER) AS x_hi FROM box) SELECT b2.* FROM b2, geo WHERE z_lo < 0 OR z_hi > nz OR y_lo < 0 OR y_hi > ny - 24 OR x_lo < 0 OR x_hi > nx - 24"),
    "slack": _rows("SELECT 2 AS slack_z, 16 AS slack_y, 16 AS slack_x FROM geo"),
    "timepoint_bbox": _rows("SELECT * FROM bb"),
    "snap_to_chunks": _rows("SELECT t, CAST(floor(z_lo / 4.0) * 4 AS INTEGER) AS z_lo, CAST(least(ceil(z_hi / 4.0) * 4, nz) AS INTEGER) AS z_hi, CAST(floor(y_lo / 32.0) * 32 AS INTEGER) AS y_lo, CAST(least(ceil(y_hi / 32.0) * 32, ny) AS INTEGER) AS y_hi, CAST(floor(x_lo / 32.0) * 32 AS INTEGER) AS x_lo, CAST(least(ceil(x_hi / 32.0) * 32, nx) AS INTEGER) AS x_hi FROM bb, geo"),
    "chunk_hits": _rows(", zc AS (SELECT t, name, unnest(range(z_lo // 4, (z_hi - 1) // 4 + 1)) AS cz FROM box), yc AS (SELECT t, name, unnest(range(y_lo // 32, (y_hi - 1) // 32 + 1)) AS cy FROM box), xc AS (SELECT t, name, unnest(range(x_lo // 32, (x_hi - 1) // 32 + 1)) AS cx FROM box) SELECT t, CAST(cz AS INTEGER) AS cz, CAST(cy AS INTEGER) AS cy, CAST(cx AS INTEGER) AS cx, count(*) AS n_tiles FROM zc JOIN yc USING (t, name) JOIN xc USING (t, name) GROUP BY ALL"),
    "z_segments": _rows(", edge_z AS (SELECT t, z FROM (SELECT t, unnest([0, 64, z_lo, z_hi]) AS z FROM box) WHERE z BETWEEN 0 AND 64 GROUP BY ALL), seg AS (SELECT t, z AS za, lead(z) OVER (PARTITION BY t ORDER BY z) AS zb FROM edge_z) SELECT s.t, s.za, s.zb, coalesce(string_agg(b.name, ',' ORDER BY b.name) FILTER (WHERE b.z_lo <= s.za AND s.zb <= b.z_hi), '') AS tiles FROM seg s JOIN box b ON b.t = s.t WHERE s.zb IS NOT NULL GROUP BY s.t, s.za, s.zb"),
    "blend_edges": _rows(", w AS (SELECT t, name, x - CAST(substr(name, 6, 1) AS INTEGER) * 9 AS x FROM placed), ed AS (SELECT r.t, a, b, CAST(trunc(q.x - p.x) AS INTEGER) AS length FROM rp r JOIN w p ON p.t = r.t AND p.name = a JOIN w q ON q.t = r.t AND q.name = b) SELECT t, a AS name, 2 AS axis, true AS lower, length FROM ed WHERE length > 0 AND length < 64 UNION ALL SELECT t, b, 2, false, length FROM ed WHERE length > 0 AND length < 64"),
    "blend_weights_1d": "WITH l AS (SELECT DISTINCT CAST(p_size AS INTEGER) AS length FROM part WHERE p_size > 0), r AS (SELECT length, unnest(range(length)) AS i FROM l) SELECT lower, length, CAST(CASE WHEN lower THEN length - 1 - i ELSE i END AS INTEGER) AS i, round(0.01::DOUBLE + i * 0.98::DOUBLE / greatest(length - 1, 1), 9) AS w FROM r, (VALUES (true), (false)) q(lower)",
    "blend_weighted_average": f"WITH {_VOXELS}, s AS (SELECT vec_id // 2 AS tile_pair, z, y, CAST((vec_id % 2) * 2 + x AS INTEGER) AS x, v, CASE WHEN vec_id % 2 = 0 THEN CASE x WHEN 2 THEN 0.99::DOUBLE WHEN 3 THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END ELSE CASE x WHEN 0 THEN 0.01::DOUBLE WHEN 1 THEN 0.99::DOUBLE ELSE 1.0::DOUBLE END END AS w FROM vox) SELECT tile_pair, z, y, x, round(sum(w * v) / (1e-12::DOUBLE + sum(w)), 6) AS value FROM s GROUP BY ALL",
    "drift_outliers": f"WITH {_SERIES}, m AS (SELECT user_id, median(abs(step)) AS med FROM ser GROUP BY user_id) SELECT user_id, event_id, round(abs(step), 6) AS mag, round(med, 6) AS med FROM ser JOIN m USING (user_id) WHERE abs(step) > greatest(3 * med, med + 5)",
    "cumulative_drift": f"WITH {_SERIES} SELECT user_id, event_id, round(step, 2) AS step, round(sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cum_step FROM ser",
    "drift_magnitude": _rows("SELECT t, name, round(sqrt(dz * dz + dy * dy + dx * dx), 6) AS magnitude FROM node WHERE kind = 'drift' AND dz IS NOT NULL"),
    "validation_problems": base("""
SELECT 'start file out of range' AS rule, name AS subject FROM pos, nf WHERE start_file < 0 OR start_file >= n
UNION ALL SELECT 'never alive', name FROM pos WHERE end_file <= start_file
UNION ALL SELECT 'end out of range', name FROM pos, nf WHERE end_file < 1 OR end_file > n
UNION ALL SELECT 'start beyond file', name FROM pos JOIN files ON file_i = start_file WHERE start_t >= nt
UNION ALL SELECT 'reference where not alive', name || '@' || file_i FROM refs JOIN pos USING (name), nf WHERE file_i < start_file OR file_i >= coalesce(end_file, n)
UNION ALL SELECT 'file without reference', CAST(file_i AS VARCHAR) FROM files WHERE file_i NOT IN (SELECT file_i FROM refs)
UNION ALL SELECT DISTINCT 'dropped and used', d.name || '@' || d.t FROM ovr d JOIN ovr u USING (t, name) WHERE d.verb = 'drop' AND u.verb IN ('anchor', 'realign')
UNION ALL SELECT 'unanchored and anchored', d.name || '@' || d.t FROM ovr d JOIN ovr u USING (t, name) WHERE d.verb = 'unanchor' AND u.verb = 'anchor'
UNION ALL SELECT 'unanchored and dropped', d.name || '@' || d.t FROM ovr d JOIN ovr u USING (t, name) WHERE d.verb = 'unanchor' AND u.verb = 'drop'
UNION ALL SELECT 'realign at the first timepoint', name || '@' || t FROM ovr WHERE verb = 'realign' AND t = 0
UNION ALL SELECT DISTINCT 'reference removed without replacement', name || '@' || t FROM ovr WHERE verb IN ('drop', 'unanchor') AND name IN (SELECT name FROM refs) AND t NOT IN (SELECT t FROM ovr WHERE verb = 'anchor')"""),
}
ALL["phase_correlation_pencils"] = ALL["phase_correlation_time"]
ALL["canvas_resumed"] = ALL["blend_chunks"]
_IN_STACKS = "SELECT vec_id{by} AS vec_id, z, y, x, floor(abs(v) * 1000) % 65536 AS v FROM vox WHERE {where} IN (SELECT vec_id FROM e)"
ALL["stored_offsets"] = _correlation(4, _IN_STACKS.format(by="", where="vec_id % 64 < 56 AND vec_id + 8"), _IN_STACKS.format(by=" - 8", where="vec_id % 64 >= 8 AND vec_id - 8"), 0)
# whole numbers can add up to a zero coefficient, with which the response is undefined and its first place counts
_WITH, _, _SELECT = ALL["stored_offsets"].rpartition("\nSELECT ")
ALL["stored_offsets"] = f"{_WITH}, o AS (SELECT {_SELECT}), z AS (SELECT DISTINCT vec_id FROM m WHERE abs(re) + abs(im) < 1e-6)\nSELECT vec_id, " + ", ".join(f"CAST(CASE WHEN vec_id IN (SELECT vec_id FROM z) THEN 0 ELSE {c} END AS INTEGER) AS {c}" for c in ("dz", "dy", "dx")) + " FROM o"
ALL["response_surfaces"] = ALL["phase_correlation_time"].partition(",\np AS")[0] + "\nSELECT vec_id, CAST((s // 16 + 2) % 4 AS INTEGER) AS z, CAST((s // 4 + 2) % 4 AS INTEGER) AS y, CAST((s + 2) % 4 AS INTEGER) AS x, round(v / 64, 6) + 0.0 AS v FROM r"
