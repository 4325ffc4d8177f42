"""DuckDB twins of the queries that SQL can express over whole tables."""

_P5_EDGES = """
pairs AS (
  SELECT least(left_id, right_id) AS l, greatest(left_id, right_id) AS r
  FROM duplicate_links WHERE left_id <> right_id
  GROUP BY 1, 2
  HAVING NOT bool_or(coalesce(rejected, false))
     AND bool_or(coalesce(level IN ('exact_bytes', 'exact_pixels', 'verified_visual', 'human_confirmed'), false))),
edges AS (
  SELECT l, r FROM pairs
  WHERE l IN (SELECT sample_id FROM samples WHERE sample_id IS NOT NULL) AND r IN (SELECT sample_id FROM samples WHERE sample_id IS NOT NULL)),
both_ways AS (SELECT l AS a, r AS b FROM edges UNION SELECT r, l FROM edges),
walk(v, c) AS (
  SELECT DISTINCT a, a FROM both_ways
  UNION
  SELECT e.b, w.c FROM walk w JOIN both_ways e ON e.a = w.v)"""

_P1_EDGES = r"""
own AS (
  SELECT DISTINCT sample_id,
    regexp_replace(lower(source_dataset), '[\s_-]+', '', 'g') AS s,
    regexp_replace(lower(capture_group), '[\s_-]+', '', 'g') AS k0,
    regexp_replace(lower(video_id), '[\s_-]+', '', 'g') AS k1,
    regexp_replace(lower(location), '[\s_-]+', '', 'g') AS k2,
    regexp_replace(lower(duplicate_cluster_id), '[\s_-]+', '', 'g') AS k9
  FROM samples WHERE sample_id IS NOT NULL),
unknown(u) AS (VALUES (''), ('unknown'), ('n/a'), ('na'), ('n/d'), ('nd'), ('null'), ('none'), ('nan'), ('?'), ('desconocido'), ('sindato'), ('sindatos')),
keys AS (
  SELECT sample_id, '~0|' || s || '|' || k0 AS k FROM own WHERE k0 NOT IN (SELECT u FROM unknown) AND s NOT IN (SELECT u FROM unknown)
  UNION SELECT sample_id, '~1|' || s || '|' || k1 FROM own WHERE k1 NOT IN (SELECT u FROM unknown) AND s NOT IN (SELECT u FROM unknown)
  UNION SELECT sample_id, '~2|' || s || '|' || k2 FROM own WHERE k2 NOT IN (SELECT u FROM unknown) AND s NOT IN (SELECT u FROM unknown)
  UNION SELECT sample_id, '~9|' || k9 FROM own WHERE k9 NOT IN (SELECT u FROM unknown)),
both_ways AS (SELECT sample_id AS a, k AS b FROM keys UNION SELECT k, sample_id FROM keys),
walk(v, c) AS (
  SELECT DISTINCT a, a FROM both_ways WHERE a NOT LIKE '~%'
  UNION
  SELECT e.b, least(w.c, CASE WHEN e.b LIKE '~%' THEN w.c ELSE e.b END) FROM walk w JOIN both_ways e ON e.a = w.v),
groups AS (SELECT v AS sample_id, min(c) AS group_id FROM walk WHERE v NOT LIKE '~%' GROUP BY 1)"""

_P6_BEST = """
timed AS (
  SELECT sample_id, measured_at, coalesce(is_corrupted, false) OR coalesce(processing_error, false) AS bad,
    CASE WHEN width > 0 THEN width::DOUBLE END AS w, CASE WHEN height > 0 THEN height::DOUBLE END AS h,
    CASE WHEN blur_variance >= 0 AND NOT isnan(blur_variance) AND NOT isinf(blur_variance) THEN blur_variance END AS b
  FROM quality_metrics WHERE sample_id IS NOT NULL),
best AS (
  SELECT sample_id, arg_max(w, measured_at) FILTER (w IS NOT NULL) AS width, arg_max(h, measured_at) FILTER (h IS NOT NULL) AS height,
    arg_max(b, measured_at) FILTER (b IS NOT NULL) AS blur_variance
  FROM timed GROUP BY 1),
last AS (SELECT sample_id, max(measured_at) AS at FROM timed GROUP BY 1),
flagged AS (SELECT t.sample_id, bool_or(t.bad) AS bad FROM timed t JOIN last USING (sample_id) WHERE t.measured_at IS NOT DISTINCT FROM last.at GROUP BY 1),
members AS (SELECT DISTINCT cluster_id, sample_id FROM decisions WHERE cluster_id IS NOT NULL AND sample_id IS NOT NULL),
rated AS (
  SELECT m.cluster_id, m.sample_id, best.width, best.height, best.blur_variance,
    row_number() OVER (PARTITION BY m.cluster_id ORDER BY coalesce(best.width * best.height, 0) DESC, coalesce(best.blur_variance, -1) DESC, m.sample_id) AS place,
    count(*) OVER (PARTITION BY m.cluster_id) AS eligible_samples
  FROM members m LEFT JOIN best USING (sample_id) LEFT JOIN flagged USING (sample_id) WHERE NOT coalesce(flagged.bad, false))"""

_P7_PAIRS = r"""
listed AS (
  SELECT regexp_extract(filename, '([^/]+?)(\.[A-Za-z0-9]+)?\s*$', 1) AS sample_id,
    CASE WHEN lower(trim(split)) IN ('train', 'trn', 'training') THEN 'train'
         WHEN lower(trim(split)) IN ('val', 'valid', 'validation') THEN 'val'
         WHEN lower(trim(split)) IN ('test', 'testing', 'test_unannotated') THEN 'test' END AS s
  FROM labels),
t AS (SELECT DISTINCT sample_id FROM listed WHERE s = 'train'),
e AS (SELECT DISTINCT sample_id FROM listed WHERE s IN ('val', 'test')),
dig AS (SELECT DISTINCT sample_id, lower(trim(asset_sha256)) AS g FROM quality_metrics WHERE trim(asset_sha256) <> ''),
hs AS (SELECT DISTINCT sample_id, phashes FROM descriptors WHERE phashes IS NOT NULL),
h AS (SELECT DISTINCT sample_id, pos, phashes[pos] AS x FROM hs, unnest(range(1, 9)) AS u(pos) WHERE phashes[pos] IS NOT NULL),
th AS (SELECT h.* FROM h JOIN t USING (sample_id)),
eh AS (SELECT h.* FROM h JOIN e USING (sample_id)),
found AS (
  SELECT a.sample_id AS t_id, b.sample_id AS e_id FROM dig a JOIN t USING (sample_id) JOIN dig b ON a.g = b.g JOIN e ON e.sample_id = b.sample_id
  UNION
  SELECT th.sample_id, eh.sample_id FROM th JOIN eh ON (th.pos = 1 OR eh.pos = 1) AND bit_count(xor(th.x, eh.x)) <= 6)"""

SQL = {
    "p1_found": f"WITH RECURSIVE {_P1_EDGES} SELECT sample_id, group_id FROM groups WHERE group_id IN (SELECT group_id FROM groups GROUP BY 1 HAVING count(*) > 1)",
    "p5_found": f"WITH RECURSIVE {_P5_EDGES} SELECT v AS sample_id, min(c) AS cluster_id FROM walk GROUP BY 1",
    "p5_all": f"WITH RECURSIVE {_P5_EDGES}, found AS (SELECT v, min(c) AS c FROM walk GROUP BY 1) SELECT DISTINCT s.sample_id, coalesce(f.c, s.sample_id) AS cluster_id FROM samples s LEFT JOIN found f ON f.v = s.sample_id WHERE s.sample_id IS NOT NULL",
    "p6_found": f"WITH {_P6_BEST} SELECT cluster_id, sample_id AS representative_id FROM rated WHERE place = 1",
    "p6_survivors": f"WITH {_P6_BEST} SELECT cluster_id, sample_id AS representative_id, width, height, blur_variance, eligible_samples FROM rated WHERE place = 1",
    "p7_found": f"WITH {_P7_PAIRS} SELECT DISTINCT least(t_id, e_id) AS left_id, greatest(t_id, e_id) AS right_id FROM found WHERE t_id <> e_id",
}

SQL["p2_found"] = """
WITH one AS (
  SELECT sample_id, arg_max(histogram, (computed_at IS NOT NULL, computed_at)) AS h FROM descriptors
  WHERE sample_id IS NOT NULL AND len(histogram) = 512 GROUP BY 1),
fine AS MATERIALIZED (
  SELECT sample_id, [x::DOUBLE FOR x IN h]::DOUBLE[512] AS v FROM one
  WHERE len([1 FOR x IN h IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([1 FOR x IN h IF x <> 0]) > 0),
alike AS MATERIALIZED (SELECT a.sample_id AS a, b.sample_id AS b, array_cosine_similarity(a.v, b.v) AS s FROM fine a JOIN fine b ON a.sample_id <> b.sample_id),
ranked AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY round(s, 9) DESC, b) AS place FROM alike)
SELECT DISTINCT least(a, b) AS left_id, greatest(a, b) AS right_id FROM ranked WHERE place <= 20 AND s >= 0.9
"""

#: The parts are what they have to be, and no group is split; the labels and their samples are counted here.
SQL["p1_balance"] = r"""
WITH named AS (
  SELECT DISTINCT sample_id, coalesce(CASE WHEN regexp_replace(lower(source_label), '[\s_-]+', '', 'g') NOT IN ('', 'unknown', 'n/a', 'na', 'n/d', 'nd', 'null', 'none', 'nan', '?', 'desconocido', 'sindato', 'sindatos')
    THEN regexp_replace(lower(source_label), '[\s_-]+', '', 'g') END, 'unlabeled') AS label
  FROM samples WHERE sample_id IS NOT NULL)
SELECT label, count(*) AS samples, true AS balanced FROM named GROUP BY 1
UNION ALL SELECT NULL, 0, true
"""

SQL["p7_report"] = f"""
WITH {_P7_PAIRS},
near AS (SELECT eh.sample_id AS e_id, max(1 - bit_count(xor(th.x, eh.x)) / 64.0::DOUBLE) AS c FROM th JOIN eh ON (th.pos = 1 OR eh.pos = 1) AND th.sample_id <> eh.sample_id AND bit_count(xor(th.x, eh.x)) <= 6 GROUP BY 1),
same AS (SELECT DISTINCT b.sample_id AS e_id, 1.0::DOUBLE AS c FROM dig a JOIN t USING (sample_id) JOIN dig b ON a.g = b.g AND a.sample_id <> b.sample_id JOIN e ON e.sample_id = b.sample_id),
best AS (SELECT e_id, max(c) AS c FROM (SELECT * FROM near UNION ALL SELECT * FROM same) GROUP BY 1),
held AS (SELECT DISTINCT regexp_extract(filename, '([^/]+?)(\\.[A-Za-z0-9]+)?\\s*$', 1) AS e_id, source_dataset,
  CASE WHEN lower(trim(split)) IN ('val', 'valid', 'validation') THEN 'val' WHEN lower(trim(split)) IN ('test', 'testing', 'test_unannotated') THEN 'test' END AS split FROM labels)
SELECT split, source_dataset, count(*) AS samples, count(c) AS leaked, round(sum(coalesce(c, 0)) / count(*), 6) AS coverage FROM held LEFT JOIN best USING (e_id) WHERE split IS NOT NULL AND e_id <> '' GROUP BY 1, 2
"""

SQL["p9_found"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(strip_accents(item_text)), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE item_text IS NOT NULL AND item_id IS NOT NULL),
dw AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[k:k + 9], ' ') FOR k IN range(1, len(w) - 8)]) AS g FROM d WHERE len(w) >= 10),
iw AS (SELECT DISTINCT item_id, unnest([array_to_string(w[k:k + 9], ' ') FOR k IN range(1, len(w) - 8)]) AS g FROM i WHERE len(w) >= 10)
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (g)
"""
