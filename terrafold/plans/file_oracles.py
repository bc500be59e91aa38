"""SQL for the queries over files, versions, listings and lists."""

from __future__ import annotations

from ..operators.extent import ARC_CELLS
from .fixtures import DAMAGES, REF
from .oracles import ASSETS, EDITED, ORIGINS, POINT_KEYS, POINT_TEXT, POINTS, VERTICES
from .publish import FORMS

# The bounds and faults that the queries state; written here again so that the SQL stands by itself.
BATCH, BUCKETS, SWAP = 700, 8, 4000
_NOTE = """'a "' || p_name || '" [' || p_partkey || '] {' || p_brand || '} \\ ]},"features":[ \\"é'"""

# Rules that each damage of a file of each format breaks.
_RULES = {
    "arrows": ("", "contents", "contents", "contents"),
    "geoparquet": ("", "contents", "contents", "contents"),
    "tsv": ("", "", "header, no rows", "header, line tag"),
    "fgb": ("", "magic", "magic", "magic"),
    "fgb/zip": ("", "archive members, magic", "archive members, magic", "archive members, magic"),
}
_CHECKED = [f for f in [*FORMS, "fgb", "fgb/zip"] if f not in ("arrows/box", "parquet")]
_DAMAGED = ", ".join(
    f"('{fmt}', '{damage}', '{rules}')"
    for fmt in _CHECKED
    for damage, rules in zip(DAMAGES, _RULES.get(fmt) or _RULES[fmt.split("/")[0]])
)

# Arcs of boxes on the circle, begun from where nothing reached before.
_SWEEP = f"""unrolled AS (SELECT key, xmin AS w, CASE WHEN xmax < xmin THEN xmax + 360e0 ELSE xmax END AS e, xmax, ymin, ymax FROM arcs),
reached AS (
  SELECT *, max(struct_pack(e := e, x := xmax)) OVER (PARTITION BY key ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    max(struct_pack(e := e, x := xmax)) OVER (PARTITION BY key) AS around
  FROM unrolled),
gaps AS (
  SELECT *, CASE WHEN before IS NULL OR before.e < around.e - 360e0 THEN around.x ELSE before.x END AS reach_x,
    w - CASE WHEN before IS NULL OR before.e < around.e - 360e0 THEN around.e - 360e0 ELSE before.e END AS gap FROM reached),
widest AS (SELECT * FROM gaps QUALIFY row_number() OVER (PARTITION BY key ORDER BY gap DESC, w) = 1),
heights AS (SELECT key, min(ymin) AS ymin, max(ymax) AS ymax FROM unrolled GROUP BY key)"""

ORACLES: dict[str, str] = {
    "bounded_parts": f"WITH {POINTS} SELECT fid, x, y, true AS within, true AS described FROM points",
    "chunk_sizes": f"""WITH sizes AS (SELECT event_id % {BUCKETS} AS b, count(*) AS n FROM events GROUP BY b),
pieces AS (SELECT least({BATCH}, n - i * {BATCH}) AS rows FROM (SELECT n, unnest(range((n + {BATCH} - 1) // {BATCH})) AS i FROM sizes))
SELECT rows::BIGINT AS rows, count(*) AS batches, count(*) AS groups FROM pieces GROUP BY rows""",
    "footer_conflicts": """SELECT 'crs' AS property, 'EPSG:32618' AS found, 'OGC:CRS84' AS expected, count(*) AS rows FROM events WHERE event_id % 5 = 3
UNION ALL SELECT 'edges', 'spherical', NULL, count(*) FROM events WHERE event_id % 5 = 4""",
    "tags_kept": """SELECT change, format, edges, crs_type, count(*) AS rows FROM events, (VALUES
  ('edges', 'arrows/wkb', 'spherical', 'authority_code'), ('edges', 'geoparquet', 'spherical', 'authority_code'),
  ('spelling', 'arrows/wkb', NULL, 'wkt2:2019'), ('spelling', 'arrows', NULL, 'wkt2:2019')) t(change, format, edges, crs_type)
GROUP BY change, format, edges, crs_type""",
    "republish": """SELECT stage, count(*) AS rows, sum(sign * event_id)::BIGINT AS total FROM events,
  (VALUES ('first', 1), ('after a failure', 1), ('second', -1)) s(stage, sign) GROUP BY stage""",
    "order_difference": f"""WITH l AS (SELECT event_id AS fid, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events),
r AS (SELECT fid, place + CASE place % {SWAP} WHEN 17 THEN 1 WHEN 18 THEN -1 ELSE 0 END AS place FROM l)
SELECT coalesce(l.place, r.place) AS place, l.fid AS left_fid, r.fid AS right_fid
FROM l FULL JOIN r ON l.place = r.place WHERE l.fid IS DISTINCT FROM r.fid""",
    "wrapped_extent": f"""WITH {EDITED}, {VERTICES}, arcs AS (
  SELECT 'region ' || region AS key, xmin, xmax, ymin, ymax FROM edited
  UNION ALL SELECT 'user ' || user_id, x, x, y, y FROM vertices), {_SWEEP}
SELECT key, CASE WHEN gap >= 360e0 / {ARC_CELLS} THEN w ELSE -180e0 END AS xmin, h.ymin,
  CASE WHEN gap >= 360e0 / {ARC_CELLS} THEN reach_x ELSE 180e0 END AS xmax, h.ymax FROM widest JOIN heights h USING (key)""",
    "json_ranges": f"""WITH {ORIGINS} SELECT fid, {_NOTE} AS note, x0 + 2 * w AS x, y0 + w AS y, CAST(NULL AS VARCHAR) AS cause
FROM origins JOIN part ON fid = p_partkey""",
    "damaged_features": """WITH judged AS (SELECT CASE WHEN p_partkey % 13 = 4 THEN 'no JSON' WHEN p_partkey % 17 = 5 THEN 'no feature'
  WHEN p_partkey % 19 = 6 THEN 'Not a Polygon: Point' WHEN p_partkey % 23 = 7 THEN 'extra ordinates'
  WHEN p_partkey % 29 = 8 THEN 'coordinates' ELSE 'none' END AS cause FROM part)
SELECT cause, count(*) AS records, CASE WHEN cause = 'none' THEN count(*) END AS observed FROM judged GROUP BY cause""",
    "asset_checks": f"SELECT * FROM (VALUES {_DAMAGED}) t(format, damage, rules) WHERE (SELECT count(*) FROM events) > 0",
    "bad_footers": """SELECT form, n_nationkey, rule FROM nation, (VALUES (1, 'geo footer'), (2, 'primary column'), (3, 'single column'),
  (4, 'encoding'), (5, 'geometry types'), (6, 'crs'), (7, 'geometry not last'), (8, 'wkb is binary'),
  (1, 'primary column'), (1, 'single column'), (1, 'encoding'), (1, 'geometry types')) f(fault, rule), (VALUES ('footers'), ('assets')) t(form)
WHERE n_nationkey % 9 = fault AND (form = 'footers' OR fault <> 1 OR rule = 'geo footer')""",
    "stream_checks": """SELECT n_nationkey, rule FROM nation, (VALUES (1, 'extension name'), (2, 'extension metadata'), (3, 'geometry not last'),
  (4, 'geometry missing'), (5, 'wkb is binary')) f(fault, rule) WHERE n_nationkey % 6 = fault""",
    "manifest_object": f"""WITH {ASSETS} SELECT '{REF}' AS ref, "group", name, format, url,
  (dense_rank() OVER (ORDER BY "group") - 1)::INTEGER AS group_pos FROM assets""",
    "manifest_texts": f"""WITH {ASSETS} SELECT "group", CASE WHEN p_partkey % 2 = 0 THEN file_location ELSE 'release' END AS file_location, name, format
FROM assets""",
    "unnested_manifest": f"""WITH {ASSETS} SELECT '{REF}' AS ref, "group" AS name, name AS files_name, format AS files_format, url AS files_url FROM assets""",
    "asset_files": f"""WITH {ASSETS} SELECT "group", sum(strlen(path) + 1)::BIGINT AS bytes FROM assets GROUP BY ALL""",
    "merged_lists": """WITH items AS (
  SELECT 'list-' || n_regionkey AS name, n_regionkey AS r, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INTEGER AS pos,
    CASE WHEN n_nationkey % 3 > 0 THEN CASE WHEN n_regionkey >= 3 THEN 'later ' ELSE 'first ' END || n_nationkey END AS wkt FROM nation)
SELECT name, pos, wkt FROM items
UNION ALL SELECT 'both', (row_number() OVER (ORDER BY r DESC, pos) - 1)::INTEGER, wkt FROM items WHERE r IN (1, 4)""",
    "paired_lists": """SELECT n_regionkey, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INTEGER AS pos,
  n_nationkey AS key, n_name AS label FROM nation""",
    "text_beside": f"""WITH {POINTS}, texts AS (SELECT {POINT_TEXT} AS wkt FROM points)
SELECT wkt, hex(ST_AsWKB(CAST(wkt AS GEOMETRY))) AS wkb, 'wkt,geometry' AS columns FROM texts""",
    "first_on_curve": f"WITH {POINT_KEYS} SELECT fid, hilbert_key FROM keyed ORDER BY hilbert_key NULLS LAST, fid LIMIT 1",
}
