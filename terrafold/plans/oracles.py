"""SQL that gives the same rows as each registered query, from the raw tables."""

from __future__ import annotations

from ..functions.projection import (
    ALPHA,
    FLATTENING,
    ORTHO_LAT,
    ORTHO_LON,
    SEMI_MAJOR,
    UTM_EASTING,
    UTM_MERIDIAN,
    UTM_SCALE,
)
from .catalog import SUFFIXES
from .fixtures import OVERRIDES, PIECE, REF, RELEASE_BASE, REPO_BASE

VERTICES = """vertices AS (
  SELECT user_id, ts, event_id,
    ((event_id * 7919) % 36000) / 1e2 - 180e0 AS x,
    ((user_id * 104729 + event_id * 31) % 17000) / 1e2 - 85e0 AS y
  FROM events)"""

POINTS = f"""{VERTICES}, points AS (
  SELECT event_id AS fid, event_id % 97 = 0 AS is_null,
    event_id % 97 <> 0 AND event_id % 89 = 1 AS is_empty,
    CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 1 THEN x END AS x,
    CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 1 THEN y END AS y
  FROM vertices)"""


def _num(value: str) -> str:
    """Text of a number: whole ones without a decimal point."""
    return f"regexp_replace(CAST({value} AS VARCHAR), '\\.0$', '')"


POINT_TEXT = f"""CASE WHEN is_null THEN NULL WHEN is_empty THEN 'POINT EMPTY'
  ELSE 'POINT (' || {_num('x')} || ' ' || {_num('y')} || ')' END"""

# Pieces overlap by one vertex; a last piece of one vertex belongs to the piece before.
TRACKS = f"""{VERTICES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r FROM vertices),
placed AS (
  SELECT user_id, r // {PIECE - 1} AS piece, r, x, y FROM ranked
  UNION ALL
  SELECT user_id, r // {PIECE - 1} - 1, r, x, y FROM ranked WHERE r > 0 AND r % {PIECE - 1} = 0),
tracks AS (
  SELECT user_id, piece,
    'LINESTRING (' || string_agg({_num('x')} || ' ' || {_num('y')}, ', ' ORDER BY r) || ')' AS wkt,
    min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
  FROM placed GROUP BY user_id, piece HAVING piece = 0 OR count(*) > 1)"""

ORIGINS = """origins AS (
  SELECT p_partkey AS fid,
    ((p_partkey * 7919) % 36000) / 1e2 - 180e0 AS x0,
    ((p_partkey * 104729) % 17000) / 1e2 - 85e0 AS y0,
    (p_size + 1) / 1e3 AS w
  FROM part)"""

_SHELL = [
    ("x0", "y0"), ("x0 + 2 * w", "y0"), ("x0 + 2 * w", "y0 + w"), ("x0 + w", "y0 + w"),
    ("x0 + w", "y0 + 2 * w"), ("x0", "y0 + 2 * w"), ("x0", "y0"),
]
_HOLE = [
    ("x0 + w / 4", "y0 + w / 4"), ("x0 + w / 2", "y0 + w / 4"), ("x0 + w / 2", "y0 + w / 2"),
    ("x0 + w / 4", "y0 + w / 4"),
]


def _list(ring: list[tuple[str, str]]) -> str:
    return "[" + ", ".join(f"{{'x': {x}, 'y': {y}}}" for x, y in ring) + "]"


_HOLE_LIST = f"CASE WHEN fid % 2 = 0 THEN {_list(_HOLE)} ELSE list_reverse({_list(_HOLE)}) END"
RINGS = f"""{ORIGINS}, rings AS (
  SELECT fid, 0 AS ring, {_list(_SHELL)} AS c FROM origins
  UNION ALL SELECT fid, 1, {_HOLE_LIST} FROM origins)"""
# Signed area and moments of each ring around the first vertex of its shell.
MOMENTS = f"""{RINGS}, corners AS (
  SELECT r.fid, ring, i, c[i].x - o.x0 AS px, c[i].y - o.y0 AS py,
    c[i + 1].x - o.x0 AS qx, c[i + 1].y - o.y0 AS qy
  FROM rings r JOIN origins o ON r.fid = o.fid, range(1, 7) g(i) WHERE i < len(c)),
summed AS (
  SELECT fid, ring, sum(px * qy - qx * py) AS a,
    sum((px + qx) * (px * qy - qx * py)) AS sx, sum((py + qy) * (px * qy - qx * py)) AS sy
  FROM corners GROUP BY fid, ring),
weighted AS (
  SELECT fid, ring, CASE WHEN ring = 0 THEN 1 ELSE -1 END * CASE WHEN a < 0 THEN -1 ELSE 1 END AS s, a, sx, sy
  FROM summed)"""


def _centroid(rings: str) -> str:
    return f"""WITH {MOMENTS}
SELECT o.fid, round_even(o.x0 + sum(s * sx) / (3 * sum(s * a)), 8) AS x,
  round_even(o.y0 + sum(s * sy) / (3 * sum(s * a)), 8) AS y
FROM origins o JOIN weighted m ON o.fid = m.fid WHERE {rings} GROUP BY o.fid, o.x0, o.y0"""


def _ring_text(column: str) -> str:
    pair = f"{_num('v.x')} || ' ' || {_num('v.y')}"
    return f"'(' || array_to_string(list_transform({column}, lambda v: {pair}), ', ') || ')'"


REGIONS = """boxes AS (
  SELECT n_name AS name, n_regionkey AS region, n_nationkey * 14 - 180e0 AS xmin,
    CASE WHEN n_nationkey * 14 - 180e0 + 30 > 180 THEN n_nationkey * 14 - 180e0 + 30 - 360
      ELSE n_nationkey * 14 - 180e0 + 30 END AS xmax,
    n_regionkey * 30 - 80e0 AS ymin, n_regionkey * 30 - 80e0 + 25 AS ymax
  FROM nation)"""
_WEST = " ".join(f"WHEN name = '{n}' THEN {w}e0" for n, (w, _) in OVERRIDES.items())
_EAST = " ".join(f"WHEN name = '{n}' THEN {e}e0" for n, (_, e) in OVERRIDES.items())
EDITED = f"""{REGIONS}, edited AS (
  SELECT name, region, CASE {_WEST} ELSE xmin END AS xmin, ymin,
    CASE {_EAST} ELSE xmax END AS xmax, ymax FROM boxes)"""


def _box_ring(west: str, east: str) -> str:
    corners = [(west, "ymin"), (east, "ymin"), (east, "ymax"), (west, "ymax"), (west, "ymin")]
    pairs = " || ', ' || ".join(f"{_num(x)} || ' ' || {_num(y)}" for x, y in corners)
    return f"'((' || {pairs} || '))'"


_FORMATS = "[" + ", ".join(f"'{f}'" for f in SUFFIXES) + "]"
_SUFFIX = "CASE format " + " ".join(f"WHEN '{f}' THEN '{s}'" for f, s in SUFFIXES.items()) + " END"
_FORMAT_OF = "CASE suffix " + " ".join(f"WHEN '{s}' THEN '{f}'" for f, s in SUFFIXES.items()) + " END"
ASSETS = f"""declared AS (
  SELECT p_partkey, p_size,
    translate(lower(replace(p_brand, '#', '-')), '0123456789', 'abcdefghij') AS "group",
    replace(p_name, ' ', '-') || '-' || p_partkey AS name,
    CASE WHEN p_size % 2 = 0 THEN 'repo' ELSE 'release' END AS file_location,
    list_filter({_FORMATS}, lambda f: list_position({_FORMATS}, f) % (p_size % 5 + 2) <> 0) AS formats
  FROM part),
listed AS (
  SELECT d.*, i - 1 AS format_pos, formats[i] AS format
  FROM declared d, range(1, 12) g(i) WHERE i <= len(formats)),
named AS (SELECT *, "group" || '_' || name || {_SUFFIX} AS file FROM listed),
assets AS (
  SELECT *, p_partkey * 16 + format_pos AS ordinal, "group" || '/files/' || file AS path,
    CASE file_location WHEN 'repo' THEN '{REPO_BASE}/{REF}/' || "group" || '/files/' || file
      ELSE '{RELEASE_BASE}/{REF}/' || file END AS url
  FROM named)"""

HILBERT = """cells AS (
  SELECT fid, mx IS NOT NULL AS placed,
    CASE WHEN hx > lx THEN least(65535, greatest(0, CAST(floor((mx - lx) / (hx - lx) * 65535e0) AS BIGINT))) ELSE 0 END AS qx,
    CASE WHEN hy > ly THEN least(65535, greatest(0, CAST(floor((my - ly) / (hy - ly) * 65535e0) AS BIGINT))) ELSE 0 END AS qy
  FROM mids, (SELECT min(x1) AS lx, max(x2) AS hx, min(y1) AS ly, max(y2) AS hy FROM mids)),
keyed AS (
  SELECT fid, CASE WHEN placed THEN list_reduce(
    list_transform(range(15, -1, -1), lambda k: {'x': k, 'y': 0::BIGINT, 'd': 0::BIGINT}),
    lambda s, e: {
      'x': CASE WHEN (s.y >> e.x) & 1 = 1 THEN s.x WHEN (s.x >> e.x) & 1 = 1 THEN 65535 - s.y ELSE s.y END,
      'y': CASE WHEN (s.y >> e.x) & 1 = 1 THEN s.y WHEN (s.x >> e.x) & 1 = 1 THEN 65535 - s.x ELSE s.x END,
      'd': s.d * 4 + xor(3 * ((s.x >> e.x) & 1), (s.y >> e.x) & 1)},
    {'x': qx, 'y': qy, 'd': 0::BIGINT}).d END AS hilbert_key
  FROM cells)"""
POINT_KEYS = f"{POINTS}, mids AS (SELECT fid, (x + x) / 2 AS mx, (y + y) / 2 AS my, x AS x1, x AS x2, y AS y1, y AS y2 FROM points), {HILBERT}"
POINT_ROWS = f"WITH {POINTS} SELECT fid, is_null, x, y FROM points"

_E2 = FLATTENING * (2 - FLATTENING)
_N = FLATTENING / (2 - FLATTENING)
_A = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def _f(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _utm(source: str) -> str:
    """Easting e and northing n of lon, lat in ``source``, with all its columns."""
    north = " + ".join(f"{_f(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))
    east = " + ".join(f"{_f(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))
    e = _f(_E2**0.5)
    return f"""conformal AS (
  SELECT *, radians(lon - ({UTM_MERIDIAN}e0)) AS lam,
    sinh(atanh(sin(radians(lat))) - {e} * atanh({e} * sin(radians(lat)))) AS t FROM {source}),
sphere AS (
  SELECT *, atan2(t, cos(lam)) AS xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS eta FROM conformal),
utm AS (
  SELECT *, {UTM_EASTING} + {_f(UTM_SCALE * _A)} * (eta + {east}) AS e,
    {_f(UTM_SCALE * _A)} * (xi + {north}) AS n FROM sphere)"""


_P0 = f"radians({_f(ORTHO_LAT)})"
_NU = "{a} / sqrt(1 - {e2} * sin({p}) * sin({p}))"
_NU1 = _NU.format(a=_f(SEMI_MAJOR), e2=_f(_E2), p="phi")
_NU0 = _NU.format(a=_f(SEMI_MAJOR), e2=_f(_E2), p=_P0)

ORACLES: dict[str, str] = {
    "hilbert_order": f"WITH {POINT_KEYS} SELECT fid, hilbert_key FROM keyed",
    "hilbert_position": f"""WITH {POINT_KEYS}
SELECT fid, row_number() OVER (ORDER BY hilbert_key NULLS LAST, fid) - 1 AS position FROM keyed""",
    "footprint_clusters": f"""WITH {ORIGINS}, mids AS (
  SELECT fid, (x0 + (x0 + 2 * w)) / 2 AS mx, (y0 + (y0 + 2 * w)) / 2 AS my,
    x0 AS x1, x0 + 2 * w AS x2, y0 AS y1, y0 + 2 * w AS y2 FROM origins), {HILBERT}
SELECT fid, hilbert_key FROM keyed""",
    "point_extent": f"WITH {POINTS} SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM points",
    "track_extent": f"""WITH {VERTICES} SELECT user_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
FROM vertices GROUP BY user_id""",
    "region_extent": f"""WITH {EDITED} SELECT region, min(CASE WHEN xmax < xmin THEN -180e0 ELSE xmin END) AS xmin, min(ymin) AS ymin,
  max(CASE WHEN xmax < xmin THEN 180e0 ELSE xmax END) AS xmax, max(ymax) AS ymax FROM edited GROUP BY region""",
    "footer_limits": f"""WITH {POINTS} SELECT round_even(min(x), 8) AS xmin, round_even(min(y), 8) AS ymin, round_even(min(x + y), 8) AS zmin,
  round_even(max(x), 8) AS xmax, round_even(max(y), 8) AS ymax, round_even(max(x + y), 8) AS zmax FROM points""",
    "footprint_centroid": _centroid("ring = 0"),
    "courtyard_centroid": _centroid("true"),
    "rounded_boxes": f"""WITH {ORIGINS} SELECT fid, round_even(x0, 4) AS xmin, round_even(y0, 4) AS ymin,
  round_even(x0 + 2 * w, 4) AS xmax, round_even(y0 + 2 * w, 4) AS ymax FROM origins""",
    "null_and_empty": f"""WITH {POINTS} SELECT fid, is_null, CASE WHEN is_null THEN NULL ELSE is_empty END AS is_empty,
  x IS NULL AS no_box FROM points""",
    "point_wkb": f"WITH {POINTS} SELECT fid, hex(ST_AsWKB(CAST({POINT_TEXT} AS GEOMETRY))) AS wkb, x, y FROM points",
    "point_wkt": f"WITH {POINTS} SELECT fid, {POINT_TEXT} AS wkt, x, y FROM points",
    "footprint_wkb": f"""WITH {RINGS}, texts AS (
  SELECT fid, 'POLYGON (' || string_agg({_ring_text('c')}, ', ' ORDER BY ring) || ')' AS t FROM rings GROUP BY fid)
SELECT fid, hex(ST_AsWKB(CAST(t AS GEOMETRY))) AS wkb, 2 AS rings, 4 AS hole FROM texts""",
    "track_wkt": f"WITH {TRACKS} SELECT user_id, piece, wkt FROM tracks",
    "track_wkb": f"WITH {TRACKS} SELECT user_id, piece, hex(ST_AsWKB(CAST(wkt AS GEOMETRY))) AS wkb FROM tracks",
    "track_roundtrip": f"WITH {TRACKS} SELECT count(*) AS pieces, CAST(0 AS BIGINT) AS mismatches FROM tracks",
    "vertices_zm": f"""WITH {VERTICES} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, x, y,
  round_even(x + y, 8) AS z, round_even(x * y, 8) + 0e0 AS m FROM vertices""",
    "zm_coords": f"""WITH {POINTS} SELECT fid, round_even(x, 8) AS x, round_even(y, 8) AS y, round_even(x + y, 8) AS z,
  round_even(x * y, 8) + 0e0 AS m FROM points WHERE x IS NOT NULL""",
    "ring_vertices": f"""WITH {RINGS} SELECT fid, ring, CAST(i - 1 AS INTEGER) AS seq, round_even(c[i].x, 8) AS x, round_even(c[i].y, 8) AS y
FROM rings, range(1, 8) g(i) WHERE i <= len(c)""",
    "ring_assembly": "SELECT count(*) AS rows, count(*) AS equal_rows FROM part",
    "layout_switch": f"WITH {POINTS} SELECT fid, CASE WHEN is_null THEN NULL ELSE 2 END AS n, x, y FROM points",
    "mixed_members": """SELECT p_partkey AS fid, '0' AS path, 'POINT (' || p_partkey || ' ' || (p_partkey + 1) || ')' AS wkt FROM part
UNION ALL SELECT p_partkey, '1.0', 'LINESTRING (' || p_partkey || ' ' || (p_partkey * 2) || ', ' || (p_partkey + 3) || ' ' || (p_partkey * 3) || ')' FROM part
UNION ALL SELECT p_partkey, '1.1', 'POINT (' || p_partkey || ' 0)' FROM part""",
    "collection_wkb": """SELECT p_partkey AS fid, hex(ST_AsWKB(CAST('GEOMETRYCOLLECTION (POINT (' || p_partkey || ' ' || (p_partkey + 1)
  || '), GEOMETRYCOLLECTION (LINESTRING (' || p_partkey || ' ' || (p_partkey * 2) || ', ' || (p_partkey + 3) || ' ' || (p_partkey * 3)
  || '), POINT (' || p_partkey || ' 0)))' AS GEOMETRY))) AS wkb, 'GeometryCollection' AS kind FROM part""",
    "geometry_types": """WITH kinds AS (
  SELECT 'GeometryCollection' AS k FROM part UNION ALL SELECT 'Polygon' FROM part
  UNION ALL SELECT 'Point' FROM events WHERE event_id % 97 <> 0
  UNION ALL SELECT 'Point Z' FROM events WHERE event_id % 97 <> 0)
SELECT string_agg(k, ',' ORDER BY k) AS geometry_types FROM (SELECT DISTINCT k FROM kinds)""",
    "line_tags": f"""WITH {POINTS}, texts AS (SELECT coalesce({POINT_TEXT}, '') AS line FROM points)
SELECT count(*) AS lines, count(*) FILTER (line = '') AS blank, count(*) FILTER (regexp_matches(line, '^[A-Z]+')) AS tagged,
  count(*) FILTER (regexp_replace(line, '^[A-Z]+ ', '') = 'EMPTY') AS empties FROM texts""",
    "utm_forward": f"""WITH {VERTICES}, near AS (SELECT event_id AS fid, x / 60e0 - 75e0 AS lon, y AS lat FROM vertices), {_utm('near')}
SELECT fid, round_even(e, 2) AS x, round_even(n, 2) AS y FROM utm""",
    "ortho_forward": f"""WITH {VERTICES}, near AS (
  SELECT event_id AS fid, radians(x / 6e0 - 72.69e0 - ({ORTHO_LON}e0)) AS lam, radians(43.88e0 + y / 4e0) AS phi FROM vertices)
SELECT fid, round_even({_NU1} * cos(phi) * sin(lam), 2) AS x,
  round_even({_NU1} * (sin(phi) * cos({_P0}) - cos(phi) * sin({_P0}) * cos(lam))
    + {_f(_E2)} * ({_NU0} * sin({_P0}) - {_NU1} * sin(phi)) * cos({_P0}), 2) AS y FROM near""",
    "projection_inverse": """SELECT crs, count(*) AS rows, CAST(0 AS BIGINT) AS beyond
FROM events, (VALUES ('EPSG:32618'), ('ortho')) c(crs) GROUP BY crs""",
    "footprint_utm": f"""WITH {RINGS}, near AS (
  SELECT fid, CAST(i - 1 AS INTEGER) AS seq, c[i].x / 60e0 - 75e0 AS lon, c[i].y AS lat
  FROM rings, range(1, 8) g(i) WHERE ring = 0 AND i <= len(c)), {_utm('near')}
SELECT fid, seq, round_even(e, 2) AS x, round_even(n, 2) AS y FROM utm""",
    "box_override": f"""WITH {EDITED} SELECT name, xmin, ymin, xmax, ymax, 'MULTIPOLYGON (' || CASE WHEN xmax < xmin
  THEN {_box_ring('xmin', '180e0')} || ', ' || {_box_ring('-180e0', 'xmax')}
  ELSE {_box_ring('xmin', 'xmax')} END || ')' AS wkt FROM edited""",
    "box_polygon": f"""WITH {REGIONS} SELECT name, CASE WHEN xmax < xmin
  THEN 'MULTIPOLYGON (' || {_box_ring('xmin', '180e0')} || ', ' || {_box_ring('-180e0', 'xmax')} || ')'
  ELSE 'POLYGON ' || {_box_ring('xmin', 'xmax')} END AS wkt FROM boxes""",
    "box_wrap_parts": f"""WITH {REGIONS} SELECT name, 0 AS part, xmin AS west, CASE WHEN xmax < xmin THEN 180e0 ELSE xmax END AS east,
  CAST(5 AS BIGINT) AS corners FROM boxes UNION ALL SELECT name, 1, -180e0, xmax, 5 FROM boxes WHERE xmax < xmin""",
    "region_filter": f"WITH {REGIONS} SELECT name AS region_name, xmin, ymin, xmax, ymax FROM boxes WHERE name = 'NATION_7'",
    "asset_expand": f'WITH {ASSETS} SELECT "group", name, format, path, url FROM assets',
    "asset_listing": f"""WITH {ASSETS}, bullets AS (
  SELECT "group", name, min(ordinal) AS place, string_agg('[' || format || '](' || url || ')', ', ' ORDER BY ordinal) AS links
  FROM assets GROUP BY "group", name)
SELECT "group", '{REF}' AS tag, place, '- ' || name || ' (' || links || ')' AS line FROM bullets
UNION ALL SELECT DISTINCT "group", '{REF}', CAST(-1 AS BIGINT), '## Files' || chr(10) FROM assets""",
    "manifest_lines": f"""WITH {ASSETS} SELECT "group", name, '{{"ref":"{REF}","group":"' || "group" || '","name":"' || name || '","files":['
  || string_agg('{{"format":"' || format || '","url":"' || url || '"}}', ',' ORDER BY format_pos) || ']}}' AS json
FROM assets GROUP BY "group", name""",
    "group_order": f'WITH {ASSETS} SELECT "group", min(ordinal) AS ordinal FROM assets GROUP BY "group"',
    "asset_diff": f"""WITH {ASSETS}, present AS (
  SELECT file FROM assets WHERE p_partkey % 2 = 1
  UNION ALL SELECT 'x' || file FROM assets WHERE p_partkey % 2 = 1 AND format_pos = 0)
SELECT coalesce(a.file, p.file) AS file, CASE WHEN p.file IS NULL THEN 'missing' ELSE 'undeclared' END AS status
FROM assets a FULL JOIN present p ON a.file = p.file WHERE a.file IS NULL OR p.file IS NULL""",
    "name_parse": f"""WITH {ASSETS}, broken AS (
  SELECT ordinal, CASE p_partkey % 5 WHEN 1 THEN path || 'x' WHEN 2 THEN replace(path, '/files/', '/data/')
    WHEN 3 THEN 'other' || path WHEN 4 THEN replace(path, '_', '') ELSE path END AS path FROM assets),
steps AS (SELECT ordinal, string_split(path, '/') AS s FROM broken),
parsed AS (
  SELECT ordinal, s, regexp_matches(s[-1], '^([a-z-]+)_([^_.]+)(.*)$') AS ok,
    regexp_extract(s[-1], '^([a-z-]+)_([^_.]+)(.*)$', ['g', 'n', 's']) AS m FROM steps),
named AS (
  SELECT ordinal, s, ok, CASE WHEN ok THEN m.g END AS "group", CASE WHEN ok THEN m.n END AS name,
    CASE WHEN ok THEN m.s END AS suffix FROM parsed),
known AS (SELECT *, {_FORMAT_OF} AS format FROM named)
SELECT ordinal, "group", name, suffix, format, CASE WHEN NOT ok THEN 'name does not follow the pattern'
  WHEN format IS NULL THEN 'ending belongs to no format' WHEN s[-2] <> 'files' THEN 'folder above it is not files'
  WHEN s[-3] <> "group" THEN 'outside the folder of its group' END AS error FROM known""".replace("named AS (SELECT *", "named0 AS (SELECT *").replace("FROM named)", "FROM named0)", 1),
    "name_filters": f"""WITH {ASSETS}, bases AS (
  SELECT "group", replace(file, '_wkb.arrows', '') AS base FROM assets
  WHERE file_location = 'repo' AND format = 'arrows/wkb' AND file NOT LIKE '.%'
    AND "group" IN ('brand-b', 'brand-h', 'brand-ba', 'brand-bh'))
SELECT base, CASE WHEN base LIKE 'brand-ba%' OR base LIKE 'brand-h%' THEN 'zstd' ELSE 'none' END AS compression
FROM bases WHERE base NOT LIKE '%widget%' AND NOT (base LIKE '%brand-h%' AND base <> 'brand-h_red-bolt-1')
  AND regexp_matches(base, '^[a-z]+')""",
    "parquet_roundtrip": POINT_ROWS,
    "parquet_native_roundtrip": POINT_ROWS,
    "arrow_roundtrip": POINT_ROWS,
    "arrow_interleaved_roundtrip": POINT_ROWS,
    "box_roundtrip": f"WITH {REGIONS} SELECT name, xmin, ymin, xmax, ymax FROM boxes",
    "tsv_roundtrip": f"WITH {POINTS} SELECT is_null, x, y, count(*) AS n FROM points GROUP BY is_null, x, y",
    "delimited_read": POINT_ROWS,
    "geojson_read": _centroid("true"),
    "convert_check": """SELECT CAST(2 AS BIGINT) AS passed, CAST(2 AS BIGINT) AS written, true AS complete,
  (SELECT count(*) FROM events) + (SELECT count(*) FROM part) AS rows""",
    "table_equality": """SELECT event_id AS fid, CAST(1 AS BIGINT) AS surplus FROM events WHERE event_id % 3 = 0
UNION ALL SELECT -event_id - 1, CAST(-1 AS BIGINT) FROM events WHERE event_id % 3 = 0""",
    "manifest_published": f"""WITH {ASSETS} SELECT '{REF}' AS ref, "group", name, format, url FROM assets""",
    "order_kept": f"""WITH {POINT_KEYS}
SELECT fid, row_number() OVER (ORDER BY hilbert_key NULLS LAST, fid) - 1 AS position FROM keyed""",
    "footer_report": f"""WITH {POINTS} SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax,
  'Point' AS geometry_types, 'WKB' AS encoding FROM points""",
    "crs_spellings": """SELECT spelling, crs_type, true AS kept, count(*) AS rows FROM nation,
  (VALUES ('projjson', 'projjson'), ('wkt2', 'wkt2'), ('auth-code', 'authority_code'), ('unknown', NULL)) s(spelling, crs_type)
GROUP BY spelling, crs_type""",
    "published_formats": """SELECT format, count(*) AS rows, CAST(0 AS BIGINT) AS differences FROM events,
  (VALUES ('tsv'), ('arrows'), ('arrows/interleaved'), ('arrows/wkb'), ('arrows/wkt'), ('parquet'), ('geoparquet'),
    ('geoparquet/native')) f(format) GROUP BY format""",
    "line_report": f"""WITH {POINTS} SELECT 'line tag' AS rule, count(*) AS lines FROM points WHERE fid % 11 = 3 AND NOT is_null""",
    "file_headers": "SELECT 'PAR1' AS head, count(*) > 0 AS within_limit FROM events",
    "validation_report": f"""WITH {POINTS}
SELECT CAST(fid AS VARCHAR) AS subject, 'line tag' AS rule FROM points WHERE fid % 11 = 3 AND NOT is_null
UNION ALL SELECT CAST(fid AS VARCHAR), 'wkb header' FROM points WHERE fid % 13 = 4
UNION ALL SELECT CAST(fid AS VARCHAR), 'coordinate size' FROM points WHERE fid % 17 = 5 AND NOT is_null
UNION ALL SELECT CAST(fid AS VARCHAR), 'box limit missing' FROM points WHERE fid % 19 = 6 AND x IS NOT NULL""",
    "size_check": f"""WITH {ASSETS}, sized AS (SELECT path, ordinal * 1000003 % 3000000000 AS length FROM assets)
SELECT path AS subject, 'size' AS rule, CAST(length AS VARCHAR) AS detail FROM sized WHERE length > 2147483647""",
}

from . import file_oracles  # noqa: E402

ORACLES.update(file_oracles.ORACLES)
