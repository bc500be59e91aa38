"""Small inputs of our own: shapes of every type, and the manifests of a small catalog."""

# At least two values, a null and an empty one for each type; polygons with and without a hole.
WKT = {
    "point": ["POINT (3 -7)", "POINT (12 5)", None, "POINT EMPTY"],
    "linestring": ["LINESTRING (0 1, 6 2, 9 11)", "LINESTRING (-4 8, 1 1)", None, "LINESTRING EMPTY"],
    "polygon": [
        "POLYGON ((0 0, 8 0, 8 6, 0 6, 0 0))",
        "POLYGON ((-10 -10, 14 -10, 14 12, -10 12, -10 -10), (-2 -1, 3 7, 5 -3, -2 -1))",
        None,
        "POLYGON EMPTY",
    ],
    "multipoint": ["MULTIPOINT ((5 6))", "MULTIPOINT ((1 2), (-3 4), (7 -8))", None, "MULTIPOINT EMPTY"],
    "multilinestring": [
        "MULTILINESTRING ((2 3, 4 9))",
        "MULTILINESTRING ((0 1, 5 5, 6 -2), (11 3, 12 8))",
        None,
        "MULTILINESTRING EMPTY",
    ],
    "multipolygon": [
        "MULTIPOLYGON (((1 0, 5 0, 1 5, 1 0)))",
        "MULTIPOLYGON (((1 1, 4 1, 4 3, 1 1)), ((20 20, 26 20, 23 25, 20 20)))",
        "MULTIPOLYGON (((30 30, 50 30, 50 52, 30 30), (38 34, 44 36, 46 40, 38 34)), ((-9 -9, -5 -9, -7 -6, -9 -9)))",
        None,
        "MULTIPOLYGON EMPTY",
    ],
}

# The polygons above with z = x + y and m = x * y.
POLYGON_ZM = [
    "POLYGON ZM ((0 0 0 0, 8 0 8 0, 8 6 14 48, 0 6 6 0, 0 0 0 0))",
    "POLYGON ZM ((-10 -10 -20 100, 14 -10 4 -140, 14 12 26 168, -10 12 2 -120, -10 -10 -20 100), "
    "(-2 -1 -3 2, 3 7 10 21, 5 -3 2 -15, -2 -1 -3 2))",
    None,
    "POLYGON ZM EMPTY",
]

COLLECTIONS = [
    "GEOMETRYCOLLECTION (POINT (3 -7))",
    "GEOMETRYCOLLECTION (POINT (3 -7), LINESTRING (0 1, 6 2, 9 11), MULTIPOINT ((5 6)))",
    "GEOMETRYCOLLECTION ZM (GEOMETRYCOLLECTION ZM (POINT ZM (3 -7 -4 -21)))",
    None,
    "GEOMETRYCOLLECTION EMPTY",
]

# Each group exercises one rule: skipped formats, formats of a file's own, no stated place.
MANIFESTS = [
    {
        "group": "harbours",
        "file_location": "repo",
        "format": ["tsv", "arrows", "arrows/wkb", "geoparquet"],
        "files": [{"name": "berths"}, {"name": "piers-z", "skip_format": ["tsv", "arrows"]}, {"name": "buoys"}],
    },
    {
        "group": "harbours-crs",
        "file_location": "repo",
        "format": ["arrows/wkb", "parquet"],
        "files": [{"name": "gate-utm"}, {"name": "gate-wkt2", "format": ["arrows/wkb"]}],
    },
    {
        "group": "trails",
        "format": ["fgb", "arrows/wkb", "arrows/interleaved"],
        "files": [{"name": "paths"}, {"name": "huts"}, {"name": "tiles", "format": ["arrows/box", "arrows/wkb", "fgb/zip"]}],
    },
]


def formats_of(manifest: dict, file: dict) -> list[str]:
    return [f for f in file.get("format", manifest.get("format", [])) if f not in file.get("skip_format", [])]


FILES_PER_GROUP = {m["group"]: sum(len(formats_of(m, f)) for f in m["files"]) for m in MANIFESTS}
FILES = sum(FILES_PER_GROUP.values())
