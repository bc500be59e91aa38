"""Spellings of the coordinate systems in use."""

from __future__ import annotations

from .projection import (
    FLATTENING,
    ORTHO_LAT,
    ORTHO_LON,
    SEMI_MAJOR,
    UTM_EASTING,
    UTM_MERIDIAN,
    UTM_SCALE,
)

# Names and identifiers of the public registry entries.
_ELLIPSOID = {
    "name": "WGS 84",
    "semi_major_axis": SEMI_MAJOR,
    "inverse_flattening": round(1 / FLATTENING, 9),
}
_LON = {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"}
_LAT = {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"}


def _geographic(name: str, axes: list[dict], authority: str | None, code: object) -> dict:
    out = {
        "type": "GeographicCRS",
        "name": name,
        "datum": {
            "type": "GeodeticReferenceFrame",
            "name": "World Geodetic System 1984",
            "ellipsoid": _ELLIPSOID,
        },
        "coordinate_system": {"subtype": "ellipsoidal", "axis": axes},
    }
    if authority:
        out["id"] = {"authority": authority, "code": code}
    return out


def _projected(name: str, method: str, parameters: dict, code: int | None) -> dict:
    axes = [
        {"name": "Easting", "abbreviation": "E", "direction": "east", "unit": "metre"},
        {"name": "Northing", "abbreviation": "N", "direction": "north", "unit": "metre"},
    ]
    units = {"scale": "unity", "false": "metre"}
    rows = [
        {
            "name": label,
            "value": value,
            "unit": next((u for word, u in units.items() if word in label.lower()), "degree"),
        }
        for label, value in parameters.items()
    ]
    out = {
        "type": "ProjectedCRS",
        "name": name,
        "base_crs": _geographic("WGS 84", [_LAT, _LON], "EPSG", 4326),
        "conversion": {"name": name, "method": {"name": method}, "parameters": rows},
        "coordinate_system": {"subtype": "Cartesian", "axis": axes},
    }
    if code:
        out["id"] = {"authority": "EPSG", "code": code}
    return out


PROJJSON = {
    "OGC:CRS84": _geographic("WGS 84 (CRS84)", [_LON, _LAT], "OGC", "CRS84"),
    "EPSG:4326": _geographic("WGS 84", [_LAT, _LON], "EPSG", 4326),
    "EPSG:32618": _projected(
        "WGS 84 / UTM zone 18N",
        "Transverse Mercator",
        {
            "Latitude of natural origin": 0,
            "Longitude of natural origin": UTM_MERIDIAN,
            "Scale factor at natural origin": UTM_SCALE,
            "False easting": UTM_EASTING,
            "False northing": 0,
        },
        32618,
    ),
    "ortho": _projected(
        "unknown",
        "Orthographic",
        {
            "Latitude of natural origin": ORTHO_LAT,
            "Longitude of natural origin": ORTHO_LON,
            "False easting": 0,
            "False northing": 0,
        },
        None,
    ),
}

WKT2_CRS84 = (
    'GEOGCRS["WGS 84 (CRS84)",DATUM["World Geodetic System 1984",'
    'ELLIPSOID["WGS 84",6378137,298.257223563,LENGTHUNIT["metre",1]]],'
    'PRIMEM["Greenwich",0,ANGLEUNIT["degree",0.0174532925199433]],'
    'CS[ellipsoidal,2],AXIS["geodetic longitude (Lon)",east,ORDER[1],'
    'ANGLEUNIT["degree",0.0174532925199433]],AXIS["geodetic latitude (Lat)",north,ORDER[2],'
    'ANGLEUNIT["degree",0.0174532925199433]],ID["OGC","CRS84"]]'
)


def footer_crs(crs: object, crs_type: str | None) -> dict | None:
    """The only spelling a Parquet footer allows: a PROJJSON object, or null for unknown."""
    if crs is None or isinstance(crs, dict):
        return crs
    if isinstance(crs, str) and crs in PROJJSON and crs_type in (None, "authority_code"):
        return PROJJSON[crs]
    raise ValueError(f"A Parquet footer needs PROJJSON, not {crs!r}")
