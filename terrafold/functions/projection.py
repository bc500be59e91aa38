"""Closed-form projections between the coordinate systems in use.

Each formula is a generator over a math namespace: it yields the intermediate values
it wants bound and receives them back. Points bind them as columns of chained
projections (generated JVM code); nested geometries run the same formula on the flat
ordinates of an Arrow batch.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .types import NESTING, storage_type

# WGS 84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563

# Transverse Mercator, zone 18 north.
UTM_SCALE = 0.9996
UTM_MERIDIAN = -75.0
UTM_EASTING = 500000.0

# Fixed value: the series holds up to this easting in radians; beyond it there is no result.
UTM_LIMIT = 2.623395162778

# Centre of the orthographic projection.
ORTHO_LAT = 43.88
ORTHO_LON = -72.69

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)
_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)

# Series coefficients of the third flattening, lowest power first
# (forward, inverse, and conformal to geographic latitude).
_ALPHA = [
    [1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800],
    [13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360],
    [61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440],
    [49561 / 161280, -179 / 168, 6601661 / 7257600],
    [34729 / 80640, -3418889 / 1995840],
    [212378941 / 319334400],
]
_BETA = [
    [1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800],
    [1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720],
    [17 / 480, -37 / 840, -209 / 4480, 5569 / 90720],
    [4397 / 161280, -11 / 504, -830251 / 7257600],
    [4583 / 161280, -108847 / 3991680],
    [20648693 / 638668800],
]
_DELTA = [
    [2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675],
    [7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945],
    [56 / 15, -136 / 35, -1262 / 105, 73814 / 2835],
    [4279 / 630, -332 / 35, -399572 / 14175],
    [4174 / 315, -144838 / 6237],
    [601676 / 22275],
]


def _series(rows: list[list[float]]) -> list[float]:
    return [sum(c * _N ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]


ALPHA, BETA, DELTA = _series(_ALPHA), _series(_BETA), _series(_DELTA)

_SPARK = SimpleNamespace(
    sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, asin=F.asin, sqrt=F.sqrt,
    asinh=F.asinh, atanh=F.atanh, atan2=F.atan2, abs=F.abs,
    where=lambda test, yes, no: F.when(test, F.lit(yes)).otherwise(no),
)
_NUMPY = SimpleNamespace(
    sin=np.sin, cos=np.cos, sinh=np.sinh, cosh=np.cosh, asin=np.arcsin, sqrt=np.sqrt,
    asinh=np.arcsinh, atanh=np.arctanh, atan2=np.arctan2, abs=np.abs, where=np.where,
)


def _identity(m, x, y):
    return x, y
    yield


def _utm_forward(m, lon, lat):
    phi = lat * (math.pi / 180)
    lam = (lon - UTM_MERIDIAN) * (math.pi / 180)
    sin_phi, cos_lam, sin_lam = yield m.sin(phi), m.cos(lam), m.sin(lam)
    (t,) = yield (m.sinh(m.atanh(sin_phi) - m.atanh(sin_phi * _E) * _E),)
    xi, eta = yield m.atan2(t, cos_lam), m.asinh(sin_lam / m.sqrt(t * t + cos_lam * cos_lam))
    north, east = xi, eta
    for j, a in enumerate(ALPHA, 1):
        north = north + m.sin(xi * (2.0 * j)) * m.cosh(eta * (2.0 * j)) * a
        east = east + m.cos(xi * (2.0 * j)) * m.sinh(eta * (2.0 * j)) * a
    north, east = yield north, east
    # Not a number stays that; Spark orders it above infinity, numpy nowhere.
    outside = (m.abs(east) > UTM_LIMIT) & (m.abs(east) <= math.inf)
    return (
        m.where(outside, math.inf, east * (UTM_SCALE * _RECTIFYING) + UTM_EASTING),
        m.where(outside, math.inf, north * (UTM_SCALE * _RECTIFYING)),
    )


def _utm_inverse(m, easting, northing):
    xi, eta = yield (
        northing / (UTM_SCALE * _RECTIFYING),
        (easting - UTM_EASTING) / (UTM_SCALE * _RECTIFYING),
    )
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, 1):
        xi1 = xi1 - m.sin(xi * (2.0 * j)) * m.cosh(eta * (2.0 * j)) * b
        eta1 = eta1 - m.cos(xi * (2.0 * j)) * m.sinh(eta * (2.0 * j)) * b
    xi1, eta1 = yield xi1, eta1
    chi, lam = yield (
        m.asin(m.sin(xi1) / m.cosh(eta1)),
        m.atan2(m.sinh(eta1), m.cos(xi1)),
    )
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + m.sin(chi * (2.0 * j)) * d
    return lam * (180 / math.pi) + UTM_MERIDIAN, phi * (180 / math.pi)


_SIN0, _COS0 = math.sin(math.radians(ORTHO_LAT)), math.cos(math.radians(ORTHO_LAT))
_NU0 = SEMI_MAJOR / math.sqrt(1 - _E2 * _SIN0**2)


def _ortho_forward(m, lon, lat):
    phi = lat * (math.pi / 180)
    lam = (lon - ORTHO_LON) * (math.pi / 180)
    sin_phi, cos_phi, cos_lam, sin_lam = yield m.sin(phi), m.cos(phi), m.cos(lam), m.sin(lam)
    (nu,) = yield (SEMI_MAJOR / m.sqrt(sin_phi * sin_phi * -_E2 + 1.0),)
    x = nu * cos_phi * sin_lam
    y = nu * (sin_phi * _COS0 - cos_phi * cos_lam * _SIN0) + (
        nu * sin_phi * -1.0 + _NU0 * _SIN0
    ) * (_E2 * _COS0)
    # The far side of the globe is not visible from the plane.
    hidden = sin_phi * _SIN0 + cos_phi * cos_lam * _COS0 < 0
    return m.where(hidden, math.inf, x), m.where(hidden, math.inf, y)


def _ortho_inverse(m, x, y):
    # The point in the tangent frame of the centre is (x, y, u) with u along the normal;
    # putting it on the ellipsoid X² + Y² + Z²/(1-e²) = a² gives a quadratic in u.
    x0, z0 = _NU0 * _COS0, _NU0 * (1 - _E2) * _SIN0
    k = 1 / (1 - _E2)
    base_x, base_z = y * -_SIN0 + x0, y * _COS0 + z0
    a = _COS0**2 + k * _SIN0**2
    half_b, c = yield (
        base_x * _COS0 + base_z * (k * _SIN0),
        base_x * base_x + x * x + base_z * base_z * k - SEMI_MAJOR**2,
    )
    (u,) = yield ((m.sqrt(half_b * half_b - c * a) - half_b) / a,)
    px, pz = yield y * -_SIN0 + u * _COS0 + x0, y * _COS0 + u * _SIN0 + z0
    lam = m.atan2(x, px)
    phi = m.atan2(pz * k, m.sqrt(px * px + x * x))
    return lam * (180 / math.pi) + ORTHO_LON, phi * (180 / math.pi)


# Longitude/latitude on the left; the axis order of stored coordinates is x = longitude
# for both geographic systems, so they differ by their tag only.
FORMULAS = {
    "OGC:CRS84": (_identity, _identity),
    "EPSG:4326": (_identity, _identity),
    "EPSG:32618": (_utm_forward, _utm_inverse),
    "ortho": (_ortho_forward, _ortho_inverse),
}


def _steps(src: str, dst: str) -> list:
    for name in (src, dst):
        if name not in FORMULAS:
            raise ValueError(f"No closed form for {name!r}")
    return [FORMULAS[src][1], FORMULAS[dst][0]]


def _run(formula, m, x, y, bind):
    work = formula(m, x, y)
    try:
        values = next(work)
        while True:
            values = work.send(bind(values))
    except StopIteration as done:
        return done.value


def project_numbers(x: np.ndarray, y: np.ndarray, src: str, dst: str):
    with np.errstate(invalid="ignore"):
        for formula in _steps(src, dst):
            x, y = _run(formula, _NUMPY, x, y, lambda values: values)
    return x, y


def project_columns(df: DataFrame, x: Column, y: Column, src: str, dst: str):
    """Projected x and y columns, and the table extended by what they are computed from."""
    kept, bound = df.columns, 0

    def bind(values):
        nonlocal df, bound
        names = [f"__p{bound + i}" for i in range(len(values))]
        bound += len(values)
        df = df.select("*", *[v.alias(n) for v, n in zip(values, names)])
        return [F.col(n) for n in names]

    x, y = bind([x, y])
    for formula in _steps(src, dst):
        x, y = bind(_run(formula, _SPARK, x, y, bind))
    return df, x, y, kept


def project_nested(geom: Column, kind: str, dims: str, src: str, dst: str) -> Column:
    """Project every coordinate of a nested value; z and m stay as they are."""

    def rebuild(values: pa.Array, level: int) -> pa.Array:
        if level:
            # Flattening drops what lies under null lists, so offsets come from the lengths.
            lengths = values.value_lengths().fill_null(0).to_numpy()
            ends = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(lengths, out=ends[1:])
            inner = rebuild(values.flatten(), level - 1)
            return pa.ListArray.from_arrays(pa.array(ends), inner, mask=values.is_null())
        x, y = (values.field(d).to_numpy(zero_copy_only=False) for d in "xy")
        x, y = project_numbers(x, y, src, dst)
        rest = [values.field(d) for d in dims[2:]]
        return pa.StructArray.from_arrays([pa.array(x), pa.array(y), *rest], names=list(dims))

    @arrow_udf(storage_type(kind, dims))
    def project(values: pa.Array) -> pa.Array:
        return rebuild(values, NESTING[kind])

    return project(geom)
