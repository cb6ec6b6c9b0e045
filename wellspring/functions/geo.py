"""H-27: UTM zone 33N (ETRS89 / GRS80) -> geographic longitude / latitude.

Closed-form inverse transverse Mercator (Krueger series to n^4, published in
Karney 2011, "Transverse Mercator with an accuracy of a few nanometers").
Pure built-in column arithmetic: no projection library, no UDF.  ETRS89 is
taken as WGS84 (they differ by well under a metre).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the UTM 33N projection (GRS80 ellipsoid) -------------
SEMI_MAJOR_AXIS = 6378137.0
INVERSE_FLATTENING = 298.257222101
SCALE_FACTOR = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 0.0
CENTRAL_MERIDIAN_DEG = 15.0
# ---------------------------------------------------------------------------


def series_constants(a: float = SEMI_MAJOR_AXIS, inv_f: float = INVERSE_FLATTENING):
    """Rectifying radius A and the inverse-series coefficients beta, delta."""
    f = 1.0 / inv_f
    n = f / (2.0 - f)
    big_a = a / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    beta = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    delta = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]
    return big_a, beta, delta


def utm_to_lonlat(easting, northing) -> tuple[Column, Column]:
    """Return (lon, lat) in degrees for UTM 33N easting / northing columns."""
    e = F.col(easting) if isinstance(easting, str) else easting
    nn = F.col(northing) if isinstance(northing, str) else northing
    big_a, beta, delta = series_constants()
    k_a = SCALE_FACTOR * big_a
    xi = (nn - F.lit(FALSE_NORTHING)) / F.lit(k_a)
    eta = (e - F.lit(FALSE_EASTING)) / F.lit(k_a)
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        eta_p = eta_p - F.lit(b) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lon = F.lit(CENTRAL_MERIDIAN_DEG) + F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p)))
    return lon, F.degrees(lat)


def utm_to_lonlat_sql(easting: str, northing: str) -> tuple[str, str]:
    """The same series as SQL text (used by the DuckDB oracle)."""
    big_a, beta, delta = series_constants()
    k_a = SCALE_FACTOR * big_a
    xi = f"(({northing} - {FALSE_NORTHING!r}) / {k_a!r})"
    eta = f"(({easting} - {FALSE_EASTING!r}) / {k_a!r})"
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = f"({xi_p} - {b!r} * sin({2.0 * j!r} * {xi}) * cosh({2.0 * j!r} * {eta}))"
        eta_p = f"({eta_p} - {b!r} * cos({2.0 * j!r} * {xi}) * sinh({2.0 * j!r} * {eta}))"
    chi = f"asin(sin({xi_p}) / cosh({eta_p}))"
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = f"({lat} + {d!r} * sin({2.0 * j!r} * {chi}))"
    lon = f"({CENTRAL_MERIDIAN_DEG!r} + degrees(atan2(sinh({eta_p}), cos({xi_p}))))"
    return lon, f"degrees({lat})"
