"""Projection and planar-distance expressions (plain column math, no UDF).

The projection is the published Krueger series for transverse Mercator
(accurate to well under a millimetre inside a UTM zone); constants are the
WGS84 ellipsoid and UTM parameters listed in ``dryspell.schemas``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dryspell import schemas as S


def _series_constants(a: float = S.WGS84_A, inv_f: float = S.WGS84_INV_F):
    f = 1.0 / inv_f
    n = f / (2.0 - f)
    big_a = a / (1.0 + n) * (1.0 + n ** 2 / 4.0 + n ** 4 / 64.0)
    alpha = (n / 2.0 - 2.0 * n ** 2 / 3.0 + 5.0 * n ** 3 / 16.0,
             13.0 * n ** 2 / 48.0 - 3.0 * n ** 3 / 5.0,
             61.0 * n ** 3 / 240.0)
    c = 2.0 * math.sqrt(n) / (1.0 + n)
    return big_a, alpha, c


def utm_easting_northing(lat: str, lon: str, zone: int | None = S.UTM_ZONE) -> tuple[Column, Column]:
    """(easting, northing) in metres, from column names.

    ``zone`` fixes the central meridian (default 19, the boundary file's
    projection; false northing 10,000,000 m as in a south zone). With
    ``zone=None`` each point uses its own zone and hemisphere. One SQL
    expression each, so building the plan costs a few JVM calls.
    """
    big_a, alpha, c = _series_constants()
    d = lambda v: f"CAST({v!r} AS DOUBLE)"  # noqa: E731 - exact double literals
    if zone is None:
        lon0 = f"(floor(({lon} + 180.0D) / 6.0D) * 6.0D - 177.0D)"
        n0 = f"(CASE WHEN {lat} < 0 THEN {d(S.UTM_FALSE_NORTHING_SOUTH)} ELSE 0.0D END)"
    else:
        lon0 = d(6.0 * zone - 183.0)
        n0 = d(S.UTM_FALSE_NORTHING_SOUTH)
    sin_phi = f"sin(radians({lat}))"
    t = f"sinh(atanh({sin_phi}) - {d(c)} * atanh({d(c)} * {sin_phi}))"
    dl = f"radians({lon} - {lon0})"
    xi = f"atan2({t}, cos({dl}))"
    eta = f"atanh(sin({dl}) / sqrt(1.0D + {t} * {t}))"
    e_sum, n_sum = eta, xi
    for j, aj in enumerate(alpha, start=1):
        e_sum = f"({e_sum} + {d(aj)} * cos({2.0 * j!r}D * {xi}) * sinh({2.0 * j!r}D * {eta}))"
        n_sum = f"({n_sum} + {d(aj)} * sin({2.0 * j!r}D * {xi}) * cosh({2.0 * j!r}D * {eta}))"
    ka = d(S.UTM_K0 * big_a)
    return (F.expr(f"({d(S.UTM_FALSE_EASTING)} + {ka} * {e_sum})"), F.expr(f"({n0} + {ka} * {n_sum})"))


def segment_param_sql(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    """SQL text: position u in [0, 1] of the point of segment AB closest to P.

    A degenerate segment (A == B) divides by NULL; ``least``/``greatest``
    skip the NULL and clamp to 1, which is the point A itself.
    """
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    return (f"greatest(0.0D, least(1.0D, (({px} - {ax}) * {dx} + ({py} - {ay}) * {dy})"
            f" / nullif({dx} * {dx} + {dy} * {dy}, 0.0D)))")


def distance_sq_at_sql(px: str, py: str, ax: str, ay: str, bx: str, by: str, u: str) -> str:
    """SQL text: squared distance from P to the point A + u (B - A)."""
    qx, qy = f"({ax} + {u} * ({bx} - {ax}))", f"({ay} + {u} * ({by} - {ay}))"
    return f"(({px} - {qx}) * ({px} - {qx}) + ({py} - {qy}) * ({py} - {qy}))"


def segment_distance_sq(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> Column:
    """Squared distance from point P to segment AB (one expression)."""
    return F.expr(distance_sq_at_sql(px, py, ax, ay, bx, by, segment_param_sql(px, py, ax, ay, bx, by)))
