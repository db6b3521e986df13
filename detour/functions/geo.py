"""Great-circle distance and the grid cells used by the radius join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8  # mean Earth radius (IUGG)


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Haversine distance in metres between two points given in degrees."""
    lat1, lon1, lat2, lon2 = [F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2)]
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_m) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


# Cells are enlarged by this relative margin so rounding can never lose a pair.
CELL_MARGIN = 1e-9


def lat_step(radius_m: float, earth_radius_m: float = EARTH_RADIUS_M) -> float:
    """Height of a latitude band in degrees: a pair within ``radius_m`` lies in the same
    or an adjacent band (hav(d) >= hav(dphi), so dphi <= r / R)."""
    return math.degrees(radius_m / earth_radius_m) * (1 + CELL_MARGIN)


def lat_band(lat, dlat: float) -> Column:
    return F.floor((lat + F.lit(90.0)) / F.lit(dlat))


def lon_cells(band: Column, dlat: float, radius_m: float, earth_radius_m: float = EARTH_RADIUS_M) -> Column:
    """Number of longitude cells of a band, so that a pair within ``radius_m`` with one end
    in the band lies in the same or an adjacent cell of it.

    hav(d) >= cos(phi1) cos(phi2) hav(dlambda) gives sin(dlambda / 2) <= sin(r / 2R) / cos(phi_max);
    the other end is at most one band away, so phi_max is taken over the band and both
    its neighbours. Where the bound reaches the whole circle (at a pole) there is one cell.
    Cells tile the full circle, so the antimeridian wraps.
    """
    south = F.abs((band - F.lit(1)) * F.lit(dlat) - F.lit(90.0))
    north = F.abs((band + F.lit(2)) * F.lit(dlat) - F.lit(90.0))
    c = F.cos(F.radians(F.least(F.greatest(south, north), F.lit(90.0))))
    s = F.lit(math.sin(radius_m / (2 * earth_radius_m))) / F.greatest(c, F.lit(1e-12))
    dlon = F.degrees(F.lit(2.0) * F.asin(F.least(s, F.lit(1.0)))) * F.lit(1 + CELL_MARGIN)
    return F.when(s >= F.lit(1.0), F.lit(1)).otherwise(F.greatest(F.floor(F.lit(360.0) / dlon), F.lit(1))).cast("long")


def lon_cell(lon, n_cells: Column) -> Column:
    return F.pmod(F.floor((lon + F.lit(180.0)) / (F.lit(360.0) / n_cells)), n_cells)


def is_point(lat, lon) -> Column:
    """Coordinates that are a place: no null, NaN, infinity or latitude beyond a pole."""
    return F.coalesce((F.abs(lat) <= F.lit(90.0)) & (F.abs(lon) <= F.lit(1e6)), F.lit(False))


def maybe_within(lat1: Column, cos1: Column, lon1: Column, lat2: Column, cos2: Column, lon2: Column, distance_m: float,
                 radius_m: float = EARTH_RADIUS_M) -> Column:
    """True for every pair within ``distance_m``, and for few others: products only. ``cos1`` and ``cos2`` are of the latitudes.

    sin(x / 2) >= x / 2 (1 - x^2 / 24) for 0 <= x <= pi bounds the haversine from below; gaps in longitude beyond half a turn are left
    to the exact test."""
    def least_sin(deg: Column) -> Column:
        x = F.radians(deg)
        return x * F.lit(0.5) * (F.lit(1.0) - x * x * F.lit(1 / 24))

    u, v = least_sin(lat2 - lat1), least_sin(lon2 - lon1)
    most = math.sin(min(distance_m / (2 * radius_m), math.pi / 2)) ** 2 * (1 + CELL_MARGIN) + 1e-18
    return (F.abs(lon2 - lon1) > F.lit(180.0)) | (u * u + cos1 * cos2 * v * v <= F.lit(most))
