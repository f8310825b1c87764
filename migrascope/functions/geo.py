"""Great-circle expressions and the latitude-band grid used to bucket points.

The grid for a radius r has bands slightly taller than r, each cut into cells at least r wide at
the highest latitude a point of that band or its neighbours can have. Two points within r of each
other therefore lie in the same or in adjacent bands and cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from migrascope.dims import EARTH_RADIUS_KM

BAND_SLACK = 1.000001  # keeps a pair exactly r apart inside adjacent bands
BOUND_SLACK_KM = 1e-6  # covers rounding when distances are bounded through cell centres


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    return F.asin(F.sqrt(F.least(F.lit(1.0), a))) * (2 * EARTH_RADIUS_KM)


def band_height(radius: Column) -> Column:
    return F.degrees(radius / EARTH_RADIUS_KM) * BAND_SLACK


def known(number: Column) -> Column:
    """Grid numbers are never NULL (points without coordinates are filtered before).

    Saying so keeps Spark from pushing ``IS NOT NULL`` tests of these long expressions into scans.
    """
    return F.coalesce(number, F.lit(-1).cast("long"))


def band_of(lat: Column, radius: Column) -> Column:
    return known(F.floor((lat + 90.0) / band_height(radius)))


def cells_in_band(band: Column, radius: Column) -> Column:
    """How many cells the band is cut into; one where the cap around a pole is in reach."""
    height = band_height(radius)
    angle = radius / EARTH_RADIUS_KM
    edge = F.greatest(F.abs((band - 1) * height - 90.0), F.abs((band + 2) * height - 90.0))
    reach = F.degrees(F.asin(F.least(F.lit(1.0), F.try_divide(F.sin(angle), F.cos(F.radians(edge))))))
    cells = F.greatest(F.lit(1), F.floor(F.try_divide(F.lit(360.0), reach)))
    return known(F.when(edge + F.degrees(angle) >= 90.0, F.lit(1)).otherwise(cells).cast("long"))


def turn_fraction(lon: Column) -> Column:
    """Position along the parallel in [0, 1); 180 and -180 coincide."""
    return F.pmod((lon + 180.0) / 360.0, F.lit(1.0))


def cell_of(lon: Column, cells: Column) -> Column:
    return known(F.pmod(F.floor(turn_fraction(lon) * cells), cells))


def bounding_box(lat: float, lon: float, radius_km: float, lat_col: Column, lon_col: Column) -> Column:
    """Cheap pre-filter around one point, in plain comparisons a parquet scan can use.

    No longitude limit where the circle reaches a pole; two ranges where it crosses the 180th
    meridian.
    """
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) * BAND_SLACK
    box = lat_col.between(lat - reach, lat + reach)
    if abs(lat) + reach >= 90:
        return box
    width = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(lat)))))
    west, east = lon - width * BAND_SLACK, lon + width * BAND_SLACK
    if west < -180:
        return box & ((lon_col <= east) | (lon_col >= west + 360))
    if east > 180:
        return box & ((lon_col >= west) | (lon_col <= east - 360))
    return box & lon_col.between(west, east)
