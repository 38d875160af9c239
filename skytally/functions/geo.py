"""Great-circle distance and distance bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typing import _c

EARTH_RADIUS_KM = 6371
# Band labels and upper bounds in km.
DISTANCE_BANDS = (
    ("Curta (<500km)", 500),
    ("Media (500-1500km)", 1500),
    ("Longa (1500-3000km)", 3000),
    ("Extra-longa (>3000km)", None),
)
NO_DISTANCE = "Sem coordenadas"


def haversine_km(lat1, lon1, lat2, lon2, decimals: int | None = 1) -> Column:
    """Distance on the sphere; NULL as soon as one coordinate is missing."""
    lat1, lon1, lat2, lon2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    h = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    km = F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_KM)
    return km if decimals is None else F.round(km, decimals)


def distance_band(km, bands=DISTANCE_BANDS, missing: str = NO_DISTANCE) -> Column:
    km = _c(km)
    out = F.when(km.isNull(), F.lit(missing))
    for label, upper in bands:
        if upper is None:
            return out.otherwise(F.lit(label))
        out = out.when(km < upper, F.lit(label))
    return out
