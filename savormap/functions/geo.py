"""Point and distance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
METRICS = ("planar100", "haversine")
_SLACK = 1e-9  # keeps rounding in the box from losing a row the exact test would keep

Number = Column | float


def _col(value: Number) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def wkt_point(latitude: Column, longitude: Column) -> Column:
    """``POINT(lat lon)``, latitude first as the data model has it."""
    return F.concat(
        F.lit("POINT("), latitude.cast("string"), F.lit(" "), longitude.cast("string"), F.lit(")")
    )


_POINT = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+?)\s*\)\s*$"


def wkt_latitude(wkt: Column) -> Column:
    """First ordinate of a WKT point; null for anything else."""
    return F.regexp_extract(wkt, _POINT, 1).try_cast("double")


def wkt_longitude(wkt: Column) -> Column:
    """Second ordinate of a WKT point; null for anything else."""
    return F.regexp_extract(wkt, _POINT, 2).try_cast("double")


def planar100(lat: Number, lon: Number, lat0: Number, lon0: Number) -> Column:
    """Planar distance in degrees times 100, the pipeline's kilometre."""
    dlat, dlon = _col(lat) - _col(lat0), _col(lon) - _col(lon0)
    return F.sqrt(dlat * dlat + dlon * dlon) * F.lit(100.0)


def haversine(lat: Number, lon: Number, lat0: Number, lon0: Number) -> Column:
    """Great-circle distance in kilometres."""
    phi, phi0 = F.radians(_col(lat)), F.radians(_col(lat0))
    half_lat = F.sin((phi - phi0) / 2)
    half_lon = F.sin(F.radians(_col(lon) - _col(lon0)) / 2)
    chord = half_lat * half_lat + F.cos(phi) * F.cos(phi0) * half_lon * half_lon
    return F.asin(F.least(F.sqrt(chord), F.lit(1.0))) * F.lit(2 * EARTH_KM)


def distance_km(
    lat: Number, lon: Number, lat0: Number, lon0: Number, metric: str = "planar100"
) -> Column:
    """Distance under the named metric."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
    return (planar100 if metric == "planar100" else haversine)(lat, lon, lat0, lon0)


def degrees_spanned(km: Number, metric: str = "planar100") -> Column:
    """Latitude degrees a radius of ``km`` reaches."""
    if metric == "planar100":
        return _col(km) / F.lit(100.0) + F.lit(_SLACK)
    return F.degrees(_col(km) / F.lit(EARTH_KM)) + F.lit(_SLACK)


def bounding_box(
    lat: Column, lon: Column, lat0: Number, lon0: Number, km: Number, metric: str = "planar100"
) -> Column:
    """Plain range predicates that every point within ``km`` satisfies.

    With literal centre and radius they fold to constants and reach the
    Parquet scan, where row-group statistics can skip whole files.
    """
    reach = degrees_spanned(km, metric)
    box = (lat >= _col(lat0) - reach) & (lat <= _col(lat0) + reach)
    if metric == "planar100":
        return box & (lon >= _col(lon0) - reach) & (lon <= _col(lon0) + reach)
    ratio = F.sin(_col(km) / F.lit(EARTH_KM)) / F.cos(F.radians(_col(lat0)))
    span = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + F.lit(_SLACK)
    apart = F.abs(lon - _col(lon0))
    over_pole = F.abs(_col(lat0)) + reach >= F.lit(90.0)
    return box & (over_pole | (apart <= span) | (apart >= F.lit(360.0) - span))
