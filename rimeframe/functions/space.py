"""Cells, boxes and bands on latitude, longitude and elevation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv

EARTH_RADIUS_KM = 6371.0088


def cell(coordinate: Column, degrees: float = 1) -> Column:
    """South-west edge of the grid cell: BIGINT for whole degrees, DOUBLE otherwise."""
    if float(degrees).is_integer():
        whole = int(degrees)
        edge = F.floor(coordinate / F.lit(whole))
        return edge if whole == 1 else edge * F.lit(whole)
    return F.floor(coordinate / F.lit(degrees)) * F.lit(degrees)


def cell_centre(edge: Column, degrees: float = 1) -> Column:
    return edge + F.lit(degrees / 2.0)


def in_box(latitude: Column, longitude: Column, box: dict, country: Column | None = None) -> Column:
    """Inclusive box test; a box with a country also needs a country column to compare."""
    inside = latitude.between(*box["lat"]) & longitude.between(*box["lon"])
    if box.get("country") and country is not None:
        inside = (country == F.lit(box["country"])) & inside
    return inside


def boxes_containing(
    latitude: Column, longitude: Column, boxes: dict[str, dict], country: Column | None = None
) -> Column:
    """Array of the names of all boxes that hold the point (possibly none)."""
    named = [
        F.when(in_box(latitude, longitude, box, country), F.lit(name))
        for name, box in boxes.items()
    ]
    return F.array_compact(F.array(*named))


def unit_vector(latitude: Column, longitude: Column) -> dict[str, Column]:
    """The position as a point of the unit sphere: no seam at the date line, no poles."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the sphere of mean radius, by the haversine form, which is exact for near points."""
    north = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    east = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    root = F.sqrt(north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(root, F.lit(1.0)))


def elevation_band(elevation_m: Column, width_m: int = fv.ELEVATION_BAND_M) -> Column:
    """Lower edge of the band, truncated toward zero (so -10 falls into band 0)."""
    return (elevation_m / F.lit(width_m)).cast("int") * F.lit(width_m)


def in_latitude_band(latitude: Column, band: tuple[float, float] = fv.MID_LATITUDE_BAND) -> Column:
    return F.abs(latitude).between(*band)
