"""Coordinates: regions, oceans, grid cells and compass points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import as_column, nan_to_null

KM_PER_DEGREE = 111
DEFAULT_PRECISION = 2.0
DEFAULT_MAX_KM = 250.0


@dataclass(frozen=True)
class Extent:
    """A closed latitude/longitude box."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def contains(self, lat: str | Column, lon: str | Column) -> Column:
        return as_column(lat).between(self.lat_min, self.lat_max) & as_column(lon).between(self.lon_min, self.lon_max)

    def max_cells(self, precision: float, margin: float = 0.0) -> int:
        """Upper bound on the grid cells whose centre can lie within the box plus a margin."""
        rows = int((self.lat_max - self.lat_min + 2 * margin) / precision) + 2
        cols = int((self.lon_max - self.lon_min + 2 * margin) / precision) + 2
        return rows * cols


# The study region, and the limits of valid coordinates.
NORTH_AMERICA = Extent(5, 83, -180, -50)
GLOBE = Extent(-90, 90, -180, 180)


def wrap_longitude(lon: str | Column) -> Column:
    value = as_column(lon)
    return F.when(value <= 180, value).otherwise(value - 360)


# Ocean names and the coordinates that separate them.
ARCTIC, PACIFIC, ATLANTIC = "Arctic Ocean", "Pacific Ocean", "Atlantic Ocean"
ARCTIC_ABOVE_LAT, PACIFIC_BELOW_LON = 70, -100


def infer_ocean(lat: str | Column, lon: str | Column) -> Column:
    """Ocean of a point in the study region; null when a coordinate is missing."""
    lat, lon = as_column(lat), as_column(lon)
    return (
        F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("string"))
        .when(lat > ARCTIC_ABOVE_LAT, ARCTIC)
        .when(lon < PACIFIC_BELOW_LON, PACIFIC)
        .otherwise(ATLANTIC)
    )


def ocean_by_longitude(lon: str | Column) -> Column:
    """Two-ocean rule of the climate readings; exactly -100 counts as Pacific here."""
    return F.when(as_column(lon) > PACIFIC_BELOW_LON, ATLANTIC).otherwise(PACIFIC)


def cell_index(coordinate: str | Column, precision: float = DEFAULT_PRECISION) -> Column:
    """Integer cell number of a coordinate, rounding halves to even."""
    return F.rint(as_column(coordinate) / precision).cast("bigint")


def snap(coordinate: str | Column, precision: float = DEFAULT_PRECISION) -> Column:
    """Coordinate of the cell centre. Adding 0.0 turns a negative zero into zero."""
    return F.rint(as_column(coordinate) / precision) * precision + F.lit(0.0)


def _padded_tenths(value: Column, width: int) -> Column:
    tenths = F.rint(F.abs(value) * 10).cast("bigint")
    whole = F.floor(tenths / 10).cast("string")
    padded = F.lpad(whole, F.greatest(F.lit(width), F.length(whole)), F.lit("0"))
    return F.concat(padded, F.lit("_"), F.pmod(tenths, F.lit(10)).cast("string"))


def grid_id(grid_lat: str | Column, grid_lon: str | Column) -> Column:
    """Cell name such as ``N024_0W0080_0``; null when a coordinate is null."""
    lat, lon = as_column(grid_lat), as_column(grid_lon)
    return F.concat(
        F.when(lat >= 0, "N").otherwise("S"), _padded_tenths(lat, 3),
        F.when(lon >= 0, "E").otherwise("W"), _padded_tenths(lon, 4),
    )


def planar_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    dlat, dlon = lat_a - lat_b, lon_a - lon_b
    return F.sqrt(dlat * dlat + dlon * dlon) * KM_PER_DEGREE


# The compass points in clockwise order.
CARDINALS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def cardinal_direction(value: str | Column) -> Column:
    """Degrees to one of eight compass points; text is upper-cased and cut to two characters."""
    text = as_column(value).cast("string")
    degrees = nan_to_null(F.pmod(text.try_cast("double"), F.lit(360.0)))
    octant = F.pmod(F.floor((degrees + 22.5) / 45), F.lit(8)).cast("int")
    points = F.array(*[F.lit(c) for c in CARDINALS])
    named = F.when(degrees.isNotNull(), F.element_at(points, octant + 1))
    return F.coalesce(named, F.substring(F.upper(F.trim(text)), 1, 2))
