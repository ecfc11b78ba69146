"""The fused table: observations with monthly climate and the cell's community."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import DEFAULT_PRECISION, Extent
from tidemark.functions.values import month_key
from tidemark.operators.skew import salted_lookup

# Rows of a lookup side that may be broadcast when the extent proves it stays below.
MAX_BROADCAST_ROWS = 100_000
_MONTHS = 12


def suffixed(df: DataFrame, taken: Sequence[str], keys: Sequence[str], suffix: str) -> DataFrame:
    """Append a suffix to the non-key columns whose names are taken already."""
    clash = {c: f"{c}{suffix}" for c in df.columns if c in set(taken) and c not in keys}
    return df.withColumnsRenamed(clash)


def _lookup(left: DataFrame, right: DataFrame, on: list[str], suffix: str, max_rows: int | None, extent: Extent | None,
            precision: float) -> DataFrame:
    renamed = suffixed(right, left.columns, on, suffix)
    if extent is not None:  # whichever join is taken, only cells of the extent count
        half = precision / 2
        lat = "grid_lat" + (suffix if "grid_lat" in left.columns else "")
        lon = "grid_lon" + (suffix if "grid_lon" in left.columns else "")
        renamed = renamed.where(
            F.col(lat).between(extent.lat_min - half, extent.lat_max + half)
            & F.col(lon).between(extent.lon_min - half, extent.lon_max + half)
        )
    if max_rows is None or max_rows > MAX_BROADCAST_ROWS:
        return salted_lookup(left, renamed, on)
    return left.join(F.broadcast(renamed), on, "left")


def lookup_cells(left: DataFrame, right: DataFrame, extent: Extent | None = None, precision: float = DEFAULT_PRECISION) -> DataFrame:
    """``left`` with the columns of ``right``, one row for each ``grid_id`` with its ``grid_lat`` and ``grid_lon``.

    Broadcast when the extent bounds the cells, else salted.
    """
    bound = extent.max_cells(precision) if extent is not None else None
    return _lookup(left, right, ["grid_id"], "_right", bound, extent, precision)


def join_monthly_climate(observations: DataFrame, monthly: DataFrame, extent: Extent | None = None,
                         precision: float = DEFAULT_PRECISION) -> DataFrame:
    """Observations with the monthly climate of their cell; colliding names get ``_climate``.

    ``monthly`` has one row per cell and month. With an extent holding all observations
    the cells, and so the broadcast side, are bounded; without one the join is salted.
    """
    if "month" not in observations.columns:
        observations = observations.withColumn("month", month_key("date"))
    bound = extent.max_cells(precision) * _MONTHS if extent is not None else None
    return _lookup(observations, monthly, ["grid_id", "month"], "_climate", bound, extent, precision)


def join_community(observations: DataFrame, community: DataFrame, extent: Extent | None = None,
                   precision: float = DEFAULT_PRECISION) -> DataFrame:
    """Observations with the species community of their cell; colliding names get ``_species``."""
    bound = extent.max_cells(precision) if extent is not None else None
    return _lookup(observations, community, ["grid_id"], "_species", bound, extent, precision)


def fuse(observations: DataFrame, monthly: DataFrame | None, community: DataFrame | None,
         extent: Extent | None = None, precision: float = DEFAULT_PRECISION) -> DataFrame:
    """One row per observation; a missing side is left out."""
    fused = observations.withColumn("month", month_key("date"))
    if monthly is not None:
        fused = join_monthly_climate(fused, monthly, extent, precision)
    if community is not None:
        fused = join_community(fused, community, extent, precision)
    lead = [*observations.columns, "month"]
    return fused.select(*lead, *[c for c in fused.columns if c not in lead])
