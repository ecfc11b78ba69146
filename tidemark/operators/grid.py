"""Grid cells: snapping, the cell catalogue, and assignment to the nearest cell."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import (
    DEFAULT_MAX_KM, DEFAULT_PRECISION, KM_PER_DEGREE, Extent, cell_index, grid_id, planar_km, snap,
)
from tidemark.operators.skew import DEFAULT_SALTS, salted_lookup
from tidemark.schemas import GRID_COLUMNS

# Largest neighbourhood table, counted in candidate cells, that is sent to every task.
MAX_BROADCAST_CANDIDATES = 500_000


def snap_to_grid(
    df: DataFrame, lat: str = "latitude", lon: str = "longitude", precision: float = DEFAULT_PRECISION
) -> DataFrame:
    """Add the centre and the name of the cell each point falls in."""
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    snapped = df.withColumns({
        "grid_lat": F.when(both, snap(lat, precision)),
        "grid_lon": F.when(both, snap(lon, precision)),
    })
    return snapped.withColumn("grid_id", grid_id("grid_lat", "grid_lon"))


def grid_catalog(snapped: DataFrame) -> DataFrame:
    """The distinct cells in use. Names are written for the distinct centres, not for every row."""
    centres = snapped.select("grid_lat", "grid_lon").dropna().distinct()
    return centres.select(grid_id("grid_lat", "grid_lon").alias("grid_id"), "grid_lat", "grid_lon")


def search_rings(precision: float, max_km: float) -> int:
    """How many cells away a centre can be and still lie within reach.

    A point is at most half a cell from its own centre on each axis, so a centre ``k``
    cells off is at least ``(k - 1/2) * precision`` degrees away.
    """
    return math.floor(max_km / KM_PER_DEGREE / precision + 0.5)


def candidate_cells(catalog: DataFrame, precision: float, max_km: float) -> DataFrame:
    """For every cell index, the catalogued cells that a point inside it may be assigned to.

    The catalogue lists each cell once, so a list holds at most ``(2 * rings + 1) ** 2``
    entries. Rows are filtered by centre, not by name: a filter on the name would be
    pushed below the catalogue's own aggregate and name every raw row.
    """
    rings = search_rings(precision, max_km)
    steps = F.sequence(F.lit(-rings), F.lit(rings))
    cells = catalog.select(*GRID_COLUMNS).dropna(subset=["grid_lat", "grid_lon"])
    around = cells.withColumn("di", F.explode(steps)).withColumn("dj", F.explode(steps))
    return (
        around.groupBy(
            (cell_index("grid_lat", precision) + F.col("di")).alias("_cell_i"),
            (cell_index("grid_lon", precision) + F.col("dj")).alias("_cell_j"),
        )
        .agg(F.collect_list(F.struct("grid_lat", "grid_lon", "grid_id")).alias("_candidates"))
    )


def assign_to_nearest_cell(
    target: DataFrame,
    catalog: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    max_km: float = DEFAULT_MAX_KM,
    precision: float = DEFAULT_PRECISION,
    extent: Extent | None = None,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Give each point its nearest catalogued cell within ``max_km``, else null cell columns.

    Each point looks up the candidates of its own cell index and takes the nearest;
    equal distances go to the smaller (grid_lat, grid_lon). ``precision`` is that of
    the catalogue.

    ``extent`` is a box the targets lie in: only cells in reach of it count, so points
    far outside get none. It bounds the number of cells, whatever the number of rows; if
    that bound is small the candidates are broadcast and the target is neither shuffled
    nor sorted. Otherwise the target is shuffled by cell, with every cell spread over
    ``salts`` tasks. The choice does not touch the result.
    """
    rings = search_rings(precision, max_km)
    reach = max_km / KM_PER_DEGREE
    dropped = [c for c in GRID_COLUMNS if c in target.columns]
    points = target.drop(*dropped).withColumns(
        {"_cell_i": cell_index(lat, precision), "_cell_j": cell_index(lon, precision)}
    )
    keys = ["_cell_i", "_cell_j"]
    bound = extent.max_cells(precision, reach) * (2 * rings + 1) ** 2 if extent is not None else None
    if extent is not None:
        catalog = catalog.where(
            F.col("grid_lat").between(extent.lat_min - reach, extent.lat_max + reach)
            & F.col("grid_lon").between(extent.lon_min - reach, extent.lon_max + reach)
        )
    candidates = candidate_cells(catalog, precision, max_km)
    if bound is not None and bound <= MAX_BROADCAST_CANDIDATES:
        found = points.join(F.broadcast(candidates), keys, "left")
    else:
        found = salted_lookup(points, candidates, keys, salts)

    def measured(cell):
        km = planar_km(cell["grid_lat"], cell["grid_lon"], F.col(lat), F.col(lon))
        return F.struct(
            km.alias("km"), cell["grid_lat"].alias("grid_lat"),
            cell["grid_lon"].alias("grid_lon"), cell["grid_id"].alias("grid_id"),
        )

    nearest = found.withColumn("_nearest", F.array_min(F.transform("_candidates", measured)))
    inside = F.col("_nearest.km") <= max_km
    columns = {c: F.when(inside, F.col(f"_nearest.{c}")) for c in GRID_COLUMNS}
    return nearest.withColumns(columns).drop(*keys, "_candidates", "_nearest")


def assignment_counts(assigned: DataFrame) -> DataFrame:
    """Rows, assigned rows and their percentage."""
    return assigned.agg(
        F.count("*").alias("total_rows"), F.count("grid_id").alias("assigned_rows"),
    ).withColumn("assigned_percent", F.round(F.try_divide(F.col("assigned_rows") * 100.0, F.col("total_rows")), 1))
