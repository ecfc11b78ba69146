"""Filters and per-source cleaners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import GLOBE, NORTH_AMERICA, Extent, infer_ocean, wrap_longitude
from tidemark.functions.values import coerce_date, coerce_datetime, coerce_numeric
from tidemark.operators.columns import find_coordinates, quoted, rename_observations, rename_occurrences


def drop_missing_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.dropna(subset=[lat, lon])


def filter_valid_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(GLOBE.contains(quoted(lat), quoted(lon)))


def filter_region(df: DataFrame, extent: Extent = NORTH_AMERICA, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(extent.contains(quoted(lat), quoted(lon)))


def filter_valid_names(df: DataFrame, name: str = "scientific_name", min_length: int = 3) -> DataFrame:
    return df.where(F.length(quoted(name)) >= min_length)


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def filter_any_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(columns))


def filter_in_list(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose value is in the list; an empty list keeps all rows."""
    return df.where(quoted(column).isin(list(values))) if values else df


# Fixed value: first year shown when no range is chosen.
DEFAULT_FIRST_YEAR = 2010


def filter_years(df: DataFrame, column: str = "date", first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows dated within the years, both included; without a range the default first year up to the current one."""
    if first is None and last is None:
        return df.where(F.year(column).between(F.lit(DEFAULT_FIRST_YEAR), F.year(F.current_date())))
    year = F.year(column)
    kept = df.where(year.isNotNull())
    kept = kept if first is None else kept.where(year >= first)
    return kept if last is None else kept.where(year <= last)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order, as offered by a drop-down list."""
    return df.where(quoted(column).isNotNull()).select(column).distinct().orderBy(column)


def is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "string"


def with_inferred_ocean(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Fill ``ocean`` from the coordinates, but only if it is absent or null in every row."""
    inferred = infer_ocean(quoted(lat), quoted(lon))
    if "ocean" not in df.columns:
        return df.withColumn("ocean", inferred)
    # One row at most is read to tell whether any value is present.
    known = df.where("ocean IS NOT NULL").limit(1).agg((F.count("*") > 0).alias("any_known")).scalar()
    return df.withColumn("ocean", F.when(known, F.col("ocean")).otherwise(inferred))


def _numeric_coords_in_region(df: DataFrame, extent: Extent) -> DataFrame:
    lat, lon = find_coordinates(df)
    if lat is None or lon is None:
        return df
    df = df.withColumnsRenamed({lat: "latitude", lon: "longitude"})
    for c in ("latitude", "longitude"):
        if df.schema[c].dataType.typeName() != "double":
            df = df.withColumn(c, coerce_numeric(c))
    return filter_region(df, extent)


def _as_date(df: DataFrame, column: str) -> Column:
    return coerce_date(column) if is_text(df, column) else F.col(column).cast("date")


def clean_observations(df: DataFrame, extent: Extent = NORTH_AMERICA, strict_names: bool = False) -> DataFrame:
    """Rename, coerce, keep the region, infer the ocean where the source gives none."""
    df = _numeric_coords_in_region(rename_observations(df, strict_names), extent)
    if "date" in df.columns:
        df = df.withColumn("date", _as_date(df, "date"))
    return with_inferred_ocean(df) if {"latitude", "longitude"} <= set(df.columns) else df


def with_date_parts(df: DataFrame, column: str = "event_date") -> DataFrame:
    """Add year, month and day of a date unless the frame has them."""
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({n: f(F.col(column)) for n, f in parts.items() if n not in df.columns})


def clean_occurrences(df: DataFrame, extent: Extent = NORTH_AMERICA) -> DataFrame:
    """Rename, keep valid names and the region, read dates. Without a name column: no rows."""
    df = rename_occurrences(df)
    if "scientific_name" not in df.columns:
        return df.limit(0)
    df = _numeric_coords_in_region(filter_valid_names(df), extent)
    if "event_date" in df.columns:
        if is_text(df, "event_date"):
            df = df.withColumn("event_date", coerce_datetime("event_date"))
        df = with_date_parts(df)
    return df


def clean_climate(df: DataFrame, extent: Extent = NORTH_AMERICA) -> DataFrame:
    df = _numeric_coords_in_region(df, extent)
    return df.withColumn("date", _as_date(df, "date")) if "date" in df.columns else df


def normalize_explored(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """The exploration's own cleaning: rename, drop missing, wrap longitudes, keep valid coordinates."""
    df = drop_missing_coords(df.withColumnsRenamed(renames))
    df = df.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})
    return filter_valid_coords(df.withColumn("longitude", wrap_longitude("longitude")))
