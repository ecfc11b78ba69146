"""Column naming and projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Occurrence export names and their canonical names.
OCCURRENCE_NAMES = {
    "scientificName": "scientific_name",
    "kingdom": "kingdom",
    "phylum": "phylum",
    "class": "class",
    "order": "order",
    "family": "family",
    "genus": "genus",
    "species": "species",
    "decimalLatitude": "latitude",
    "decimalLongitude": "longitude",
    "eventDate": "event_date",
    "year": "year",
    "month": "month",
    "day": "day",
    "depth": "depth",
    "occurrenceStatus": "occurrence_status",
    "individualCount": "individual_count",
}

# Lower-cased observation headers and their canonical names.
OBSERVATION_NAMES = {
    "date (mm-dd-yyyy)": "date",
    "latitude (degree)": "latitude",
    "longitude(degree)": "longitude",
    "mesh size (mm)": "mesh_size_mm",
    "microplastics measurement": "microplastics_measurement",
    "marine setting": "marine_setting",
    "sampling method": "sampling_method",
    "concentration class range": "concentration_class_range",
    "concentration class text": "concentration_class_text",
}
# Headers that differ from a canonical column in letter case only.
CASE_ONLY_NAMES = {"ocean": "ocean", "unit": "unit", "objectid": "objectid"}


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def rename_occurrences(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in OCCURRENCE_NAMES.items() if k in df.columns})


def rename_observations(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rename by trimmed lower-cased header. ``strict`` leaves out the case-only names."""
    names = OBSERVATION_NAMES if strict else {**OBSERVATION_NAMES, **CASE_ONLY_NAMES}
    renames = {c: names[c.strip().lower()] for c in df.columns if c.strip().lower() in names}
    return df.withColumnsRenamed(renames)


def find_coordinates(df: DataFrame) -> tuple[str | None, str | None]:
    """First columns whose lower-cased name contains ``lat`` and ``lon``."""
    def first(part: str) -> str | None:
        return next((c for c in df.columns if part in c.lower()), None)

    return first("lat"), first("lon")


def project_fields(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Exactly the given columns in order; a missing one is added as null of its type.

    Text that cannot be read as the wanted type becomes null; whole numbers may be written as decimals.
    """
    kinds = dict(df.dtypes)

    def projected(name: str, kind: str):
        if name not in kinds:
            return F.lit(None).cast(kind)
        if kinds[name] != "string" or kind == "string":
            return quoted(name).try_cast(kind)
        whole = kind.lower() in ("int", "integer", "bigint", "long", "smallint")
        return (quoted(name).try_cast("double") if whole else quoted(name)).try_cast(kind)

    return df.select(*[projected(n, kind).alias(n) for n, kind in fields])


def project_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that exist, or the whole frame when none does."""
    kept = [c for c in columns if c in df.columns]
    return df.select(*[quoted(c) for c in kept]) if kept else df


# The columns the exploration of each source looks at.
OBSERVATION_ANALYSIS_COLUMNS = [
    "latitude", "longitude", "Ocean", "Water Sample Depth (m)", "Marine Setting", "Sampling Method",
    "Volunteers Number", "Standardized Nurdle  Amount", "Concentration class range",
    "Concentration class text", "Unit", "Mesh size (mm)", "measurement", "Collecting Time (min)",
    "Date (MM-DD-YYYY)",
]
OCCURRENCE_ANALYSIS_COLUMNS = [
    "scientificName", "kingdom", "phylum", "class", "order", "family", "genus", "taxonRank",
    "decimalLatitude", "decimalLongitude", "eventDate", "year", "month", "day", "depth", "individualCount",
]


def with_default(df: DataFrame, column: str, value: object) -> DataFrame:
    """Add a constant column unless the frame already has it."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def missing_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]
