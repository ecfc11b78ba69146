"""Canonical column lists and types."""

from __future__ import annotations

from pyspark.sql import types as T

WAVE_COLUMNS = [
    "wave_direction_dominant", "wave_period_max", "wave_height_max",
    "wind_wave_direction_dominant", "swell_wave_height_max",
]
RANKS = ["kingdom", "phylum", "class", "order", "family", "genus"]
GRID_COLUMNS = ["grid_id", "grid_lat", "grid_lon"]


def _schema(ddl: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in ddl])


def _fields(names: list[str], kind: str) -> list[tuple[str, str]]:
    return [(n, kind) for n in names]


_GRID = [("grid_id", "string"), ("grid_lat", "double"), ("grid_lon", "double")]

# Column names, order and types of the three clean tables.
OBSERVATION_FIELDS = [
    ("date", "date"), ("latitude", "double"), ("longitude", "double"), ("ocean", "string"),
    ("marine_setting", "string"), ("sampling_method", "string"),
    ("concentration_class_range", "string"), ("concentration_class_text", "string"),
    ("unit", "string"), ("microplastics_measurement", "double"), ("objectid", "bigint"), *_GRID,
]
OCCURRENCE_FIELDS = [
    ("scientific_name", "string"), *_fields(RANKS, "string"), ("species", "string"),
    ("latitude", "double"), ("longitude", "double"), ("event_date", "timestamp"),
    ("year", "int"), ("month", "int"), ("day", "int"), ("depth", "double"),
    ("occurrence_status", "string"), ("individual_count", "int"), *_GRID,
]
CLIMATE_FIELDS = [
    ("date", "date"), ("latitude", "double"), ("longitude", "double"), ("ocean", "string"),
    ("marine_setting", "string"), *_fields(WAVE_COLUMNS, "double"), *_GRID,
]

OBSERVATION_COLUMNS = [n for n, _ in OBSERVATION_FIELDS]
OCCURRENCE_COLUMNS = [n for n, _ in OCCURRENCE_FIELDS]
CLIMATE_COLUMNS = [n for n, _ in CLIMATE_FIELDS]


def observation_schema() -> T.StructType:
    return _schema(OBSERVATION_FIELDS)


def occurrence_schema() -> T.StructType:
    return _schema(OCCURRENCE_FIELDS)


def climate_schema() -> T.StructType:
    return _schema(CLIMATE_FIELDS)


# The raw occurrence export as it is landed (tab-separated).
RAW_OCCURRENCE_DDL = (
    "scientificName string, kingdom string, phylum string, class string, `order` string, "
    "family string, genus string, species string, taxonRank string, decimalLatitude double, "
    "decimalLongitude double, depth double, eventDate string, year int, month int, day int, "
    "individualCount int, occurrenceStatus string"
)

# Message rows of the two yearly metrics, and the envelope around them.
METRIC_ROW_DDL = (
    "ocean_region string, environment_type string, avg_concentration double, "
    "total_observations bigint, unit string, total_microplastics bigint, avg_pollution double, "
    "species_count bigint, risk_raw double, risk_index double"
)
ENVELOPE_DDL = (
    "metric_type string, year int, timestamp string, "
    f"data array<struct<{METRIC_ROW_DDL.replace(' double', ':double').replace(' bigint', ':bigint').replace(' string', ':string')}>>, "
    "record_count int"
)
