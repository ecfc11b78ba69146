"""Delimited files and cached extracts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import RAW_OCCURRENCE_DDL
from tidemark.session import path_exists

# Columns the occurrence export is expected to hold.
EXPECTED_OCCURRENCE_COLUMNS = (
    "scientificName", "kingdom", "phylum", "class", "decimalLatitude", "decimalLongitude",
)


def read_occurrences_tsv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = RAW_OCCURRENCE_DDL, skip_bad: bool = False
) -> DataFrame:
    """Tab-separated UTF-8 occurrences with quoting off.

    Columns are matched by header name (``enforceSchema`` off would demand the exact
    order), so the export may carry more columns than the schema. With ``skip_bad``
    rows whose field count does not fit the header are dropped.
    """
    header = _header_line(spark, path)
    names = header.split("\t")
    types = {f.name: f.dataType for f in _as_struct(schema)} if schema is not None else {}
    read_schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    reader = (
        spark.read.option("sep", "\t").option("quote", "").option("header", True).option("encoding", "UTF-8")
        .option("mode", "DROPMALFORMED" if skip_bad else "PERMISSIVE")
        .schema(read_schema)
    )
    if skip_bad:
        # A pruned CSV scan does not look at the fields it skips, so a bad line would pass.
        reader = reader.option("columnPruning", False)
    return reader.csv(path)


def _as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def _header_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).limit(1).head()
    return first[0] if first is not None else ""


def count_expected_columns(df: DataFrame, expected: Sequence[str] = EXPECTED_OCCURRENCE_COLUMNS) -> int:
    return len(set(expected) & set(df.columns))


# Separators tried in this order.
SEPARATORS = (",", "\t", ";")


def read_delimited(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Read a delimited file with the first separator that yields more than one column.

    Only the header line is looked at to pick the separator. Columns are text unless
    ``infer`` is set, which costs a second pass over the file; cleaners, projections and
    rules coerce text themselves. No usable separator gives an empty frame.
    """
    header = _header_line(spark, path)
    for sep in SEPARATORS:
        if len(header.split(sep)) > 1:
            return (
                spark.read.option("header", True).option("sep", sep).option("multiLine", False)
                .option("escape", '"').option("inferSchema", infer).csv(path)
            )
    return spark.createDataFrame([], T.StructType([]))


def cached_extract(spark: SparkSession, path: str, extract: Callable[[], DataFrame]) -> DataFrame:
    """Reuse a finished extract at ``path``, else run it and write it as Parquet.

    The ``_SUCCESS`` marker tells a finished write from one that broke off.
    """
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        extract().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def placeholder(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """An empty frame with the given columns."""
    return spark.createDataFrame([], schema)


def or_placeholder(df: DataFrame | None, spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """The frame itself, or the empty placeholder when it is missing or has no columns."""
    if df is None or not df.columns:
        return placeholder(spark, schema)
    return df


def load_inferred(df: DataFrame) -> DataFrame:
    """Prepare an inferred frame for bulk loading: NaN becomes null, other values are kept."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns
    ])
