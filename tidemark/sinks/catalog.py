"""Bulk loads into catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.columns import quoted
from tidemark.sources.files import load_inferred


def _lost(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value cannot be held by the target type: it becomes null, or another number."""
    cast = value.try_cast(target)
    gone = cast.isNull()
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        gone = gone | ~cast.cast(source).eqNullSafe(value)
    return value.isNotNull() & gone


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in a table's columns and types, or a ValueError that names what does not fit.

    Columns are matched by name and must be the same; a value that its column's type cannot hold is an error, not null.
    """
    missing = [c for c in schema.names if c not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if missing or extra:
        raise ValueError(f"missing columns: {', '.join(missing) or 'none'}; unknown columns: {', '.join(extra) or 'none'}")
    changed = [f for f in schema.fields if df.schema[f.name].dataType != f.dataType]
    if changed:
        lost = [F.count_if(_lost(quoted(f.name), df.schema[f.name].dataType, f.dataType)).alias(f"n{i}") for i, f in enumerate(changed)]
        counts = df.agg(*lost).first()
        wrong = [f"{f.name}: {n} values are no {f.dataType.simpleString()}" for f, n in zip(changed, counts, strict=True) if n]
        if wrong:
            raise ValueError("; ".join(wrong))
    return df.select(*[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def load_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Load a batch into the catalog table ``name`` and return the table.

    The first batch creates it at ``path`` with the batch's columns and types; later ones must fit these. NaN becomes null.
    """
    spark = df.sparkSession
    rows = load_inferred(df)
    if spark.catalog.tableExists(name):
        rows = conform(rows, spark.table(name).schema)
        rows.write.mode("append").format("parquet").saveAsTable(name)
    else:
        rows.write.format("parquet").option("path", path).saveAsTable(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
