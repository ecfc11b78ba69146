"""Stage tables, reports and the climate history."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import keep_last, union_by_name
from tidemark.session import drop_path, materialize, path_exists, scratch_dir


def write_stage_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table below ``out_dir``, side by side, and return the paths by table name."""
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in tables}

    def write(name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(paths[name])

    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        list(pool.map(write, tables, tables.values()))
    return paths


def write_quality_report(report: DataFrame, out_dir: str, stage: str) -> dict[str, str]:
    """One Parquet partition per dataset, and a CSV copy of all rules read back from it."""
    base = f"{out_dir.rstrip('/')}/quality_{stage}"
    report.write.mode("overwrite").partitionBy("dataset").parquet(f"{base}_rules")
    written = report.sparkSession.read.parquet(f"{base}_rules").select(*report.columns)
    written.write.mode("overwrite").option("header", True).csv(f"{base}_csv")
    return {"rules": f"{base}_rules", "csv": f"{base}_csv"}


class VersionedTable:
    """A table that is replaced as a whole: each write goes to a new numbered folder.

    Readers take the newest folder that finished, so a write that breaks off, or one
    that reads the version before it, never harms the table. The last few versions
    are kept for readers that are still busy with them.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 5):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep

    def _hadoop(self, path: str):
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        root, fs = self._hadoop(self.path)
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        numbers = [int(n.removeprefix("v=")) for n in names if n.startswith("v=")]
        return sorted(n for n in numbers if path_exists(self.spark, f"{self.path}/v={n}/_SUCCESS"))

    def read(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}") if versions else None

    def replace(self, df: DataFrame) -> DataFrame:
        versions = self._versions()
        target = f"{self.path}/v={versions[-1] + 1 if versions else 0}"
        df.write.mode("overwrite").parquet(target)
        for old in versions[: max(0, len(versions) + 1 - self.keep)]:
            path, fs = self._hadoop(f"{self.path}/v={old}")
            fs.delete(path, True)
        return self.spark.read.parquet(target)


class DatedTable:
    """A table in one folder per day, month or year; a batch rewrites the folders of its dates and no others.

    The manifest has one row for each folder: its oldest and newest date and number of rows, the batch that wrote it last,
    and when. Incremental extraction asks it for the newest date, so that no reading has to be scanned for that.

    Folders are replaced when a batch has been written in full. Between that and the new manifest a batch may break off;
    run again, it gives what it would have given.
    """

    PART = "partition_start"

    def __init__(self, spark: SparkSession, path: str, date: str = "date", grain: str = "month"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.date = date
        self.grain = grain
        self._manifest = VersionedTable(spark, f"{self.path}/_manifest", keep=2)

    def manifest(self) -> DataFrame | None:
        """(start, oldest, newest, n_rows, batch, written_at) of every folder; rows without a date have a folder with null start."""
        current = self._manifest.read()
        return None if current is None else current.drop("columns")

    def dates(self) -> DataFrame | None:
        """The oldest and newest ``date`` of each folder: enough for what incremental extraction asks for."""
        current = self.manifest()
        return None if current is None else current.select(F.explode(F.array("oldest", "newest")).alias("date"))

    def _scan(self, columns: T.StructType) -> DataFrame:
        return self.spark.read.schema(T.StructType([*columns.fields, T.StructField(self.PART, T.DateType())])).parquet(self.path)

    def _stored(self) -> DataFrame | None:
        current = self._manifest.read()
        return None if current is None else self._scan(T.StructType.fromJson(json.loads(current.first()["columns"])))

    def read(self) -> DataFrame | None:
        stored = self._stored()
        return None if stored is None else stored.drop(self.PART)

    def between(self, start: str, end: str) -> DataFrame | None:
        """The rows of a range of dates; other folders are not read."""
        stored, dates = self._stored(), [F.lit(d).cast("date") for d in (start, end)]
        if stored is None:
            return None
        folders = F.col(self.PART).between(F.trunc(dates[0], self.grain) if self.grain != "day" else dates[0], dates[1])
        return stored.where(folders & F.col(self.date).cast("date").between(*dates)).drop(self.PART)

    def merge(self, new: DataFrame, keys: Sequence[str], order_by: Sequence[str], batch: str) -> DataFrame:
        """Add rows and keep the last per key, of which the date is a part; columns that either side lacks are null.

        What is collected are the folders of the batch, of which a calendar has only so many.
        """
        if self.date not in keys:
            raise ValueError(f"keys lack {self.date}: rows of one key must be in one folder")
        scratch = scratch_dir(self.spark, "batch")
        day = F.col(self.date).cast("date")
        incoming = materialize(new.withColumn(self.PART, day if self.grain == "day" else F.trunc(day, self.grain)), scratch)
        starts = [r[0] for r in incoming.select(self.PART).distinct().collect()]

        def touched(column: str) -> Column:
            known = F.col(column).isin([d for d in starts if d is not None])
            return F.coalesce(known, F.lit(None in starts))

        stored = self._stored()
        combined = incoming if stored is None else union_by_name(stored.where(touched(self.PART)), incoming)
        merged = keep_last(combined, keys, order_by)
        columns = T.StructType([f for f in merged.schema.fields if f.name != self.PART])
        merged.hint("rebalance", self.PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.PART).parquet(self.path)

        listed = self._scan(columns).where(touched(self.PART)).groupBy(F.col(self.PART).alias("start")).agg(
            F.min(day).alias("oldest"), F.max(day).alias("newest"), F.count("*").alias("n_rows"))
        listed = listed.withColumns({"batch": F.lit(batch), "written_at": F.current_timestamp()})
        before = self.manifest()
        if before is not None:
            listed = listed.unionByName(before.where(~touched("start")))
        self._manifest.replace(listed.withColumn("columns", F.lit(columns.json())).coalesce(1))
        drop_path(self.spark, scratch)
        return self.read()


def append_history(history: DatedTable, new: DataFrame, order_by: list[str], batch: str) -> DataFrame:
    """Add new readings and keep the last per (date, grid_id); folders without new readings are left as they are."""
    return history.merge(new, ["date", "grid_id"], order_by, batch)
