"""Stateful jobs over decoded messages: latest rows, counts, the recent ring and last-seen time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.live import KEYS, RECENT_KEPT, has_null_key, latest_by_key, latest_by_type, latest_groups, recent_messages, rows_of
from tidemark.session import drop_path, materialize, scratch_dir
from tidemark.sinks.files import VersionedTable
from tidemark.streaming.messages import decode, decode_parsed, explode_keys, parse, rejected_parsed

ARRIVAL_ORDER = ("sent_at", "seq")


def latest_rows_stream(raw: DataFrame, metric: str, order_by: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Rows of the latest message per key of one metric. The state is one row per key."""
    return latest_by_key(explode_keys(decode(raw), metric), metric, order_by)


def latest_type_stream(raw: DataFrame, order_by: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    messages = decode(raw).select("metric_type", *order_by, "year", "record_count")
    return latest_by_type(messages, order_by)


def counts_stream(raw: DataFrame) -> DataFrame:
    """Messages per type, whether or not their rows are usable, and the newest time seen."""
    return decode(raw).groupBy("metric_type").agg(
        F.count("*").alias("messages"), F.max("sent_at").alias("last_seen"))


def run_to_table(
    stream: DataFrame, table: VersionedTable, checkpoint: str, output_mode: str = "complete",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a table equal to the stream's aggregate: each batch replaces it as a whole.

    The aggregate is small (one row per key), and a replaced batch is simply written
    again after a restart.
    """
    def replace(batch: DataFrame, _batch_id: int) -> None:
        table.replace(batch)

    return _start(stream, replace, checkpoint, output_mode, trigger)


def run_recent_ring(
    raw: DataFrame, table: VersionedTable, checkpoint: str, keep: int = RECENT_KEPT,
    order_by: Sequence[str] = ARRIVAL_ORDER, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the newest messages in a table of at most ``keep`` rows.

    A batch that is repeated after a failure adds the same messages again; they are
    dropped as equal rows.
    """
    columns = [*order_by, "metric_type", "timestamp", "record_count"]
    messages = decode(raw).select(*columns)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        newest = recent_messages(batch, order_by, keep)
        old = table.read()
        both = newest if old is None else old.unionByName(newest).distinct()
        table.replace(recent_messages(both, order_by, keep))

    return _start(messages, merge, checkpoint, "append", trigger)


class LiveTables:
    """What a consumer of metric messages keeps, as tables filled by one stream.

    ``keyed``: for each metric the rows of the latest message of each key, replaced as a whole by each batch: one row per key.
    ``appended``: with ``null_keys="append"`` rows with a null key part, which replace nothing; one folder per batch.
    ``rejected``: messages that were skipped, with the reason; one folder per batch.
    ``counts``: per batch the messages of each type and the newest time they state; one folder per batch.

    Folders are named after the batch, and keyed rows carry the order of their message, so a batch that is
    repeated after a failure changes nothing. Views read these tables and decode no message.
    """

    def __init__(self, spark: SparkSession, path: str, null_keys: str = "append", order_by: Sequence[str] = ARRIVAL_ORDER):
        self.spark = spark
        self.path = path.rstrip("/")
        self.null_keys = null_keys
        self.order_by = list(order_by)
        self._keyed = {metric: VersionedTable(spark, f"{self.path}/keyed/{metric}") for metric in KEYS}

    def _folder(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one batch of raw messages. Each is parsed once, and its rows are grouped by key once."""
        scratch = scratch_dir(self.spark, "messages")
        parsed = materialize(parse(batch), f"{scratch}/parsed")
        rejected_parsed(parsed).write.mode("overwrite").parquet(self._folder("rejected", batch_id))
        messages = materialize(decode_parsed(parsed), f"{scratch}/decoded")
        for metric, table in self._keyed.items():
            groups = materialize(explode_keys(messages, metric).select(*KEYS[metric][0], *self.order_by, "rows"), f"{scratch}/{metric}")
            if self.null_keys == "append":
                apart = F.coalesce(has_null_key(metric), F.lit(False))
                groups.where(apart).write.mode("overwrite").parquet(self._folder(f"appended/{metric}", batch_id))
                groups = groups.where(~apart)
            old = table.read()
            table.replace(latest_groups(groups if old is None else old.unionByName(groups), metric, self.order_by))
        counted = messages.groupBy("metric_type").agg(F.count("*").alias("messages"), F.max("sent_at").alias("last_seen"))
        counted.write.mode("overwrite").parquet(self._folder("counts", batch_id))
        drop_path(self.spark, scratch)

    def run(self, raw: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return _start(raw, self.take, checkpoint, "append", trigger)

    def rows(self, metric: str) -> DataFrame:
        """The rows of one metric that count now."""
        groups = self._keyed[metric].read()
        if groups is None:
            raise ValueError("no batch has been taken in yet")
        if self.null_keys == "append":
            groups = groups.unionByName(self.spark.read.parquet(f"{self.path}/appended/{metric}").select(*groups.columns))
        return rows_of(groups, metric)

    def rejected(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rejected").select("value", "reason")

    def counts(self) -> DataFrame:
        """Messages of each type and the newest time they state."""
        return self.spark.read.parquet(f"{self.path}/counts").groupBy("metric_type").agg(
            F.sum("messages").alias("messages"), F.max("last_seen").alias("last_seen"))

    def last_seen(self) -> DataFrame:
        return self.counts().agg(F.max("last_seen").alias("last_seen"))


def _start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str, trigger: dict | None,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself, passing on its failure."""
    query.awaitTermination()


def table_or_empty(spark: SparkSession, table: VersionedTable, schema) -> DataFrame:
    """The current version, or no rows before the first batch."""
    current = table.read()
    return current if current is not None else spark.createDataFrame([], schema)
