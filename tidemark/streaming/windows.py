"""Event-time windows, alerts and indicators over metric rows and new observations."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.geo import NORTH_AMERICA, Extent
from tidemark.operators.clean import filter_region
from tidemark.operators.grid import snap_to_grid


def windowed_metrics(
    rows: DataFrame, time: str, value: str, by: Sequence[str], length: str = "5 minutes", slide: str | None = None,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Count, mean, minimum and maximum per window and group; rows later than ``lateness`` are dropped.

    With ``slide`` the windows overlap, else they tumble.
    """
    window = F.window(time, length, slide) if slide else F.window(time, length)
    timed = rows.withWatermark(time, lateness) if rows.isStreaming else rows
    return timed.groupBy(window.alias("w"), *by).agg(
        F.count(value).alias("n"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
             "n", "avg_value", "max_value", "min_value")


def threshold_alerts(rows: DataFrame, value: str, threshold: float) -> DataFrame:
    """Rows above a threshold, passed on as they arrive."""
    return rows.where(F.col(value) > threshold).withColumn("threshold", F.lit(float(threshold)))


def point_feed(observations: DataFrame, value: str = "microplastics_measurement", extent: Extent = NORTH_AMERICA) -> DataFrame:
    """Map points of new observations in the region."""
    points = filter_region(observations.dropna(subset=["latitude", "longitude"]), extent)
    return points.select("latitude", "longitude", F.col(value).alias("value"))


def cell_metrics(
    observations: DataFrame, time: str, value: str = "microplastics_measurement", length: str = "30 days",
    lateness: str = "10 minutes", extent: Extent = NORTH_AMERICA,
) -> DataFrame:
    """Windowed measurement metrics per grid cell of a stream of new observations."""
    inside = snap_to_grid(filter_region(observations, extent))
    return windowed_metrics(inside, time, value, ["grid_id"], length, lateness=lateness)


def with_latency(messages: DataFrame, sent: str = "sent_at", arrival: str = "arrival") -> DataFrame:
    """Seconds from sending to arrival and from arrival to this batch's start. Both are null where a time is missing."""
    def seconds(later: Column, earlier: Column) -> Column:
        return (F.unix_micros(later) - F.unix_micros(earlier)) / 1e6

    return messages.withColumns({
        "ingest_seconds": seconds(F.col(arrival), F.col(sent)),
        "processing_seconds": seconds(F.current_timestamp(), F.col(arrival)),
    })


def throughput(messages: DataFrame, time: str, valid: str, length: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Valid and discarded messages, the mean rate, and the ingest latency of the valid ones per window.

    ``messages`` has ``ingest_seconds``: see :func:`with_latency`.
    """
    window = F.window(time, length)
    timed = messages.withWatermark(time, lateness) if messages.isStreaming else messages
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    delay = F.when(F.col(valid), F.col("ingest_seconds"))
    return timed.groupBy(window.alias("w")).agg(
        F.count_if(F.col(valid)).alias("valid"), F.count_if(~F.col(valid)).alias("discarded"),
        F.avg(delay).alias("avg_ingest_seconds"), F.max(delay).alias("max_ingest_seconds"),
    ).select(F.col("w.start").alias("window_start"), "valid", "discarded",
             ((F.col("valid") + F.col("discarded")) / seconds).alias("per_second"), "avg_ingest_seconds", "max_ingest_seconds")


OBSERVED = "ops_indicators"


def observed(messages: DataFrame, valid: str) -> DataFrame:
    """The same messages, with their numbers and latencies observed as they pass; :class:`OpsListener` receives these."""
    return messages.observe(
        OBSERVED, F.count_if(F.col(valid)).alias("valid"), F.count_if(~F.col(valid)).alias("discarded"),
        *[agg(c).alias(f"{name}_{c}") for c in ("ingest_seconds", "processing_seconds") for name, agg in (("avg", F.avg), ("max", F.max))])


class OpsListener(StreamingQueryListener):
    """Keeps the indicators of the last batches of every stream: observed numbers and latencies, rate and duration."""

    def __init__(self, keep: int = 100):
        self.batches: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if seen is not None and progress.numInputRows:
            self.batches.append({
                "query": str(progress.id), "batch": progress.batchId, "input_rows": progress.numInputRows,
                "processed_per_second": progress.processedRowsPerSecond, "batch_millis": progress.batchDuration, **seen.asDict()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_indicators(query: StreamingQuery) -> dict[str, float | int | None]:
    """Rates and durations of the last batch as Spark reports them."""
    progress = query.lastProgress
    if progress is None:
        return {"input_rows": 0, "input_per_second": None, "processed_per_second": None, "batch_millis": None}
    return {
        "input_rows": progress["numInputRows"],
        "input_per_second": progress["inputRowsPerSecond"],
        "processed_per_second": progress["processedRowsPerSecond"],
        "batch_millis": progress["durationMs"].get("triggerExecution"),
    }
