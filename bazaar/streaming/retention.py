"""A8 on a stream: the 90-day TTL (7,776,000 s) of the product-event store as Structured Streaming.

The reference expires raw events with a TTL index. On a stream the natural form is an event-time
watermark of the same length: daily per-product event counts are kept as streaming state, and
state for windows older than the watermark (newest event time − 90 days) is dropped — the TTL
applied to the aggregate instead of by a background deleter. Late events older than the watermark
are ignored, exactly like documents that would already have expired.

Streaming checkpoints go under the shared folder named by ``spark.checkpoint.dir``. Watermarks need
a TIMESTAMP event time; ``created_at`` (TIMESTAMP_NTZ, UTC) is converted under the UTC session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.plans.docpipes import RETENTION_SECONDS
from bazaar.session import ensure_checkpoint_dir
from bazaar.sources.tables import COLLECTIONS

C = F.col


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """product_events arriving as Parquet files under ``path`` (explicit schema, no inference)."""
    return (spark.readStream.schema(COLLECTIONS["product_events"])
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def daily_event_counts(events: DataFrame, ttl_seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Per (day, product, event type) counts with state expiring ``ttl_seconds`` behind the newest
    event time. Append mode emits a day once it can no longer change."""
    return (events.withColumn("event_time", C("created_at").cast("timestamp"))
            .withWatermark("event_time", f"{int(ttl_seconds)} seconds")
            .groupBy(F.window("event_time", "1 day").alias("day"), "product_id", "event_type")
            .agg(F.count(F.lit(1)).alias("events")))


def deduplicated_events(events: DataFrame, ttl_seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Exact duplicate events dropped while they are within the retention window."""
    return (events.withColumn("event_time", C("created_at").cast("timestamp"))
            .withWatermark("event_time", f"{int(ttl_seconds)} seconds")
            .dropDuplicatesWithinWatermark(["customer_id", "product_id", "event_type", "session_id", "created_at"]))


def start(df: DataFrame, name: str, sink: str, output_mode: str = "append", path: str | None = None,
          available_now: bool = True):
    """Start a streaming query into ``sink`` (a format such as parquet; memory gathers on the driver and is for tests)
    with its checkpoint in the shared checkpoint folder."""
    base = ensure_checkpoint_dir(df.sparkSession)
    w = (df.writeStream.queryName(name).outputMode(output_mode).format(sink)
         .option("checkpointLocation", f"{base.rstrip('/')}/streams/{name}"))
    if path:
        w = w.option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
