"""The load report of a stream as it goes on: event-time windows with a watermark.

``load_stream`` reads the stream through its source and counts events and bytes for
each segment and window of append time, flagged against the stream's rate policy.
A window takes events until the watermark (the newest append time seen, less
``delay``) has passed its end; what comes later is dropped, and its state is gone.
``autoscale_stream`` applies the policy batch by batch: a flagged window of an open
segment scales the stream, once for each epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream import options as O
from segstream.functions.routing import event_length
from segstream.operators.maintain import segment_load
from segstream.sources import table as TB
from segstream.sources.datasource import APPEND_TIME, register
from segstream.sources.log import CommitLog


def load_stream(spark: SparkSession, root: str, scope: str, stream: str, window: str = "1 minute", delay: str = "5 minutes",
                approx_bytes_per_trigger: int | None = None) -> DataFrame:
    """(window_start, segment_id, events, bytes, needs_split), streaming."""
    register(spark)
    policy = O.StreamConfig.from_json(CommitLog(spark, root, scope, stream).snapshot().config).scaling
    reader = spark.readStream.format("segstream").option("path", root).option("scope", scope).option("stream", stream)
    reader = reader.option(O.START_STREAM_CUT, "earliest").option(APPEND_TIME, "true")
    if approx_bytes_per_trigger is not None:
        reader = reader.option(O.APPROX_BYTES_PER_TRIGGER, str(approx_bytes_per_trigger))
    events = reader.load().withColumn("append_ts", F.col("append_ts").cast("timestamp")).withColumn("len", event_length("event"))
    return segment_load(
        events.withWatermark("append_ts", delay), window,
        target_events_per_sec=policy.target_rate if policy.kind == "by_event_rate" else None,
        target_kib_per_sec=policy.target_rate if policy.kind == "by_data_rate" else None,
    )


def autoscale_stream(spark: SparkSession, root: str, scope: str, stream: str, checkpoint: str, window: str = "1 minute",
                     delay: str = "5 minutes", approx_bytes_per_trigger: int | None = None):
    """Start a query that scales the stream by its policy's factor when an open
    segment went over the target; returns the ``StreamingQuery``."""

    def apply(batch: DataFrame, _: int) -> None:
        snap = CommitLog(spark, root, scope, stream).snapshot()
        policy = O.StreamConfig.from_json(snap.config).scaling
        if policy.kind == "fixed" or policy.scale_factor < 2:
            return
        open_now = [int(s) for s in snap.current_segments]
        if not batch.where(F.col("needs_split") & F.col("segment_id").isin(open_now)).isEmpty():
            TB.scale(spark, root, scope, stream, len(open_now) * policy.scale_factor)

    loads = load_stream(spark, root, scope, stream, window, delay, approx_bytes_per_trigger)
    return loads.writeStream.foreachBatch(apply).outputMode("update").option("checkpointLocation", checkpoint).start()
