"""Stream maintenance as DataFrame operators: truncation, retention, scaling
and segment load reports.  Each returns either the surviving events or a cut
(one row per segment); the table layer records cuts in the commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.functions.routing import event_length, segment_for_key
from segstream.operators.cuts import small_table
from segstream.operators.offsets import assign_offsets


def truncate_at(df: DataFrame, head: dict[int, int]) -> DataFrame:
    """Events at or after the head cut.  Segments missing from the cut keep
    everything (they are newer than the cut)."""
    if not head:
        return df
    heads = small_table(df.sparkSession, sorted((int(s), int(h)) for s, h in head.items()), ["_hs", "_head"], ["bigint", "bigint"])
    gone = (F.col("segment_id") == F.col("_hs")) & (F.col("offset") < F.col("_head"))
    return df.join(F.broadcast(heads), gone, "left_anti")  # one row a segment of the cut


def head_cut_frame(survivors: DataFrame, all_events: DataFrame) -> DataFrame:
    """(segment_id, position): first surviving offset per segment, or the
    segment's tail when nothing survives."""
    tails = all_events.groupBy("segment_id").agg(F.max(F.col("offset") + F.col("len")).alias("_tail"))
    heads = survivors.groupBy("segment_id").agg(F.min("offset").alias("_head"))
    return tails.join(heads, "segment_id", "left").select(
        "segment_id", F.coalesce("_head", "_tail").cast("bigint").alias("position")
    )


def _ntz(value):
    """A wall-clock literal that no session time zone shifts."""
    if hasattr(value, "isoformat"):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def retain_by_time(df: DataFrame, duration_ms: int, now=None) -> DataFrame:
    """Events appended within ``duration_ms`` before ``now`` (default: the
    newest append time in the stream)."""
    if now is None:
        now = df.agg(F.max("append_ts")).first()[0]  # one value back to the driver
    if now is None:
        return df
    limit = _ntz(now) - F.expr(f"INTERVAL {int(duration_ms)} MILLISECONDS")
    return df.where(F.col("append_ts") >= limit)


def retain_by_size(df: DataFrame, limit_bytes: int, blocks: int | None = None) -> DataFrame:
    """The newest events of the stream whose total size stays within the limit.

    ``newer`` (bytes appended after an event, over all segments) is a suffix
    sum in append order, computed with the same two-level prefix sum as
    offsets (one group per block of the order, never the whole stream).
    """
    x = df.withColumn("_all", F.lit(0).cast("bigint")).withColumn("_rev", -F.col("seq"))
    x = assign_offsets(x, order_by="_rev", segment_col="_all", offset_col="_newer", blocks=blocks)
    return x.where(F.col("_newer") + F.col("len") <= F.lit(int(limit_bytes))).drop("_all", "_rev", "_newer")


def retain_appended(df: DataFrame, limit_bytes: int, blocks: int | None = None) -> DataFrame:
    """As ``retain_by_size`` for stored events: the append order is the append
    time of the transaction, then (segment, offset)."""
    x = df.withColumn("_all", F.lit(0).cast("bigint"))
    age = F.unix_micros(F.col("append_ts").cast("timestamp"))
    x = x.withColumn("_r0", -age).withColumn("_r1", -F.col("segment_id")).withColumn("_r2", -F.col("offset"))
    x = assign_offsets(x, order_by=["_r0", "_r1", "_r2"], segment_col="_all", offset_col="_newer", blocks=blocks)
    return x.where(F.col("_newer") + F.col("len") <= F.lit(int(limit_bytes))).drop("_all", "_r0", "_r1", "_r2", "_newer")


def place_in_epochs(df: DataFrame, n_for_epoch: dict[int, int], epoch_col: str = "_epoch") -> DataFrame:
    """Route events to the segments of the epoch they were appended in.

    ``df`` carries an ``_epoch`` column; ``n_for_epoch[e]`` is the number of
    uniform key ranges of epoch ``e``.  The segment id carries the epoch.
    """
    seg = None
    for e, n in sorted(n_for_epoch.items()):
        branch = segment_for_key("routing_key", n, epoch=e, event="event")
        seg = F.when(F.col(epoch_col) == F.lit(int(e)), branch) if seg is None else seg.when(
            F.col(epoch_col) == F.lit(int(e)), branch
        )
    return df.withColumn("segment_id", seg.cast("bigint"))


def scale_stream(df: DataFrame, split_seq: int, n_before: int, n_after: int) -> DataFrame:
    """Re-route: events with ``seq < split_seq`` in epoch 0 with ``n_before``
    segments, the rest in epoch 1 with ``n_after`` segments; offsets per segment."""
    x = df.withColumn("_epoch", F.when(F.col("seq") < F.lit(int(split_seq)), F.lit(0)).otherwise(F.lit(1)))
    x = place_in_epochs(x.drop("segment_id", "offset"), {0: n_before, 1: n_after})
    if "len" not in x.columns:
        x = x.withColumn("len", event_length("event"))
    return assign_offsets(x.drop("_epoch"), order_by="seq")


def segment_load(df: DataFrame, window: str = "1 hour", target_events_per_sec: float | None = None,
                 target_kib_per_sec: float | None = None) -> DataFrame:
    """Events and bytes per segment per time window, against the policy target.

    ``needs_split``: the window's rate is above the target (a scale-up hint);
    rates are compared as totals (events > target * seconds) to stay exact.
    """
    secs = _window_seconds(window)
    g = df.groupBy(F.window("append_ts", window).alias("w"), "segment_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("len").alias("bytes")
    )
    out = g.select(
        # seconds since the epoch of the wall-clock window start (no time zone involved)
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(w.start as timestamp_ntz))")
        .cast("bigint").alias("window_start"),
        F.col("segment_id"),
        F.col("events"),
        F.col("bytes"),
    )
    flag = F.lit(False)
    if target_events_per_sec is not None:
        flag = F.col("events") > F.lit(target_events_per_sec * secs)
    if target_kib_per_sec is not None:
        flag = F.col("bytes") > F.lit(target_kib_per_sec * 1024 * secs)
    return out.withColumn("needs_split", flag)


def _window_seconds(window: str) -> int:
    n, unit = window.split()
    unit = unit.rstrip("s").lower()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]

