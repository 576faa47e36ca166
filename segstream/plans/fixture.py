"""Event-stream views over the driver's tables.

Each view turns a table into the stream a user would have appended: a routing
key, a payload, an append order and an append time, placed in segments by the
key rule and given offsets.  Columns:
``scope, stream, routing_key, event (binary), seq, append_ts, len, segment_id, offset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream.functions.routing import event_length, segment_for_key
from segstream.operators.offsets import assign_offsets

STREAM_COLUMNS = ["scope", "stream", "routing_key", "event", "seq", "append_ts", "len", "segment_id", "offset"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_stream(
    df: DataFrame,
    scope: str,
    stream: str,
    key: str,
    payload: str,
    order: str,
    append_ts: str | None,
    n_segments: int,
    tiebreak: bool = False,
) -> DataFrame:
    """Route and place the rows of ``df`` as an appended stream.

    ``tiebreak``: the order column is not unique, so ties are ordered by the
    payload bytes (equal payloads have equal lengths, so offsets are defined)."""
    placed = df.select(
        F.lit(scope).alias("scope"),
        F.lit(stream).alias("stream"),
        F.col(key).cast("string").alias("routing_key"),
        F.col(payload).cast("binary").alias("event"),
        F.col(order).cast("bigint").alias("seq"),
        (F.col(append_ts) if append_ts else F.lit(None).cast("timestamp_ntz")).alias("append_ts"),
    )
    placed = placed.withColumn("len", event_length("event")).withColumn(
        "segment_id", segment_for_key("routing_key", n_segments, event="event")
    )
    order = ["seq", "event"] if tiebreak else ["seq"]
    return assign_offsets(placed, order_by=order).select(*STREAM_COLUMNS)


def events_stream(spark: SparkSession, sf_dir: str, n_segments: int = 3) -> DataFrame:
    """``events`` as stream demo/events: key user_id, payload props, order event_id."""
    return as_stream(table(spark, sf_dir, "events"), "demo", "events", "user_id", "props", "event_id", "ts", n_segments)


def conversations_stream(spark: SparkSession, sf_dir: str, n_segments: int = 4) -> DataFrame:
    """``conversations`` as a stream: key conv_id, UTF-8 payload text, order (conv_id, turn)."""
    conv = table(spark, sf_dir, "conversations").withColumn(
        "_order", F.col("conv_id") * F.lit(1_000_000) + F.col("turn")
    )
    return as_stream(conv, "demo", "conversations", "conv_id", "text", "_order", None, n_segments)


def lineitem_stream(spark: SparkSession, sf_dir: str, n_segments: int = 16) -> DataFrame:
    """``lineitem`` as a stream (scale fixture): key l_orderkey, payload the row as JSON."""
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn(
        "_payload", F.to_json(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))
    ).withColumn("_order", F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber"))
    return as_stream(li, "demo", "lineitem", "l_orderkey", "_payload", "_order", "l_shipdate", n_segments, tiebreak=True)


def documents_stream(spark: SparkSession, sf_dir: str, n_segments: int = 4) -> DataFrame:
    """``documents`` as a stream of large UTF-8 payloads: key source, payload text, order doc_id."""
    return as_stream(table(spark, sf_dir, "documents"), "demo", "documents", "source", "text", "doc_id", None, n_segments)
