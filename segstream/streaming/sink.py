"""Structured Streaming into an event table (``foreachBatch``).

Each micro-batch is one transactional append keyed by (query, batch id): the
query is identified by its checkpoint folder, which survives restarts, so a
batch that Spark replays after a failure is found in the log and skipped
(exactly-once).  With ``exactly_once=False`` replays append again
(at-least-once).  Update and Complete output modes write each emitted row as
one event, which is how an append-only stream records changing results.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame

from segstream import options as O
from segstream.sources import table as TB


def batch_writer(root: str, scope: str, stream: str, query_key: str, order_by=None, opts: dict | None = None,
                 exactly_once: bool | None = None) -> Callable[[DataFrame, int], None]:
    o = O.lower_keys(opts or {})
    if exactly_once is None:
        exactly_once = O.flag(o, O.EXACTLY_ONCE, True)

    def write(batch: DataFrame, batch_id: int) -> None:
        TB.append(batch, root, scope, stream, order_by=order_by, opts=o, query_id=query_key,
                  batch_id=int(batch_id), exactly_once=exactly_once)

    return write


def stream_to_table(df: DataFrame, root: str, scope: str, stream: str, checkpoint: str, order_by=None,
                    opts: dict | None = None, output_mode: str = "append", processing_time: str | None = None,
                    available_now: bool = False, exactly_once: bool | None = None, query_name: str | None = None):
    """Start a streaming query that appends ``df`` (columns ``event`` and
    optional ``routing_key``) to the table; returns the ``StreamingQuery``."""
    TB.check_write_schema(df)
    writer = (
        df.writeStream.foreachBatch(batch_writer(root, scope, stream, checkpoint, order_by, opts, exactly_once))
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def drain(query):
    """Let a started query read everything there is, batch by batch under its
    budget, then stop it: what ``availableNow`` does for sources that can plan
    several batches at once. Returns the stopped query."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
