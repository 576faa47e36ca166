"""segstream: segmented, append-only event streams kept as Spark tables.

Batch: ``append``, ``read_stream``, ``read_events``, ``next_cut``, ``stream_info``,
``list_streams``; maintenance: ``truncate``, ``apply_retention``, ``scale``,
``compact``, ``vacuum``; streaming: ``stream_to_table`` and the ``segstream``
data source (``register``); SQL: ``register_view``.
"""

from segstream.sources.table import (
    append,
    autoscale,
    load_report,
    apply_retention,
    compact,
    drop_truncated,
    list_streams,
    next_cut,
    read_events,
    read_stream,
    scale,
    stream_info,
    truncate,
    vacuum,
)


def register(spark) -> None:
    """Make ``spark.read.format("segstream")`` / ``readStream`` available."""
    from segstream.sources.datasource import register as _register

    _register(spark)


def register_view(spark, name: str, root: str, scope: str, stream: str, start=None, end=None) -> None:
    """A temp view over a stream (five-column schema) for SQL users; the view
    binds the stream's positions when it is created."""
    read_stream(spark, root, scope, stream, start=start, end=end).createOrReplaceTempView(name)


def stream_to_table(*args, **kwargs):
    from segstream.streaming.sink import stream_to_table as _s

    return _s(*args, **kwargs)


__all__ = [
    "append", "autoscale", "load_report", "apply_retention", "compact", "drop_truncated", "list_streams", "next_cut", "read_events", "read_stream", "register",
    "register_view", "scale", "stream_info", "stream_to_table", "truncate", "vacuum",
]
