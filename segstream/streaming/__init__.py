"""Structured Streaming: the foreachBatch sink (the micro-batch source is the
``segstream`` data source's stream reader)."""

from segstream.streaming.sink import batch_writer, drain, stream_to_table

__all__ = ["batch_writer", "drain", "stream_to_table"]
