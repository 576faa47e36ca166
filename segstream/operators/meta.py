"""Stream metadata as DataFrames: head / tail cuts and per-segment extents.

All are aggregates grouped by segment, so the work is spread over the data
and only one row per segment is produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.functions.cuts import cut_to_json


def segment_extents(df: DataFrame) -> DataFrame:
    """(segment_id, head, tail, events, bytes) over the visible events."""
    return df.groupBy("segment_id").agg(
        F.min("offset").alias("head"),
        F.max(F.col("offset") + F.col("len")).alias("tail"),
        F.count(F.lit(1)).alias("events"),
        F.sum("len").alias("bytes"),
    )


def stream_info(df: DataFrame) -> DataFrame:
    """One row: ``head_stream_cut``, ``tail_stream_cut`` as canonical JSON text."""
    ext = segment_extents(df)
    return ext.agg(
        cut_to_json(F.map_from_entries(F.collect_list(F.struct("segment_id", "head")))).alias("head_stream_cut"),
        cut_to_json(F.map_from_entries(F.collect_list(F.struct("segment_id", "tail")))).alias("tail_stream_cut"),
    )
