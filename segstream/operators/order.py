"""Per-key order of a stream (events of one routing key in append order).

A key lives in one segment per epoch, so its append order is
``(segment_id, offset)``.  ``key_seq`` (0-based position of an event among its
key's events) is a prefix count per key, computed with the two-level prefix
sum: a hot key is split over blocks of the order instead of landing in one
task.  ``ordered_by_key`` then range-partitions on ``(routing_key, key_seq)``
so even a key holding a third of the stream is spread over many partitions,
each sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.operators.offsets import assign_offsets


def with_key_seq(df: DataFrame, blocks: int | None = None) -> DataFrame:
    # Monotone numeric image of (epoch, offset) for the block split; the exact
    # order inside a block comes from (segment_id, offset).
    ordv = F.shiftright(F.col("segment_id"), 32).cast("double") * F.lit(float(2**62)) + F.col("offset").cast("double")
    x = df.withColumn("_ord", ordv).withColumn("_one", F.lit(1).cast("bigint"))
    x = assign_offsets(
        x, order_by=["_ord", "segment_id", "offset"], segment_col="routing_key", len_col="_one",
        offset_col="key_seq", blocks=blocks,
    )
    return x.drop("_ord", "_one")


def ordered_by_key(df: DataFrame, partitions: int | None = None) -> DataFrame:
    x = with_key_seq(df)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return x.repartitionByRange(n, "routing_key", "key_seq").sortWithinPartitions("routing_key", "key_seq")
