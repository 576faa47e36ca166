"""Event boundaries of a stream, kept beside its files as a small Parquet table.

An append (or ``compact``) leaves one row for each stride of ``STRIDE`` bytes of a
file: where its events lie and, in a few bits each, where every event starts. The
next cut under a byte budget is the start of the first event at or after a given
offset, so it is found in one such row a segment, and planning a micro-batch
reads no event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STRIDE = 64 << 10
#: lo, hi: the bytes that the row's events take; starts: first bytes of its events, from ``lo``.
SCHEMA = "path string, segment_id long, lo long, hi long, rows long, starts array<int>"


def marks_dir(stream_folder: str, txn: str) -> str:
    return f"{stream_folder}/_marks/txn={txn}"


def write_marks(events: DataFrame, folder: str) -> DataFrame:
    """Write the marks of the written files that ``events`` reads; read them back.
    A file's marks lie together, in order, so that statistics find them."""
    located = events.select(F.input_file_name().alias("path"), "segment_id", "offset", "len")
    runs = located.repartition("path").groupBy("path", "segment_id", F.expr(f"`offset` div {STRIDE}").alias("_stride")).agg(
        F.min("offset").alias("lo"), F.max(F.col("offset") + F.col("len")).alias("hi"), F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_list(F.expr(f"CAST(`offset` % {STRIDE} AS int)"))).alias("_at"),
    )
    starts = F.transform("_at", lambda x: x - F.element_at("_at", 1)).alias("starts")
    marks = runs.select("path", "segment_id", "lo", "hi", "rows", starts)
    marks.sortWithinPartitions("segment_id", "lo").write.mode("overwrite").parquet(folder)
    return events.sparkSession.read.schema(SCHEMA).parquet(folder)


def targets(start: dict[int, int], budget_each: int, end: dict[int, int] | None, head: dict[int, int],
            tail: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """(known, wanted): positions that need no lookup, and for the other segments
    the offset before which the last event taken starts."""
    known, wanted = {}, {}
    for s, c in start.items():
        s, c = int(s), int(c)
        t = c + budget_each
        if end is not None and s in end:
            t = min(t, int(end[s]))
        top = int(tail.get(s, 0))
        if t <= max(c, int(head.get(s, 0))) or top <= c:
            known[s] = c
        elif top <= t:
            known[s] = top
        else:
            wanted[s] = t
    return known, wanted


def boundaries(spark: SparkSession, folders: list[str], wanted: dict[int, int]) -> dict[int, int]:
    """Per segment the start of the first event at or after ``wanted`` (or the end
    of the last one of the row): one row of marks and one number a segment."""
    from segstream.operators.cuts import small_table

    asked = small_table(spark, sorted(wanted.items()), ["_seg", "_before"], ["bigint", "bigint"])
    marks = spark.read.schema(SCHEMA).parquet(*folders).where(
        (F.col("lo") < max(wanted.values())) & (F.col("hi") >= min(wanted.values())))
    # one row a segment of the cut: its size is known
    found = marks.join(F.broadcast(asked), (F.col("segment_id") == F.col("_seg")) & (F.col("lo") < F.col("_before")) & (F.col("hi") >= F.col("_before")))
    later = F.array_min(F.filter("starts", lambda x: F.col("lo") + x >= F.col("_before")))
    position = F.coalesce(F.col("lo") + later, F.col("hi"))
    return {int(r["segment_id"]): int(r["position"]) for r in found.select("segment_id", position.alias("position")).collect()}


def boundary_in(filesystem, folder: str, segment: int, before: int) -> int | None:
    """The same for one segment, through pyarrow (the streaming planner)."""
    import bisect

    import pyarrow.dataset as pads

    field = pads.field
    inside = (field("segment_id") == segment) & (field("lo") < before) & (field("hi") >= before)
    rows = pads.dataset(folder, filesystem=filesystem, format="parquet").to_table(columns=["lo", "hi", "starts"], filter=inside).to_pylist()
    if not rows:
        return None
    row = rows[0]
    at = bisect.bisect_left(row["starts"], before - row["lo"])
    return row["lo"] + row["starts"][at] if at < len(row["starts"]) else row["hi"]
