"""Stream-cut operators: range predicates, bound resolution and the next cut
under a byte budget.

A cut is ``{segment_id: offset}``.  An event belongs to ``[start, end)`` when
its *start* offset does.  Segment ids carry their epoch in the high 32 bits;
cuts built here always hold the segments of one epoch, and segments of other
epochs are placed by the epoch rule: a segment newer than the start cut is
read from 0, one older is skipped; a segment older than the end cut is read to
its end, one newer is skipped.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.functions.routing import EPOCH_SHIFT


def epoch(segment_id: int) -> int:
    return int(segment_id) // EPOCH_SHIFT


def cut_epoch(cut: dict[int, int]) -> int | None:
    if not cut:
        return None
    return max(epoch(s) for s in cut)


def segment_ranges(
    segments: Iterable[int] | None,
    start: dict[int, int] | None,
    end: dict[int, int] | None,
) -> dict[int, tuple[int, int | None]]:
    """Per segment ``(lo, hi)`` with ``hi=None`` for no upper bound.

    ``start=None`` / ``end=None`` mean the beginning / the end of the stream.
    Segments that fall out of the range are left out of the result.
    """
    segs = set(int(s) for s in (segments or []))
    segs |= set(int(s) for s in (start or {}))
    segs |= set(int(s) for s in (end or {}))
    e_start = cut_epoch(start) if start else None
    e_end = cut_epoch(end) if end else None
    out: dict[int, tuple[int, int | None]] = {}
    for s in sorted(segs):
        e = epoch(s)
        if start is None or e_start is None:
            lo = 0
        elif s in start:
            lo = int(start[s])
        elif e > e_start:
            lo = 0
        elif e < e_start:
            continue
        else:
            lo = 0
        if end is None or e_end is None:
            hi = None
        elif s in end:
            hi = int(end[s])
        elif e < e_end:
            hi = None
        elif e > e_end:
            continue
        else:
            hi = None
        if hi is not None and hi <= lo:
            continue
        out[s] = (lo, hi)
    return out


def small_table(spark, rows: list[tuple], names: list[str], types: list[str]) -> DataFrame:
    """A driver-side table of known small size (one row per segment) built in
    the JVM from one literal SQL expression, without a Python RDD."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])

    def lit(v, t):
        return f"CAST({'NULL' if v is None else int(v)} AS {t})"

    structs = ", ".join(
        "struct(" + ", ".join(f"{lit(v, t)} AS `{n}`" for v, n, t in zip(r, names, types)) + ")" for r in rows
    )
    return spark.range(1).select(F.expr(f"inline(array({structs}))"))


def filter_ranges(df: DataFrame, ranges: dict[int, tuple[int, int | None]], segment_col: str = "segment_id",
                  offset_col: str = "offset") -> DataFrame:
    """Keep the events in the ranges: a semi join with the range table, which has
    one row a segment (its size is known on the driver) and is broadcast. The
    segments and the outermost offsets are literal predicates, too, so that
    partitions, files and row groups outside of them are not read."""
    if not ranges:
        return df.where(F.lit(False))
    seg, off = F.col(segment_col), F.col(offset_col)
    lows, highs = zip(*ranges.values())
    outer = seg.isin([int(s) for s in ranges])
    if min(lows) > 0:
        outer = outer & (off >= F.lit(int(min(lows))))
    if None not in highs:
        outer = outer & (off < F.lit(int(max(highs))))
    table = small_table(df.sparkSession, [(int(s), int(lo), None if hi is None else int(hi)) for s, (lo, hi) in ranges.items()],
                        ["_rs", "_lo", "_hi"], ["bigint", "bigint", "bigint"])
    inside = (seg == F.col("_rs")) & (off >= F.col("_lo")) & (F.col("_hi").isNull() | (off < F.col("_hi")))
    return df.where(outer).join(F.broadcast(table), inside, "left_semi")


def cut_filter(df: DataFrame, start: dict[int, int] | None = None, end: dict[int, int] | None = None,
               segments: Iterable[int] | None = None) -> DataFrame:
    """Events between two cuts (``None`` = beginning / end of the stream)."""
    if start is None and end is None:
        return df
    return filter_ranges(df, segment_ranges(segments, start, end))


def budget_per_segment(budget: int, n_segments: int) -> int:
    """The byte budget is split evenly; each segment may take at least one event."""
    return max(1, int(budget) // max(1, int(n_segments)))


def next_cut_frame(df: DataFrame, start: dict[int, int], budget: int,
                   end: dict[int, int] | None = None) -> DataFrame:
    """(segment_id, position): the next cut under an approximate byte budget.

    Every event whose start offset is below ``start[s] + budget/n`` is taken;
    the next position of a segment is the end of its last taken event, or
    ``start[s]`` when it has none.  Only the events inside the window are read
    (the outermost offsets push down to the scan).  ``end`` caps each segment.
    """
    b = budget_per_segment(budget, len(start))
    ranges = {}
    for s, c in start.items():
        hi = int(c) + b
        if end is not None and s in end:
            hi = min(hi, int(end[s]))
        if hi > int(c):
            ranges[int(s)] = (int(c), hi)
    spark = df.sparkSession
    starts = small_table(spark, [(int(s), int(c)) for s, c in start.items()], ["segment_id", "_from"], ["bigint", "bigint"])
    taken = filter_ranges(df, ranges).groupBy("segment_id").agg(
        F.max(F.col("offset") + F.col("len")).alias("_to")
    )
    # starts has one row per segment of the cut: its size is known and small.
    return (
        F.broadcast(starts)
        .join(taken, "segment_id", "left")
        .select("segment_id", F.coalesce("_to", "_from").cast("bigint").alias("position"))
    )


def next_cut(df: DataFrame, start: dict[int, int], budget: int, end: dict[int, int] | None = None) -> dict[int, int]:
    """Driver-side next cut (one row per segment comes back)."""
    return {int(r["segment_id"]): int(r["position"]) for r in next_cut_frame(df, start, budget, end).collect()}
