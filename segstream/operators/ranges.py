"""Partial scaling: segments own key ranges, and one can be split or several merged.

The interval table has one row a segment: ``segment_id`` (its epoch in the high 32
bits), the key positions ``[lo, hi)`` it owns, and whether it is ``sealed``. A
scaling seals the segments it replaces and opens new ones in the next epoch; the
others go on. At any time the open segments cover all positions once, so a
segment's successors are the segments opened when it was sealed that share
positions with it.

A cut holds the segments that were open at some moment. Another segment lies
behind the cut if it was opened later than the cut's segments that share its
positions (it is read from 0), and before it if it was sealed earlier.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.functions.routing import EPOCH_SHIFT, KEY_SPACE, key_position
from segstream.operators.cuts import epoch, small_table

GRID_BITS = 24  #: positions are dealt to 256 cells, so that routing is a hash join


@dataclass(frozen=True)
class Interval:
    segment_id: int
    lo: int
    hi: int
    sealed: bool = False

    def shares(self, other: "Interval") -> bool:
        return self.lo < other.hi and other.lo < self.hi


def uniform(n: int) -> list[Interval]:
    """Epoch 0: ``n`` ranges, the same as the uniform rule's."""
    borders = [-(-i * KEY_SPACE // n) for i in range(n + 1)]
    return [Interval(i, borders[i], borders[i + 1]) for i in range(n)]


def open_segments(table: list[Interval]) -> list[Interval]:
    return sorted((x for x in table if not x.sealed), key=lambda x: x.lo)


def replace_segments(table: list[Interval], gone: list[int], borders: list[int]) -> list[Interval]:
    """Seal the open segments ``gone``, whose ranges join to one, and open
    segments between the ``borders`` (first and last are that range's)."""
    old = sorted((x for x in table if x.segment_id in gone), key=lambda x: x.lo)
    if len(old) != len(set(gone)) or any(x.sealed for x in old):
        raise ValueError("only open segments can be replaced")
    if any(a.hi != b.lo for a, b in zip(old, old[1:])) or (borders[0], borders[-1]) != (old[0].lo, old[-1].hi) or sorted(set(borders)) != borders:
        raise ValueError("the new ranges must cover the old ones, which must be neighbours")
    e = max(epoch(x.segment_id) for x in table) + 1
    number = max(x.segment_id % EPOCH_SHIFT for x in table) + 1
    new = [Interval(e * EPOCH_SHIFT + number + i, a, b) for i, (a, b) in enumerate(zip(borders, borders[1:]))]
    return [replace(x, sealed=True) if x.segment_id in gone else x for x in table] + new


def split(table: list[Interval], segment: int, parts: int = 2) -> list[Interval]:
    """One segment becomes ``parts`` of about equal ranges."""
    old = next(x for x in table if x.segment_id == segment)
    return replace_segments(table, [segment], [old.lo + (old.hi - old.lo) * i // parts for i in range(parts + 1)])


def merge(table: list[Interval], segments: list[int]) -> list[Interval]:
    """Neighbouring segments become one."""
    old = [x for x in table if x.segment_id in segments]
    return replace_segments(table, segments, [min(x.lo for x in old), max(x.hi for x in old)])


def successors(table: list[Interval]) -> dict[int, list[int]]:
    """Of each sealed segment the segments that took over its positions."""
    out = {}
    for x in table:
        if x.sealed:
            later = [y for y in table if epoch(y.segment_id) > epoch(x.segment_id) and x.shares(y)]
            first = min(epoch(y.segment_id) for y in later)
            out[x.segment_id] = sorted(y.segment_id for y in later if epoch(y.segment_id) == first)
    return out


def route(df: DataFrame, table: list[Interval], key: str = "routing_key", event: str = "event") -> DataFrame:
    """Add ``segment_id``: the open segment that owns the key's position. The
    table has one row a segment and cell it touches, which bounds the broadcast."""
    rows = [(x.segment_id, x.lo, x.hi, cell) for x in open_segments(table) for cell in range(x.lo >> GRID_BITS, ((x.hi - 1) >> GRID_BITS) + 1)]
    owners = small_table(df.sparkSession, rows, ["_seg", "_lo", "_hi", "_cell"], ["bigint"] * 4)
    placed = df.withColumn("_pos", key_position(key, event))
    owns = (F.shiftright("_pos", GRID_BITS) == F.col("_cell")) & (F.col("_pos") >= F.col("_lo")) & (F.col("_pos") < F.col("_hi"))
    met = placed.join(F.broadcast(owners), owns)
    return met.withColumn("segment_id", F.col("_seg")).drop("_pos", "_seg", "_lo", "_hi", "_cell")


def route_history(df: DataFrame, stages: list[tuple[int | None, list[Interval]]], order: str = "seq") -> DataFrame:
    """Route events by the table of their time: ``stages`` are (the first ``order``
    value after the stage, table), the last with None."""
    out, since = None, None
    for until, table in stages:
        mine = df if since is None else df.where(F.col(order) >= since)
        routed = route(mine if until is None else mine.where(F.col(order) < until), table)
        out, since = routed if out is None else out.unionByName(routed), until
    return out


def ranges_between(table: list[Interval], start: dict[int, int] | None, end: dict[int, int] | None) -> dict[int, tuple[int, int | None]]:
    """Per segment the offsets ``(lo, hi)`` between two cuts (None: the beginning,
    the end); segments outside are left out. ``table`` is the newest one."""
    known = {x.segment_id: x for x in table}

    def side(x: Interval, cut: dict[int, int]) -> int:
        """-1 if the segment lies wholly before the cut, 1 if behind it."""
        shared = [known[s] for s in cut if known[s].shares(x)]
        return 1 if epoch(x.segment_id) > max(epoch(y.segment_id) for y in shared) else -1

    out = {}
    for s, x in sorted(known.items()):
        lo, hi = 0, None
        if start is not None:
            if s in start:
                lo = int(start[s])
            elif side(x, start) < 0:
                continue
        if end is not None:
            if s in end:
                hi = int(end[s])
            elif side(x, end) > 0:
                continue
        if hi is None or hi > lo:
            out[s] = (lo, hi)
    return out
