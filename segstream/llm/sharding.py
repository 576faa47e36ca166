"""Consistent-hash ring with virtual nodes and bounded loads.

Keys and virtual nodes lie on a ring of ``CELLS`` cells (the top bits of a
64-bit hash). A key belongs to the next virtual node clockwise. A shard takes
keys up to its capacity in ring order; what overflows continues clockwise to
the next virtual node whose shard has room. Only the row count of each cell
reaches the driver (at most ``CELLS`` numbers, whatever the input), where the
walk is planned as ranges of ranks within a cell. Rows then find their range
with a window over their own cell, so no task holds a shard.

With ``slack`` 0 the capacities add up to the number of rows, so counts are at
most one apart (law ``rows``); a larger slack moves fewer rows when a shard is
added, and the largest load is (1 + slack) times the mean.

Defined results: a null doc_id is a key like any other; a null text has size 1
and the checksum of nothing; rows that repeat a key share a cell and are told
apart by their checksum and size, so equal rows are interchangeable; an empty
table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16
CELLS = 1 << CELL_BITS


def ring(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise; one cell holds one node."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(replicas):
            cell = xxhash.xxh64_intdigest(f"{shard}/{replica}".encode()) >> (64 - CELL_BITS)
            while cell in taken:
                cell = (cell + 1) % CELLS
            taken[cell] = shard
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def plan(counts: np.ndarray, shards: int, replicas: int, slack: float) -> pd.DataFrame:
    """Ranges of ranks: cell, lo, hi, shard and the first slot of the range."""
    nodes = ring(shards, replicas)
    at = [c for c, _ in nodes]
    cap, load = capacities(int(counts.sum()), shards, slack), [0] * shards
    out, over = [], []

    def take(cell: int, lo: int, hi: int, shard: int) -> int:
        n = min(hi - lo, cap[shard] - load[shard])
        if n > 0:
            out.append((cell, lo, lo + n, shard, load[shard]))
            load[shard] += n
        return lo + max(n, 0)

    for cell in np.flatnonzero(counts):
        node = bisect.bisect_left(at, cell) % len(nodes)
        lo = take(int(cell), 0, int(counts[cell]), nodes[node][1])
        if lo < counts[cell]:
            over.append((int(cell), lo))
    free = [(c, s) for c, s in nodes if load[s] < cap[s]]
    for cell, lo in over:
        while lo < counts[cell]:
            i = bisect.bisect_left(free, (cell, -1))
            shard = free[i % len(free)][1]
            lo = take(cell, lo, int(counts[cell]), shard)
            if load[shard] == cap[shard]:
                free = [x for x in free if x[1] != shard]
    return pd.DataFrame(out, columns=["cell", "lo", "hi", "shard", "first"]).astype("int64")


def assign_shards(df: DataFrame, shards: int = 8, replicas: int = 64, slack: float = 0.0) -> DataFrame:
    """Shard and gapless slot of each row by its doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.xxhash64("doc_id")
    keyed = df.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place.alias("place"),
        F.shiftrightunsigned(place, 64 - CELL_BITS).alias("cell"),
    )
    # bounded: one row a cell at most, CELLS rows whatever the input
    found = df.select(F.shiftrightunsigned(place, 64 - CELL_BITS).alias("cell")).groupBy("cell").count().collect()
    counts = np.zeros(CELLS, np.int64)
    for r in found:
        counts[r["cell"]] = r["count"]
    ranges = df.sparkSession.createDataFrame(plan(counts, shards, replicas, slack), "cell long, lo long, hi long, shard long, first long")
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = keyed.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    hit = ranked.join(F.broadcast(ranges), (ranked["cell"] == ranges["cell"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return hit.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows" if not slack else "bounded").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("rank") - F.col("lo")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
