"""Offset assignment (append order inside each segment).

The offset of an event is the sum of ``len`` over the events before it in its
segment.  A plain ``sum(len) over (partition by segment_id order by seq)``
puts a whole segment in one task, and one segment may hold a third of the
stream.  We do a two-level prefix sum instead:

1. Cut the append order into *blocks*: contiguous ranges of the order.  With
   an explicit order the blocks are approximate quantiles of the order columns,
   ties in one split by the next (``block_by_order``, distributed and JVM-side);
   without one the block is the input partition and the order is (partition,
   row) order.
2. ``groupBy(segment_id, block).sum(len)`` -- a partial aggregate, combined
   map-side; its size is bounded by segments x blocks, not by rows.
3. A running sum over that small table per segment gives the base offset of
   each (segment, block).
4. The rows are hash-partitioned on (segment_id, block) once; a window per
   (segment, block) adds the local running sum.  A group never holds more than
   one block, so a hot segment is spread over as many tasks as it has blocks.
5. The base table joins back on (segment_id, block), null-safe; Spark's own
   size threshold decides whether it is broadcast. A shuffle join only moves
   the small side (the big side is already partitioned on the join keys).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "_blk"
_SEQ = "_seq"
_BASE = "_base"


def _default_blocks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: A value (or tuple prefix) that holds this many blocks' rows is split by the next column.
HEAVY = 2
ENDED = -1.0  #: image of a string behind its last byte; that of a null is lower
CHUNK_BYTES = 6  # bytes of a string in one image: 48 bits are exact in a double


def _images(df: DataFrame, col: str) -> Iterator[Column]:
    """Numbers that together order a column's values; rows that agree in one are
    told apart by the next. Nulls come first. A string yields images without end."""
    kind, c = df.schema[col].dataType.typeName(), F.col(col)
    low = F.lit(float("-inf"))
    if kind in ("string", "binary"):
        raw, at = c.cast("binary"), 1
        while True:  # the next bytes, in byte order; -1 behind the last one
            part = F.substring(raw, at, CHUNK_BYTES)
            number = F.conv(F.rpad(F.hex(part), 2 * CHUNK_BYTES, "0"), 16, 10).cast("double") * 8 + F.length(part)
            yield F.when(c.isNull(), low).when(F.length(part) > 0, number).otherwise(F.lit(ENDED))
            at += CHUNK_BYTES
    if kind in ("timestamp", "timestamp_ntz", "date"):
        c = F.unix_micros(c.cast("timestamp"))
    image = c.cast("double")
    yield F.coalesce(F.when(F.isnan(image), F.lit(float("inf"))).otherwise(image), low)
    if kind in ("long", "decimal"):  # what a double leaves out of a large number
        whole = c.cast("decimal(38,0)") - F.floor(image.cast("decimal(38,0)"))
        yield F.coalesce(whole.cast("double"), low)


def _levels(df: DataFrame, cols: Sequence[str]) -> Iterator[tuple[Column, Column | None]]:
    """Images of all order columns in turn. A string's go on while a row that is
    asked about has more bytes (the second column tells)."""
    for col in cols:
        if df.schema[col].dataType.typeName() not in ("string", "binary"):
            for image in _images(df, col):
                yield image, None
            continue
        at = CHUNK_BYTES
        for image in _images(df, col):
            more = F.coalesce(F.octet_length(F.col(col).cast("binary")) > at, F.lit(False))
            if (yield image, more) is False:
                break
            at += CHUNK_BYTES


def _split(cuts: list[float], share: int) -> tuple[list[float], dict[int, int]]:
    """Block borders from quantiles, and the blocks that hold one value alone
    with as many blocks' rows as it takes quantiles; with all if nulls or ended
    strings take all quantiles, whose next images tell nothing and take nothing."""
    borders, heavy = [], {}
    for value in sorted({float(c) for c in cuts if c is not None}):
        n = sum(1 for c in cuts if c == value)
        if n == len(cuts) > 1 and value <= ENDED:
            n = share
        if not borders or borders[-1] < value:
            borders.append(value)
        if n >= HEAVY and share > 1:
            heavy[len(borders)] = n
            borders.append(math.nextafter(value, math.inf))
    return borders, heavy


def _finite(image: Column) -> Column:
    return F.least(F.greatest(image, F.lit(-1.7e308)), F.lit(1.7e308))


@dataclass
class _Cuts:
    """Ranges of one image, and of those that hold one value how the next splits them."""

    level: int
    borders: list[float]
    heavy: dict[int, int]
    below: dict[int, "_Cuts"] = field(default_factory=dict)
    starts: list[int] = field(default_factory=list)

    def number(self, at: int) -> int:
        """Number the blocks from ``at`` on, in order; return the next number."""
        self.starts = []
        for i in range(len(self.borders) + 1):
            self.starts.append(at)
            at = self.below[i].number(at) if i in self.below else at + 1
        return at

    def open_blocks(self) -> dict[int, tuple["_Cuts", int, int]]:
        """Number of each heavy block not split yet -> (cuts, index, share)."""
        found = {self.starts[i]: (self, i, n) for i, n in self.heavy.items() if i not in self.below}
        for b in self.below.values():
            found.update(b.open_blocks())
        return found

    def block(self, images: list[Column], index: Column | None = None) -> Column:
        """The block of a row, from its images. (Each index is written out once
        for the number and once for each split range: never level by level.)"""
        if index is None:
            values = ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in self.borders)
            index = F.size(F.filter(F.expr(f"CAST(array({values}) AS array<double>)"), lambda c: c <= images[self.level]))
        out = F.element_at(F.expr("array(" + ", ".join(f"{v}L" for v in self.starts) + ")"), index + 1)
        if not self.below:
            return out
        inner = None
        for i, b in self.below.items():
            inner = (F.when if inner is None else inner.when)(index == i, b.block(images))
        return inner.otherwise(out)


def block_by_order(df: DataFrame, order_by: Sequence[str] | str, blocks: int) -> DataFrame:
    """Add ``_blk``: about ``blocks`` contiguous ranges of the whole order tuple.

    The first image of the order is cut at its quantiles. A value that takes
    several of them is a block of its own, which the next image of the same
    column, then the next columns split further, until no block is heavy or the
    columns are used up. Every step is one distributed aggregate that brings back
    the quantiles (at most ``blocks`` numbers); without ties there is one step."""
    from pyspark.ml.feature import Bucketizer

    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    zero = F.lit(0).cast("bigint")
    if blocks <= 1:
        return df.withColumn(_BLOCK, zero)
    levels = _levels(df, cols)
    image, more = next(levels)
    images, probe, root_index = [_finite(image)], f"{_BLOCK}_x", f"{_BLOCK}_i"
    x = df.withColumn(probe, images[0])
    # one distributed pass, K numbers back; an error well under a block's share
    quantiles = x.approxQuantile(probe, [i / blocks for i in range(1, blocks)], min(0.01, 0.25 / blocks))
    root = _Cuts(0, *_split(quantiles, blocks))
    if not root.borders:  # no rows
        return x.drop(probe).withColumn(_BLOCK, zero)
    bucketizer = Bucketizer(splits=[float("-inf"), *root.borders, float("inf")], inputCol=probe, outputCol=root_index, handleInvalid="keep")
    x = bucketizer.transform(x).withColumn(root_index, F.col(root_index).cast("int"))

    def blocked() -> DataFrame:
        root.number(0)
        return x.withColumn(_BLOCK, root.block(images, F.col(root_index)))

    out = blocked()
    while heavy := root.open_blocks():
        rows = out.where(F.col(_BLOCK).isin(sorted(heavy)))
        try:
            if more is not None:
                image, more = levels.send(bool(rows.agg(F.coalesce(F.max(more), F.lit(False))).first()[0]))
            else:
                image, more = next(levels)
        except StopIteration:
            break
        images.append(_finite(image))
        _split_heavy(rows, images, heavy)
        out = blocked()
    return out.drop(probe, root_index)


def _split_heavy(rows: DataFrame, images: list[Column], heavy: dict[int, tuple[_Cuts, int, int]]) -> None:
    most = max(n for _, _, n in heavy.values())
    probs = F.array(*[F.lit(i / most) for i in range(1, most)])
    found = rows.groupBy(_BLOCK).agg(F.percentile_approx(images[-1], probs, F.lit(max(10_000, 10 * most))).alias("q")).collect()
    quantiles = {int(r[_BLOCK]): list(r["q"]) for r in found}
    for b, (cuts, index, n) in heavy.items():
        q = quantiles.get(b, [])
        own = [q[min(len(q), round((i + 1) * most / n)) - 1] for i in range(n - 1)] if q else []
        cuts.below[index] = _Cuts(len(images) - 1, *_split(own, n))


def assign_offsets(
    df: DataFrame,
    order_by: Sequence[str] | str | None = None,
    base: dict[int, int] | None = None,
    blocks: int | None = None,
    segment_col: str = "segment_id",
    len_col: str = "len",
    offset_col: str = "offset",
) -> DataFrame:
    """Add ``offset``: exclusive running sum of ``len`` per segment in append order.

    ``order_by``: columns giving the append order (must be unique per segment);
    when absent the order is the input's (partition, row) order, which is
    stable only for a deterministic input.  ``base``: per-segment offset to
    start from (the tail of the stream before this append).
    """
    if isinstance(order_by, str):
        order_by = [order_by]
    order_by = list(order_by or [])

    if order_by:
        k = blocks or _default_blocks(df)
        keyed = block_by_order(df, order_by, k)
        order_cols = [F.col(c) for c in order_by]
    else:
        keyed = df.withColumn(_BLOCK, F.spark_partition_id().cast("bigint")).withColumn(
            _SEQ, F.monotonically_increasing_id()
        )
        order_cols = [F.col(_SEQ)]

    seg = F.col(segment_col)
    # Partial sums straight from the input: map-side combined, so this branch
    # shuffles (segment, block) sums per map task, not rows.  (Deriving them
    # from the row exchange instead would shuffle every row a second time.)
    partial = keyed.groupBy(segment_col, _BLOCK).agg(F.sum(len_col).alias("_bytes"))
    before = Window.partitionBy(segment_col).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_bytes").over(before), F.lit(0)).cast("bigint")
    if base:
        start = start + F.coalesce(F.element_at(_base_map(base), seg), F.lit(0)).cast("bigint")
    bases = partial.select(segment_col, _BLOCK, start.alias(_BASE))

    bases = bases.withColumnRenamed(segment_col, "_bseg").withColumnRenamed(_BLOCK, "_bblk")
    local = Window.partitionBy(segment_col, _BLOCK).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    out = (
        keyed.repartition(segment_col, _BLOCK)
        .withColumn("_local", F.coalesce(F.sum(len_col).over(local), F.lit(0)).cast("bigint"))
        .join(bases, F.col(segment_col).eqNullSafe(F.col("_bseg")) & F.col(_BLOCK).eqNullSafe(F.col("_bblk")), "inner")
        .withColumn(offset_col, (F.col(_BASE) + F.col("_local")).cast("bigint"))
        .drop(_BASE, "_local", _BLOCK, _SEQ, "_bseg", "_bblk")
    )
    return out


def _base_map(base: dict[int, int]) -> Column:
    """Per-segment start offsets as one map literal (one entry per segment)."""
    items = ", ".join(f"CAST({int(k)} AS BIGINT), CAST({int(base[k])} AS BIGINT)" for k in sorted(base))
    return F.expr(f"map({items})")


def place_rows(df: DataFrame, order_by: Sequence[str], base: dict[int, int] | None, tasks: int, segment_col: str = "segment_id",
               len_col: str = "len", offset_col: str = "offset") -> DataFrame:
    """As ``assign_offsets``, laid out for writing: ``tasks`` partitions of about
    equal bytes, each a contiguous range of (segment, offset), sorted, so that a
    file holds a narrow extent.

    The sums of (segment, block) place a block as well as they give its offset:
    a block goes to the partition that its bytes fall into when all segments are
    laid end to end. That table has at most segments x blocks rows, which bounds
    what is broadcast; the rows move once and no bounds are sampled for it."""
    blocks = 4 * tasks if tasks > 1 else 1
    keyed = block_by_order(df, order_by, blocks)
    partial = keyed.groupBy(segment_col, _BLOCK).agg(F.sum(len_col).alias("_bytes"))
    inside = Window.partitionBy(segment_col).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_bytes").over(inside), F.lit(0)).cast("bigint")
    if base:
        start = start + F.coalesce(F.element_at(_base_map(base), F.col(segment_col)), F.lit(0)).cast("bigint")
    over_all = Window.orderBy(segment_col, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_bytes").over(over_all), F.lit(0)).cast("double")
    task = F.least(F.floor(ahead * tasks / F.sum("_bytes").over(Window.partitionBy())), F.lit(tasks - 1)).cast("int")
    plan = partial.select(F.col(segment_col).alias("_pseg"), F.col(_BLOCK).alias("_pblk"), start.alias(_BASE), task.alias("_task"))
    rows = keyed.join(F.broadcast(plan), (F.col(segment_col) == F.col("_pseg")) & (F.col(_BLOCK) == F.col("_pblk")))
    local = Window.partitionBy("_task", segment_col, _BLOCK).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col(_BASE) + F.coalesce(F.sum(len_col).over(local), F.lit(0))
    return (
        rows.repartitionById(tasks, "_task")
        .withColumn(offset_col, offset.cast("bigint"))
        .drop(_BASE, "_task", _BLOCK, "_pseg", "_pblk")
        .sortWithinPartitions(segment_col, offset_col)
    )
