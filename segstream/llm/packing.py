"""Hierarchical multi-length packing of token ids.

Tiers are context sizes, powers of two from 512 to 4096. A document first gives
whole windows of the largest tier; what remains is routed to the smallest tier
that holds it. Tiers are packed from the longest down: each piece opens a window
of its tier, and the gap behind it is filled with the longest shorter pieces
that fit; the last gap is closed by cutting a piece of the shortest tier there
is. Full windows are powers of two long and need no padding. Windows of one
tier are dealt into step groups of ``step_tokens`` tokens each, so every step
has one shape and the same number of tokens.

Each input partition is packed on its own and without a shuffle: pieces wait in
a pool of at most ``pool_tokens`` tokens, the one window that stays open moves
on to the next pool, and the end of a partition is split into powers of two
down to the smallest tier. Only the last few hundred tokens of a partition can
be padded. Sequence ids hold the partition number in their upper bits, so a
task that runs again gives the same ids.

Defined results: a null or empty text is its end id alone; a null doc_id is
kept as it is; repeated rows are packed each; an empty table gives an empty
result; other columns are dropped.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.llm.tokens import encoder

TIERS = (512, 1024, 2048, 4096)
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)
FIELDS = [x.strip().split()[0] for x in SCHEMA.split(",")]

Piece = tuple[int, int, tuple]  # length, start, (doc_id, ids of the document)


class Packer:
    """Packs the documents of one partition; ``rows`` collects placed pieces."""

    def __init__(self, partition: int, tiers: tuple[int, ...], pool_tokens: int, step_tokens: int):
        self.tiers, self.largest, self.pool_tokens, self.step_tokens = tiers, tiers[-1], pool_tokens, step_tokens
        self.prefix = partition << 32
        self.sequences = 0
        self.dealt = dict.fromkeys(tiers, 0)
        self.pool: list[Piece] = []
        self.waiting = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece], tier: int) -> None:
        """Write out one window; ``tier`` names its step group."""
        offset = 0
        group = (self.prefix << 3) + (self.tiers.index(tier) << 32) + self.dealt[tier] // max(1, self.step_tokens // tier)
        self.dealt[tier] += 1
        for length, start, (doc_id, ids) in pieces:
            crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            self.rows.append((doc_id, start, length, crc, len(ids), self.prefix + self.sequences, offset, tier, group))
            offset += length
        self.sequences += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        doc, start = (doc_id, ids), 0
        while len(ids) - start >= self.largest:
            self.close([(self.largest, start, doc)], self.largest)
            start += self.largest
        if start < len(ids):
            self.pool.append((len(ids) - start, start, doc))
            self.waiting += len(ids) - start
            if self.waiting >= self.pool_tokens:
                self.pack()

    def pack(self) -> None:
        """Close every window but the last; its pieces are the next pool."""
        pool = sorted(self.pool, key=lambda p: (p[0], p[1]))
        lengths = [p[0] for p in pool]
        while pool:
            opened = [pool.pop()]
            lengths.pop()
            tier = next(t for t in self.tiers if t >= opened[0][0])
            gap = tier - opened[0][0]
            while gap and pool:
                i = bisect.bisect_right(lengths, gap) - 1
                if i < 0:  # the shortest is too long: cut it
                    length, start, doc = pool.pop(0)
                    lengths.pop(0)
                    opened.append((gap, start, doc))
                    at = bisect.bisect_left(lengths, length - gap)
                    pool.insert(at, (length - gap, start + gap, doc))
                    lengths.insert(at, length - gap)
                    gap = 0
                else:
                    opened.append(pool.pop(i))
                    gap -= lengths.pop(i)
            if gap:
                pool = opened
                break
            self.close(opened, tier)
        self.pool, self.waiting = pool, sum(p[0] for p in pool)

    def finish(self) -> None:
        """The last open window becomes powers of two and one short rest."""
        self.pack()
        while self.waiting:
            size = next((t for t in reversed(self.tiers) if t <= self.waiting), self.waiting)
            window, left = [], size
            while left:
                length, start, doc = self.pool.pop(0)
                part = min(length, left)
                window.append((part, start, doc))
                if part < length:
                    self.pool.insert(0, (length - part, start + part, doc))
                left -= part
            self.close(window, next(t for t in self.tiers if t >= size))
            self.waiting -= size

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(FIELDS)
        self.rows = []
        kinds = [pa.int32() if n == "tier" else pa.int64() for n in FIELDS]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FIELDS)


def pack_documents(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, tiers: tuple[int, ...] = TIERS,
    pool_tokens: int = 1 << 20, step_tokens: int = 1 << 15,
) -> DataFrame:
    """One row for each piece of ``docs`` (doc_id, text): where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, e = None, encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                if packer is None and part.num_rows:
                    packer = Packer(part["part"][0].as_py(), tiers, pool_tokens, step_tokens)
                for doc_id, packed in zip(part["doc_id"].to_pylist(), e.packed(part["text"].to_pylist())):
                    packer.add(doc_id, np.append(np.frombuffer(packed, e.dtype), np.array(end_id, e.dtype)))
                if len(packer.rows) >= 4096:
                    yield packer.take()
        if packer is not None:
            packer.finish()
            yield packer.take()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, SCHEMA)
