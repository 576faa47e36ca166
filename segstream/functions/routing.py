"""Column functions for placing events: key position, segment, event length.

A routing key maps to a position in ``[0, 2^32)`` taken from the first 32 bits
of its MD5; an epoch with ``n`` uniform key ranges puts the key in segment
number ``position * n div 2^32``.  Segment ids carry the epoch in their high
32 bits (``epoch * 2^32 + number``) so ``(segment_id, offset)`` order follows
the order of epochs.  Events without a key are placed by the hash of their own
bytes, so a retried task puts each event in the same segment again.

Everything is a built-in expression: it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SPACE = 1 << 32  # positions are 32-bit
EPOCH_SHIFT = 1 << 32  # segment_id = epoch * EPOCH_SHIFT + number
EVENT_HEADER_BYTES = 8  # an event takes 8 + its byte length in a segment


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_position(routing_key, event=None) -> Column:
    """First 32 bits of md5(routing_key) as a bigint; md5(event) when the key is null."""
    digest = F.md5(_col(routing_key))
    if event is not None:
        digest = F.coalesce(digest, F.md5(_col(event)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def segment_number(position, n_segments: int) -> Column:
    """Uniform key ranges: ``position * n div 2^32`` (exact integer arithmetic)."""
    return F.shiftright(_col(position) * F.lit(int(n_segments)), 32).cast("bigint")


def segment_for_key(routing_key, n_segments: int, epoch: int = 0, event=None) -> Column:
    """Segment id of a key for an epoch of ``n_segments`` uniform ranges."""
    seg = segment_number(key_position(routing_key, event), n_segments)
    if epoch:
        seg = seg + F.lit(int(epoch) * EPOCH_SHIFT)
    return seg


def event_length(event) -> Column:
    """Bytes an event takes in its segment: 8 + octet_length(event)."""
    return (F.lit(EVENT_HEADER_BYTES) + F.octet_length(_col(event))).cast("bigint")


def epoch_of(segment_id) -> Column:
    return F.shiftright(_col(segment_id), 32)


def number_of(segment_id) -> Column:
    return F.pmod(_col(segment_id), F.lit(EPOCH_SHIFT))
