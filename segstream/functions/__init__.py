"""Column functions (all JVM-side built-in expressions)."""

from segstream.functions.cuts import cut_from_json, cut_to_json
from segstream.functions.routing import (
    EPOCH_SHIFT,
    KEY_SPACE,
    epoch_of,
    event_length,
    key_position,
    number_of,
    segment_for_key,
    segment_number,
)

__all__ = [
    "EPOCH_SHIFT", "KEY_SPACE", "cut_from_json", "cut_to_json", "epoch_of",
    "event_length", "key_position", "number_of", "segment_for_key", "segment_number",
]
