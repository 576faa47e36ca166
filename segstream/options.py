"""Options of the ``segstream`` format: names, validation, positions and the
stream configuration (scaling and retention policies).

Option keys are case-insensitive, as in every Spark data source.
"""

from __future__ import annotations

import enum
import json
from dataclasses import dataclass, field

from pyspark.errors import PySparkValueError

# --- fixed values: option names (must equal the reference's for user code to carry over)
SCOPE = "scope"
STREAM = "stream"
PATH = "path"
CONTROLLER = "controller"
TRANSACTION_TIMEOUT_MS = "transaction_timeout_ms"
START_STREAM_CUT = "start_stream_cut"
END_STREAM_CUT = "end_stream_cut"
ALLOW_CREATE_SCOPE = "allow_create_scope"
ALLOW_CREATE_STREAM = "allow_create_stream"
DEFAULT_NUM_SEGMENTS = "default_num_segments"
READ_AFTER_WRITE_CONSISTENCY = "read_after_write_consistency"
TRANSACTION_STATUS_POLL_INTERVAL_MS = "transaction_status_poll_interval_ms"
METADATA = "metadata"
DEFAULT_SCALE_FACTOR = "default_scale_factor"
DEFAULT_SEGMENT_TARGET_RATE_BYTES_PER_SEC = "default_segment_target_rate_bytes_per_sec"
DEFAULT_SEGMENT_TARGET_RATE_EVENTS_PER_SEC = "default_segment_target_rate_events_per_sec"
DEFAULT_RETENTION_DURATION_MILLISECONDS = "default_retention_duration_milliseconds"
DEFAULT_RETENTION_SIZE_BYTES = "default_retention_size_bytes"
EXACTLY_ONCE = "exactly_once"
APPROX_BYTES_PER_TRIGGER = "approx_bytes_per_trigger"

POSITION_EARLIEST = "earliest"
POSITION_LATEST = "latest"
POSITION_UNBOUNDED = "unbounded"

METADATA_STREAM_INFO = "StreamInfo"
METADATA_STREAMS = "Streams"

ROUTING_KEY = "routing_key"
EVENT = "event"

# --- fixed values: defaults (milliseconds)
DEFAULT_TRANSACTION_TIMEOUT_MS = 30 * 1000
DEFAULT_BATCH_TRANSACTION_TIMEOUT_MS = 2 * 60 * 1000
DEFAULT_TRANSACTION_STATUS_POLL_INTERVAL_MS = 50

# --- fixed values: validation messages
MSG_MISSING = "Missing required option '{}'"
MSG_MULTIPLE_SCALING = "Cannot set multiple options for scaling"
MSG_MULTIPLE_RETENTION = "Cannot have multiple retention policy options"
MSG_NUM_SEGMENTS = "Number of segments needs to be integer and should be at least one"
MSG_SCALE_FACTOR = "Scale factor needs to be an integer greater than 1"
MSG_RATE_BYTES = "Target rate should an integer and should at least be 1024 bytes"
MSG_RATE_EVENTS = "Target rate should be an integer amd should be at least one event per second"
MSG_RETENTION_SIZE = "Retention size should be an integer more than or equal to zero bytes"
MSG_RETENTION_TIME = "Retention time should be an integer morethan or equal to zero milliseconds"
MSG_BYTES_PER_TRIGGER = "Max offset should be of type long more than or equal to one"

INT_MAX = 2**31 - 1
LONG_MAX = 2**63 - 1


class _ValueError(PySparkValueError):
    """A PySparkValueError that carries the reference's plain message."""

    def __init__(self, message: str):
        super().__init__(message=message)
        self._plain = message

    def __str__(self) -> str:
        return self._plain


OptionError = _ValueError


def lower_keys(options) -> dict[str, str]:
    """Options as a plain dict with lower-case keys (keys are case-insensitive)."""
    return {str(k).lower(): (None if v is None else str(v)) for k, v in dict(options or {}).items()}


def _parse_int(value: str, lo: int, hi: int = INT_MAX) -> int | None:
    try:
        n = int(str(value).strip())
    except (TypeError, ValueError):
        return None
    if n < lo or n > hi:
        return None
    return n


def validate_options(options) -> dict[str, str]:
    """Check the option map; return it with lower-case keys."""
    o = lower_keys(options)
    if not (o.get(SCOPE) or ""):
        raise _ValueError(MSG_MISSING.format(SCOPE))
    if not (o.get(STREAM) or ""):
        raise _ValueError(MSG_MISSING.format(STREAM))
    if DEFAULT_SEGMENT_TARGET_RATE_BYTES_PER_SEC in o and DEFAULT_SEGMENT_TARGET_RATE_EVENTS_PER_SEC in o:
        raise _ValueError(MSG_MULTIPLE_SCALING)
    if DEFAULT_RETENTION_DURATION_MILLISECONDS in o and DEFAULT_RETENTION_SIZE_BYTES in o:
        raise _ValueError(MSG_MULTIPLE_RETENTION)
    if DEFAULT_NUM_SEGMENTS in o and _parse_int(o[DEFAULT_NUM_SEGMENTS], 1) is None:
        raise _ValueError(MSG_NUM_SEGMENTS)
    if DEFAULT_SCALE_FACTOR in o and _parse_int(o[DEFAULT_SCALE_FACTOR], 2) is None:
        raise _ValueError(MSG_SCALE_FACTOR)
    if DEFAULT_SEGMENT_TARGET_RATE_BYTES_PER_SEC in o and _parse_int(o[DEFAULT_SEGMENT_TARGET_RATE_BYTES_PER_SEC], 1024) is None:
        raise _ValueError(MSG_RATE_BYTES)
    if DEFAULT_SEGMENT_TARGET_RATE_EVENTS_PER_SEC in o and _parse_int(o[DEFAULT_SEGMENT_TARGET_RATE_EVENTS_PER_SEC], 1) is None:
        raise _ValueError(MSG_RATE_EVENTS)
    # Retention limits are longs here (the reference parsed them as int first).
    if DEFAULT_RETENTION_SIZE_BYTES in o and _parse_int(o[DEFAULT_RETENTION_SIZE_BYTES], 0, LONG_MAX) is None:
        raise _ValueError(MSG_RETENTION_SIZE)
    if DEFAULT_RETENTION_DURATION_MILLISECONDS in o and _parse_int(o[DEFAULT_RETENTION_DURATION_MILLISECONDS], 0, LONG_MAX) is None:
        raise _ValueError(MSG_RETENTION_TIME)
    if APPROX_BYTES_PER_TRIGGER in o and _parse_int(o[APPROX_BYTES_PER_TRIGGER], 1, LONG_MAX) is None:
        raise _ValueError(MSG_BYTES_PER_TRIGGER)
    return o


def flag(options: dict[str, str], key: str, default: bool) -> bool:
    v = options.get(key)
    if v is None:
        return default
    return str(v).strip().lower() == "true"


# ---------------------------------------------------------------- positions


class PositionKind(enum.Enum):
    EARLIEST = "earliest"
    LATEST = "latest"
    UNBOUNDED = "unbounded"
    SPECIFIC = "specific"


@dataclass(frozen=True)
class Position:
    """A symbolic or specific stream position (a cut is segment id -> offset)."""

    kind: PositionKind
    cut: tuple[tuple[int, int], ...] = ()

    @staticmethod
    def specific(cut: dict[int, int]) -> "Position":
        return Position(PositionKind.SPECIFIC, tuple(sorted((int(k), int(v)) for k, v in cut.items())))

    def cut_dict(self) -> dict[int, int]:
        return dict(self.cut)


EARLIEST = Position(PositionKind.EARLIEST)
LATEST = Position(PositionKind.LATEST)
UNBOUNDED = Position(PositionKind.UNBOUNDED)


def cut_to_text(cut: dict[int, int]) -> str:
    """Canonical JSON text of a cut: keys are segment ids as strings, sorted numerically."""
    return json.dumps({str(k): int(cut[k]) for k in sorted(cut, key=int)}, separators=(",", ":"))


def cut_from_text(text: str) -> dict[int, int]:
    raw = json.loads(text)
    if isinstance(raw, str):  # a cut quoted once more, as stored in offsets
        raw = json.loads(raw)
    if not isinstance(raw, dict):
        raise _ValueError(f"Not a stream cut: {text!r}")
    return {int(k): int(v) for k, v in raw.items()}


def parse_position(options: dict[str, str], key: str, default: Position) -> Position:
    """Trimmed, case-insensitive earliest / latest / unbounded, else a specific cut."""
    value = options.get(key)
    if value is None:
        return default
    text = value.strip()
    low = text.lower()
    if low == POSITION_LATEST:
        return LATEST
    if low == POSITION_EARLIEST:
        return EARLIEST
    if low == POSITION_UNBOUNDED:
        return UNBOUNDED
    return Position.specific(cut_from_text(text))


# ------------------------------------------------------------ stream config


@dataclass
class ScalingPolicy:
    kind: str = "fixed"  # fixed | by_data_rate | by_event_rate
    target_rate: int = 0  # KiB/s for by_data_rate, events/s for by_event_rate
    scale_factor: int = 0
    min_segments: int = 1

    def to_json(self) -> dict:
        return {"kind": self.kind, "target_rate": self.target_rate, "scale_factor": self.scale_factor,
                "min_segments": self.min_segments}


@dataclass
class RetentionPolicy:
    kind: str = "none"  # none | time | size
    limit: int = 0  # milliseconds or bytes

    def to_json(self) -> dict:
        return {"kind": self.kind, "limit": self.limit}


@dataclass
class StreamConfig:
    scaling: ScalingPolicy = field(default_factory=ScalingPolicy)
    retention: RetentionPolicy = field(default_factory=RetentionPolicy)

    def to_json(self) -> dict:
        return {"scaling": self.scaling.to_json(), "retention": self.retention.to_json()}

    @staticmethod
    def from_json(d: dict) -> "StreamConfig":
        return StreamConfig(ScalingPolicy(**d.get("scaling", {})), RetentionPolicy(**d.get("retention", {})))


def build_stream_config(options) -> StreamConfig:
    """Scaling and retention policies from the options (after validation)."""
    o = lower_keys(options)
    cfg = StreamConfig()
    if DEFAULT_NUM_SEGMENTS in o:
        n = int(o[DEFAULT_NUM_SEGMENTS])
        factor = o.get(DEFAULT_SCALE_FACTOR)
        rate_bytes = o.get(DEFAULT_SEGMENT_TARGET_RATE_BYTES_PER_SEC)
        rate_events = o.get(DEFAULT_SEGMENT_TARGET_RATE_EVENTS_PER_SEC)
        if factor is not None and rate_bytes is not None and rate_events is None:
            cfg.scaling = ScalingPolicy("by_data_rate", int(rate_bytes) // 1024, int(factor), n)
        elif factor is not None and rate_events is not None and rate_bytes is None:
            cfg.scaling = ScalingPolicy("by_event_rate", int(rate_events), int(factor), n)
        else:
            cfg.scaling = ScalingPolicy("fixed", 0, 0, n)
    ms = o.get(DEFAULT_RETENTION_DURATION_MILLISECONDS)
    size = o.get(DEFAULT_RETENTION_SIZE_BYTES)
    if ms is not None and size is None:
        cfg.retention = RetentionPolicy("time", int(ms))
    elif size is not None and ms is None:
        cfg.retention = RetentionPolicy("size", int(size))
    return cfg
