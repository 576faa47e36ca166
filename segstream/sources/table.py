"""Event tables: append, read between cuts, metadata and maintenance.

Reads go through Spark's Parquet source over the committed transaction
folders, so Catalyst prunes ``segment_id`` partitions, pushes offset ranges to
row-group statistics, prunes columns and keeps the scan vectorised.  Appends
route and place events with DataFrame expressions, write with Spark's Parquet
writer into a fresh transaction folder, and become visible with one log entry.
"""

from __future__ import annotations

import datetime as _dt
import threading
import time
import uuid
from urllib.parse import unquote
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segstream import options as O
from segstream.functions.routing import EPOCH_SHIFT, event_length, key_position, segment_number
from segstream.operators.cuts import filter_ranges, segment_ranges
from segstream.operators.maintain import head_cut_frame, retain_appended, retain_by_time, truncate_at
from segstream.operators.offsets import place_rows
from segstream.sources.log import (
    CommitLog,
    ConcurrentAppendError,
    Snapshot,
    StreamNotFoundError,
    TransactionTimeoutError,
    data_dir,
    stream_dir,
)
from segstream.sources.marks import boundaries, marks_dir, targets, write_marks

READ_SCHEMA = T.StructType([
    T.StructField("event", T.BinaryType()),
    T.StructField("scope", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("segment_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])

FILE_SCHEMA = T.StructType([
    T.StructField("event", T.BinaryType()),
    T.StructField("routing_key", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("append_ts", T.TimestampNTZType()),
    T.StructField("len", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("txn", T.StringType()),
    T.StructField("segment_id", T.LongType()),
])

# --- fixed values: write-schema error texts
MSG_KEY_TYPE = "routing_key attribute type must be a string; received unsupported type {}"
MSG_EVENT_MISSING = "Required attribute 'event' not found"
MSG_EVENT_TYPE = "event attribute type must be a string or binary; received unsupported type {}"


class WriteSchemaError(ValueError):
    pass


class ScopeNotFoundError(RuntimeError):
    pass


# ------------------------------------------------------------------ create


def ensure_stream(spark: SparkSession, root: str, scope: str, stream: str, opts: dict | None = None) -> CommitLog:
    """Create scope and stream if missing and allowed (config of an existing stream is kept)."""
    o = O.validate_options({**(opts or {}), O.SCOPE: scope, O.STREAM: stream})
    log = CommitLog(spark, root, scope, stream)
    if O.flag(o, O.ALLOW_CREATE_SCOPE, True):
        log.create_scope()
    if O.flag(o, O.ALLOW_CREATE_STREAM, True) and not log.stream_exists():
        if not log.scope_exists():
            raise ScopeNotFoundError(f"scope does not exist: {scope}")
        cfg = O.build_stream_config(o)
        log.create_stream(cfg, cfg.scaling.min_segments)
    return log


# -------------------------------------------------------------------- read


def files_frame(spark: SparkSession, root: str, scope: str, stream: str, snap: Snapshot,
                ranges: dict[int, tuple[int, int | None]] | None = None) -> DataFrame:
    """Committed rows of the snapshot with the storage columns.

    With ``ranges``, only files whose recorded offset extent overlaps a range
    (and is not wholly truncated) are listed: data skipping from the log, done
    at planning time, before Parquet row-group pushdown."""
    base = data_dir(root, scope, stream)
    if not snap.txns:
        return spark.createDataFrame([], FILE_SCHEMA)

    def wanted(f) -> bool:
        if ranges is None:
            return True
        s = int(f["segment_id"])
        if s not in ranges:
            return False
        lo, hi = ranges[s]
        lo = max(lo, int(snap.head.get(s, 0)))
        return int(f["hi"]) > lo and (hi is None or int(f["lo"]) < hi)

    rel_files = [f for f in snap.files if "base" in f and wanted(f)]
    if ranges is None:
        paths = [f"{base}/txn={t}" for t in snap.txns if t not in snap.rel_txns]
    else:
        paths = [f["path"] for f in snap.files if "base" not in f and wanted(f)]
        # Large transactions keep their extents in a manifest: read their folders
        # (segment partition filter and offset statistics still prune).
        paths += [f"{base}/txn={t}" for t in sorted(snap.manifest_txns)]
    parts = []
    if paths:
        parts.append(spark.read.schema(FILE_SCHEMA).option("basePath", base).parquet(*paths))
    if rel_files:
        parts.append(_relative_files(spark, base, rel_files))
    if not parts:
        return spark.createDataFrame([], FILE_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _relative_files(spark: SparkSession, base: str, files: list[dict]) -> DataFrame:
    """Files whose offsets are relative: add each file's base from the log.
    The (file name, base) table has one row per file of the log: its size is
    known here, so it is broadcast."""
    import posixpath

    bases = spark.createDataFrame([(posixpath.basename(f["path"]), int(f["base"])) for f in files],
                                  "_fname string, _fbase bigint")
    df = spark.read.schema(FILE_SCHEMA).option("basePath", base).parquet(*[f["path"] for f in files])
    df = df.withColumn("_fname", F.col("_metadata.file_name")).join(F.broadcast(bases), "_fname")
    return df.withColumn("offset", (F.col("offset") + F.col("_fbase")).cast("bigint")).select(*FILE_SCHEMA.names)


def resolve_batch_bounds(start: O.Position, end: O.Position, snap: Snapshot) -> tuple[dict | None, dict | None]:
    """Batch rule: start earliest/unbounded = beginning, latest is an error;
    end latest/unbounded = tail, earliest is an error."""
    if start.kind in (O.PositionKind.EARLIEST, O.PositionKind.UNBOUNDED):
        s = None
    elif start.kind == O.PositionKind.SPECIFIC:
        s = start.cut_dict()
    else:
        raise O.OptionError("start_stream_cut 'latest' is not allowed in a batch read")
    if end.kind in (O.PositionKind.LATEST, O.PositionKind.UNBOUNDED):
        e = None
    elif end.kind == O.PositionKind.SPECIFIC:
        e = end.cut_dict()
    else:
        raise O.OptionError("end_stream_cut 'earliest' is not allowed in a batch read")
    return s, e


def read_events(spark: SparkSession, root: str, scope: str, stream: str, start: dict | None = None,
                end: dict | None = None, snap: Snapshot | None = None, allow_create: bool = True,
                opts: dict | None = None) -> DataFrame:
    """Visible events between two cuts with all storage columns (plus scope/stream)."""
    log = CommitLog(spark, root, scope, stream)
    if snap is None:
        if not log.stream_exists() and allow_create:
            ensure_stream(spark, root, scope, stream, opts)
        snap = log.snapshot()
    ranges = segment_ranges(snap.all_segments, start, end) if (start is not None or end is not None) else None
    df = files_frame(spark, root, scope, stream, snap, ranges)
    df = truncate_at(df, {s: h for s, h in snap.head.items() if h > 0})  # skip truncated data
    if ranges is not None:
        df = filter_ranges(df, ranges)
    return df.withColumn("scope", F.lit(scope)).withColumn("stream", F.lit(stream))


def read_stream(spark: SparkSession, root: str, scope: str, stream: str,
                start: O.Position | dict | None = None, end: O.Position | dict | None = None,
                opts: dict | None = None) -> DataFrame:
    """The five-column read schema between two positions (batch semantics)."""
    start = _position(start, O.EARLIEST)
    end = _position(end, O.LATEST)
    o = O.lower_keys(opts or {})
    log = CommitLog(spark, root, scope, stream)
    if not log.stream_exists() and O.flag(o, O.ALLOW_CREATE_STREAM, True):
        ensure_stream(spark, root, scope, stream, o)
    snap = log.snapshot()
    s, e = resolve_batch_bounds(start, end, snap)
    df = read_events(spark, root, scope, stream, s, e, snap=snap)
    return df.select("event", "scope", "stream", "segment_id", "offset")


def _position(p, default: O.Position) -> O.Position:
    if p is None:
        return default
    if isinstance(p, O.Position):
        return p
    if isinstance(p, dict):
        return O.Position.specific(p)
    return O.parse_position({"p": str(p)}, "p", default)


# ------------------------------------------------------------------- write


def check_write_schema(df: DataFrame) -> None:
    """``event`` string or binary is required, ``routing_key`` must be a string
    (exact, case-sensitive names); checked on the driver before any job runs."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    if O.ROUTING_KEY in fields and not isinstance(fields[O.ROUTING_KEY], T.StringType):
        raise WriteSchemaError(MSG_KEY_TYPE.format(fields[O.ROUTING_KEY].simpleString()))
    if O.EVENT not in fields:
        raise WriteSchemaError(MSG_EVENT_MISSING)
    if not isinstance(fields[O.EVENT], (T.StringType, T.BinaryType)):
        raise WriteSchemaError(MSG_EVENT_TYPE.format(fields[O.EVENT].simpleString()))


class NullEventError(ValueError):
    """A row to append has no event."""


def project_for_write(df: DataFrame, order_by: list[str] | None) -> DataFrame:
    """The stored columns; ``seq`` is the first order column where it is an
    integer (else its whole part), ``_o0``, ``_o1``, ... are the order columns
    as they are, ``_row`` the input's (partition, row) order, ``_pos`` the position
    of the routing key (hashed once, whatever epoch the rows are placed in)."""
    keep = [F.col(O.EVENT).cast("binary").alias("event")]
    if O.ROUTING_KEY in df.columns:
        keep.append(F.col(O.ROUTING_KEY).cast("string").alias("routing_key"))
    else:
        keep.append(F.lit(None).cast("string").alias("routing_key"))
    if order_by:
        first = F.col(order_by[0])
        if df.schema[order_by[0]].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
            keep.append(F.unix_micros(first.cast("timestamp")).alias("seq"))
        else:
            keep.append(F.expr(f"try_cast(`{order_by[0]}` AS bigint)").alias("seq"))
        keep += [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    else:
        keep.append(F.lit(None).cast("bigint").alias("seq"))
    stored = df.select(*keep, F.monotonically_increasing_id().alias("_row"))
    return stored.withColumn("_pos", key_position("routing_key", "event")).withColumn("len", event_length("event"))


@dataclass
class AppendResult:
    version: int | None
    txn: str | None
    rows: int
    skipped: bool = False


def append(df: DataFrame, root: str, scope: str, stream: str, order_by: str | list[str] | None = None,
           opts: dict | None = None, query_id: str | None = None, batch_id: int | None = None,
           exactly_once: bool | None = None) -> AppendResult:
    """Append the rows of ``df`` (columns ``event`` and optional ``routing_key``).

    ``order_by``: columns giving the append order, of any ordered type; ties,
    and rows without ``order_by``, keep the input's (partition, row) order.
    With ``query_id``/``batch_id`` and exactly-once on, a batch that was
    committed before is skipped (replays after a failure).

    The input is evaluated once, into a staging folder; offsets are computed
    from what was staged, so an input that changes when it is read again still
    gives every row once. If another writer commits first, the staged rows are
    placed again behind its tail and the commit is repeated; a truncation in
    between only repeats the commit. The writer renews its transaction while it
    lives; one that was not renewed within ``transaction_timeout_ms`` raises
    TransactionTimeoutError, a null event NullEventError, and nothing is visible.
    """
    spark = df.sparkSession
    o = O.lower_keys(opts or {})
    if exactly_once is None:
        exactly_once = O.flag(o, O.EXACTLY_ONCE, True)
    check_write_schema(df)
    if isinstance(order_by, str):
        order_by = [order_by]
    log = CommitLog(spark, root, scope, stream)
    if not log.stream_exists():
        if not O.flag(o, O.ALLOW_CREATE_SCOPE, True) and not log.scope_exists():
            raise ScopeNotFoundError(f"scope does not exist: {scope}")
        if not O.flag(o, O.ALLOW_CREATE_STREAM, True):
            raise StreamNotFoundError(f"stream does not exist: {scope}/{stream}")
        ensure_stream(spark, root, scope, stream, o)
    if _committed(log.snapshot(), query_id, batch_id, exactly_once):
        return AppendResult(None, None, 0, skipped=True)
    timeout = _timeout_ms(o, batch_id is not None)
    txn = uuid.uuid4().hex
    target = f"{data_dir(root, scope, stream)}/txn={txn}"
    staging = f"{stream_dir(root, scope, stream)}/_staging/{txn}"
    log.fs.mkdirs(target)
    with Lease(log, txn, timeout) as lease:
        try:
            seen = Observation()
            counted = project_for_write(df, order_by).observe(
                seen, F.count(F.lit(1)).alias("rows"), F.count("event").alias("events"), F.sum("len").alias("bytes"))
            counted.write.parquet(staging)
            return _place_and_commit(spark, log, staging, seen.get, target, lease, order_by, query_id, batch_id, exactly_once)
        finally:
            log.fs.delete(staging)


class Lease:
    """The right to commit a transaction: a record with a deadline that the
    writer keeps moving while it lives. A writer that dies, or can't renew for
    the whole timeout, has lost it, and ``vacuum`` may delete its folder."""

    def __init__(self, log: CommitLog, txn: str, timeout_ms: int):
        self.log, self.txn, self.timeout_ms = log, txn, timeout_ms
        self.until, self.ended = 0, threading.Event()

    def __enter__(self) -> Lease:
        self.until = _now_ms() + self.timeout_ms
        self.log.start_transaction(self.txn, self.until)
        threading.Thread(target=self._keep, daemon=True).start()
        return self

    def _keep(self) -> None:
        while not self.ended.wait(self.timeout_ms / 4000) and self.held():
            until = _now_ms() + self.timeout_ms
            self.log.renew_transaction(self.txn, until)
            self.until = until

    def held(self) -> bool:
        return _now_ms() < self.until and self.log.transaction_deadline(self.txn) is not None

    def __exit__(self, *_) -> None:
        self.ended.set()
        self.log.end_transaction(self.txn)


def _now_ms() -> int:
    return int(time.time() * 1000)


def _timeout_ms(o: dict, streaming: bool) -> int:
    default = O.DEFAULT_TRANSACTION_TIMEOUT_MS if streaming else O.DEFAULT_BATCH_TRANSACTION_TIMEOUT_MS
    return int(o.get(O.TRANSACTION_TIMEOUT_MS, default))


def _committed(snap: Snapshot, query_id, batch_id, exactly_once: bool) -> bool:
    return exactly_once and query_id is not None and batch_id is not None and (str(query_id), int(batch_id)) in snap.batches


TASK_BYTES = 128 << 20  #: bytes of events that one task of an append places
SMALL_TASK_BYTES = 4 << 20  #: as few tasks as this leaves work for, up to the shuffle partitions


def _tasks(spark: SparkSession, size: int) -> int:
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // SMALL_TASK_BYTES))
    return max(1, few, -(-size // TASK_BYTES))


def _place_and_commit(spark: SparkSession, log: CommitLog, staging: str, total: dict, target: str, lease: Lease, order_by: list[str] | None,
                      query_id, batch_id, exactly_once: bool) -> AppendResult:
    """Write the staged rows behind the tail and commit; again if the tail moved."""
    txn = lease.txn
    if total["events"] < total["rows"]:
        raise NullEventError(f"{total['rows'] - total['events']} rows have no event")
    if not total["rows"]:
        return AppendResult(None, None, 0)  # an empty append writes no log entry
    staged = spark.read.parquet(staging)
    order = [f"_o{i}" for i in range(len(order_by or []))] + ["_row"]
    placed_at = None
    while True:
        snap = log.snapshot()
        if _committed(snap, query_id, batch_id, exactly_once):
            return AppendResult(None, None, 0, skipped=True)
        epoch, n = snap.epochs[-1]
        base = {s: snap.tail.get(s, 0) for s in snap.current_segments}
        if placed_at != (epoch, base):
            stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            routed = staged.withColumn("segment_id", segment_number("_pos", n) + F.lit(epoch * EPOCH_SHIFT)).withColumn(
                "append_ts", F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
            )
            (
                place_rows(routed, order, base, _tasks(spark, int(total["bytes"])))
                .select("event", "routing_key", "seq", "append_ts", "len", "offset", "segment_id")
                .write.mode("overwrite")
                .partitionBy("segment_id")
                .parquet(target)
            )
            files, manifest, tail, rows = _extents(spark, target, stream_dir(log.root, log.scope, log.stream), txn)
            if rows != total["rows"]:
                raise TransactionTimeoutError(f"transaction {txn} holds {rows} of {total['rows']} rows")
            placed_at = (epoch, base)
        if not lease.held():
            raise TransactionTimeoutError(f"transaction {txn} was not renewed within its timeout; nothing was appended")
        entry = {"kind": "append", "txn": txn, "files": files, "manifest": manifest, "marked": True,
                 "tail": {str(k): v for k, v in tail.items()}, "rows": rows, "query_id": query_id, "batch_id": batch_id}
        try:
            return AppendResult(log.commit(snap, entry), txn, rows)
        except ConcurrentAppendError:
            continue


INLINE_FILES_MAX = 20000  # beyond this many files a transaction's extents go to a Parquet manifest


def _extents(spark: SparkSession, target: str, stream_folder: str, txn: str):
    """Per-file extents of a written transaction, and per-segment tails, from the
    event boundaries that are written beside it (``marks``).

    Up to ``INLINE_FILES_MAX`` files the extents come back to the driver and
    go into the log entry (one row per file).  Beyond that they are written as
    a Parquet manifest by the executors and only the per-segment tails (one
    row per segment) come back."""
    events = spark.read.schema("len bigint, offset bigint, segment_id bigint").parquet(target)
    marks = write_marks(events, marks_dir(stream_folder, txn))
    ext = marks.groupBy("path", "segment_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("rows").alias("rows"))
    head = ext.limit(INLINE_FILES_MAX + 1).collect()
    if len(head) <= INLINE_FILES_MAX:
        files = [_extent_row(r) for r in head]
        tail: dict[int, int] = {}
        for f in files:
            tail[f["segment_id"]] = max(tail.get(f["segment_id"], 0), f["hi"])
        return files, None, tail, sum(f["rows"] for f in files)
    manifest_path = f"{stream_folder}/_manifests/{txn}"
    ext.write.mode("overwrite").parquet(manifest_path)
    per = spark.read.parquet(manifest_path).groupBy("segment_id").agg(
        F.max("hi").alias("hi"), F.sum("rows").alias("rows")).collect()
    return [], manifest_path, {int(r["segment_id"]): int(r["hi"]) for r in per}, int(sum(r["rows"] for r in per))


def _extent_row(r) -> dict:
    return {"path": unquote(r["path"]), "segment_id": int(r["segment_id"]), "lo": int(r["lo"]), "hi": int(r["hi"]),
            "rows": int(r["rows"])}


def next_cut(spark: SparkSession, root: str, scope: str, stream: str, start: dict[int, int], budget: int,
             end: dict[int, int] | None = None) -> dict[int, int]:
    """Next cut under a byte budget, from the event boundaries kept beside the
    files: one small row a segment is read, no event. (Files that a format write
    left have no boundaries until ``compact``; of those the events of each
    segment's budget window are read.)"""
    from segstream.operators.cuts import budget_per_segment, next_cut_frame
    from segstream.sources.log import iter_files, _txn_of_path

    snap = CommitLog(spark, root, scope, stream).snapshot()
    each = budget_per_segment(budget, len(start))
    cut, wanted = targets(start, each, end, snap.head, snap.tail)
    txns: set[str] = set()
    for f in iter_files(snap, wanted):
        if int(f["lo"]) < wanted[int(f["segment_id"])] <= int(f["hi"]):
            txns.add(_txn_of_path(f["path"]))
    if txns <= snap.marked:
        folder = stream_dir(root, scope, stream)
        return cut | (boundaries(spark, [marks_dir(folder, t) for t in sorted(txns)], wanted) if wanted else {})
    asked = {s: int(start[s]) for s in wanted}
    events = read_events(spark, root, scope, stream, start=asked, end=wanted, snap=snap)
    rows = next_cut_frame(events, asked, each * len(asked), {s: wanted[s] for s in asked}).collect()
    return cut | {int(r["segment_id"]): int(r["position"]) for r in rows}


# --------------------------------------------------------------- metadata


def stream_info(spark: SparkSession, root: str, scope: str, stream: str, opts: dict | None = None) -> DataFrame:
    """The StreamInfo table: one row, head and tail cut as text."""
    log = CommitLog(spark, root, scope, stream)
    if not log.stream_exists():
        ensure_stream(spark, root, scope, stream, opts)
    snap = log.snapshot()
    return spark.createDataFrame(
        [(O.cut_to_text(snap.head_cut()), O.cut_to_text(snap.tail_cut()))],
        "head_stream_cut string, tail_stream_cut string",
    )


def list_streams(spark: SparkSession, root: str, scope: str) -> DataFrame:
    """The Streams table: (scope_name, stream_name) for every stream of a scope."""
    log = CommitLog(spark, root, scope, "_")
    names = log.list_streams()
    return spark.createDataFrame([(scope, s) for s in names], "scope_name string, stream_name string")


# ------------------------------------------------------------- maintenance


def truncate(spark: SparkSession, root: str, scope: str, stream: str, cut: dict[int, int]) -> int:
    """Move the head: events before the cut are no longer visible."""
    log = CommitLog(spark, root, scope, stream)
    while True:
        try:
            return log.commit(log.snapshot(), {"kind": "truncate", "head": {str(int(k)): int(v) for k, v in cut.items()}})
        except ConcurrentAppendError:
            continue  # the head only moves forward, whatever was committed before it


def scale(spark: SparkSession, root: str, scope: str, stream: str, segments: int) -> int:
    """Seal every current segment and start a new epoch of uniform key ranges."""
    log = CommitLog(spark, root, scope, stream)
    while True:
        snap = log.snapshot()
        try:
            return log.commit(snap, {"kind": "scale", "epoch": snap.current_epoch + 1, "segments": int(segments)})
        except ConcurrentAppendError:
            continue  # what was appended meanwhile stays in the epoch that this one seals


def retention_cut(spark: SparkSession, root: str, scope: str, stream: str) -> dict[int, int] | None:
    """The head cut the stream's retention policy asks for (None: no policy)."""
    log = CommitLog(spark, root, scope, stream)
    snap = log.snapshot()
    policy = O.StreamConfig.from_json(snap.config).retention
    if policy.kind == "none":
        return None
    if policy.kind == "size":
        return size_cut(spark, root, scope, stream, snap, policy.limit)
    events = read_events(spark, root, scope, stream, snap=snap)
    keep = retain_by_time(events, policy.limit, now=_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    return {int(r["segment_id"]): int(r["position"]) for r in head_cut_frame(keep, events).collect()}


def size_cut(spark: SparkSession, root: str, scope: str, stream: str, snap: Snapshot, limit: int) -> dict[int, int]:
    """The head cut that keeps the newest events of at most ``limit`` bytes.

    The extents of the files tell, from the newest transaction back, which ones
    stay whole; inside the one where the limit is reached, the event boundaries
    tell where. No event is read, unless that transaction holds events of many
    append times (a compaction) or was left by a format write: then its events
    are, and only they."""
    from dataclasses import replace

    from segstream.sources.log import iter_files, _txn_of_path

    folder = stream_dir(root, scope, stream)
    pieces: dict[str, dict[int, tuple[int, int]]] = {}
    headed: dict[str, dict[int, int]] = {}  # transactions that a head lies inside of
    for f in iter_files(snap):
        s, txn = int(f["segment_id"]), _txn_of_path(f["path"])
        lo, hi, head = int(f["lo"]), int(f["hi"]), snap.head.get(s, 0)
        if hi > head:
            if lo < head and txn in snap.marked:
                headed.setdefault(txn, {})[s] = head
            of = pieces.setdefault(txn, {})
            was = of.get(s, (max(lo, head), hi))
            of[s] = (min(was[0], max(lo, head)), max(was[1], hi))
    for txn, heads in headed.items():  # the first event that a head inside an event leaves
        for s, at in boundaries(spark, [marks_dir(folder, txn)], heads).items():
            pieces[txn][s] = (at, pieces[txn][s][1])
    cut: dict[int, int] = {}
    for of in pieces.values():
        for s, (_, hi) in of.items():
            cut[s] = max(hi, cut.get(s, 0))
    left = int(limit)
    for txn in reversed(snap.txns):
        of = pieces.get(txn, {})
        size = sum(hi - lo for lo, hi in of.values())
        if size <= left:
            left -= size
            cut.update({s: lo for s, (lo, _) in of.items()})
            continue
        if txn in snap.rel_txns or txn in snap.compacted or txn not in snap.marked:
            alone = replace(snap, txns=[txn], files=[f for f in iter_files(snap) if _txn_of_path(f["path"]) == txn], manifests=[])
            keep = retain_appended(read_events(spark, root, scope, stream, snap=alone), left)
            cut.update({int(r["segment_id"]): int(r["at"]) for r in keep.groupBy("segment_id").agg(F.min("offset").alias("at")).collect()})
            break
        for s in sorted(of, reverse=True):  # of one append time: the higher segment is the newer
            lo, hi = of[s]
            if hi - lo <= left:
                left -= hi - lo
                cut[s] = lo
            else:
                if left:
                    cut |= boundaries(spark, [marks_dir(folder, txn)], {s: hi - left})
                break
        break
    return cut


def apply_retention(spark: SparkSession, root: str, scope: str, stream: str) -> dict[int, int] | None:
    cut = retention_cut(spark, root, scope, stream)
    if cut:
        truncate(spark, root, scope, stream, cut)
    return cut


def load_report(spark: SparkSession, root: str, scope: str, stream: str, window: str = "1 minute") -> DataFrame:
    """Events and bytes per segment and time window of the current epoch,
    flagged against the stream's scaling policy (``needs_split``)."""
    from segstream.operators.maintain import segment_load

    log = CommitLog(spark, root, scope, stream)
    snap = log.snapshot()
    policy = O.StreamConfig.from_json(snap.config).scaling
    events = read_events(spark, root, scope, stream, snap=snap)
    events = events.where(F.col("segment_id").isin([int(s) for s in snap.current_segments]))
    return segment_load(
        events, window,
        target_events_per_sec=policy.target_rate if policy.kind == "by_event_rate" else None,
        target_kib_per_sec=policy.target_rate if policy.kind == "by_data_rate" else None,
    )


def autoscale(spark: SparkSession, root: str, scope: str, stream: str, window: str = "1 minute") -> int | None:
    """Apply the stream's rate policy once: when a segment of the current epoch
    went over the target rate in a window, scale to ``segments * factor``.
    Returns the new segment count, or None when nothing changes (fixed
    policies never scale).  Only one row per flagged window comes back."""
    log = CommitLog(spark, root, scope, stream)
    snap = log.snapshot()
    policy = O.StreamConfig.from_json(snap.config).scaling
    if policy.kind == "fixed" or policy.scale_factor < 2:
        return None
    hot = load_report(spark, root, scope, stream, window).where("needs_split").limit(1).count()
    if not hot:
        return None
    n = len(snap.current_segments) * policy.scale_factor
    scale(spark, root, scope, stream, n)
    return n


COMPACT_TARGET_BYTES = 128 << 20


def compact(spark: SparkSession, root: str, scope: str, stream: str, target_bytes: int = COMPACT_TARGET_BYTES) -> int | None:
    """Rewrite the visible events into few large files, range-partitioned on
    ``(segment_id, offset)`` so each file holds a contiguous offset range of one
    segment (narrow extents for data skipping).  Offsets do not change.  The
    old transaction folders stay on disk for readers of older snapshots until
    ``vacuum`` removes them after the transaction timeout.
    """
    import math

    log = CommitLog(spark, root, scope, stream)
    snap = log.snapshot()
    if not snap.txns:
        return None
    live = sum(max(0, t - snap.head.get(s, 0)) for s, t in snap.tail.items())
    parts = max(1, math.ceil(live / max(1, int(target_bytes))))
    df = truncate_at(files_frame(spark, root, scope, stream, snap), {s: h for s, h in snap.head.items() if h > 0})
    txn, replaced = uuid.uuid4().hex, list(snap.txns)
    target = f"{data_dir(root, scope, stream)}/txn={txn}"
    log.fs.mkdirs(target)
    with Lease(log, txn, O.DEFAULT_BATCH_TRANSACTION_TIMEOUT_MS) as lease:
        (
            df.select("event", "routing_key", "seq", "append_ts", "len", "offset", "segment_id")
            .repartitionByRange(parts, "segment_id", "offset")
            .sortWithinPartitions("segment_id", "offset")
            .write.mode("overwrite")
            .partitionBy("segment_id")
            .parquet(target)
        )
        files, manifest, _, _ = _extents(spark, target, stream_dir(root, scope, stream), txn)
        entry = {"kind": "compact", "txn": txn, "files": files, "manifest": manifest, "marked": True, "replaced": replaced}
        while True:
            if not lease.held():
                raise TransactionTimeoutError(f"compaction {txn} was not renewed within its timeout; nothing was replaced")
            try:
                return log.commit(snap, entry)
            except ConcurrentAppendError:
                snap = log.snapshot()  # appends and truncations in between leave the rewrite good
                if not set(replaced) <= set(snap.txns):
                    raise


def drop_truncated(spark: SparkSession, root: str, scope: str, stream: str) -> list[str]:
    """Drop from the stream every transaction whose files all end at or before
    the head (truncation or retention made them invisible), with one log
    entry; ``vacuum`` deletes their folders once the timeout has passed."""
    from segstream.sources.log import iter_files, _txn_of_path

    log = CommitLog(spark, root, scope, stream)
    while True:
        snap = log.snapshot()
        if not snap.head:
            return []
        live: set[str] = set()
        seen: set[str] = set()
        for f in iter_files(snap):
            t = _txn_of_path(f["path"])
            seen.add(t)
            if int(f["hi"]) > int(snap.head.get(int(f["segment_id"]), 0)):
                live.add(t)
        gone = sorted(seen - live)
        try:
            if gone:
                log.commit(snap, {"kind": "drop", "txns": gone})
            return gone
        except ConcurrentAppendError:
            continue


def vacuum(spark: SparkSession, root: str, scope: str, stream: str, older_than_ms: int | None = None) -> list[str]:
    """Delete transaction folders that are no longer needed, with their manifests:

    * aborted ones, once their lease has run out (their writer can't commit any
      more);
    * ones replaced by compaction or dropped after truncation, once the default
      timeout has passed since that commit, so that readers bound before it can
      finish (``older_than_ms`` replaces that time, and the timeout of folders
      without a start record).

    Folders are listed before the log is read, so a transaction that commits in
    between is seen as committed.
    """
    log = CommitLog(spark, root, scope, stream)
    base, manifests = data_dir(root, scope, stream), f"{stream_dir(root, scope, stream)}/_manifests"
    folders = [d[len("txn="):] for d in log.fs.list_dirs(base) if d.startswith("txn=")]
    lists = log.fs.list_dirs(manifests)
    marks = f"{stream_dir(root, scope, stream)}/_marks"
    marked = [d[len("txn="):] for d in log.fs.list_dirs(marks) if d.startswith("txn=")]
    snap = log.snapshot()
    limit = O.DEFAULT_BATCH_TRANSACTION_TIMEOUT_MS if older_than_ms is None else int(older_than_ms)
    now, committed, removed = _now_ms(), set(snap.txns), []
    for txn in folders:
        if txn in committed:
            continue
        if txn in snap.removed:
            until = snap.removed[txn] + limit
        else:
            until = log.transaction_deadline(txn.split("-")[0])  # tasks of a format write share their job's record
            if until is None:
                until = log.fs.modification_time_ms(f"{base}/txn={txn}") + limit
        if now >= until:
            log.fs.delete(f"{base}/txn={txn}")
            log.end_transaction(txn)
            removed.append(txn)
    gone = [t for t in removed if t in snap.removed]
    if gone:
        try:
            log.commit(snap, {"kind": "vacuum", "txns": gone})
        except ConcurrentAppendError:
            pass  # the record stays until the next vacuum
    for d in lists:
        if d in removed or d not in snap.manifest_txns and d not in folders:
            log.fs.delete(f"{manifests}/{d}")
    for d in marked:
        if d in removed or d not in snap.marked and d not in folders:
            log.fs.delete(f"{marks}/txn={d}")
    return removed


def uncommitted_txns(spark: SparkSession, root: str, scope: str, stream: str) -> list[str]:
    log = CommitLog(spark, root, scope, stream)
    committed = set(log.snapshot().txns)
    base = data_dir(root, scope, stream)
    return [d[4:] for d in log.fs.list_dirs(base) if d.startswith("txn=") and d[4:] not in committed]
