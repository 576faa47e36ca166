"""``spark.read.format("segstream")`` / ``spark.readStream.format("segstream")``.

A Python Data Source over the event tables.  Its code runs in Python workers
(planning on the driver side, reading on executors), so it reads the commit
log and the Parquet files with pyarrow: one input partition per committed file
that overlaps the requested range, read with column projection and an offset
filter.  ``segstream.sources.table.read_stream`` is the native-scan path for
batch jobs (Catalyst pushdown, vectorised reader); this source gives the
option-driven surface and the streaming reader.

Options: ``path`` (table root), ``scope``, ``stream``, ``start_stream_cut``,
``end_stream_cut``, ``approx_bytes_per_trigger``, ``metadata``
(``StreamInfo`` / ``Streams``), ``append_time`` (``true`` adds the column
``append_ts``, for event-time windows) and the stream-creation options.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from segstream import options as O
from segstream.operators.cuts import budget_per_segment, segment_ranges

READ_SCHEMA_DDL = "event binary, scope string, stream string, segment_id bigint, offset bigint"
APPEND_TIME_DDL = READ_SCHEMA_DDL + ", append_ts timestamp_ntz"
STREAM_INFO_DDL = "head_stream_cut string, tail_stream_cut string"
STREAMS_DDL = "scope_name string, stream_name string"


APPEND_TIME = "append_time"


def register(spark) -> None:
    spark.dataSource.register(SegstreamDataSource)


def _root(o: dict) -> str:
    root = o.get(O.PATH)
    if not root:
        raise O.OptionError(O.MSG_MISSING.format(O.PATH))
    return root


def _log(o: dict):
    from segstream.sources.log import CommitLog

    return CommitLog(None, _root(o), o[O.SCOPE], o[O.STREAM])


def _existing(o: dict):
    """The log of the stream; a missing stream is created where that is allowed."""
    log = _log(o)
    if log.stream_exists():
        return log
    if not O.flag(o, O.ALLOW_CREATE_STREAM, True):
        raise O.OptionError(f"stream {o[O.SCOPE]}/{o[O.STREAM]} does not exist")
    if O.flag(o, O.ALLOW_CREATE_SCOPE, True):
        log.create_scope()
    elif not log.scope_exists():
        raise O.OptionError(f"scope does not exist: {o[O.SCOPE]}")
    config = O.build_stream_config(o)
    log.create_stream(config, config.scaling.min_segments)
    return log


@dataclass
class FilePart(InputPartition):
    path: str
    segment_id: int
    lo: int
    hi: int | None
    base: int = 0  # added to the stored offsets (files written by the Python writer)


@dataclass
class FileGroup(InputPartition):
    """Several file slices read by one task (small files are packed together)."""

    parts: list


PACK_BYTES = 128 << 20  # target bytes per input partition, like spark.sql.files.maxPartitionBytes


PACK_MIN_BYTES = 4 << 20
PACK_SPREAD = 16  # aim for up to this many partitions per scan before packing to PACK_BYTES


def _pack(parts: list[FilePart], target: int | None = None) -> list[FileGroup]:
    """Packing of file slices by their byte extent, in segment and offset
    order.  The target size spreads a scan over up to ``PACK_SPREAD`` tasks,
    between ``PACK_MIN_BYTES`` and ``PACK_BYTES`` per task; a partition only
    grows past the target when one slice does."""
    if target is None:
        total = sum((p.hi - p.lo) if p.hi is not None else PACK_BYTES for p in parts)
        target = min(PACK_BYTES, max(PACK_MIN_BYTES, total // PACK_SPREAD))
    groups, cur, size = [], [], 0
    for p in sorted(parts, key=lambda x: (x.segment_id, x.lo)):
        est = p.hi - p.lo if p.hi is not None else PACK_BYTES
        if cur and size + est > target:
            groups.append(FileGroup(cur))
            cur, size = [], 0
        cur.append(p)
        size += est
    if cur:
        groups.append(FileGroup(cur))
    return groups


@dataclass
class RowsPart(InputPartition):
    rows: list


def _file_parts(snap, ranges: dict[int, tuple[int, int | None]]) -> list[FileGroup]:
    """Files overlapping the ranges, each clipped to its range (truncated
    prefixes skipped), packed into input partitions."""
    from segstream.sources.log import iter_files

    parts = []
    for f in iter_files(snap, ranges.keys()):
        s = int(f["segment_id"])
        if s not in ranges:
            continue
        lo, hi = ranges[s]
        lo = max(lo, int(snap.head.get(s, 0)))
        if f["hi"] <= lo or (hi is not None and f["lo"] >= hi):
            continue
        clip_lo, clip_hi = max(lo, int(f["lo"])), int(f["hi"]) if hi is None else min(hi, int(f["hi"]))
        parts.append(FilePart(f["path"], s, clip_lo, clip_hi, int(f.get("base", 0))))
    return _pack(parts)


def _read_file(part: FilePart, o: dict) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    from segstream.sources.log import ArrowFS, _strip_scheme

    fs = ArrowFS(part.path).arrow_fs
    pf = pq.ParquetFile(_strip_scheme(part.path), filesystem=fs)
    lo = part.lo - part.base
    hi = None if part.hi is None else part.hi - part.base
    groups = _row_groups_in_range(pf, lo, hi)
    if not groups:
        return
    extra = ["append_ts"] if O.flag(o, APPEND_TIME, False) else []
    scope, stream = o[O.SCOPE], o[O.STREAM]
    for batch in pf.iter_batches(columns=["event", "offset", *extra], batch_size=65536, row_groups=groups):
        off = batch.column(1)
        if part.base:
            off = pc.add(off, pa.scalar(part.base, pa.int64()))
            batch = batch.set_column(1, "offset", off)
        mask = pc.greater_equal(off, pa.scalar(part.lo, pa.int64()))
        if part.hi is not None:
            mask = pc.and_(mask, pc.less(off, pa.scalar(part.hi, pa.int64())))
        b = batch.filter(mask)
        if b.num_rows == 0:
            continue
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.binary()), pa.nulls(n, pa.string()).fill_null(scope),
             pa.nulls(n, pa.string()).fill_null(stream), pa.nulls(n, pa.int64()).fill_null(part.segment_id),
             b.column(1), *[b.column(2).cast(pa.timestamp("us")) for _ in extra]],
            names=["event", "scope", "stream", "segment_id", "offset", *extra],
        )


def _row_groups_in_range(pf, lo: int, hi: int | None) -> list[int]:
    """Row groups whose offset statistics overlap ``[lo, hi)`` (all when a
    group has no statistics)."""
    md = pf.metadata
    col = md.schema.names.index("offset")
    keep = []
    for i in range(md.num_row_groups):
        st = md.row_group(i).column(col).statistics
        if st is None or not st.has_min_max:
            keep.append(i)
            continue
        if st.max < lo or (hi is not None and st.min >= hi):
            continue
        keep.append(i)
    return keep


class SegstreamDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segstream"

    def __init__(self, options):
        super().__init__(options)
        self.o = O.validate_options(options)
        meta = self.o.get(O.METADATA)
        if meta is not None and meta not in (O.METADATA_STREAM_INFO, O.METADATA_STREAMS):
            raise O.OptionError(f"Unknown metadata table '{meta}'; use StreamInfo or Streams")
        self.meta = meta

    def schema(self):
        if self.meta == O.METADATA_STREAM_INFO:
            return STREAM_INFO_DDL
        if self.meta == O.METADATA_STREAMS:
            return STREAMS_DDL
        return APPEND_TIME_DDL if O.flag(self.o, APPEND_TIME, False) else READ_SCHEMA_DDL

    def reader(self, schema):
        if self.meta is not None:
            return MetaReader(self.o, self.meta)
        return BatchReader(self.o)

    def streamReader(self, schema):
        if self.meta is not None:
            raise O.OptionError("metadata tables support batch reads only")
        return StreamReader(self.o)

    def writer(self, schema, overwrite):
        if overwrite:
            raise O.OptionError("segstream tables are append-only: save mode Overwrite is not supported")
        from segstream.sources.pywrite import BatchWriter

        return BatchWriter(self.o, schema)

    def streamWriter(self, schema, overwrite):
        if overwrite:
            raise O.OptionError("segstream tables are append-only: complete mode would need a truncate")
        from segstream.sources.pywrite import StreamWriter

        return StreamWriter(self.o, schema)


class BatchReader(DataSourceReader):
    def __init__(self, o: dict):
        self.o = o
        self.snap = _existing(o).snapshot()  # bind positions now (planning time)
        start = O.parse_position(o, O.START_STREAM_CUT, O.EARLIEST)
        end = O.parse_position(o, O.END_STREAM_CUT, O.LATEST)
        from segstream.sources.table import resolve_batch_bounds

        s, e = resolve_batch_bounds(start, end, self.snap)
        if e is None:
            e = dict(self.snap.tail)  # latest binds to the tail now
        self.ranges = segment_ranges(self.snap.all_segments, s, e)

    def partitions(self):
        return _file_parts(self.snap, self.ranges)

    def read(self, partition):
        for part in partition.parts:
            yield from _read_file(part, self.o)


class MetaReader(DataSourceReader):
    def __init__(self, o: dict, meta: str):
        self.o = o
        self.meta = meta

    def partitions(self):
        log = _log(self.o)
        if self.meta == O.METADATA_STREAMS:
            rows = [(self.o[O.SCOPE], s) for s in log.list_streams()]
        else:
            snap = log.snapshot()
            rows = [(O.cut_to_text(snap.head_cut()), O.cut_to_text(snap.tail_cut()))]
        return [RowsPart(rows)]

    def read(self, partition):
        yield from (tuple(r) for r in partition.rows)


class StreamReader(DataSourceStreamReader):
    """Micro-batch reader.  Offsets are cuts (``{"<segment>": offset}``).

    Start defaults to ``latest``, end to ``unbounded``; both bind once, on the
    first call.  With ``approx_bytes_per_trigger`` each batch takes the next
    cut under that budget; ``latestOffset`` never changes state, the reader
    only remembers the end of the last planned batch.

    Spark fixes the end of an ``availableNow`` run with one such call and does
    not tell a Python source about the trigger, so with a budget that run ends
    after one batch. ``segstream.streaming.drain`` reads to the tail in batches
    under the budget and then stops.
    """

    def __init__(self, o: dict):
        self.o = o
        self.budget = int(o[O.APPROX_BYTES_PER_TRIGGER]) if O.APPROX_BYTES_PER_TRIGGER in o else None
        self._start = None
        self._end = None
        self._resolved = False
        self._last_end = None

    # -- binding --------------------------------------------------------
    def _snap(self):
        return _log(self.o).snapshot()

    def _resolve(self):
        if self._resolved:
            return
        snap = _existing(self.o).snapshot()
        start = O.parse_position(self.o, O.START_STREAM_CUT, O.LATEST)
        end = O.parse_position(self.o, O.END_STREAM_CUT, O.UNBOUNDED)
        if start.kind in (O.PositionKind.EARLIEST, O.PositionKind.UNBOUNDED):
            self._start = snap.head_cut()
        elif start.kind == O.PositionKind.LATEST:
            self._start = snap.tail_cut()
        else:
            self._start = start.cut_dict()
        if end.kind == O.PositionKind.LATEST:
            self._end = snap.tail_cut()
        elif end.kind == O.PositionKind.SPECIFIC:
            self._end = end.cut_dict()
        elif end.kind == O.PositionKind.UNBOUNDED:
            self._end = None
        else:
            raise O.OptionError("end_stream_cut 'earliest' is not allowed in a streaming read")
        self._resolved = True

    # -- offsets --------------------------------------------------------
    def initialOffset(self):
        self._resolve()
        return _offset(self._start)

    def latestOffset(self):
        self._resolve()
        snap = self._snap()
        from segstream.sources.log import stream_dir

        frm = self._last_end if self._last_end is not None else self._start
        frm = _advance_epoch(snap, _skip_truncated(snap, frm))
        if self.budget is None:
            nxt = _tail_from(snap, frm)
        else:
            nxt = _next_cut_files(snap, frm, self.budget, stream_dir(self.o[O.PATH], self.o[O.SCOPE], self.o[O.STREAM]))
        if self._end is not None:
            nxt = _cap(nxt, self._end)
        return _offset(nxt)

    def partitions(self, start, end):
        s, e = _cut(start), _cut(end)
        self._last_end = e
        snap = self._snap()
        ranges = segment_ranges(snap.all_segments, s, e)
        return _file_parts(snap, ranges)

    def read(self, partition):
        for part in partition.parts:
            yield from _read_file(part, self.o)

    def commit(self, end):
        pass


def _offset(cut: dict[int, int]) -> dict:
    return {str(k): int(v) for k, v in sorted(cut.items())}


def _cut(offset: dict) -> dict[int, int]:
    return {int(k): int(v) for k, v in offset.items()}


def _skip_truncated(snap, cut: dict[int, int]) -> dict[int, int]:
    """A position before the head jumps to the head."""
    return {s: max(int(c), int(snap.head.get(s, 0))) for s, c in cut.items()}


def _advance_epoch(snap, cut: dict[int, int]) -> dict[int, int]:
    """When every segment of the cut is sealed and read to its end, move to
    the next epoch's segments at 0 (readers go on across a scaling)."""
    while cut and all(s in snap.sealed and cut[s] >= snap.sealed[s] for s in cut):
        e = max(s >> 32 for s in cut)
        nxt = snap.segments_of(e + 1)
        if not nxt:
            break
        cut = {s: int(snap.head.get(s, 0)) for s in nxt}
    return cut


def _tail_from(snap, frm: dict[int, int]) -> dict[int, int]:
    """Everything available: the tail cut of the newest epoch (never behind ``frm``)."""
    tail = snap.tail_cut()
    return {s: max(int(t), int(frm.get(s, 0))) for s, t in tail.items()}


def _cap(cut: dict[int, int], end: dict[int, int]) -> dict[int, int]:
    e_end = max(s >> 32 for s in end) if end else 0
    out = {}
    for s, c in cut.items():
        if s in end:
            out[s] = min(int(c), int(end[s]))
        elif (s >> 32) > e_end:
            return dict(end)
        else:
            out[s] = c
    return out


def _next_cut_files(snap, frm: dict[int, int], budget: int, stream_folder: str) -> dict[int, int]:
    """Next cut under the byte budget, from the event boundaries kept beside the
    files (``marks``): one small row a segment. Only a file that a format write
    left, which has none, gives its ``offset`` and ``len`` columns. Segments are
    looked up in parallel threads (pyarrow releases the GIL while it reads)."""
    from concurrent.futures import ThreadPoolExecutor

    from segstream.sources.log import ArrowFS, _strip_scheme, _txn_of_path, iter_files
    from segstream.sources.marks import boundary_in, marks_dir, targets

    cut, wanted = targets(frm, budget_per_segment(budget, len(frm)), None, snap.head, snap.tail)
    holds = {int(f["segment_id"]): f for f in iter_files(snap, wanted)
             if int(f["lo"]) < wanted[int(f["segment_id"])] <= int(f["hi"])}

    def advance(s: int) -> tuple[int, int]:
        f = holds[s]
        txn = _txn_of_path(f["path"])
        if txn in snap.marked:
            folder = marks_dir(stream_folder, txn)
            return s, boundary_in(ArrowFS(folder).arrow_fs, _strip_scheme(folder), s, wanted[s])
        return s, _window_end(f, int(f["lo"]), wanted[s])

    if not wanted:
        return cut
    with ThreadPoolExecutor(max_workers=min(16, len(wanted))) as pool:
        return cut | dict(pool.map(advance, wanted))


def _window_end(f: dict, lo: int, hi: int) -> int | None:
    """End of the last event of file ``f`` whose start offset is in ``[lo, hi)``."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    from segstream.sources.log import ArrowFS, _strip_scheme

    fs = ArrowFS(f["path"]).arrow_fs
    base = int(f.get("base", 0))
    t = pq.read_table(_strip_scheme(f["path"]), columns=["offset", "len"], filesystem=fs,
                      filters=[("offset", ">=", lo - base), ("offset", "<", hi - base)])
    if not t.num_rows:
        return None
    return pc.max(pc.add(t.column("offset"), t.column("len"))).as_py() + base
