"""``df.write.format("segstream")`` and ``writeStream.format("segstream")``.

A Python Data Source writer cannot run a Spark job at commit, so it cannot
assign stream-wide offsets the way ``table.append`` does.  Instead each task
places its own rows: it routes them (md5 rule), writes one Parquet file per
segment into its own transaction folder with offsets *relative to the file*,
and reports (file, segment, bytes).  The commit, on the driver side, orders
the tasks by partition id, gives every file its base offset after the stream's
tail and records the files with their bases in one log entry.  Readers add the
base (a broadcast join on the file name, sized by the file count in the log);
``compact`` rewrites such files with absolute offsets.

A write job has one start record, which ``prepare`` creates and every task renews
while it writes; the folders of its tasks carry the job's name, so ``vacuum``
leaves them alone until the record has run out, and a commit after that fails
instead of listing files that may be gone. With ``exactly_once=false`` a batch
write commits each task's files when the task ends: they are visible before the
job is done, and a task that runs again appends its rows again.

Streaming writes are exactly-once when the ``query_id`` option names the
query (the commit is keyed by (query_id, batch id)); without it a replayed
batch is appended again (at-least-once).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from segstream import options as O
from segstream.functions.routing import EPOCH_SHIFT, EVENT_HEADER_BYTES


@dataclass
class PiecesMessage(WriterCommitMessage):
    partition_id: int
    txn: str
    pieces: list = field(default_factory=list)  # {path, segment_id, rows, bytes}


def check_schema(schema) -> None:
    """Same checks and texts as ``table.check_write_schema``."""
    from pyspark.sql import types as T

    from segstream.sources.table import MSG_EVENT_MISSING, MSG_EVENT_TYPE, MSG_KEY_TYPE, WriteSchemaError

    fields = {f.name: f.dataType for f in schema.fields}
    if O.ROUTING_KEY in fields and not isinstance(fields[O.ROUTING_KEY], T.StringType):
        raise WriteSchemaError(MSG_KEY_TYPE.format(fields[O.ROUTING_KEY].simpleString()))
    if O.EVENT not in fields:
        raise WriteSchemaError(MSG_EVENT_MISSING)
    if not isinstance(fields[O.EVENT], (T.StringType, T.BinaryType)):
        raise WriteSchemaError(MSG_EVENT_TYPE.format(fields[O.EVENT].simpleString()))


def _segment(key, event: bytes, epoch: int, n: int) -> int:
    digest = hashlib.md5(key.encode("utf-8") if key is not None else event).hexdigest()
    return epoch * EPOCH_SHIFT + ((int(digest[:8], 16) * n) >> 32)


class JobLease:
    """The start record of a write job, renewed from its tasks.

    A batch job whose record has run out is over: its tasks fail and its commit
    is refused. A streaming query is idle between batches, so its record may run
    out and be renewed by the next batch; its commit looks that no file of the
    batch is gone."""

    def __init__(self, o: dict, job: str, streaming: bool):
        self.o, self.job, self.streaming, self.next = o, job, streaming, 0.0
        default = O.DEFAULT_TRANSACTION_TIMEOUT_MS if streaming else O.DEFAULT_BATCH_TRANSACTION_TIMEOUT_MS
        self.timeout_ms = int(o.get(O.TRANSACTION_TIMEOUT_MS, default))

    def _log(self):
        from segstream.sources.log import CommitLog

        return CommitLog(None, self.o[O.PATH], self.o[O.SCOPE], self.o[O.STREAM])

    def _require(self, log, job: str) -> None:
        from segstream.sources.log import TransactionTimeoutError

        until = log.transaction_deadline(job)
        if until is None or time.time() * 1000 >= until:
            raise TransactionTimeoutError(f"write {job} was not renewed within its timeout; nothing was appended")

    def start(self) -> None:
        self._log().start_transaction(self.job, int(time.time() * 1000) + self.timeout_ms)

    def renew(self) -> None:
        """At most four times in a timeout."""
        if time.time() >= self.next:
            log = self._log()
            if not self.streaming:
                self._require(log, self.job)
            log.renew_transaction(self.job, int(time.time() * 1000) + self.timeout_ms)
            self.next = time.time() + self.timeout_ms / 4000

    def check(self, messages) -> None:
        from segstream.sources.log import TransactionTimeoutError

        log = self._log()
        # Spark may commit with another copy of the writer: the folders name the job
        for job in {m.txn.split("-")[0] for m in messages if m is not None and m.pieces}:
            self._require(log, job)
        for p in (p for m in messages if m is not None for p in m.pieces):
            if not log.fs.exists(p["path"]):
                raise TransactionTimeoutError(f"write {self.job} lost {p['path']}; nothing was appended")

    def end(self) -> None:
        self._log().end_transaction(self.job)


def write_pieces(batches, o: dict, epoch: int, n: int, lease: JobLease) -> PiecesMessage:
    """Task side: route, place relative to the file, write one file per segment."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark import TaskContext

    from segstream.sources.log import ArrowFS, _strip_scheme, data_dir

    ctx = TaskContext.get()
    pid = ctx.partitionId() if ctx is not None else 0
    txn = f"{lease.job}-{uuid.uuid4().hex}"
    per_seg: dict[int, tuple[list, list]] = {}
    lease.renew()
    for b in batches:
        lease.renew()
        names = b.schema.names
        ev = b.column(names.index(O.EVENT)).to_pylist()
        keys = b.column(names.index(O.ROUTING_KEY)).to_pylist() if O.ROUTING_KEY in names else [None] * len(ev)
        for e, k in zip(ev, keys):
            if e is None:
                raise ValueError("a row to append has no event")
            raw = e.encode("utf-8") if isinstance(e, str) else bytes(e)
            s = _segment(k, raw, epoch, n)
            evs, ks = per_seg.setdefault(s, ([], []))
            evs.append(raw)
            ks.append(k)
    root = o[O.PATH]
    base_dir = f"{data_dir(root, o[O.SCOPE], o[O.STREAM])}/txn={txn}"
    fs = ArrowFS(root)
    stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    pieces = []
    for s, (evs, ks) in sorted(per_seg.items()):
        lens = [EVENT_HEADER_BYTES + len(e) for e in evs]
        offs, acc = [], 0
        for ln in lens:
            offs.append(acc)
            acc += ln
        table = pa.table({
            "event": pa.array(evs, pa.binary()),
            "routing_key": pa.array(ks, pa.string()),
            "seq": pa.nulls(len(evs), pa.int64()),
            "append_ts": pa.array([stamp] * len(evs), pa.timestamp("us")),
            "len": pa.array(lens, pa.int64()),
            "offset": pa.array(offs, pa.int64()),
        })
        folder = f"{base_dir}/segment_id={s}"
        fs.mkdirs(folder)
        path = f"{folder}/part-{pid:05d}-{uuid.uuid4().hex[:8]}.parquet"
        pq.write_table(table, _strip_scheme(path), filesystem=fs.arrow_fs)
        pieces.append({"path": path, "segment_id": s, "rows": len(evs), "bytes": acc})
        lease.renew()
    return PiecesMessage(pid, txn, pieces)


def commit_pieces(o: dict, messages, query_id: str | None = None, batch_id: int | None = None,
                  exactly_once: bool = True) -> int | None:
    """Bases after the tail, in task order; one log entry. If another writer
    commits first, the bases are taken anew behind it."""
    from segstream.sources.log import CommitLog, ConcurrentAppendError

    log = CommitLog(None, o[O.PATH], o[O.SCOPE], o[O.STREAM])
    msgs = sorted([m for m in messages if m is not None and m.pieces], key=lambda m: m.partition_id)
    while msgs:
        snap = log.snapshot()
        if exactly_once and query_id is not None and batch_id is not None and (str(query_id), int(batch_id)) in snap.batches:
            return None
        current = set(snap.current_segments)
        if any(int(p["segment_id"]) not in current for m in msgs for p in m.pieces):
            raise ConcurrentAppendError("the stream was scaled while this write ran; retry the write")
        tail = dict(snap.tail)
        files = []
        for m in msgs:
            for p in m.pieces:
                s = int(p["segment_id"])
                base = int(tail.get(s, 0))
                files.append({"path": p["path"], "segment_id": s, "lo": base, "hi": base + int(p["bytes"]),
                              "rows": int(p["rows"]), "base": base})
                tail[s] = base + int(p["bytes"])
        entry = {"kind": "append", "txn": msgs[0].txn, "txns": [m.txn for m in msgs], "relative": True,
                 "files": files, "tail": {str(k): v for k, v in tail.items()},
                 "rows": sum(f["rows"] for f in files), "query_id": query_id, "batch_id": batch_id}
        try:
            return log.commit(snap, entry)
        except ConcurrentAppendError:
            continue
    return None


def prepare(o: dict) -> tuple[int, int]:
    """Create the stream if allowed; return (epoch, segments) of its newest epoch."""
    from segstream.sources.log import CommitLog

    log = CommitLog(None, o[O.PATH], o[O.SCOPE], o[O.STREAM])
    if not log.stream_exists():
        if O.flag(o, O.ALLOW_CREATE_SCOPE, True):
            log.create_scope()
        elif not log.scope_exists():
            from segstream.sources.table import ScopeNotFoundError

            raise ScopeNotFoundError(f"scope does not exist: {o[O.SCOPE]}")
        if not O.flag(o, O.ALLOW_CREATE_STREAM, True):
            from segstream.sources.log import StreamNotFoundError

            raise StreamNotFoundError(f"stream does not exist: {o[O.SCOPE]}/{o[O.STREAM]}")
        cfg = O.build_stream_config(o)
        log.create_stream(cfg, cfg.scaling.min_segments)
    snap = log.snapshot()
    return snap.epochs[-1]


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, o: dict, schema):
        check_schema(schema)
        self.o = o
        self.epoch, self.n = prepare(o)
        self.exactly_once = O.flag(o, O.EXACTLY_ONCE, True)
        self.lease = JobLease(o, uuid.uuid4().hex, streaming=False)
        self.lease.start()

    def write(self, iterator):
        done = write_pieces(iterator, self.o, self.epoch, self.n, self.lease)
        if not self.exactly_once:
            commit_pieces(self.o, [done])
            done.pieces = []
        return done

    def commit(self, messages):
        if any(m is not None and m.pieces for m in messages):
            self.lease.check(messages)
            commit_pieces(self.o, messages)
        self.lease.end()

    def abort(self, messages):
        # What was not committed stays invisible until vacuum.
        self.lease.end()


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, o: dict, schema):
        check_schema(schema)
        self.o = o
        prepare(o)
        self.query_id = o.get("query_id")
        self.exactly_once = O.flag(o, O.EXACTLY_ONCE, True)
        self.lease = JobLease(o, uuid.uuid4().hex, streaming=True)

    def write(self, iterator):
        # Read the newest epoch per batch so a scaling between batches is followed.
        from segstream.sources.log import CommitLog

        snap = CommitLog(None, self.o[O.PATH], self.o[O.SCOPE], self.o[O.STREAM]).snapshot()
        epoch, n = snap.epochs[-1]
        return write_pieces(iterator, self.o, epoch, n, self.lease)

    def commit(self, messages, batchId):
        if any(m is not None and m.pieces for m in messages):
            self.lease.check(messages)
            commit_pieces(self.o, messages, self.query_id, batchId, self.exactly_once)

    def abort(self, messages, batchId):
        pass
