"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables.  Keys match ``segstream.plans.oracle.ORACLE``.

Queries that exercise the table layer write into a fresh table root under the
session's shared folder (``spark.checkpoint.dir``) and return the read-back.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segstream.functions.cuts import cut_from_json, cut_to_json
from segstream.operators import ranges
from segstream.operators.batches import batch_ids
from segstream.operators.cuts import cut_filter, filter_ranges, next_cut_frame
from segstream.operators.maintain import retain_by_size, retain_by_time, scale_stream, segment_load, truncate_at
from segstream.operators.meta import stream_info
from segstream.operators.offsets import assign_offsets
from segstream.operators.order import with_key_seq
from segstream.options import cut_to_text
from segstream.plans.fixture import events_stream, table
from segstream.session import fresh_table_root
from segstream.sources import table as TB

N_SEGMENTS = 3
# --- fixed parameters of the queries
BUDGETS = (1, 10, 20, 33, 100, 1000, 100000)
RETENTION_MS = 7 * 24 * 3600 * 1000
RETENTION_BYTES = 100000
UPDATE_BATCHES = 10
SCALE_AFTER = 6
LOAD_TARGET = 0.0025  # events a second: nine an hour


def _payload(df: DataFrame) -> DataFrame:
    return df.withColumn("payload", F.col("event").cast("string"))


def _seq_marks(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Order thresholds at 1/4, 1/2, 7/8 of the event_id range (one aggregate)."""
    r = table(spark, sf_dir, "events").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(r["lo"]), int(r["hi"])
    span = hi - lo
    return {"t1": lo + span // 4, "t2": lo + (3 * span) // 4, "mid": lo + span // 2, "t3": lo + (7 * span) // 8}


def _cut_at(df: DataFrame, seq_from: int) -> dict[int, int]:
    """Cut at the first event with seq >= ``seq_from`` in each segment (tail when none)."""
    rows = df.groupBy("segment_id").agg(
        F.min(F.when(F.col("seq") >= F.lit(seq_from), F.col("offset"))).alias("first"),
        F.max(F.col("offset") + F.col("len")).alias("tail"),
    ).collect()
    return {int(r["segment_id"]): int(r["first"] if r["first"] is not None else r["tail"]) for r in rows}


def _write_events(spark: SparkSession, sf_dir: str, **kw) -> tuple[str, TB.AppendResult]:
    root = fresh_table_root(spark, "q")
    ev = table(spark, sf_dir, "events")
    src = ev.select(F.col("props").alias("event"), F.col("user_id").cast("string").alias("routing_key"), "event_id")
    res = TB.append(src, root, "demo", "events", order_by="event_id",
                    opts={"default_num_segments": str(N_SEGMENTS)}, **kw)
    return root, res


def _read_payload(spark, root, **kw) -> DataFrame:
    return _payload(TB.read_stream(spark, root, "demo", "events", **kw)).select("payload", "segment_id", "offset")


# ---------------------------------------------------------------- placement


def q_route_to_segment(spark, sf_dir):
    return events_stream(spark, sf_dir, N_SEGMENTS).select("seq", "routing_key", "segment_id")


def q_assign_offsets(spark, sf_dir):
    return events_stream(spark, sf_dir, N_SEGMENTS).select("seq", "segment_id", "offset", "len")


# --------------------------------------------------------------------- scans


def q_scan_full(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir)
    df = TB.read_stream(spark, root, "demo", "events")
    return _payload(df).select("payload", "scope", "stream", "segment_id", "offset")


def q_scan_columns(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir)
    return TB.read_stream(spark, root, "demo", "events").select("segment_id", "offset")


def q_count_events(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir)
    return TB.read_stream(spark, root, "demo", "events").agg(F.count(F.lit(1)).alias("events"))


def q_decode_event(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return _payload(ev).select("segment_id", "offset", "payload")


def q_scan_defaults(spark, sf_dir):
    """Whole stream through ``spark.read.format("segstream")`` with no positions."""
    from segstream.sources.datasource import register

    root, _ = _write_events(spark, sf_dir)
    register(spark)
    df = spark.read.format("segstream").option("path", root).option("scope", "demo").option("stream", "events").load()
    return _payload(df).select("payload", "segment_id", "offset")


STREAM_SCAN_BATCHES = 8


def _stream_rows(spark, root: str, start: str, restart: bool) -> DataFrame:
    """What ``readStream`` delivers from ``start`` to the tail under a byte budget,
    collected by a file sink. With ``restart`` the query is stopped after a few
    batches and started again from its checkpoint."""
    from segstream.sources.datasource import register
    from segstream.sources.log import CommitLog
    from segstream.streaming import drain

    register(spark)
    size = sum(CommitLog(spark, root, "demo", "events").snapshot().tail.values())
    source = (
        spark.readStream.format("segstream").option("path", root).option("scope", "demo").option("stream", "events")
        .option("start_stream_cut", start).option("approx_bytes_per_trigger", str(max(1, size // STREAM_SCAN_BATCHES))).load()
    )
    out, checkpoint = fresh_table_root(spark, "out"), fresh_table_root(spark, "ckpt")
    sink = source.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if restart:
        first = sink.start()
        while first.isActive and sum(p["numInputRows"] > 0 for p in first.recentProgress) < 3 and not first.status["message"].startswith("Waiting"):
            time.sleep(0.05)
        first.stop()
    drain(sink.start())
    return _payload(spark.read.schema(source.schema).parquet(out)).select("payload", "scope", "stream", "segment_id", "offset")


def q_stream_scan(spark, sf_dir):
    """The whole stream through ``readStream``, with a stop and a restart on the way."""
    root, _ = _write_events(spark, sf_dir)
    return _stream_rows(spark, root, "earliest", restart=True)


def q_scan_cut_range(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    root, _ = _write_events(spark, sf_dir)
    ev = TB.read_events(spark, root, "demo", "events")
    start, end = _cut_at(ev, m["t1"]), _cut_at(ev, m["t2"])
    return _read_payload(spark, root, start=start, end=end)


def q_scan_from_cut(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return _payload(cut_filter(ev, start=_cut_at(ev, m["t1"]))).select("payload", "segment_id", "offset")


def q_scan_to_cut(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return _payload(cut_filter(ev, end=_cut_at(ev, m["t2"]))).select("payload", "segment_id", "offset")


def q_union_self(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir)
    df = _read_payload(spark, root)
    return df.unionAll(df)


# ---------------------------------------------------------------- cuts


def _next_cut(budget: int) -> Callable:
    def q(spark, sf_dir):
        ev = events_stream(spark, sf_dir, N_SEGMENTS)
        head = {s: 0 for s in range(N_SEGMENTS)}
        return next_cut_frame(ev, head, budget)

    q.__name__ = f"q_next_cut_b{budget}"
    return q


def _batch_ids(budget: int) -> Callable:
    """The micro-batch that takes each event when the whole stream is read under the budget."""

    def q(spark, sf_dir):
        ev = events_stream(spark, sf_dir, N_SEGMENTS).select("segment_id", "offset", "len")
        return batch_ids(ev, {s: 0 for s in range(N_SEGMENTS)}, budget).select("segment_id", "offset", "batch")

    q.__name__ = f"q_batch_ids_b{budget}"
    return q


def q_cut_roundtrip(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    tail = ev.groupBy("segment_id").agg(F.max(F.col("offset") + F.col("len")).alias("position"))
    text = tail.agg(cut_to_json(F.map_from_entries(F.collect_list(F.struct("segment_id", "position")))).alias("cut_text"))
    back = text.select("cut_text", F.explode(cut_from_json("cut_text")).alias("segment_id", "position"))
    return back.select("segment_id", "position", "cut_text")


# ---------------------------------------------------------------- metadata


def q_meta_stream_info(spark, sf_dir):
    from segstream.sources.datasource import register

    root, _ = _write_events(spark, sf_dir)
    register(spark)
    return (
        spark.read.format("segstream").option("path", root).option("scope", "demo").option("stream", "events")
        .option("metadata", "StreamInfo").load()
    )


def q_meta_stream_info_frame(spark, sf_dir):
    return stream_info(events_stream(spark, sf_dir, N_SEGMENTS))


def q_meta_streams(spark, sf_dir):
    """One stream for each event type is created, then the scope is listed."""
    root = fresh_table_root(spark, "q")
    for r in table(spark, sf_dir, "events").select("event_type").distinct().collect():  # one row for each type
        TB.ensure_stream(spark, root, "demo", r["event_type"])
    return TB.list_streams(spark, root, "demo")


# ----------------------------------------------------------------- writes


def q_append_readback(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir)
    return _read_payload(spark, root)


def q_append_alo_readback(spark, sf_dir):
    root, _ = _write_events(spark, sf_dir, exactly_once=False)
    return _read_payload(spark, root)


def q_write_projection(spark, sf_dir):
    """Extra columns are ignored; event arrives as binary, key as string."""
    root = fresh_table_root(spark, "q")
    ev = table(spark, sf_dir, "events")
    src = ev.select(
        F.col("props").cast("binary").alias("event"), F.col("user_id").cast("string").alias("routing_key"),
        "event_id", "value", "event_type", "ts",
    )
    TB.append(src, root, "demo", "events", order_by="event_id", opts={"default_num_segments": str(N_SEGMENTS)})
    return _read_payload(spark, root)


def q_txn_dedup_replay(spark, sf_dir):
    """The same (query id, batch id) delivered twice is committed once."""
    root = fresh_table_root(spark, "q")
    ev = table(spark, sf_dir, "events")
    src = ev.select(F.col("props").alias("event"), F.col("user_id").cast("string").alias("routing_key"), "event_id")
    for _ in range(2):
        TB.append(src, root, "demo", "events", order_by="event_id", opts={"default_num_segments": str(N_SEGMENTS)},
                  query_id="q-replay", batch_id=0)
    return _read_payload(spark, root)


def q_stream_append(spark, sf_dir):
    """Structured Streaming into the table through the foreachBatch sink."""
    from segstream.streaming.sink import stream_to_table

    root = fresh_table_root(spark, "q")
    ev = table(spark, sf_dir, "events")
    src = (
        spark.readStream.schema(ev.schema).parquet(f"{sf_dir.rstrip('/')}/events*.parquet")
        .select(F.col("props").alias("event"), F.col("user_id").cast("string").alias("routing_key"), "event_id")
    )
    ckpt = fresh_table_root(spark, "ckpt")
    q = stream_to_table(src, root, "demo", "events", checkpoint=ckpt, order_by="event_id",
                        opts={"default_num_segments": str(N_SEGMENTS)}, available_now=True)
    q.awaitTermination()
    return _read_payload(spark, root)


def _txn_events(spark, sf_dir) -> DataFrame:
    """lineitem rows are events, orders are their transactions."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def q_committed_only(spark, sf_dir):
    """The lines of status F orders are committed, those of the others fail
    while they are written; the table is read back with its offsets."""
    root = _commit_f_abort_others(spark, sf_dir)
    ids = F.split(F.col("event").cast("string"), ":")
    return TB.read_stream(spark, root, "demo", "lines").select(
        ids[0].cast("bigint").alias("l_orderkey"), ids[1].cast("int").alias("l_linenumber"), "segment_id", "offset"
    )


def _append_lines(spark, sf_dir, root: str, status: str, fails: bool) -> None:
    """Append the lines of the orders of a status; ``fails``: a task dies after its first lines."""
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    if fails:
        key = F.when(F.col("l_linenumber") > 1, F.raise_error(F.lit("aborted"))).otherwise(key)
    rows = _txn_events(spark, sf_dir).where(F.col("o_orderstatus") == status).select(
        key.alias("event"), F.col("l_orderkey").cast("string").alias("routing_key"), "l_orderkey", "l_linenumber"
    )
    try:
        TB.append(rows, root, "demo", "lines", order_by=["l_orderkey", "l_linenumber"], opts={"default_num_segments": str(N_SEGMENTS)})
    except Exception:
        if not fails:
            raise


def _commit_f_abort_others(spark, sf_dir) -> str:
    """A table root whose stream ``lines`` got one transaction for each status;
    only that of F commits."""
    root = fresh_table_root(spark, "q")
    for status in ("F", "O", "P"):
        _append_lines(spark, sf_dir, root, status, fails=status != "F")
    return root


def q_abort_leaves_nothing(spark, sf_dir):
    """What each status tried to append and what of it the table shows."""
    root = _commit_f_abort_others(spark, sf_dir)
    order = F.substring_index(F.col("event").cast("string"), ":", 1).cast("bigint")
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    seen = TB.read_stream(spark, root, "demo", "lines").select(order.alias("k")).join(status, "k").groupBy("status").agg(F.count(F.lit(1)).alias("visible"))
    tried = _txn_events(spark, sf_dir).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("staged_events"))
    return tried.join(seen, "status", "left").select("status", "staged_events", F.coalesce("visible", F.lit(0)).cast("bigint").alias("visible_events"))


def q_expired_txns(spark, sf_dir):
    """The lines of status F orders are committed, the writers of the others die
    in a task. Once their leases are gone, vacuum deletes the folders of exactly
    these transactions; the committed lines stay readable."""
    root = fresh_table_root(spark, "q")
    removed = {}
    for status in ("F", "O", "P"):
        _append_lines(spark, sf_dir, root, status, fails=status != "F")
        removed[status] = len(TB.vacuum(spark, root, "demo", "lines", older_than_ms=0))
    order = F.substring_index(F.col("event").cast("string"), ":", 1).cast("bigint")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    seen = TB.read_stream(spark, root, "demo", "lines").select(order.alias("k")).join(orders, "k").groupBy("status").agg(F.count(F.lit(1)).alias("visible_events"))
    gone = F.create_map(*[F.lit(x) for pair in removed.items() for x in pair])
    return orders.select("status").distinct().join(seen, "status", "left").select(
        "status", F.coalesce("visible_events", F.lit(0)).cast("bigint").alias("visible_events"), gone[F.col("status")].cast("bigint").alias("removed_txns"))


UPDATE_FILE_ROWS = 1_000_000
UPDATE_STATE_PARTITIONS = 8


def q_update_as_append(spark, sf_dir):
    """Running counts a key from a streaming aggregate in update mode: each batch
    appends one event for every key whose count changed, and the stream is read
    back. The batches are ten equal event_id ranges, written as files in order
    and taken a range at a trigger."""
    from segstream.streaming.sink import stream_to_table

    ev = table(spark, sf_dir, "events")
    r = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, width = int(r["lo"]), int(r["hi"]) - int(r["lo"]) + 1
    files = -(-int(r["n"]) // (UPDATE_BATCHES * UPDATE_FILE_ROWS))
    number = F.expr(f"(event_id - {lo}) * {UPDATE_BATCHES} div {width}")
    source = fresh_table_root(spark, "source")
    for b in range(UPDATE_BATCHES):
        ev.where(number == b).select("user_id").repartition(files).write.mode("append").parquet(source)
    counts = (
        spark.readStream.schema("user_id long").option("maxFilesPerTrigger", files).parquet(source)
        .groupBy(F.col("user_id").cast("string").alias("key")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    )
    event = F.to_json(F.create_map(F.lit("key"), F.col("key"), F.lit("value"), F.col("value")))
    root, conf = fresh_table_root(spark, "q"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(min(int(before), UPDATE_STATE_PARTITIONS)))  # how many state stores the new query gets
    try:
        stream_to_table(counts.select(event.alias("event"), F.col("key").alias("routing_key")), root, "demo", "counts",
                        checkpoint=fresh_table_root(spark, "ckpt"), output_mode="update", available_now=True).awaitTermination()
    finally:
        spark.conf.set(conf, before)
    events = TB.read_events(spark, root, "demo", "counts")
    # one append time a batch, in order
    times = events.select("append_ts").distinct().withColumn("batch_id", (F.row_number().over(Window.orderBy("append_ts")) - 1).cast("bigint"))
    text = F.col("event").cast("string")
    return events.join(times, "append_ts").select(
        "batch_id", F.get_json_object(text, "$.key").alias("key"), F.get_json_object(text, "$.value").cast("bigint").alias("value"), text.alias("event"))


# ------------------------------------------------------------- maintenance


def q_truncate_at_cut(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return _payload(truncate_at(ev, _cut_at(ev, m["t1"]))).select("payload", "segment_id", "offset")


def q_scan_truncated(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    root, _ = _write_events(spark, sf_dir)
    ev = TB.read_events(spark, root, "demo", "events")
    TB.truncate(spark, root, "demo", "events", _cut_at(ev, m["t1"]))
    return _read_payload(spark, root)


def q_stream_truncated_start(spark, sf_dir):
    """A streaming read whose start lies before the head begins at the head."""
    m = _seq_marks(spark, sf_dir)
    root, _ = _write_events(spark, sf_dir)
    ev = TB.read_events(spark, root, "demo", "events")
    TB.truncate(spark, root, "demo", "events", _cut_at(ev, m["t1"]))
    start = cut_to_text({s: 0 for s in range(N_SEGMENTS)})
    return _stream_rows(spark, root, start, restart=False).drop("scope", "stream")


def q_retention_by_time(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return retain_by_time(ev, RETENTION_MS).select("seq", "segment_id", "offset")


def q_retention_by_size(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return retain_by_size(ev, RETENTION_BYTES).select("seq", "segment_id", "offset")


def q_scale_reroute(spark, sf_dir):
    m = _seq_marks(spark, sf_dir)
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return scale_stream(ev, m["mid"], N_SEGMENTS, SCALE_AFTER).select("seq", "segment_id", "offset")


def q_scan_across_epochs(spark, sf_dir):
    """Read from a cut in epoch 0 to a cut in epoch 1."""
    m = _seq_marks(spark, sf_dir)
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    sc = scale_stream(ev, m["mid"], N_SEGMENTS, SCALE_AFTER)
    e0 = sc.where(F.col("segment_id") < F.lit(1 << 32))
    e1 = sc.where(F.col("segment_id") >= F.lit(1 << 32))
    start = _cut_at(e0, m["t1"])
    end = _cut_at(e1, m["t3"])
    segs = list(range(N_SEGMENTS)) + [(1 << 32) + i for i in range(SCALE_AFTER)]
    return cut_filter(sc, start=start, end=end, segments=segs).select("seq", "segment_id", "offset")


def _partial_scaling(spark, sf_dir) -> tuple[DataFrame, list, dict[str, int]]:
    """Three segments; at the middle the second is split in three, at 7/8 the
    first and the lowest of the new ones are merged."""
    m = _seq_marks(spark, sf_dir)
    first = ranges.uniform(N_SEGMENTS)
    second = ranges.split(first, 1, 3)
    third = ranges.merge(second, [0, ranges.open_segments(second)[1].segment_id])
    ev = events_stream(spark, sf_dir, N_SEGMENTS).drop("segment_id", "offset")
    placed = ranges.route_history(ev, [(m["mid"], first), (m["t3"], second), (None, third)])
    return assign_offsets(placed, order_by="seq"), third, m


def q_scale_partial(spark, sf_dir):
    return _partial_scaling(spark, sf_dir)[0].select("seq", "segment_id", "offset")


def q_scan_across_partial(spark, sf_dir):
    """Between a cut before both scalings and one after the first."""
    ev, table_, m = _partial_scaling(spark, sf_dir)
    start = _cut_at(ev.where(F.col("segment_id") < N_SEGMENTS), m["t1"])
    open_then = {x.segment_id for x in table_ if x.segment_id >> 32 < 2} - {1}
    end = _cut_at(ev.where(F.col("segment_id").isin(sorted(open_then))), m["t2"])
    return filter_ranges(ev, ranges.ranges_between(table_, start, end)).select("seq", "segment_id", "offset")


def q_segment_load(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return segment_load(ev, "1 hour", target_events_per_sec=LOAD_TARGET)


def q_ordered_by_key(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return with_key_seq(ev).select("routing_key", "key_seq", "segment_id", "offset")


# ------------------------------------------------------- workload queries


def _ids_stream(spark, sf_dir) -> DataFrame:
    """events with the event id as payload text (for the numeric decode queries)."""
    from segstream.plans.fixture import as_stream

    ev = table(spark, sf_dir, "events").withColumn("_p", F.col("event_id").cast("string"))
    return as_stream(ev, "demo", "ids", "user_id", "_p", "event_id", "ts", N_SEGMENTS)


def q_decode_int(spark, sf_dir):
    return _ids_stream(spark, sf_dir).select("seq", F.col("event").cast("string").cast("int").alias("value"))


def q_map_plus_one(spark, sf_dir):
    return _ids_stream(spark, sf_dir).select(
        "seq", (F.col("event").cast("string").cast("int") + F.lit(1)).alias("value_plus_one")
    )


def q_self_join_mod5(spark, sf_dir):
    """values.join(values, key = value % 5), pre-aggregated per key on each side
    before the join (pairs are counted, not emitted)."""
    v = _ids_stream(spark, sf_dir).select(F.col("event").cast("string").cast("bigint").alias("value"))
    side = v.groupBy(F.pmod(F.col("value"), F.lit(5)).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")
    )
    left, right = side.alias("l"), side.alias("r")
    return left.join(right, "key").select(
        "key",
        (F.col("l.n") * F.col("r.n")).cast("bigint").alias("pairs"),
        (F.col("l.s") * F.col("r.n")).cast("bigint").alias("sum_left"),
        (F.col("r.s") * F.col("l.n")).cast("bigint").alias("sum_right"),
    )


def q_count_by_key(spark, sf_dir):
    ev = events_stream(spark, sf_dir, N_SEGMENTS)
    return _payload(ev).groupBy("payload").agg(F.count(F.lit(1)).alias("count"))


def q_event_from_row(spark, sf_dir):
    from segstream.plans.fixture import as_stream

    ev = table(spark, sf_dir, "events").withColumn("_p", F.to_json(F.struct("event_id", "user_id", "event_type")))
    s = as_stream(ev, "demo", "rows", "user_id", "_p", "event_id", "ts", N_SEGMENTS)
    return _payload(s).select("seq", "payload", "segment_id", "offset")


def _map_events(spark, sf_dir) -> DataFrame:
    from segstream.plans.fixture import as_stream

    ev = table(spark, sf_dir, "events").withColumn(
        "_p", F.to_json(F.create_map(F.lit("key"), F.col("user_id").cast("string"), F.lit("value"), F.col("event_id").cast("string")))
    )
    return as_stream(ev, "demo", "maps", "user_id", "_p", "event_id", "ts", N_SEGMENTS)


def q_event_from_map(spark, sf_dir):
    return _payload(_map_events(spark, sf_dir)).select("seq", "payload", "segment_id", "offset")


def q_json_tuple_readback(spark, sf_dir):
    s = _map_events(spark, sf_dir)
    return s.select("seq", F.json_tuple(F.col("event").cast("string"), "key", "value").alias("key", "value"))


def q_conversations_offsets(spark, sf_dir):
    """UTF-8 payloads: lengths are bytes, not characters."""
    from segstream.plans.fixture import conversations_stream

    return conversations_stream(spark, sf_dir).select("seq", "segment_id", "offset", "len")


DOC_SEGMENTS = 4
DOC_BUDGET = 400000


def q_documents_offsets(spark, sf_dir):
    """Large multi-language payloads: offsets count bytes of whole texts."""
    from segstream.plans.fixture import documents_stream

    return documents_stream(spark, sf_dir, DOC_SEGMENTS).select("seq", "segment_id", "offset", "len")


def q_documents_next_cut(spark, sf_dir):
    """Next cut over large events: a segment always takes at least its first event."""
    from segstream.plans.fixture import documents_stream

    ev = documents_stream(spark, sf_dir, DOC_SEGMENTS)
    return next_cut_frame(ev, {s: 0 for s in range(DOC_SEGMENTS)}, DOC_BUDGET)


def q_lineitem_offsets(spark, sf_dir):
    """The scale fixture: lineitem rows as JSON events over 16 segments."""
    from segstream.plans.fixture import lineitem_stream

    return lineitem_stream(spark, sf_dir, 16).select("seq", "segment_id", "offset", "len")


def q_pages_offsets(spark, sf_dir):
    """Raw HTML pages as events (key page_id): byte lengths of whole pages."""
    from segstream.plans.fixture import as_stream

    pages = table(spark, sf_dir, "pages")
    return as_stream(pages, "demo", "pages", "page_id", "html", "page_id", None, 4).select("seq", "segment_id", "offset", "len")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "route_to_segment": q_route_to_segment,
    "assign_offsets": q_assign_offsets,
    "scan_full": q_scan_full,
    "scan_columns": q_scan_columns,
    "stream_scan": q_stream_scan,
    "count_events": q_count_events,
    "decode_event": q_decode_event,
    "scan_defaults": q_scan_defaults,
    "scan_cut_range": q_scan_cut_range,
    "scan_from_cut": q_scan_from_cut,
    "scan_to_cut": q_scan_to_cut,
    "union_self": q_union_self,
    **{f"next_cut_b{b}": _next_cut(b) for b in BUDGETS},
    **{f"batch_ids_b{b}": _batch_ids(b) for b in BUDGETS},
    "cut_roundtrip": q_cut_roundtrip,
    "meta_stream_info": q_meta_stream_info,
    "meta_stream_info_frame": q_meta_stream_info_frame,
    "meta_streams": q_meta_streams,
    "append_readback": q_append_readback,
    "append_alo_readback": q_append_alo_readback,
    "write_projection": q_write_projection,
    "txn_dedup_replay": q_txn_dedup_replay,
    "stream_append": q_stream_append,
    "committed_only": q_committed_only,
    "abort_leaves_nothing": q_abort_leaves_nothing,
    "expired_txns": q_expired_txns,
    "update_as_append": q_update_as_append,
    "truncate_at_cut": q_truncate_at_cut,
    "scan_truncated": q_scan_truncated,
    "stream_truncated_start": q_stream_truncated_start,
    "retention_by_time": q_retention_by_time,
    "retention_by_size": q_retention_by_size,
    "scale_reroute": q_scale_reroute,
    "scan_across_epochs": q_scan_across_epochs,
    "scale_partial": q_scale_partial,
    "scan_across_partial": q_scan_across_partial,
    "segment_load": q_segment_load,
    "ordered_by_key": q_ordered_by_key,
    "decode_int": q_decode_int,
    "map_plus_one": q_map_plus_one,
    "self_join_mod5": q_self_join_mod5,
    "count_by_key": q_count_by_key,
    "event_from_row": q_event_from_row,
    "event_from_map": q_event_from_map,
    "json_tuple_readback": q_json_tuple_readback,
    "conversations_offsets": q_conversations_offsets,
    "documents_offsets": q_documents_offsets,
    "documents_next_cut": q_documents_next_cut,
    "lineitem_offsets": q_lineitem_offsets,
    "pages_offsets": q_pages_offsets,
}
