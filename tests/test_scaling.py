"""Key-range epochs, retention by size from extents, batch numbers."""

import random

import pytest
from pyspark.sql import functions as F

from segstream.functions.routing import KEY_SPACE
from segstream.operators import ranges as R
from segstream.operators import batches
from segstream.operators.batches import batch_ids
from segstream.operators.maintain import head_cut_frame, retain_appended
from segstream.operators.offsets import assign_offsets
from segstream.sources import table as TB
from segstream.sources.datasource import register
from segstream.sources.log import CommitLog


def random_scaling(rng, table):
    open_now = R.open_segments(table)
    if rng.random() < 0.5 or len(open_now) < 2:
        return R.split(table, rng.choice(open_now).segment_id, rng.randrange(2, 4))
    i = rng.randrange(len(open_now) - 1)
    return R.merge(table, [x.segment_id for x in open_now[i : i + rng.randrange(2, 4)]])


@pytest.mark.parametrize("seed", range(20))
def test_ranges_between_cuts_follow_time(seed):
    """Events at random positions and times; a cut at a moment parts them by time."""
    rng = random.Random(seed)
    table, events, tails, cuts = R.uniform(rng.randrange(1, 4)), [], {}, []
    for t in range(400):
        if rng.random() < 0.03:
            table = random_scaling(rng, table)
        if rng.random() < 0.05:
            cuts.append((t, {x.segment_id: tails.get(x.segment_id, 0) for x in R.open_segments(table)}))
        p = rng.randrange(KEY_SPACE)
        (owner,) = [x.segment_id for x in R.open_segments(table) if x.lo <= p < x.hi]
        events.append((t, owner, tails.get(owner, 0)))
        tails[owner] = tails.get(owner, 0) + rng.randrange(8, 20)
    for _ in range(30):
        (t1, start), (t2, end) = rng.choice(cuts + [(0, None)]), rng.choice(cuts + [(10**9, None)])
        found = R.ranges_between(table, start, end)
        got = [t for t, s, o in events if s in found and o >= found[s][0] and (found[s][1] is None or o < found[s][1])]
        assert got == [t for t, _, _ in events if t1 <= t < t2]


def test_open_segments_cover_all_positions_and_succeed_each_other():
    rng = random.Random(1)
    table = R.uniform(3)
    for _ in range(40):
        table = random_scaling(rng, table)
        now = R.open_segments(table)
        assert now[0].lo == 0 and now[-1].hi == KEY_SPACE and all(a.hi == b.lo for a, b in zip(now, now[1:]))
    known = {x.segment_id: x for x in table}
    for s, later in R.successors(table).items():
        assert later and all(known[s].shares(known[x]) for x in later)
        assert sum(min(known[s].hi, known[x].hi) - max(known[s].lo, known[x].lo) for x in later) == known[s].hi - known[s].lo


def test_what_can_not_be_replaced():
    table = R.uniform(4)
    with pytest.raises(ValueError):
        R.merge(table, [0, 2])
    with pytest.raises(ValueError):
        R.replace_segments(table, [0], [0, 5])
    sealed = R.split(table, 0)
    with pytest.raises(ValueError):
        R.split(sealed, 0)


def test_route_agrees_with_the_uniform_rule(spark):
    from segstream.functions.routing import segment_for_key

    df = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("routing_key"), F.col("id").cast("string").cast("binary").alias("event"))
    for n in (1, 3, 7):
        out = R.route(df, R.uniform(n)).withColumn("rule", segment_for_key("routing_key", n, event="event"))
        assert out.count() == 3000 and out.where("rule <> segment_id").isEmpty()


def test_retention_by_size_reads_no_event(spark, root, monkeypatch):
    register(spark)
    opts = {"default_num_segments": "3", "default_retention_size_bytes": "1"}

    def add(n):
        df = spark.range(n).select(F.repeat(F.lit("x"), (F.col("id") % 30).cast("int")).alias("event"), F.col("id").cast("string").alias("routing_key"), "id")
        TB.append(df, root, "s", "t", order_by="id", opts=opts)

    for n in (300, 200, 400):
        add(n)
    log = CommitLog(spark, root, "s", "t")

    def check(limits, events_read):
        events = TB.read_events(spark, root, "s", "t").cache()
        size = events.agg(F.sum("len")).first()[0]
        for limit in [f * size // 100 for f in limits] + [0, size]:
            keep = retain_appended(events, limit)
            wanted = {int(r["segment_id"]): int(r["position"]) for r in head_cut_frame(keep, events).collect()}
            with monkeypatch.context() as m:
                if not events_read:
                    m.setattr(TB, "read_events", lambda *a, **k: pytest.fail("events were read"))
                assert TB.size_cut(spark, root, "s", "t", log.snapshot(), limit) == wanted

    check([40], events_read=False)
    TB.truncate(spark, root, "s", "t", {0: 1000, 1: 0, 2: 2000})
    check([90], events_read=False)
    TB.compact(spark, root, "s", "t")
    add(100)
    check([60], events_read=True)
    assert TB.apply_retention(spark, root, "s", "t") == log.snapshot().tail  # a limit of one byte keeps nothing


@pytest.mark.parametrize("budget", [1, 1000])
def test_batch_ids_equal_walking_the_chain(spark, budget):
    """Events from empty to far longer than a stride, a start inside the stream."""
    size = F.when(F.col("id") % 97 == 5, 3_000_000).otherwise(F.col("id") % 40).cast("long")
    df = spark.range(400).select("id", (F.col("id") * F.col("id") % 3).alias("segment_id"), (8 + size).alias("len"))
    ev = assign_offsets(df, order_by="id").cache()
    rows = sorted((r["segment_id"], r["offset"], r["len"]) for r in ev.collect())
    segments = sorted({s for s, _, _ in rows})
    third = {s: [o for x, o, _ in rows if x == s] for s in segments}
    for start in ({s: 0 for s in segments}, {s: v[len(v) // 3] for s, v in third.items()}):
        each, wanted = max(1, budget // len(start)), {}
        for s in segments:
            batch, begin, end = 0, None, None
            for x, o, n in rows:
                if x != s or o < start[s]:
                    continue
                if begin is None:
                    begin = o
                elif o >= begin + each:
                    batch, begin = batch + 1, o
                wanted[s, o] = batch
        got = {(r["segment_id"], r["offset"]): r["batch"] for r in batch_ids(ev, start, budget).collect()}
        assert got == wanted


def walked(rows, start, each):
    """Batch of each (segment, offset), event by event."""
    wanted, begin, batch = {}, {}, {}
    for s, o in sorted(rows):
        if o >= start[s]:
            if s not in begin:
                begin[s], batch[s] = o, 0
            elif o >= begin[s] + each:
                begin[s], batch[s] = o, batch[s] + 1
            wanted[s, o] = batch[s]
    return wanted


@pytest.mark.parametrize("stride, most, budget", [(64, 256, 2), (64, 256, 90), (256, 4096, 400), (64, 64, 3000), (1 << 20, 1 << 24, 60)])
def test_batch_ids_over_many_strides(spark, monkeypatch, stride, most, budget):
    """Strides shorter and longer than events and batches; other columns stay."""
    for name, value in (("STRIDE", stride), ("STRIDE_MOST", most), ("DOORS", 4)):
        monkeypatch.setattr(batches, name, value)
    size = F.when(F.col("id") % 53 == 7, 700).otherwise(F.col("id") * F.col("id") % 23).cast("long")
    df = spark.range(900).select("id", (F.col("id") % 7 % 2).alias("segment_id"), (8 + size).alias("len"))
    ev = assign_offsets(df, order_by="id", base={0: 1000, 1: 5}).cache()
    rows = {(r["segment_id"], r["offset"]): r["id"] for r in ev.collect()}
    start = {0: 1000, 1: 2000}
    got = batch_ids(ev, start, budget)
    assert got.columns == [*ev.columns, "batch"]
    got = got.collect()
    assert all(rows[r["segment_id"], r["offset"]] == r["id"] for r in got)
    wanted = walked(rows, start, max(1, budget // 2))
    assert len(got) == len(wanted) and {(r["segment_id"], r["offset"]): r["batch"] for r in got} == wanted


def test_batch_ids_of_events_without_a_length(spark):
    """They take no bytes, also at the end, and come once for each event of their
    start; without a segment they are no event."""
    rows = [(0, 0, 9), (0, 9, None), (0, 9, 10), (0, 19, 8), (0, 27, None), (None, 0, None), (1, 0, None)]
    ev = spark.createDataFrame(rows, "segment_id long, offset long, len long")
    got = [tuple(r) for r in batch_ids(ev.where("segment_id = 0"), {0: 0}, 10).collect()]
    twice = [(0, 9, None, 0), (0, 9, 10, 0)] * 2
    assert sorted(got, key=str) == sorted([(0, 0, 9, 0), *twice, (0, 19, 8, 1), (0, 27, None, 1)], key=str)
    assert [tuple(r) for r in batch_ids(ev, {1: 0}, 10).collect()] == [(1, 0, None, 0)]
    assert batch_ids(ev.where("segment_id IS NULL"), {0: 0}, 10).isEmpty()


def test_batch_ids_keep_few_rows_beside_the_events(spark, monkeypatch):
    """The tables of the rounds hold doors, not a row for each event and round."""
    kept, keep = [], batches._Scratch.keep

    def counted(self, df):
        out = keep(self, df)
        kept.append(out[0].count())
        return out

    monkeypatch.setattr(batches._Scratch, "keep", counted)
    df = spark.range(150_000).select("id", (F.col("id") % 2).alias("segment_id"), (30 + F.col("id") % 5).cast("long").alias("len"))
    ev = assign_offsets(df, order_by="id")
    assert batch_ids(ev, {0: 0, 1: 0}, 1000).agg(F.max("batch")).first()[0] > 2000
    assert sum(kept) < 2000


@pytest.mark.parametrize("budget", [10, 20, 33, 100])
def test_batch_ids_of_short_batches_keep_few_rows_beside_the_events(spark, monkeypatch, budget):
    """Also where most events begin a batch, a stride has a few doors only."""
    kept, keep = [], batches._Scratch.keep

    def counted(self, df):
        out = keep(self, df)
        kept.append(out[0].count())
        return out

    monkeypatch.setattr(batches._Scratch, "keep", counted)
    df = spark.range(60_000).select("id", (F.col("id") % 3).alias("segment_id"), (8 + F.col("id") % 29).cast("long").alias("len"))
    ev = assign_offsets(df, order_by="id").cache()
    start = {0: 0, 1: 0, 2: 0}
    got = {(r["segment_id"], r["offset"]): r["batch"] for r in batch_ids(ev, start, budget).collect()}
    assert got == walked([(r["segment_id"], r["offset"]) for r in ev.collect()], start, budget // 3)
    assert sum(kept) < 600


def test_load_stream_equals_load_report_and_scales(spark, root, scratch):
    from segstream.streaming import drain
    from segstream.streaming.load import autoscale_stream, load_stream

    opts = {"default_num_segments": "2", "default_scale_factor": "2", "default_segment_target_rate_events_per_sec": "100"}

    def add(n):
        df = spark.range(n).select(F.col("id").cast("string").alias("event"), (F.col("id") % 9).cast("string").alias("routing_key"), "id")
        TB.append(df, root, "s", "t", order_by="id", opts=opts)

    add(400)
    add(150)
    for window in ("1 second", "1 hour"):
        last = {}

        def keep(batch, _):
            last.update({(r["window_start"], r["segment_id"]): (r["events"], r["bytes"], r["needs_split"]) for r in batch.collect()})

        loads = load_stream(spark, root, "s", "t", window, approx_bytes_per_trigger=3000)
        drain(loads.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{scratch}/{window[2:]}").start())
        report = TB.load_report(spark, root, "s", "t", window).collect()
        assert last == {(r["window_start"], r["segment_id"]): (r["events"], r["bytes"], r["needs_split"]) for r in report}
        assert any(v[2] for v in last.values()) == (window == "1 second")
    drain(autoscale_stream(spark, root, "s", "t", f"{scratch}/auto", "1 second"))
    snap = CommitLog(spark, root, "s", "t").snapshot()
    assert snap.current_epoch == 1 and len(snap.current_segments) == 4


def test_load_stream_drops_events_behind_the_watermark(spark, root, scratch):
    """Rows of an hour ago that arrive after newer ones were counted are late."""
    from segstream.operators.maintain import segment_load

    schema = "append_ts timestamp, segment_id long, len long"
    source = f"{scratch}/source"
    for i, (minute, n) in enumerate([(90, 3), (91, 2), (5, 7), (92, 1)]):
        rows = [(1_700_000_000 + 60 * minute, 0, 10)] * n
        df = spark.createDataFrame(rows, "t long, segment_id long, len long").select(F.timestamp_seconds("t").alias("append_ts"), "segment_id", "len")
        df.coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).withWatermark("append_ts", "10 minutes")
    seen = []
    q = segment_load(events, "1 hour").writeStream.foreachBatch(lambda b, _: seen.extend(b.collect())).outputMode("update")
    q.option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start().awaitTermination()
    last = {r["window_start"]: r["events"] for r in seen}
    assert sum(last.values()) == 6 and len(last) == 1
