"""File layout of appends, event boundaries, and writers beside each other."""

import threading
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from segstream.operators.cuts import next_cut_frame
from segstream.operators.offsets import assign_offsets, block_by_order, place_rows
from segstream.sources import table as TB
from segstream.sources.datasource import register
from segstream.sources.log import CommitLog, TransactionTimeoutError


def rows(spark, n, tied=True):
    """One value of the first order column for all rows, long string ties, nulls and NaNs."""
    key = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.concat(F.lit("same prefix "), F.col("id") % 11)).otherwise("tie")
    number = F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 4 == 0, F.lit(None)).otherwise((F.col("id") % 13).cast("double"))
    df = spark.range(n).select(F.lit(7).cast("long").alias("a"), key.alias("k"), number.alias("d"), F.col("id").alias("o"),
                               (F.col("id") % 3).alias("segment_id"), (5 + F.xxhash64("id") % 5 + 5).cast("long").alias("len"))
    return df.repartition(5, "o")


@pytest.mark.parametrize("order", [["a", "k", "d", "o"], ["a", "o"], ["d", "o"]])
def test_ties_of_the_first_columns_are_split(spark, order):
    df = rows(spark, 6000)
    blocked = block_by_order(df, order, 24).cache()
    sizes = [r["count"] for r in blocked.groupBy("_blk").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 6000 / 24 * 3.1
    before = F.lag("_blk").over(Window.partitionBy(F.lit(1)).orderBy(*order))
    assert blocked.withColumn("p", before).where("p > _blk").isEmpty()
    running = F.sum("len").over(Window.partitionBy("segment_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    expected = {(r["o"], r["x"]) for r in df.select("o", F.coalesce(running, F.lit(0)).alias("x")).collect()}
    assert {(r["o"], r["offset"]) for r in assign_offsets(df, order_by=order, blocks=24).select("o", "offset").collect()} == expected
    placed = place_rows(df, order, None, 5)
    assert {(r["o"], r["offset"]) for r in placed.select("o", "offset").collect()} == expected
    parts = placed.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct("segment_id", "offset")).alias("lo"), F.max(F.struct("segment_id", "offset")).alias("hi"), F.sum("len").alias("b")).orderBy("p").collect()
    assert len(parts) == 5 and all(tuple(x["hi"]) < tuple(y["lo"]) for x, y in zip(parts, parts[1:]))
    assert max(r["b"] for r in parts) < 2 * min(r["b"] for r in parts)


def stream(spark, root, n=4000, segments="3", **kw):
    df = spark.range(n).select(F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("event"), (F.col("id") % 50).cast("string").alias("routing_key"), "id")
    TB.append(df, root, "s", "t", order_by="id", opts={"default_num_segments": segments}, **kw)


def test_files_of_an_append_do_not_overlap(spark, root, monkeypatch):
    monkeypatch.setattr(TB, "SMALL_TASK_BYTES", 10_000)
    stream(spark, root, 8000)
    files = CommitLog(spark, root, "s", "t").snapshot().files
    by_segment = {}
    for f in files:
        by_segment.setdefault(f["segment_id"], []).append((f["lo"], f["hi"]))
    assert len(files) > 6
    for extents in by_segment.values():
        extents.sort()
        assert extents[0][0] == 0 and all(a[1] == b[0] for a, b in zip(extents, extents[1:]))
    mid = {s: e[len(e) // 2][0] for s, e in by_segment.items()}
    some = TB.read_events(spark, root, "s", "t", start=mid, end={s: p + 1 for s, p in mid.items()})
    assert len(some.inputFiles()) == len(mid) and some.count() == len(mid)


@pytest.mark.parametrize("compacted", [False, True])
def test_next_cut_reads_boundaries_not_events(spark, root, monkeypatch, compacted):
    monkeypatch.setattr(TB, "SMALL_TASK_BYTES", 20_000)
    for _ in range(2):
        stream(spark, root)
    if compacted:
        TB.compact(spark, root, "s", "t")
    log = CommitLog(spark, root, "s", "t")
    events = TB.read_events(spark, root, "s", "t").cache()
    events.count()
    tail = log.snapshot().tail
    heads = {s: 0 for s in tail}
    for budget in (30, 10_000):
        for cut in (heads, {s: t // 2 for s, t in _starts(events, tail).items()}, tail):
            wanted = {int(r["segment_id"]): int(r["position"]) for r in next_cut_frame(events, cut, budget).collect()}
            with monkeypatch.context() as m:
                m.setattr(TB, "read_events", lambda *a, **k: pytest.fail("events were read"))
                assert TB.next_cut(spark, root, "s", "t", cut, budget) == wanted
            from segstream.sources.datasource import _next_cut_files

            with monkeypatch.context() as m:
                m.setattr("segstream.sources.datasource._window_end", lambda *a: pytest.fail("events were read"))
                assert _next_cut_files(log.snapshot(), cut, budget, f"{root}/s/t") == wanted
    end = {s: t // 3 for s, t in _starts(events, tail).items()}
    capped = {int(r["segment_id"]): int(r["position"]) for r in next_cut_frame(events, heads, 10**6, end).collect()}
    assert TB.next_cut(spark, root, "s", "t", heads, 10**6, end) == capped


def _starts(events, tail):
    """The start of an event near the middle of each segment, twice over."""
    half = F.expr("CASE segment_id " + " ".join(f"WHEN {s} THEN {t // 2}" for s, t in tail.items()) + " END")
    return {r["segment_id"]: 2 * r["p"] for r in events.where(F.col("offset") >= half).groupBy("segment_id").agg(F.min("offset").alias("p")).collect()}


def test_next_cut_across_a_format_write_and_a_truncation(spark, root):
    register(spark)
    stream(spark, root, 500)
    more = spark.range(300).select(F.repeat(F.lit("y"), (F.col("id") % 9).cast("int")).alias("event"), F.col("id").cast("string").alias("routing_key"))
    more.write.format("segstream").mode("append").option("path", root).option("scope", "s").option("stream", "t").save()
    log = CommitLog(spark, root, "s", "t")
    tail = log.snapshot().tail
    events = TB.read_events(spark, root, "s", "t")
    for cut in ({s: 0 for s in tail}, {s: t - 200 for s, t in _near_end(events, tail).items()}):
        for budget in (3, 300, 3000):
            wanted = {int(r["segment_id"]): int(r["position"]) for r in next_cut_frame(events, cut, budget).collect()}
            assert TB.next_cut(spark, root, "s", "t", cut, budget) == wanted
    TB.truncate(spark, root, "s", "t", _near_end(events, tail))
    low = {s: 0 for s in tail}
    assert TB.next_cut(spark, root, "s", "t", low, 30) == low  # nothing is left in the window


def _near_end(events, tail):
    late = F.expr("CASE segment_id " + " ".join(f"WHEN {s} THEN {max(0, t - 300)}" for s, t in tail.items()) + " END")
    return {r["segment_id"]: r["p"] for r in events.where(F.col("offset") >= late).groupBy("segment_id").agg(F.min("offset").alias("p")).collect()}


def test_slow_format_write_beside_vacuum(spark, root):
    """Tasks renew the job's record, so vacuum leaves their folders alone although
    the job runs longer than its timeout."""
    register(spark)
    stream(spark, root, 10)

    @F.udf("string")
    def slow(i):
        time.sleep(0.02)
        return str(i)

    df = spark.range(0, 480, 1, 4).select(slow("id").alias("event"))
    options = {"path": root, "scope": "s", "stream": "t", "transaction_timeout_ms": "4000"}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    done = threading.Event()

    def sweep():
        while not done.wait(0.5):
            TB.vacuum(spark, root, "s", "t", older_than_ms=0)

    sweeper = threading.Thread(target=sweep)
    sweeper.start()
    try:
        df.write.format("segstream").mode("append").options(**options).save()
    finally:
        done.set()
        sweeper.join()
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert TB.read_stream(spark, root, "s", "t").count() == 490


def test_format_write_that_timed_out_appends_nothing(spark, root, monkeypatch):
    from segstream.sources.pywrite import BatchWriter, PiecesMessage

    stream(spark, root, 10)
    options = {"path": root, "scope": "s", "stream": "t", "transaction_timeout_ms": "200"}
    writer = BatchWriter(options, spark.createDataFrame([], "event string").schema)
    pieces = [{"path": "x", "segment_id": 0, "rows": 1, "bytes": 9}]
    time.sleep(0.4)
    with pytest.raises(TransactionTimeoutError):
        writer.commit([PiecesMessage(0, f"{writer.lease.job}-a", pieces)])
    assert TB.read_stream(spark, root, "s", "t").count() == 10


def test_at_least_once_format_write_shows_finished_tasks(spark, root):
    register(spark)
    stream(spark, root, 10)
    options = {"path": root, "scope": "s", "stream": "t"}
    failing = F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string"))
    one_by_one = spark.range(0, 100, 1, 2).select(failing.alias("event"))
    with pytest.raises(Exception):
        one_by_one.write.format("segstream").mode("append").options(**options, exactly_once="true").save()
    assert TB.read_stream(spark, root, "s", "t").count() == 10
    with pytest.raises(Exception):
        one_by_one.write.format("segstream").mode("append").options(**options, exactly_once="false").save()
    assert TB.read_stream(spark, root, "s", "t").count() in (10, 60)  # the first task's rows, if it ended first
    spark.range(0, 40, 1, 2).select(F.col("id").cast("string").alias("event")).write.format("segstream").mode("append").options(**options, exactly_once="false").save()
    assert TB.read_stream(spark, root, "s", "t").count() in (50, 100)


def test_scale_compact_and_append_race(spark, root):
    stream(spark, root, 200)
    errors = []

    def run(f):
        try:
            f()
        except Exception as e:  # told apart below
            errors.append(e)

    jobs = [lambda: stream(spark, root, 100), lambda: stream(spark, root, 100), lambda: TB.compact(spark, root, "s", "t"),
            lambda: TB.scale(spark, root, "s", "t", 5), lambda: TB.truncate(spark, root, "s", "t", {0: 0})]
    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert TB.read_stream(spark, root, "s", "t").count() == 400
    TB.vacuum(spark, root, "s", "t", older_than_ms=0)
    assert TB.read_stream(spark, root, "s", "t").count() == 400
