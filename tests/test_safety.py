"""Appends, commits and vacuum under odd input, races and broken files."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from segstream import options as O
from segstream.operators.offsets import assign_offsets
from segstream.operators.order import with_key_seq
from segstream.sources import table as TB
from segstream.sources.log import CommitLog, TransactionTimeoutError


def texts(df):
    return [bytes(r["event"]).decode() for r in df.collect()]


def frame(spark, rows, schema="event string, routing_key string"):
    return spark.createDataFrame(rows, schema)


def test_nondeterministic_input_keeps_every_row_once(spark, root):
    df = spark.range(4000).select(F.concat(F.col("id"), F.lit("-"), F.rand()).alias("event"), F.rand().alias("o"))
    assert TB.append(df, root, "s", "a", order_by="o").rows == 4000
    rows = TB.read_events(spark, root, "s", "a").select("segment_id", "offset", "len").collect()
    assert len({(r["segment_id"], r["offset"]) for r in rows}) == len(rows) == 4000
    tail = CommitLog(spark, root, "s", "a").snapshot().tail
    assert sum(tail.values()) == sum(r["len"] for r in rows)


def test_racing_writers_all_commit(spark, root):
    TB.append(frame(spark, [("first", "k")]), root, "s", "r", opts={"default_num_segments": "2"})
    failures = []

    def work(i):
        try:
            TB.append(frame(spark, [(f"{i}-{j}", f"k{j}") for j in range(20)]), root, "s", "r")
            TB.truncate(spark, root, "s", "r", {0: 0})
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures
    rows = TB.read_events(spark, root, "s", "r").select("segment_id", "offset", "len", "event").collect()
    assert sorted(bytes(r["event"]).decode() for r in rows) == sorted(["first"] + [f"{i}-{j}" for i in range(3) for j in range(20)])
    for s in (0, 1):
        at = 0
        for r in sorted((r for r in rows if r["segment_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["len"]


def test_null_events_raise_and_leave_nothing(spark, root):
    with pytest.raises(TB.NullEventError):
        TB.append(frame(spark, [("a", "k"), (None, "k")]), root, "s", "n")
    assert TB.read_stream(spark, root, "s", "n").count() == 0
    assert TB.vacuum(spark, root, "s", "n", older_than_ms=0) and not TB.uncommitted_txns(spark, root, "s", "n")


def test_order_column_of_any_type(spark, root):
    base = dt.datetime(2024, 1, 1)
    rows = [("late", base + dt.timedelta(milliseconds=900)), ("mid", base + dt.timedelta(milliseconds=500)), ("early", base + dt.timedelta(milliseconds=100))]
    for kind in ("timestamp", "timestamp_ntz", "string"):
        df = frame(spark, rows, "event string, o timestamp_ntz").withColumn("o", F.col("o").cast(kind))
        TB.append(df, root, "s", kind, order_by="o", opts={"default_num_segments": "1"})
        assert texts(TB.read_stream(spark, root, "s", kind).orderBy("offset")) == ["early", "mid", "late"]


def test_empty_ordered_append_commits_nothing(spark, root):
    df = frame(spark, [], "event string, o bigint")
    assert TB.append(df, root, "s", "e", order_by="o").version is None


def test_events_without_a_key_keep_their_order(spark):
    rows = [(i, None if i % 2 else "k", i % 3, 10 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "seq bigint, routing_key string, segment_id bigint, offset bigint")
    got = with_key_seq(df).collect()
    assert len(got) == 20 and sorted(r["key_seq"] for r in got if r["routing_key"] is None) == list(range(10))


def test_blocks_follow_what_is_asked(spark):
    from segstream.operators.offsets import block_by_order

    df = spark.range(100_000).withColumn("len", F.lit(1).cast("bigint")).withColumn("segment_id", F.lit(0).cast("bigint"))
    sizes = [r["count"] for r in block_by_order(df, "id", 400).groupBy("_blk").count().collect()]
    assert len(sizes) > 350 and max(sizes) < 3 * 250
    out = assign_offsets(df, order_by="id", blocks=400)
    assert out.where("offset <> id").count() == 0


def test_options_are_checked(spark, root):
    with pytest.raises(ValueError):
        TB.append(frame(spark, [("a", "k")]), root, "s", "o", opts={"default_num_segments": "-2"})


def test_names_with_a_space(spark, tmp_path):
    root = str(tmp_path / "my tables")
    TB.append(frame(spark, [(str(i), f"k{i}") for i in range(10)]), root, "my scope", "my stream", opts={"default_num_segments": "1"})
    assert TB.read_stream(spark, root, "my scope", "my stream", start={0: 0}).count() == 10


def test_broken_log_files_do_not_block_the_stream(spark, root):
    TB.append(frame(spark, [("a", "k")]), root, "s", "t")
    log = CommitLog(spark, root, "s", "t")
    open(f"{log.dir}/{2:020d}.json", "w").close()  # a torn version
    open(f"{log.dir}/{1:020d}.snapshot.json", "w").write('{"version"')  # a torn snapshot
    assert TB.append(frame(spark, [("b", "k")]), root, "s", "t").version == 3
    assert sorted(texts(TB.read_stream(spark, root, "s", "t"))) == ["a", "b"]


def test_reader_bound_before_compaction_outlives_vacuum(spark, root):
    TB.append(frame(spark, [("a", "k")]), root, "s", "c")
    bound = TB.read_stream(spark, root, "s", "c")
    time.sleep(1.2)
    TB.compact(spark, root, "s", "c")
    assert TB.vacuum(spark, root, "s", "c", older_than_ms=60_000) == []
    assert texts(bound) == ["a"]
    assert len(TB.vacuum(spark, root, "s", "c", older_than_ms=0)) == 1
    assert texts(TB.read_stream(spark, root, "s", "c")) == ["a"]


def test_vacuum_leaves_running_transactions_alone(spark, root):
    TB.append(frame(spark, [("a", "k")]), root, "s", "v")
    log = CommitLog(spark, root, "s", "v")
    folder = f"{TB.data_dir(root, 's', 'v')}/txn=running"
    with TB.Lease(log, "running", 800) as lease:
        log.fs.mkdirs(folder)
        time.sleep(2)  # far beyond the timeout, but renewed
        assert TB.vacuum(spark, root, "s", "v", older_than_ms=0) == [] and lease.held()
    log.start_transaction("dead", int(time.time() * 1000) - 1)  # its writer is gone
    log.fs.mkdirs(f"{TB.data_dir(root, 's', 'v')}/txn=dead")
    assert "dead" in TB.vacuum(spark, root, "s", "v", older_than_ms=0)


def test_lost_lease_appends_nothing(spark, root, monkeypatch):
    TB.append(frame(spark, [("a", "k")]), root, "s", "l")
    monkeypatch.setattr(TB.Lease, "held", lambda self: False)
    with pytest.raises(TransactionTimeoutError):
        TB.append(frame(spark, [("b", "k")]), root, "s", "l", opts={O.TRANSACTION_TIMEOUT_MS: "500"})
    assert texts(TB.read_stream(spark, root, "s", "l")) == ["a"]


def test_retention_by_size_follows_the_appends(spark, root):
    opts = {"default_num_segments": "1", O.DEFAULT_RETENTION_SIZE_BYTES: "60"}
    for first in (100, 0):  # the later append has the smaller order values
        df = spark.createDataFrame([(f"e{first + i}", first + i) for i in range(10)], "event string, o bigint")
        TB.append(df, root, "s", "size", order_by="o", opts=opts)
    TB.apply_retention(spark, root, "s", "size")
    assert texts(TB.read_stream(spark, root, "s", "size").orderBy("offset")) == [f"e{i}" for i in range(4, 10)]


def test_retention_by_time_expires_an_idle_stream(spark, root):
    TB.append(frame(spark, [("a", "k")]), root, "s", "idle", opts={O.DEFAULT_RETENTION_DURATION_MILLISECONDS: "300"})
    time.sleep(0.5)
    TB.apply_retention(spark, root, "s", "idle")
    assert TB.read_stream(spark, root, "s", "idle").count() == 0
