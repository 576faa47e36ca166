import pytest
from pyspark.sql import functions as F

from segstream.sources import table as TB
from segstream.sources.datasource import register
from segstream.sources.log import CommitLog

from stream_helpers import keys_for_segments


def _vals(df):
    return sorted(r[0] for r in df.select(F.col("event").cast("string")).collect())


def _append(spark, root, values, key=None, stream="t", **kw):
    rows = [(str(v), key) for v in values]
    df = spark.createDataFrame(rows, "event string, routing_key string")
    return TB.append(df, root, "s", stream, opts={"default_num_segments": "3"}, **kw)


def test_append_and_read_back(spark, root):
    _append(spark, root, range(0, 10), key="0")
    _append(spark, root, range(10, 20), key="1")
    df = TB.read_stream(spark, root, "s", "t")
    assert df.columns == ["event", "scope", "stream", "segment_id", "offset"]
    assert _vals(df) == sorted(str(v) for v in range(20))
    # one key keeps append order inside its segment
    rows = df.where(F.col("event").cast("string").isin([str(v) for v in range(10)])).orderBy("offset").collect()
    assert [r.event.decode() for r in rows] == [str(v) for v in range(10)]
    assert [r.offset for r in rows] == [sum(8 + len(str(v)) for v in range(i)) for i in range(10)]


def test_column_types(spark, root):
    _append(spark, root, ["1"], key=None)
    r = TB.read_stream(spark, root, "s", "t").collect()[0]
    assert r.event == b"1" and r.scope == "s" and r.stream == "t" and r.offset == 0


def test_binding_at_planning_time(spark, root):
    _append(spark, root, range(0, 21))
    first = TB.read_stream(spark, root, "s", "t")
    _append(spark, root, range(21, 30))
    second = TB.read_stream(spark, root, "s", "t")
    assert first.count() == 21  # symbolic end bound when the frame was built
    assert second.count() == 30


def test_cut_ranges(spark, root):
    k = keys_for_segments(3)
    _append(spark, root, range(0, 10), key=k[0])
    _append(spark, root, range(10, 20), key=k[1])
    _append(spark, root, [20], key=k[2])
    tail1 = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    _append(spark, root, range(21, 31), key=k[2])
    tail2 = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    head = {0: 0, 1: 0, 2: 0}
    assert _vals(TB.read_stream(spark, root, "s", "t", start=head, end=tail1)) == sorted(str(v) for v in range(21))
    assert _vals(TB.read_stream(spark, root, "s", "t", start=head, end=tail2)) == sorted(str(v) for v in range(31))
    assert _vals(TB.read_stream(spark, root, "s", "t", start=tail1, end=tail2)) == sorted(str(v) for v in range(21, 31))
    assert _vals(TB.read_stream(spark, root, "s", "t", start=tail1)) == sorted(str(v) for v in range(21, 31))
    assert _vals(TB.read_stream(spark, root, "s", "t", end=tail1)) == sorted(str(v) for v in range(21))
    # the same range through the data source
    register(spark)
    import json
    df = (spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "t")
          .option("start_stream_cut", json.dumps({str(a): b for a, b in tail1.items()})).load())
    assert _vals(df) == sorted(str(v) for v in range(21, 31))


def test_batch_bound_errors(spark, root):
    _append(spark, root, range(3))
    with pytest.raises(Exception, match="latest"):
        TB.read_stream(spark, root, "s", "t", start="latest")
    with pytest.raises(Exception, match="earliest"):
        TB.read_stream(spark, root, "s", "t", end="earliest")


def test_union_self(spark, root):
    _append(spark, root, range(11), key="0")
    df = TB.read_stream(spark, root, "s", "t")
    assert _vals(df.unionAll(df)) == sorted([str(v) for v in range(11)] * 2)


def test_metadata_tables(spark, root):
    register(spark)
    for name in ("a", "b", "c"):
        _append(spark, root, range(1, 6), stream=name)
    streams = spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "a") \
        .option("metadata", "Streams").load()
    assert sorted(r.stream_name for r in streams.collect()) == ["a", "b", "c"]
    info = spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "a") \
        .option("metadata", "StreamInfo").load().collect()
    assert len(info) == 1
    snap = CommitLog(spark, root, "s", "a").snapshot()
    import json
    assert {int(k): v for k, v in json.loads(info[0].tail_stream_cut).items()} == snap.tail_cut()
    assert sum(snap.tail_cut().values()) == sum(8 + 1 for _ in range(5))
    with pytest.raises(Exception):
        spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "a") \
            .option("metadata", "streaminfo").load().collect()


def test_write_schema_errors(spark, root):
    with pytest.raises(TB.WriteSchemaError, match="Required attribute 'event' not found"):
        TB.append(spark.createDataFrame([("1",)], "value string"), root, "s", "t")
    with pytest.raises(TB.WriteSchemaError, match="event attribute type must be a string or binary; received unsupported type int"):
        TB.append(spark.createDataFrame([(1,)], "event int"), root, "s", "t")
    with pytest.raises(TB.WriteSchemaError, match="routing_key attribute type must be a string; received unsupported type int"):
        TB.append(spark.createDataFrame([("1", 1)], "event string, routing_key int"), root, "s", "t")


def test_save_modes(spark, root):
    register(spark)
    df = spark.createDataFrame([("1",)], "event string")
    with pytest.raises(Exception):
        df.write.format("segstream").mode("overwrite").option("path", root).option("scope", "s").option("stream", "t").save()
    with pytest.raises(Exception):
        df.write.format("segstream").mode("ignore").option("path", root).option("scope", "s").option("stream", "t").save()


def test_missing_scope_and_stream(spark, root):
    df = spark.createDataFrame([("1",)], "event string")
    with pytest.raises(TB.ScopeNotFoundError, match="scope does not exist"):
        TB.append(df, root, "nope", "t", opts={"allow_create_scope": "false"})
    _append(spark, root, ["x"], stream="other")
    with pytest.raises(Exception, match="does not exist"):
        TB.append(df, root, "s", "t2", opts={"allow_create_stream": "false"})


def test_abort_leaves_nothing(spark, root):
    from pyspark.sql.functions import udf

    @udf("string")
    def boom(x):
        if int(x) > 50:
            raise RuntimeError("fail in the middle of the write")
        return x

    df = spark.range(100).repartition(4).select(boom(F.col("id").cast("string")).alias("event"))
    with pytest.raises(Exception):
        TB.append(df, root, "s", "t", opts={"default_num_segments": "3"})
    assert TB.read_stream(spark, root, "s", "t").count() == 0
    staged = TB.uncommitted_txns(spark, root, "s", "t")
    assert TB.vacuum(spark, root, "s", "t", older_than_ms=0) == staged
    assert TB.uncommitted_txns(spark, root, "s", "t") == []


def test_replayed_batch_is_skipped(spark, root):
    r1 = _append(spark, root, range(5), query_id="q", batch_id=0)
    r2 = _append(spark, root, range(5), query_id="q", batch_id=0)
    assert not r1.skipped and r2.skipped
    assert TB.read_stream(spark, root, "s", "t").count() == 5
    # at-least-once appends again
    _append(spark, root, range(5), query_id="q", batch_id=0, exactly_once=False)
    assert TB.read_stream(spark, root, "s", "t").count() == 10


def test_truncate_and_retention(spark, root):
    k = keys_for_segments(3)
    _append(spark, root, range(6), key=k[0])
    tail = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    TB.truncate(spark, root, "s", "t", tail)
    assert TB.read_stream(spark, root, "s", "t").count() == 0
    _append(spark, root, [28, 29], key=k[0])
    assert _vals(TB.read_stream(spark, root, "s", "t")) == ["28", "29"]
    # reading from the old head skips the truncated part
    assert _vals(TB.read_stream(spark, root, "s", "t", start={0: 0, 1: 0, 2: 0})) == ["28", "29"]


def test_retention_by_size_policy(spark, root):
    df = spark.createDataFrame([(str(v), str(v % 3), v) for v in range(100, 200)], "event string, routing_key string, n bigint")
    TB.append(df, root, "s", "t", order_by="n", opts={"default_num_segments": "3", "default_retention_size_bytes": "220"})
    cut = TB.apply_retention(spark, root, "s", "t")
    left = _vals(TB.read_stream(spark, root, "s", "t"))
    assert left == [str(v) for v in range(180, 200)]  # 20 newest events of 11 bytes each
    assert cut is not None


def test_scale_and_read_across(spark, root):
    _append(spark, root, range(0, 30), key=None)
    TB.scale(spark, root, "s", "t", 6)
    _append(spark, root, range(30, 60), key=None)
    snap = CommitLog(spark, root, "s", "t").snapshot()
    assert len(snap.current_segments) == 6 and snap.current_epoch == 1
    df = TB.read_stream(spark, root, "s", "t")
    assert _vals(df) == sorted(str(v) for v in range(60))
    assert df.where(F.col("segment_id") >= (1 << 32)).count() == 30


def test_compaction_keeps_rows_and_offsets(spark, root):
    for i in range(6):
        _append(spark, root, range(i * 10, i * 10 + 10), key=str(i % 3))
    before = sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect())
    files_before = len(CommitLog(spark, root, "s", "t").snapshot().files)
    TB.compact(spark, root, "s", "t")
    snap = CommitLog(spark, root, "s", "t").snapshot()
    assert len(snap.txns) == 1 and len(snap.files) < files_before
    after = sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect())
    assert after == before
    # the replaced folders are garbage once the timeout passed
    assert len(TB.vacuum(spark, root, "s", "t", older_than_ms=0)) == 6
    assert sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect()) == before
    # appends continue after compaction
    _append(spark, root, [99], key="0")
    assert TB.read_stream(spark, root, "s", "t").count() == 61


def test_datasource_write_then_read(spark, root):
    register(spark)
    opts = {"path": root, "scope": "s", "stream": "t", "default_num_segments": "3"}
    df = spark.createDataFrame([(str(v), str(v % 4)) for v in range(40)], "event string, routing_key string").repartition(4)
    df.write.format("segstream").options(**opts).mode("append").save()
    _append(spark, root, range(40, 50), key="1")
    df.limit(5).write.format("segstream").options(**opts).mode("append").save()
    back = TB.read_stream(spark, root, "s", "t")
    vals = _vals(back)
    assert vals == sorted([str(v) for v in range(50)] + [r.event for r in df.limit(5).collect()])
    # offsets are a gap-free sequence per segment
    for s, rows in _by_segment(back).items():
        expect = 0
        for off, ln in rows:
            assert off == expect
            expect += ln
    # the data source reader and the native reader agree
    ds = spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "t").load()
    assert sorted(tuple(r) for r in ds.collect()) == sorted(tuple(r) for r in back.collect())
    # compaction makes the offsets absolute in the files and keeps every row
    TB.compact(spark, root, "s", "t")
    assert sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect()) == sorted(tuple(r) for r in back.collect())


def _by_segment(df):
    out = {}
    for r in df.select("segment_id", "offset", F.octet_length("event").alias("n")).collect():
        out.setdefault(r.segment_id, []).append((r.offset, 8 + r.n))
    return {s: sorted(v) for s, v in out.items()}


def test_datasource_write_schema_errors(spark, root):
    register(spark)
    df = spark.createDataFrame([(1,)], "event int")
    with pytest.raises(Exception, match="event attribute type must be a string or binary"):
        df.write.format("segstream").option("path", root).option("scope", "s").option("stream", "t").mode("append").save()


def test_source_partitions_pack_small_files(spark, root):
    from segstream.sources.datasource import PACK_BYTES, _file_parts, _pack, FilePart
    from segstream.operators.cuts import segment_ranges

    for i in range(4):
        _append(spark, root, range(i * 10, i * 10 + 10), key=str(i))
    snap = CommitLog(spark, root, "s", "t").snapshot()
    groups = _file_parts(snap, segment_ranges(snap.all_segments, None, dict(snap.tail)))
    assert len(groups) == 1 and len(groups[0].parts) == len(snap.files)
    big = [FilePart(f"f{i}", 0, i * PACK_BYTES, (i + 1) * PACK_BYTES) for i in range(3)]
    assert len(_pack(big)) == 3


def test_load_report_and_autoscale(spark, root):
    opts = {"default_num_segments": "2", "default_scale_factor": "2", "default_segment_target_rate_events_per_sec": "1"}
    rows = [(str(v), str(v)) for v in range(300)]  # one append: all in the same minute window
    TB.append(spark.createDataFrame(rows, "event string, routing_key string"), root, "s", "t", opts=opts)
    rep = TB.load_report(spark, root, "s", "t", "1 minute").collect()
    assert sum(r.events for r in rep) == 300
    assert any(r.needs_split for r in rep)  # > 60 events per minute in a segment
    assert TB.autoscale(spark, root, "s", "t") == 4
    assert len(CommitLog(spark, root, "s", "t").snapshot().current_segments) == 4
    # nothing appended to the new epoch yet: no further scaling
    assert TB.autoscale(spark, root, "s", "t") is None
    # a fixed policy never scales
    TB.append(spark.createDataFrame(rows, "event string, routing_key string"), root, "s", "fixed",
              opts={"default_num_segments": "2"})
    assert TB.autoscale(spark, root, "s", "fixed") is None


def test_empty_append_commits_nothing(spark, root):
    _append(spark, root, [1, 2])
    before = CommitLog(spark, root, "s", "t").snapshot().version
    empty = spark.createDataFrame([], "event string, routing_key string")
    r = TB.append(empty, root, "s", "t")
    assert r.rows == 0 and r.version is None
    assert CommitLog(spark, root, "s", "t").snapshot().version == before


def test_large_transactions_use_a_manifest(spark, root, monkeypatch, scratch):
    """Extents of transactions with many files go to a Parquet manifest;
    native reads, cut ranges, the data source, the streaming reader and
    compaction all work from it."""
    import json

    monkeypatch.setattr(TB, "INLINE_FILES_MAX", 0)
    k = keys_for_segments(3)
    for i, key in enumerate(k):
        _append(spark, root, range(i * 10, i * 10 + 10), key=key)
    snap = CommitLog(spark, root, "s", "t").snapshot()
    assert snap.files == [] and len(snap.manifests) == 3
    assert _vals(TB.read_stream(spark, root, "s", "t")) == sorted(str(v) for v in range(30))
    cut = {s: 8 + 1 for s in snap.current_segments}  # skip the first event of each segment
    assert _vals(TB.read_stream(spark, root, "s", "t", start=cut)) == sorted(
        str(v) for v in range(30) if v not in (0, 10, 20))
    register(spark)
    ds = spark.read.format("segstream").option("path", root).option("scope", "s").option("stream", "t") \
        .option("start_stream_cut", json.dumps({str(a): b for a, b in cut.items()})).load()
    assert _vals(ds) == sorted(str(v) for v in range(30) if v not in (0, 10, 20))
    q = (spark.readStream.format("segstream").option("path", root).option("scope", "s").option("stream", "t")
         .option("start_stream_cut", "earliest").option("approx_bytes_per_trigger", "30")
         .load().writeStream.format("memory").queryName("mani").option("checkpointLocation", f"{scratch}/c").start())
    q.processAllAvailable()
    q.stop()
    assert sorted(r.event.decode() for r in spark.sql("select event from mani").collect()) == sorted(str(v) for v in range(30))
    before = sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect())
    TB.compact(spark, root, "s", "t")
    assert sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect()) == before


def test_truncated_transactions_are_dropped_and_vacuumed(spark, root):
    k = keys_for_segments(3)[0]
    _append(spark, root, range(0, 5), key=k)
    _append(spark, root, range(5, 10), key=k)
    cut = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    _append(spark, root, range(10, 15), key=k)
    TB.truncate(spark, root, "s", "t", cut)
    before = sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect())
    gone = TB.drop_truncated(spark, root, "s", "t")
    assert len(gone) == 2
    snap = CommitLog(spark, root, "s", "t").snapshot()
    assert len(snap.txns) == 1
    assert sorted(tuple(r) for r in TB.read_stream(spark, root, "s", "t").collect()) == before
    assert sorted(TB.vacuum(spark, root, "s", "t", older_than_ms=0)) == sorted(gone)
    assert _vals(TB.read_stream(spark, root, "s", "t")) == sorted(str(v) for v in range(10, 15))
