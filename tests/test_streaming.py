import json
import os
import time

import pytest
from pyspark.sql import functions as F

from segstream.sources import table as TB
from segstream.sources.datasource import register
from segstream.sources.log import CommitLog
from segstream.streaming.sink import stream_to_table

from stream_helpers import keys_for_segments


def _append(spark, root, values, key=None, segments="3"):
    df = spark.createDataFrame([(str(v), key) for v in values], "event string, routing_key string")
    TB.append(df, root, "s", "t", opts={"default_num_segments": segments})


def _reader(spark, root, **opts):
    register(spark)
    r = spark.readStream.format("segstream").option("path", root).option("scope", "s").option("stream", "t")
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load()


def _run(df, name, ckpt, trigger_once=False):
    q = (df.select((F.col("event").cast("string").cast("int") + 1).alias("v"))
         .writeStream.format("memory").queryName(name).option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    return q


def _seen(spark, name):
    return sorted(r.v for r in spark.sql(f"select v from {name}").collect())


def test_from_earliest_with_budget(spark, root, scratch):
    k = keys_for_segments(3)
    for key, vals in zip(k, [(10, 40, 70), (20, 50, 80), (30, 60, 90)]):
        _append(spark, root, vals, key=key)
    q = _run(_reader(spark, root, start_stream_cut="earliest", approx_bytes_per_trigger="10"), "b10", f"{scratch}/c1")
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    q.stop()
    assert _seen(spark, "b10") == [11, 21, 31, 41, 51, 61, 71, 81, 91]
    assert batches == [3, 3, 3]
    q = _run(_reader(spark, root, start_stream_cut="earliest", approx_bytes_per_trigger="33"), "b33", f"{scratch}/c2")
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    q.stop()
    assert batches == [6, 3]


def test_from_latest_and_restart(spark, root, scratch):
    _append(spark, root, [-1])
    ckpt, out = f"{scratch}/ckpt", f"{scratch}/out"

    def start():
        df = _reader(spark, root).select((F.col("event").cast("string").cast("int") + 1).alias("v"))
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).start()
        q.processAllAvailable()
        return q

    q = start()
    _append(spark, root, [1, 2, 3])
    q.processAllAvailable()
    q.stop()
    _append(spark, root, [4, 5, 6])  # while stopped
    q = start()
    _append(spark, root, [7, 8])
    q.processAllAvailable()
    q.stop()
    got = sorted(r.v for r in spark.read.parquet(out).collect())
    assert got == [2, 3, 4, 5, 6, 7, 8, 9]  # -1 never seen, nothing lost or repeated


def test_specific_start_and_end(spark, root, scratch):
    _append(spark, root, [-10, -11, -12])
    cut = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    _append(spark, root, [0, 1, 2])
    end = CommitLog(spark, root, "s", "t").snapshot().tail_cut()
    _append(spark, root, [30, 31])
    text = lambda c: json.dumps({str(a): b for a, b in c.items()})
    q = _run(_reader(spark, root, start_stream_cut=text(cut), end_stream_cut=text(end)), "spec", f"{scratch}/c")
    q.stop()
    assert _seen(spark, "spec") == [1, 2, 3]


def test_truncated_start(spark, root, scratch):
    k = keys_for_segments(3)[0]
    _append(spark, root, range(6), key=k)
    head = CommitLog(spark, root, "s", "t").snapshot().head_cut()
    TB.truncate(spark, root, "s", "t", CommitLog(spark, root, "s", "t").snapshot().tail_cut())
    text = json.dumps({str(a): b for a, b in head.items()})
    q = _run(_reader(spark, root, start_stream_cut=text, approx_bytes_per_trigger="10"), "trunc", f"{scratch}/c")
    assert _seen(spark, "trunc") == []
    _append(spark, root, [28, 29], key=k)
    q.processAllAvailable()
    q.stop()
    assert _seen(spark, "trunc") == [29, 30]


def test_reads_across_scaling(spark, root, scratch):
    _append(spark, root, [1, 2, 3])
    q = _run(_reader(spark, root, start_stream_cut="earliest", approx_bytes_per_trigger="20"), "scl", f"{scratch}/c")
    _append(spark, root, [4, 5, 6])
    q.processAllAvailable()
    TB.scale(spark, root, "s", "t", 6)
    _append(spark, root, range(9, 17))
    q.processAllAvailable()
    q.stop()
    assert _seen(spark, "scl") == [v + 1 for v in [1, 2, 3, 4, 5, 6] + list(range(9, 17))]


def test_row_metrics(spark, root, scratch):
    _append(spark, root, [-1], segments="5")
    q = _run(_reader(spark, root), "met", f"{scratch}/c")
    _append(spark, root, [1, 2, 3], segments="5")
    q.processAllAvailable()
    q.stop()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3


def test_stream_self_join(spark, root, scratch):
    register(spark)
    _append(spark, root, [1, 2], segments="2")
    src = _reader(spark, root, start_stream_cut="earliest")
    vals = src.select(F.col("event").cast("string").cast("int").alias("value"))
    a = vals.select((F.col("value") % 5).alias("key"), F.col("value").alias("a"))
    b = vals.select((F.col("value") % 5).alias("key"), F.col("value").alias("b"))
    j = a.join(b, "key")
    q = j.writeStream.format("memory").queryName("sj").option("checkpointLocation", f"{scratch}/c").start()
    q.processAllAvailable()
    _append(spark, root, [6, 3], segments="2")
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("select key, a, b from sj").collect())
    assert got == sorted([(1, 1, 1), (2, 2, 2), (3, 3, 3), (1, 6, 1), (1, 1, 6), (1, 6, 6)])


def test_sink_append_and_update_mode(spark, root, scratch):
    src_dir = f"{scratch}/in"
    os.makedirs(src_dir)
    spark.createDataFrame([(v,) for v in [1, 2, 2, 3, 3, 3]], "value int").write.parquet(f"{src_dir}/a")
    stream = spark.readStream.schema("value int").parquet(f"{src_dir}/*")
    counts = stream.groupBy("value").count().select(
        F.to_json(F.create_map(F.lit("key"), F.col("value").cast("string"), F.lit("value"), F.col("count").cast("string"))).alias("event")
    )
    q = stream_to_table(counts, root, "s", "t", checkpoint=f"{scratch}/ck", output_mode="update",
                        opts={"default_num_segments": "1"})
    q.processAllAvailable()
    spark.createDataFrame([(v,) for v in [1, 2, 3]], "value int").write.parquet(f"{src_dir}/b")
    q.processAllAvailable()
    q.stop()
    back = TB.read_stream(spark, root, "s", "t").select(
        F.json_tuple(F.col("event").cast("string"), "key", "value").alias("k", "v"))
    got = sorted((int(r.k), int(r.v)) for r in back.collect())
    assert got == [(1, 1), (1, 2), (2, 2), (2, 3), (3, 3), (3, 4)]


def test_sink_replay_is_exactly_once(spark, root, scratch):
    from segstream.streaming.sink import batch_writer

    fn = batch_writer(root, "s", "t", "query-1", opts={"default_num_segments": "3"})
    df = spark.createDataFrame([(str(v),) for v in range(5)], "event string")
    fn(df, 0)
    fn(df, 0)  # Spark replays a batch whose commit marker was lost
    fn(df, 1)
    assert TB.read_stream(spark, root, "s", "t").count() == 10


def test_rate_source_to_table(spark, root, scratch):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load().select(
        F.col("timestamp").cast("string").alias("event"), F.col("value").cast("string").alias("routing_key"))
    q = stream_to_table(rate, root, "s", "t", checkpoint=f"{scratch}/ck", processing_time="1 second",
                        opts={"default_num_segments": "2"})
    deadline = time.time() + 120
    while time.time() < deadline and not CommitLog(spark, root, "s", "t").stream_exists():
        time.sleep(0.5)
    while time.time() < deadline and not any(p["numInputRows"] > 0 for p in q.recentProgress):
        time.sleep(0.5)
    q.stop()
    assert TB.read_stream(spark, root, "s", "t").count() > 0


def test_stream_end_earliest_is_an_error(spark, root, scratch):
    _append(spark, root, [1])
    df = _reader(spark, root, end_stream_cut="earliest")
    with pytest.raises(Exception):
        q = df.writeStream.format("memory").queryName("bad").option("checkpointLocation", f"{scratch}/c").start()
        q.processAllAvailable()


def test_sink_complete_mode_appends_whole_result(spark, root, scratch):
    src_dir = f"{scratch}/in"
    os.makedirs(src_dir)
    spark.createDataFrame([(v,) for v in [1, 2, 2]], "value int").write.parquet(f"{src_dir}/a")
    stream = spark.readStream.schema("value int").parquet(f"{src_dir}/*")
    counts = stream.groupBy("value").count().select(F.concat_ws(":", "value", "count").alias("event"))
    q = stream_to_table(counts, root, "s", "t", checkpoint=f"{scratch}/ck", output_mode="complete",
                        opts={"default_num_segments": "1"})
    q.processAllAvailable()
    spark.createDataFrame([(3,)], "value int").write.parquet(f"{src_dir}/b")
    q.processAllAvailable()
    q.stop()
    got = sorted(r.e for r in TB.read_stream(spark, root, "s", "t").select(F.col("event").cast("string").alias("e")).collect())
    assert got == sorted(["1:1", "2:2", "1:1", "2:2", "3:1"])


def test_sql_view(spark, root):
    import segstream

    _append(spark, root, [5, 6, 7])
    segstream.register_view(spark, "ev_view", root, "s", "t")
    rows = spark.sql("SELECT sum(CAST(CAST(event AS STRING) AS INT)) AS s FROM ev_view").collect()
    assert rows[0].s == 18


def test_write_stream_format(spark, root, scratch):
    register(spark)
    src_dir = f"{scratch}/in"
    os.makedirs(src_dir)
    spark.createDataFrame([(str(v),) for v in range(1, 6)], "event string").write.parquet(f"{src_dir}/a")
    stream = spark.readStream.schema("event string").parquet(f"{src_dir}/*")
    q = (stream.writeStream.format("segstream").option("path", root).option("scope", "s").option("stream", "t")
         .option("query_id", "w1").option("default_num_segments", "2")
         .option("checkpointLocation", f"{scratch}/ck").start())
    q.processAllAvailable()
    assert _seen_table(spark, root) == [str(v) for v in range(1, 6)]
    spark.createDataFrame([(str(v),) for v in range(6, 11)], "event string").write.parquet(f"{src_dir}/b")
    q.processAllAvailable()
    q.stop()
    assert _seen_table(spark, root) == sorted(str(v) for v in range(1, 11))


def _seen_table(spark, root):
    return sorted(r.e for r in TB.read_stream(spark, root, "s", "t").select(F.col("event").cast("string").alias("e")).collect())


def test_stress_random_appends_and_scalings(spark, root, scratch):
    """Random data, random scalings and a random byte budget: every value
    arrives exactly once."""
    import random

    rnd = random.Random(1)
    _append(spark, root, [101, 102, 103, 104, 105])
    budget = rnd.choice([1, 20, 100, 1000])
    df = _reader(spark, root, start_stream_cut="earliest", approx_bytes_per_trigger=str(budget))
    q = _run(df, "stress", f"{scratch}/c")
    expect = [101, 102, 103, 104, 105]
    nxt = 200
    for _ in range(5):
        if rnd.random() < 0.4:
            TB.scale(spark, root, "s", "t", rnd.randint(1, 6))
        vals = list(range(nxt, nxt + rnd.randint(1, 15)))
        nxt += 100
        _append(spark, root, vals, key=None)
        expect += vals
        q.processAllAvailable()
    q.stop()
    assert _seen(spark, "stress") == sorted(v + 1 for v in expect)


def test_console_sink(spark, root, scratch, capsys):
    _append(spark, root, [1, 2, 3])
    df = _reader(spark, root, start_stream_cut="earliest").selectExpr("CAST(event AS STRING) AS v")
    q = df.writeStream.format("console").option("checkpointLocation", f"{scratch}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3
