"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Each timing forces full execution (``noop`` sink or a real write), so nothing
is collected to the driver except the small results the operators need.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from segstream.session import fresh_table_root, local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="segstream-bench")

    from segstream.plans import queries as Q
    from segstream.sources import table as TB
    from segstream.sources.datasource import register

    # Warm-up (not timed): JIT, Python workers and the Parquet reader on a small table.
    warm = spark.read.parquet(f"{sf_dir}/orders.parquet")
    warm.groupBy("o_orderstatus").agg(F.sum("o_totalprice")).collect()
    TB.append(warm.limit(1000).select(F.col("o_orderkey").cast("string").alias("event"),
                                      F.col("o_custkey").cast("string").alias("routing_key"), "o_orderkey"),
              fresh_table_root(spark, "bench-warm"), "w", "w", order_by="o_orderkey")

    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def run(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        if isinstance(out, int):
            rows[name] = out

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li_src = lineitem.select(
        F.to_json(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")).alias("event"),
        F.col("l_orderkey").cast("string").alias("routing_key"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"),
    )
    root = fresh_table_root(spark, "bench")

    # appends with routing + offset assignment + transactional commit
    run("append_lineitem_3seg", lambda: TB.append(li_src, root, "b", "li3", order_by="ord",
                                                   opts={"default_num_segments": "3"}).rows)
    run("append_lineitem_64seg", lambda: TB.append(li_src, root, "b", "li64", order_by="ord",
                                                    opts={"default_num_segments": "64"}).rows)
    run("append_input_order", lambda: TB.append(li_src.drop("ord"), root, "b", "lio",
                                                 opts={"default_num_segments": "16"}).rows)

    # scans: whole stream, and a 10% cut range (pushdown to segment partitions + offset stats)
    def full_scan():
        df = TB.read_stream(spark, root, "b", "li64")
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("event")).alias("b")).first()["n"]

    run("scan_full", full_scan)

    snap_tail = {int(r["segment_id"]): int(r["t"]) for r in TB.read_events(spark, root, "b", "li64")
                 .groupBy("segment_id").agg(F.max(F.col("offset") + F.col("len")).alias("t")).collect()}
    start = {s: t * 45 // 100 for s, t in snap_tail.items()}
    end = {s: t * 55 // 100 for s, t in snap_tail.items()}

    def cut_scan():
        df = TB.read_stream(spark, root, "b", "li64", start=start, end=end)
        return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]

    run("scan_cut_range_10pct", cut_scan)

    def budget_cuts():
        cut = {s: 0 for s in snap_tail}
        for _ in range(5):
            cut = TB.next_cut(spark, root, "b", "li64", cut, 1 << 20)
        return len(cut)

    run("next_cut_x5", budget_cuts)

    # streaming read through the Python data source, 8 MiB per trigger
    def stream_read():
        register(spark)
        df = (spark.readStream.format("segstream").option("path", root).option("scope", "b").option("stream", "li3")
              .option("start_stream_cut", "earliest").option("approx_bytes_per_trigger", str(8 << 20)).load())
        ck = fresh_table_root(spark, "bench-ckpt")
        q = df.writeStream.format("noop").option("checkpointLocation", ck).start()
        q.processAllAvailable()
        n = sum(p["numInputRows"] for p in q.recentProgress)
        q.stop()
        return n

    run("stream_read_8MiB", stream_read)

    # registered query plans over the whole tables
    for name in ("assign_offsets", "ordered_by_key", "retention_by_size", "scale_reroute", "segment_load",
                 "committed_only"):
        run(f"q_{name}", lambda name=name: noop(Q.QUERIES[name](spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "rows": rows, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
