"""Task failures during an append: Spark retries the task, the blocks and
offsets are recomputed deterministically, and the result is exact.  Runs in a
subprocess because task retries need a ``local[n,maxFailures]`` master."""

import json
import os
import subprocess
import sys
import textwrap

SCRIPT = textwrap.dedent(r'''
    import json, sys
    sys.path.insert(0, sys.argv[1])
    from pyspark.sql import SparkSession, functions as F
    from pyspark import TaskContext
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setCheckpointDir(sys.argv[2] + "/ckpt")
    from segstream.sources import table as TB

    @F.udf("string")
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 1 and x.endswith("7"):
            raise RuntimeError("lost executor")
        return x

    rows = [(str(v), str(v % 5), v) for v in range(400)]
    df = spark.createDataFrame(rows, "event string, routing_key string, n bigint").repartition(4, "n")
    df = df.select(flaky("event").alias("event"), "routing_key", "n")
    TB.append(df, sys.argv[2] + "/t", "s", "t", order_by="n", opts={"default_num_segments": "3"})
    got = [(r.event.decode(), r.segment_id, r.offset) for r in TB.read_stream(spark, sys.argv[2] + "/t", "s", "t").collect()]
    print("RESULT" + json.dumps(got))
''')


def test_append_survives_task_retries(tmp_path):
    from stream_helpers import segment_of

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SCRIPT, repo, str(tmp_path)], capture_output=True, text=True,
                         timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    got = sorted(tuple(r) for r in json.loads(line[0][len("RESULT"):]))
    expect, tails = [], {}
    for v in range(400):
        s = segment_of(str(v % 5), 3)
        expect.append((str(v), s, tails.get(s, 0)))
        tails[s] = tails.get(s, 0) + 8 + len(str(v))
    assert got == sorted(expect)
