"""Seeded random appends, scalings and truncations checked against a plain
Python model of segments (list of (offset, payload) per segment)."""

import random

from pyspark.sql import functions as F

from segstream.functions.routing import EPOCH_SHIFT
from segstream.operators.cuts import segment_ranges
from segstream.sources import table as TB
from segstream.sources.log import CommitLog

from stream_helpers import segment_of


class Model:
    def __init__(self, n):
        self.epoch, self.n = 0, n
        self.segs = {s: [] for s in range(n)}
        self.head = {}

    def append(self, rows):
        for payload, key in rows:
            s = self.epoch * EPOCH_SHIFT + segment_of(key, self.n)
            seg = self.segs[s]
            off = seg[-1][0] + 8 + len(seg[-1][1].encode()) if seg else 0
            seg.append((off, payload))

    def scale(self, n):
        self.epoch += 1
        self.n = n
        for i in range(n):
            self.segs[self.epoch * EPOCH_SHIFT + i] = []

    def tail(self):
        out = {}
        for i in range(self.n):
            s = self.epoch * EPOCH_SHIFT + i
            seg = self.segs[s]
            out[s] = seg[-1][0] + 8 + len(seg[-1][1].encode()) if seg else 0
        return out

    def read(self, start, end):
        ranges = segment_ranges(list(self.segs), start, end)
        out = []
        for s, (lo, hi) in ranges.items():
            lo = max(lo, self.head.get(s, 0))
            out += [(p, s, o) for o, p in self.segs[s] if o >= lo and (hi is None or o < hi)]
        return sorted(out)


def test_random_against_model(spark, root):
    rnd = random.Random(1)
    m = Model(3)
    cuts = [None]
    counter = 0
    for step in range(8):
        op = rnd.choice(["append", "append", "append", "scale", "truncate"]) if step else "append"
        if op == "append":
            rows = []
            for _ in range(rnd.randint(1, 12)):
                rows.append((f"v{counter}-é" * rnd.randint(1, 3), f"key{rnd.randint(0, 9)}"))
                counter += 1
            df = spark.createDataFrame([(p, k, i) for i, (p, k) in enumerate(rows)],
                                       "event string, routing_key string, n bigint")
            TB.append(df, root, "s", "t", order_by="n", opts={"default_num_segments": "3"})
            m.append(rows)
        elif op == "scale":
            n = rnd.randint(1, 5)
            TB.scale(spark, root, "s", "t", n)
            m.scale(n)
        else:
            tail = m.tail()
            cut = {s: rnd.randint(0, t) for s, t in tail.items()}
            # truncate only at event boundaries of the model
            for s in cut:
                offs = [o for o, _ in m.segs[s] if o <= cut[s]]
                cut[s] = offs[-1] if offs else 0
            TB.truncate(spark, root, "s", "t", cut)
            for s, h in cut.items():
                m.head[s] = max(h, m.head.get(s, 0))
        snap = CommitLog(spark, root, "s", "t").snapshot()
        assert snap.tail_cut() == m.tail()
        cuts.append(m.tail())
    # every pair of recorded tails as a range, plus open ends
    for a in cuts:
        for b in cuts:
            got = sorted((r.p, r.segment_id, r.offset) for r in TB.read_stream(spark, root, "s", "t", start=a, end=b)
                         .select(F.col("event").cast("string").alias("p"), "segment_id", "offset").collect())
            assert got == m.read(a, b), (a, b)
