from segstream.functions.routing import EPOCH_SHIFT
from segstream.operators.cuts import budget_per_segment, next_cut, segment_ranges

E1 = EPOCH_SHIFT


def _budget_stream(spark):
    # three segments, three 10-byte events each ("10","40","70" / "20","50","80" / "30","60","90")
    rows = []
    for seg, vals in enumerate([(10, 40, 70), (20, 50, 80), (30, 60, 90)]):
        for i, v in enumerate(vals):
            rows.append((seg, i * 10, 10, str(v)))
    return spark.createDataFrame(rows, "segment_id bigint, offset bigint, len bigint, payload string")


def _batches(spark, budget):
    df = _budget_stream(spark)
    cut = {0: 0, 1: 0, 2: 0}
    tail = {0: 30, 1: 30, 2: 30}
    n = 0
    while cut != tail:
        cut = next_cut(df, cut, budget, end=tail)
        n += 1
    return n


def test_budget_batches(spark):
    # the reference's expectations: 3 batches at 1, 10, 20; 2 at 33; 1 at 100 and max long
    assert [_batches(spark, b) for b in (1, 10, 20, 33, 100, 2**63 - 1)] == [3, 3, 3, 2, 1, 1]


def test_budget_split():
    assert budget_per_segment(1, 3) == 1
    assert budget_per_segment(33, 3) == 11
    assert budget_per_segment(100, 3) == 33


def test_ranges_same_epoch():
    r = segment_ranges([0, 1, 2], {0: 10, 1: 20}, {0: 30, 1: 40, 2: 50})
    assert r == {0: (10, 30), 1: (20, 40), 2: (0, 50)}
    assert segment_ranges([0, 1], None, None) == {0: (0, None), 1: (0, None)}
    # empty ranges drop out
    assert segment_ranges([0], {0: 30}, {0: 30}) == {}


def test_ranges_across_epochs():
    segs = [0, 1, E1, E1 + 1, E1 + 2]
    r = segment_ranges(segs, {0: 5, 1: 7}, {E1: 10, E1 + 1: 20, E1 + 2: 30})
    # old segments read to their end, new ones from 0 to the end cut
    assert r == {0: (5, None), 1: (7, None), E1: (0, 10), E1 + 1: (0, 20), E1 + 2: (0, 30)}
    # start in the new epoch skips the old one
    r = segment_ranges(segs, {E1: 3, E1 + 1: 0, E1 + 2: 0}, None)
    assert set(r) == {E1, E1 + 1, E1 + 2}
    # end in the old epoch skips the new one
    r = segment_ranges(segs, None, {0: 5, 1: 5})
    assert r == {0: (0, 5), 1: (0, 5)}


def test_many_segments_use_a_range_table(spark):
    from segstream.operators.cuts import filter_ranges

    n = 300
    rows = [(s, o * 10, 10) for s in range(n) for o in range(4)]
    df = spark.createDataFrame(rows, "segment_id bigint, offset bigint, len bigint")
    ranges = segment_ranges(range(n), {s: 10 for s in range(n)}, {s: 30 for s in range(n)})
    out = filter_ranges(df, ranges)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    assert sorted(r.offset for r in out.collect()) == sorted([10, 20] * n)
