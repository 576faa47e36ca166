import collections
import hashlib
import random

import numpy as np
import pytest

from segstream.llm import anchors
from segstream.llm.queries import op11_fixed_anchors

LONG = " ".join(f"word{i % 977} thing{i}" for i in range(30_000))


def brute(rows, window):
    """(doc_id, words, removed, digest) by looking every run up."""
    first = {}
    split = [(d, (t or "").encode("utf-8", "surrogatepass").split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i : i + window])
                first[key] = min(d, first.get(key, d))
    out = collections.Counter()
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def got(df):
    return collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def made_up(seed, window):
    """Few words, shared passages at all offsets, chains of overlaps and copies of copies."""
    rng = random.Random(seed)
    passages = [[f"p{j}_{rng.randrange(40)}" for _ in range(rng.randrange(max(1, window - 3), 3 * window))] for j in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(0, window))]
            p = rng.choice(passages)
            a = rng.randrange(0, max(1, len(p) // 2))
            words += p[a : a + rng.randrange(1, len(p) + 1)]
        rows.append((rng.randrange(50), " ".join(words)))
    rows += [(100 + i, rows[3][1]) for i in range(10)] + [(None, rows[3][1]), (7, None), (8, ""), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [2, 7, 8, 50])
def test_equals_looking_up_every_run(spark, window, monkeypatch):
    monkeypatch.setattr(anchors, "GROUP_CHARS", 2500)  # many groups
    rows = made_up(window, window)
    found = anchors.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window)
    assert got(found) == brute(rows, window)


def test_odd_rows(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(anchors.repeat_digests(docs)) == brute(rows, 50)
    assert anchors.repeat_digests(no_docs).count() == 0


def test_spans_are_maximal_and_texts_keep_the_rest(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"a b {passage} c"), (2, f"{passage} mine {passage[3:]} x"), (3, LONG), (4, LONG + " more")]
    out = {r["doc_id"]: r for r in anchors.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in out[2]["spans"]] == [(0, 60), (61, 59)]
    assert bytes(out[2]["kept_text"]) == b"mine x"
    assert [tuple(s) for s in out[4]["spans"]] == [(0, 60_000)] and bytes(out[4]["kept_text"]) == b"more"
    assert out[1]["spans"] == [] and out[3]["spans"] == []


def test_texts_are_not_shuffled_after_they_are_dealt(spark):
    rows = spark.createDataFrame(made_up(1, 50), "doc_id long, text string")
    found, name, _ = anchors._repeats(rows, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert name in plan and plan.count("Exchange") == 4  # two to lanes, two back to the groups


def test_rolling_hashes_depend_on_order_and_place():
    h = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x123456789ABCDEF1)
    for width in (1, 2, 3, 7, 25, 50):
        runs = anchors.rolling(h, width)
        assert len(runs) == len(h) - width + 1 and len(set(runs.tolist())) == len(runs)
        assert all(anchors.rolling(h[i : i + width], width)[0] == runs[i] for i in range(len(runs)))
    assert anchors.rolling(h[:2], 2)[0] != anchors.rolling(h[:2][::-1].copy(), 2)[0]
    assert len(anchors.rolling(h[:5], 9)) == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op11_fixed_anchors(spark, sf)) == brute(rows, 50)
