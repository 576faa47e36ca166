import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from segstream.llm import ann, attention, toxicity
from segstream.llm.queries import op8_kmeans_tree

SF = "/root/testdata/sf0.001"


def base_by_hand(rows):
    tokens = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = collections.Counter()
    for (_, w), h in zip(tokens, held):
        if not h:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, w), h in zip(tokens, held):
        out.append((d, h, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def same_rows(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0


def test_scores_of_odd_rows(docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = attention.score_texts(docs, common=50, fit_steps=5, groups=8).collect()  # most words go through the join
    same_rows(got, base_by_hand(rows))
    assert attention.score_texts(no_docs, fit_steps=2).collect() == []
    alone = attention.score_texts(docs.where("doc_id = 4"), fit_steps=2, groups=8).collect()
    assert len(alone) == 1 and alone[0]["n_tokens"] == 1


@pytest.fixture(scope="module")
def fitted(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    e = attention.WordEncoder("byte_bpe_50k.json", keep=500)
    ids = [x.astype(int) for x in e.words([attention.words_of(t) for t in texts], np.array(50256, e.dtype).tobytes())]
    counts = np.bincount(np.concatenate(ids[:150]), minlength=50257)
    model = attention.Model(counts, ids[:150], 16, 50256)
    untrained = model.score(ids[150:], model.table()).sum()
    model.train(ids[:150], 150, batch=128)
    return model, ids, counts, untrained


def test_training_helps_held_out_texts(fitted):
    model, ids, counts, untrained = fitted
    held = np.concatenate(ids[150:])
    unigram = np.log10((counts[held] + 0.1) / (counts + 0.1).sum()).sum()
    score = model.score(ids[150:], model.table()).sum()
    assert score > untrained and score > unigram


def test_model_is_a_causal_distribution(fitted):
    model, ids, _, _ = fitted
    table, prefix = model.table(), ids[0][:21]
    every = [np.append(prefix, i) for i in range(0, 50257)]
    before = model.score([prefix], table)[0]
    share = sum((10 ** (model.score(every[i : i + 8192], table) - before)).sum() for i in range(0, len(every), 8192))
    assert share == pytest.approx(1, abs=1e-3)  # the next id's probabilities add up to 1
    a, b = model.score([ids[0], np.append(ids[0], 7)], table)
    last = model.score([np.append(ids[0], 7)], table)[0] - a
    assert b - a == pytest.approx(last, abs=1e-3)  # what follows doesn't change what was scored
    together, alone = model.score(ids[:9], table, 16), [model.score([x], table)[0] for x in ids[:9]]
    assert together == pytest.approx(alone, abs=1e-3)


def true_nearest(ids, x, q, query_id, k):
    s = (x * q).sum(axis=1)
    rows = [i for i in np.lexsort((ids, -s)) if ids[i] != query_id]
    return [(int(ids[i]), float(s[i])) for i in rows[:k]]


def test_search_reaches_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = collections.defaultdict(dict)
    for r in op8_kmeans_tree(spark, "/root/testdata/sf0.1").collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        want, mine = true_nearest(ids, x, x[i], ids[i], 20), got[ids[i]]
        assert sorted(mine) == list(range(1, 21))
        assert [v for v, _ in sorted(mine.values(), key=lambda p: (-p[1], p[0]))] == [mine[k][0] for k in range(1, 21)]
        exact = dict(zip(ids.tolist(), (x * x[i]).sum(axis=1)))
        assert all(s == exact[v] for v, s in mine.values())
        hits.append(len({v for v, _ in mine.values()} & {v for v, _ in want}) / 20)
    assert len(got) == len(hits) and np.mean(hits) >= 0.9


def test_full_visits_are_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.integers(-3, 4, 6).astype(float).tolist(), "x") for i in range(300)]
    data += [(i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0], "x") for i in range(300, 700)]  # one very common vector
    data += [(1000, None, "x"), (1001, [0.0] * 6, "x"), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (1003, [float("nan")] * 6, "x"), (1004, [float("inf")] * 6, "x"), (1005, [1.0], "x"), (None, [1.0] * 6, "x"), (20, [3.0] * 6, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, rank string").repartition(5)
    got = collections.defaultdict(list)
    for r in ann.search(df, df.where("vec_id % 20 = 0"), k=7, leaf_rows=20, branch=4, block_rows=64, visits=1.0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    rows = [(i, v) for i, v, _ in data if i is not None and v and len(v) == 6 and all(y is not None and math.isfinite(y) for y in v) and any(v)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    asked = {int(i): min(v for j, v in rows if j == i) for i in ids if i % 20 == 0}
    assert set(got) == set(asked)
    for i, q in asked.items():
        assert [(v, s) for _, v, s in sorted(got[i])] == true_nearest(ids, x, np.array(q), i, 7)
    few = spark.createDataFrame(data[:3], df.schema)
    assert ann.search(few, few).count() == 6  # all candidates, if fewer
    assert ann.search(df.limit(0), df).collect() == [] and ann.search(df, df.limit(0)).collect() == []


def test_machines_mark_clauses():
    parse = lambda s: toxicity.parse(s.split())
    assert parse("O I O") == ["O", "I", "O"]
    assert parse("N O I") == ["N", "O", "In"] and parse("N O O O I")[-1] == "I"
    assert parse("R O I") == ["R", "O", "Ir"] and parse("I R") == ["I", "R"]
    assert parse("Y T") == ["Y", "Ty"] and parse("I Y") == ["Iy", "Y"]
    assert parse("R Y N I")[-1] == "Inry"
    g = toxicity.Grammar({"idiot": 1.0}, {"vequ": 1.0})
    assert list(g.clauses("fine words. you idiot, really! more vequan here\nend")) == [" you idiot, really!", " more vequan here\n"]
    assert list(g.clauses("unidiot xvequ")) == []


def made_up_labels(seed, n=500):
    """Toxic texts hold at least two insults, some of them stems with many endings."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('abcdefg')}{rng.choice(['ra', 'ti', 'no'])}{rng.randrange(60)}q".replace("0", "o").replace("1", "l") for _ in range(rng.randrange(10, 80))]
        words = [re.sub(r"\d", "z", w) + rng.choice("abcdefghij") for w in words]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["grubbo", "snerk", "vlort" + rng.choice("abcdefghijk") * 3]))
        rows.append((i, " ".join(words), "en", "s", 5))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = made_up_labels(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    marks = spark.createDataFrame(labels + [(3, 1, None), (None, 0, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    truth = {i: t for i, _, t in labels}
    got = toxicity.score_documents(docs, marks).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r["predicted"] == truth[r["doc_id"]] for r in held]
    assert sum(right) / len(right) > 0.97
    flipped = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    again = toxicity.score_documents(docs, flipped).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))  # held-out labels play no part


def test_toxicity_odd_rows(spark, docs, no_docs):
    marks = spark.createDataFrame([(1, 1, 0), (8, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (marks, marks.limit(0)):
        got = toxicity.score_documents(docs, labels)
        rows = got.collect()
        assert got.columns == [c for c in docs.columns if c != "score"] + ["held_out", "score", "predicted"]
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity.score_documents(no_docs, marks).collect() == []
