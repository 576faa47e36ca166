import collections
import random
import re

import numpy as np

from segstream.llm import divergence as dv
from segstream.llm.queries import op13_count_cells

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

LONG = " ".join(f"word{i % 977} thing{i}" for i in range(30_000))


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def brute(rows, min_docs=3, top=200):
    """Both reports term by term, in Python's integers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs_of, count = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        words = TERM.findall(lowered(text))
        count[lang, source].update(words)
        docs_of[lang].update(set(words))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = [t for t, d in docs_of[lang].items() if d >= min_docs]
        sources = {r[2] for r in rows if r[1] == lang}

        def share(c, n):
            return 1 + 10**9 * (c + 1) // (n + len(kept))

        total = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        n = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        for s in sources:
            p = {t: share(count[lang, s][t], n[s]) for t in kept}
            found = []
            for other in sources - {s}:
                q = {t: share(count[lang, other][t], n[other]) for t in kept}
                found.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode(), other))
            out |= {(lang, s, "pair", item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(found))}
            q = {t: share(total[t], sum(total.values())) for t in kept}
            found = sorted((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[t] > q[t])
            out |= {(lang, s, "term", item, -v, i + 1) for i, (v, _, item) in enumerate(found[:top])}
    return out


def got(df):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)


def made_up(seed):
    """Many terms of equal counts, a source that holds a third, one without terms, a language that keeps none."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdéßЖ日Z" for b in "xyzÄ\U0001f642"]
    rows = []
    for _ in range(150):
        text = rng.choice([" ", "\n", "1,"]).join(rng.choice(words) for _ in range(rng.randrange(0, 30)))
        rows.append((text, rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "a", "b", "C", None, "ü"])))
    rows += rows[:10] + [("123 -", "en", "numbers"), ("once", "fr", "a"), (None, "fr", "b"), ("", "it", "z"), (None, None, "none"), (LONG, "en", "a")]
    return rows


def test_equals_term_by_term(spark, monkeypatch):
    rows = made_up(1)
    assert got(dv.divergence(frame(spark, rows))) == brute(rows)
    monkeypatch.setattr(dv, "FLUSH", 10)
    monkeypatch.setattr(dv, "PAIRS_AT_ONCE", 1)
    assert got(dv.divergence(frame(spark, rows), min_docs=1, top=5)) == brute(rows, 1, 5)


def test_ties_that_pass_the_last_rank(spark):
    """All terms of a source in one cell: the ranks end inside it, in UTF-8 order."""
    terms = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rows = [(" ".join(terms), "en", "a")] * 3 + [("other words here", "en", "b")] * 4
    random.Random(2).shuffle(rows)
    assert got(dv.divergence(frame(spark, rows))) == brute(rows)


def test_odd_rows_and_empty_tables(spark, docs, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert got(dv.divergence(docs)) == brute(rows)
    assert dv.divergence(no_docs).count() == 0


def test_shares_stay_exact_where_longs_would_not(spark):
    count, total = np.array([0, 5, 9_300_000_000, 2**62]), np.array([2**62 + 10] * 4)
    expected = [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(count, total)]
    assert dv.exact_shares(count, total).tolist() == expected
    df = spark.createDataFrame([(int(c), int(t)) for c, t in zip(count, total)], "c long, t long")
    col = dv.share(df["c"], df["t"], dv.F.lit(0))
    assert [r[0] for r in df.orderBy("c").select(col).collect()] == expected


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang", "source").collect()]
    assert got(op13_count_cells(spark, sf)) == brute(rows)
