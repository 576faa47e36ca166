"""Source divergence audit by count-cell ranking.

Every (lang, source) group gives each term that its language keeps a share p in
billionths, smoothed by one; f = floor((p - q)^2 / q) tells how far p is above
or below the share q of something else. Two reports come out:

* ``term``: the terms that a source uses more than its language does (q is the
  language's share), the first 200 ranks;
* ``pair``: for each other source of the language (q is its share), f summed
  over all kept terms, all ranks.

Method. f depends on a term only through its counts, so terms are grouped by
(group count, lang count) and f is evaluated once a cell. Cells of equal f are
merged and ranked by cumulative multiplicity; only cells that begin within the
first ranks are expanded again, in UTF-8 order of their terms.

For pairs, most terms are absent from one side or both. With h(c) terms of
count c in a source and z = 0, the sum over all kept terms is

    sum over terms that both hold of f(a, b) - f(a, z) - f(z, b) + f(z, z)
    + sum of h_A(a) (f(a, z) - f(z, z)) + sum of h_B(b) (f(z, b) - f(z, z)) + V f(z, z)

so only terms that both sources hold are looked at pair by pair, and as many
numbers as the report has rows come out of each batch. The rest needs the
histograms alone.

Texts are counted where they are read; a task sends one row for each term and
group of a few thousand documents, so a frequent term or a large source is
combined before it moves. Arithmetic is exact: long and decimal columns, and
numpy integers that become Python's where a product would not fit.

Defined results: null text, lang and source are ''; a group without terms and a
language that keeps none are reported with value 0 in ``pair`` and nothing in
``term``; a language with one source has no ``pair`` rows; repeated rows are
documents of their own; equal values take ranks in UTF-8 order of the items; an
empty table gives an empty result; very long texts are counted whole; columns
other than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segstream.llm.common import settle, written

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
FLUSH = 400_000  #: (group, term) entries that a task holds before it sends them
PAIRS_AT_ONCE = 1_000_000
#: Letters A-Z lower-cased, other ASCII bytes that are no letters made blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents, partly combined."""

    def rows(held: dict) -> pa.RecordBatch:
        keys = [(lang, source, term, n, d) for (lang, source), terms in held.items() for term, (n, d) in terms.items()]
        types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*keys), types)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            langs, sources, texts = batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]
            for i in range(batch.num_rows):
                group = held.setdefault((langs[i], sources[i]), {})
                size -= len(group)
                for term, n in Counter(terms_of(texts[i].as_py())).items():
                    entry = group.get(term)
                    if entry is None:
                        group[term] = [n, 1]
                    else:
                        entry[0] += n
                        entry[1] += 1
                size += len(group)
                if size > FLUSH:
                    yield rows(held)
                    held, size = {}, 0
        if size:
            yield rows(held)

    return grouped(docs).mapInArrow(run, "lang string, source string, term binary, n long, d long")


def grouped(docs: DataFrame) -> DataFrame:
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*named, F.col("text").cast("string").cast("binary").alias("text"))


def held_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, c, total, first): counts of kept terms in the groups
    that hold them and in the language; ``first`` marks one row of each term."""
    counts = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("c"), F.sum("d").alias("d"))
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("c").alias("total"), F.sum("d").alias("d"), F.collect_list(F.struct("source", "c")).alias("groups")
    )
    kept = by_term.where(F.col("d") >= min_docs).select("lang", "term", "total", F.posexplode("groups").alias("at", "g"))
    return kept.select("lang", "g.source", "term", "g.c", "total", (F.col("at") == 0).alias("first"))


def count_cells(held: DataFrame) -> DataFrame:
    """(lang, source, c, total, m, heads): the number of terms of each cell, and
    how many of them are the first of their rows."""
    return held.groupBy("lang", "source", "c", "total").agg(F.count(F.lit(1)).alias("m"), F.count_if("first").alias("heads"))


def share(count: Column, n: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (n + kept)), exact for any long count."""
    top = (count + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", top, (n + kept).cast("decimal(20,0)"))


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares stay under 2^31, so squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, n, kept, lang_n): of each occurring group the sum of its
    kept terms' counts, and of its language the number and sum of kept terms."""
    groups = grouped(docs).select("lang", "source").distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum(F.col("c") * F.col("m")).alias("n"))
    langs = cells.groupBy("lang").agg(F.sum("heads").alias("kept"), F.sum(F.col("heads") * F.col("total")).alias("lang_n"))
    out = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    return out.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "kept", "lang_n")])


def term_report(held: DataFrame, cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms a source overuses."""
    cell = ["lang", "source", "c", "total"]
    p, q = share(F.col("c"), F.col("n"), F.col("kept")), share(F.col("total"), F.col("lang_n"), F.col("kept"))
    cells = cells.join(groups, ["lang", "source"]).withColumn("p", p).withColumn("q", q).where("p > q").select(*cell, "m", excess(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    ranked = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    before = F.sum("m").over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    ranked = ranked.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = cells.join(ranked, ["lang", "source", "value"]).select(*cell, "value", "before")
    in_order = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = held.join(chosen, cell).withColumn("at", F.row_number().over(in_order)).where(F.col("at") <= top)
    rank = (F.col("before") + F.col("at")).cast("int")
    return terms.where(rank <= top).select("lang", "source", F.col("term").cast("string").alias("item"), "value", rank.alias("rank"))


def exact_shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` of numpy integers; Python's where a long would overflow."""
    if count.size and int(count.max()) >= (1 << 63) // SCALE - 1:
        return (1 + (SCALE * (count.astype(object) + 1)) // total.astype(object)).astype(np.int64)
    return 1 + (SCALE * (count + 1)) // total


def exact_excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pair_sums(vectors: DataFrame) -> DataFrame:
    """(lang, a, b, value): over the terms that both sources hold, what they add
    to the sums of terms that one of them holds; one row a batch and pair."""

    def both(codes: np.ndarray, c: np.ndarray, total: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        p, zero = exact_shares(c, total), exact_shares(np.zeros_like(c), total)
        pa_, pb, za, zb = p[:, :, None], p[:, None, :], zero[:, :, None], zero[:, None, :]
        g = exact_excess(pa_, pb) - exact_excess(pa_, zb) - exact_excess(za, pb) + exact_excess(za, zb)
        key, where = np.unique((codes[:, :, None] * groups + codes[:, None, :]).ravel(), return_inverse=True)
        sums = np.zeros(len(key), np.int64)
        np.add.at(sums, where, g.ravel())
        return key, sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch["groups"]
            ends = np.asarray(lists.offsets)
            ends, flat = ends - ends[0], lists.flatten()
            width = np.diff(ends)
            name = pa.StructArray.from_arrays([batch["lang"].take(pa.array(np.repeat(np.arange(batch.num_rows), width))), flat.field("source")], ["lang", "source"])
            pairs = list(zip(name.field("lang").to_pylist(), name.field("source").to_pylist()))
            names = sorted(set(pairs))
            code = {x: i for i, x in enumerate(names)}
            codes = np.fromiter((code[x] for x in pairs), np.int64, len(pairs))
            c, total = np.asarray(flat.field("c")), np.asarray(flat.field("total"))
            for k in np.unique(width[width > 1]):
                starts = ends[:-1][width == k]
                step = max(1, PAIRS_AT_ONCE // int(k * k))
                for i in range(0, len(starts), step):
                    at = starts[i : i + step, None] + np.arange(k)
                    key, sums = both(codes[at], c[at], total[at], len(names))
                    a, b = key // len(names), key % len(names)
                    other = a != b
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[x][0] for x in a[other]], pa.string()), pa.array([names[x][1] for x in a[other]], pa.string())]
                        + [pa.array([names[x][1] for x in b[other]], pa.string()), pa.array(sums[other])],
                        ["lang", "a", "b", "value"],
                    )

    return vectors.mapInArrow(run, "lang string, a string, b string, value long")


def pair_report(held: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) of each source against the others."""
    size = groups.select("lang", "source", (F.col("n") + F.col("kept")).alias("total"))
    vectors = held.drop("total", "first").join(size, ["lang", "source"]).groupBy("lang", "term").agg(F.collect_list(F.struct("source", "c", "total")).alias("groups"))
    shared = pair_sums(vectors.where(F.size("groups") > 1)).groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("shared"))
    a = groups.select("lang", F.col("source").alias("a"), F.col("n").alias("n_a"), "kept")
    b = groups.select("lang", F.col("source").alias("b"), F.col("n").alias("n_b"))
    pairs = a.join(b, "lang").where(F.col("a") != F.col("b"))
    none = F.lit(0).cast("long")
    p0, q0 = share(none, F.col("n_a"), F.col("kept")), share(none, F.col("n_b"), F.col("kept"))
    histogram = cells.groupBy("lang", "source", "c").agg(F.sum("m").alias("m"))

    def one_sided(side: str) -> DataFrame:
        """Of each pair, the terms that ``side`` holds as if the other had none."""
        bars = histogram.withColumnRenamed("source", side).join(pairs, ["lang", side])
        p, q = (share(F.col("c"), F.col("n_a"), F.col("kept")), q0) if side == "a" else (p0, share(F.col("c"), F.col("n_b"), F.col("kept")))
        each = (excess(p, q) - excess(p0, q0)).cast("decimal(38,0)")
        return bars.groupBy("lang", "a", "b").agg(F.sum(F.col("m") * each).alias(f"only_{side}"))

    known = pairs
    for part in (shared, one_sided("a"), one_sided("b")):
        known = known.join(part, ["lang", "a", "b"], "left")
    absent = F.when(F.col("kept") > 0, excess(p0, q0).cast("decimal(38,0)") * F.col("kept")).otherwise(F.lit(0))
    parts = [F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)")) for c in ("shared", "only_a", "only_b")]
    value = (parts[0] + parts[1] + parts[2] + absent).cast("long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    named = known.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value"))
    return named.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): both reports."""
    held, terms_folder = written(held_terms(docs, min_docs), "terms")
    cells, cells_folder = written(count_cells(held), "cells")
    groups, groups_folder = written(group_table(docs, cells), "groups")
    columns = ("lang", "source", "part", "item", "value", "rank")
    terms = term_report(held, cells, groups, top).withColumn("part", F.lit("term")).select(*columns)
    pairs = pair_report(held, cells, groups).withColumn("part", F.lit("pair")).select(*columns)
    return settle(pairs.unionByName(terms), "divergence", terms_folder, cells_folder, groups_folder)
