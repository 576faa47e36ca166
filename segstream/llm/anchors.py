"""Substring dedup by fixed-block anchors.

A run of ``window`` words that an earlier document (smaller doc_id) holds, too,
is removed wherever it stands later. Every such run covers one whole block of
the earlier document, if blocks are ``(window + 1) // 2`` words long and laid
end to end from its first word. So:

1. Anchors. Each document's blocks are the index, and every rolling window of a
   block's length is a probe. Hashes of both are dealt to *lanes* by their value;
   a lane tells each group of documents which of its hashes also stand in
   another group and are a block in one of them. (A lane compares 32-bit
   fingerprints; what they confuse, the next step tells apart.)
2. Extension. Around each anchor found, probe or block, the runs of ``window``
   words that contain it are hashed in full (96 bits) and dealt to lanes with the
   smallest doc_id of the group that holds them. A lane tells a group which runs
   another group holds under a smaller doc_id. Runs that follow each other join
   into maximal exact repeats.
3. Removal. Each group marks the words of its repeats, those that an earlier
   document of another group holds and those of one of its own.

Scale. Documents are dealt into groups of about ``GROUP_CHARS`` characters by a
hash and written once, bucketed by group, so that no later step shuffles texts.
A group sends each distinct hash once to a lane, packed with others in one
binary value: a passage or text that a third of all documents hold costs as
many entries as there are groups, never a pair of documents. The number of
groups and lanes grows with the text, so that each fits its task.

Defined results: a null text has no words; a document with fewer words than
``window`` loses nothing; a row without a doc_id neither loses words nor makes
others lose any; documents (or repeated rows) with one doc_id are not earlier
than each other; runs are judged on the input, so a run of repeats inside one
document stays; white space between words is not kept; very long texts are taken
whole; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import delete_shared, fresh_folder, settle

WINDOW = 50
GROUP_CHARS = 8 << 20
LANE_BYTES = 16 << 20
FOUR = np.uint64(0xFFFFFFFF)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # ASCII white space, as bytes know no other


def join_hashes(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """The hash of two neighbouring runs from theirs."""
    x = (a ^ (a >> np.uint64(31))) * MIX[seed] + b
    x = (x ^ (x >> np.uint64(29))) * MIX[1 - seed]
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``width`` hashes, by doubling; entry i is the run at i."""
    out, size, power, have = None, 0, h, 1
    while True:
        if width & have:
            out = power if out is None else join_hashes(out[: max(0, len(power) - size)], power[size:], seed)
            size += have
        have *= 2
        if have > width:
            return out[: max(0, len(h) - width + 1)]
        power = join_hashes(power[: -(have // 2)], power[have // 2 :], seed) if len(power) > have // 2 else power[:0]


class Group:
    """The documents of a group as one row of word hashes.

    ``ids`` and ``sizes`` are those of documents that can take part: a doc_id
    and at least ``window`` words. ``start`` is where each begins."""

    def __init__(self, ids: list, texts: list, window: int):
        self.window, self.block = window, (window + 1) // 2
        hashes, self.ids, self.members, sizes = [], [], [], []
        for i, (doc_id, text) in enumerate(zip(ids, texts)):
            words = words_of(text) if doc_id is not None else ()
            if len(words) >= window:
                hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
                self.ids.append(doc_id)
                self.members.append(i)
                sizes.append(len(words))
        self.ids, self.sizes = np.array(self.ids, np.int64), np.array(sizes, np.int64)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.at = np.arange(len(self.hashes)) - self.start[self.doc]

    def runs(self, width: int, seed: int = 0) -> np.ndarray:
        """Hashes of runs of ``width`` words at every place; see ``whole``."""
        out = np.zeros(len(self.hashes), np.uint64)
        found = rolling(self.hashes, width, seed) if len(self.hashes) else out
        out[: len(found)] = found
        return out

    def whole(self, width: int) -> np.ndarray:
        """Places where a run of ``width`` words ends within its document."""
        return self.at + width <= self.sizes[self.doc]

    def window_keys(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(self.window), self.runs(self.window, 1) & FOUR

    def anchors(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """Lane and fingerprint, in one number, of the run at each place."""
        h = self.runs(self.block)
        return ((h >> np.uint64(32)) % np.uint64(lanes)) << np.uint64(32) | (h & FOUR), self.whole(self.block)


def lane_slices(lane: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of a sorted array."""
    if len(lane):
        cuts = np.flatnonzero(np.diff(lane)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(lane)]):
            yield int(lane[a]), slice(int(a), int(b))


def packed(rows: list[tuple], names: str) -> pa.Table:
    """Rows of two numbers and any number of arrays as a table with binary columns."""
    columns = list(zip(*rows)) or [()] * len(names.split())
    arrays = [pa.array(c, pa.int64()) for c in columns[:2]] + [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[2:]]
    return pa.table(arrays, names.split())


def unpacked(table: pa.Table, name: str, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in table[name].to_pylist()]


def texts_of(table: pa.Table) -> tuple[list, list]:
    return table["doc_id"].to_pylist(), table["text"].to_pylist()


# ---------------------------------------------------------------- step 1


def probes(docs: DataFrame, window: int, lanes: int) -> DataFrame:
    """(lane, grp, prints, blocks): each distinct fingerprint of the group's
    runs, sorted, and a bit for those that are a block."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = Group(*texts_of(table), window)
        prints, whole = group.anchors(lanes)
        laid = (group.at % group.block == 0).astype(np.uint64)
        marked = np.unique((prints << np.uint64(1) | laid)[whole])
        last = np.r_[marked[1:] >> np.uint64(1) != marked[:-1] >> np.uint64(1), True][: len(marked)]
        marked = marked[last]  # of a run that is a block and is none, the one that says it is
        out = []
        for lane, at in lane_slices(marked >> np.uint64(33)):
            values = marked[at]
            out.append((lane, key[0].as_py(), (values >> np.uint64(1)).astype("<u4"), np.packbits((values & np.uint64(1)).astype(np.uint8))))
        return packed(out, "lane grp prints blocks")

    return docs.groupBy("grp").applyInArrow(run, "lane long, grp long, prints binary, blocks binary")


def shared_anchors(dealt: DataFrame) -> DataFrame:
    """(lane, grp, prints): fingerprints of a group that another one holds, too,
    and that are a block in one of them."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        groups, prints = table["grp"].to_pylist(), unpacked(table, "prints", "<u4")
        bits = [np.unpackbits(b)[: len(p)] for b, p in zip(unpacked(table, "blocks", "u1"), prints)]
        who = np.repeat(np.arange(len(groups), dtype=np.uint64), [len(p) for p in prints])
        v = np.concatenate(prints).astype(np.uint64) << np.uint64(32) | who << np.uint64(1) | np.concatenate(bits).astype(np.uint64)
        v.sort()
        value = v >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        count = np.diff(np.r_[first, len(v)])
        laid = np.add.reduceat((v & np.uint64(1)).astype(np.int64), first) > 0
        keep = np.repeat((count > 1) & laid, count)
        v = v[keep]
        who, value = (v & FOUR) >> np.uint64(1), (v >> np.uint64(32)).astype("<u4")
        order = np.argsort(who, kind="stable")
        who, value = who[order], value[order]
        lane = key[0].as_py()
        return packed([(lane, groups[g], value[at]) for g, at in lane_slices(who)], "lane grp prints")

    return dealt.groupBy("lane").applyInArrow(run, "lane long, grp long, prints binary")


# ---------------------------------------------------------------- step 2


def around(group: Group, hit: np.ndarray) -> np.ndarray:
    """Places of the runs of ``window`` words that hold a run of ``block`` words at a hit."""
    at = np.flatnonzero(hit)
    doc = group.doc[at]
    reach = group.window - group.block
    lo = np.maximum(at - reach, group.start[doc])
    hi = np.minimum(at, group.start[doc] + group.sizes[doc] - group.window)
    change = np.zeros(len(group.hashes) + 1, np.int64)
    np.add.at(change, lo, 1)
    np.add.at(change, hi + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def smallest_ids(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (a, b), sorted, and the smallest id of each."""
    order = np.lexsort((ids, b, a))
    a, b, ids = a[order], b[order], ids[order]
    first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    return a[first], b[first], ids[first]


def candidate_runs(docs: DataFrame, anchors: DataFrame, window: int, lanes: int, run_lanes: int) -> DataFrame:
    """(lane, grp, a, b, ids): the runs around a group's anchors, by 64 and 32
    bits, each with the smallest doc_id of the group that holds it."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = unpacked(right, "prints", "<u4")
        if not found or not left.num_rows:
            return packed([], "lane grp a b ids")
        group = Group(*texts_of(left), window)
        prints, whole = group.anchors(lanes)
        lane = np.repeat(np.array(right["lane"].to_pylist(), np.uint64), [len(f) for f in found])
        wanted = np.sort(lane << np.uint64(32) | np.concatenate(found).astype(np.uint64))
        at = around(group, whole & (wanted[np.minimum(np.searchsorted(wanted, prints), len(wanted) - 1)] == prints))
        a, b = (x[at] for x in group.window_keys())
        a, b, ids = smallest_ids(a, b, group.ids[group.doc[at]])
        dealt = a % np.uint64(run_lanes)
        order = np.argsort(dealt, kind="stable")
        a, b, ids = a[order], b[order].astype("<u4"), ids[order]
        return packed([(n, key[0].as_py(), a[s], b[s], ids[s]) for n, s in lane_slices(dealt[order])], "lane grp a b ids")

    return docs.groupBy("grp").cogroup(anchors.groupBy("grp")).applyInArrow(run, "lane long, grp long, a binary, b binary, ids binary")


def later_runs(dealt: DataFrame) -> DataFrame:
    """(grp, a, b): runs that another group holds under a smaller doc_id."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        groups, a = table["grp"].to_pylist(), unpacked(table, "a", "<u8")
        who = np.repeat(np.arange(len(groups)), [len(x) for x in a])
        a, b, ids = np.concatenate(a), np.concatenate(unpacked(table, "b", "<u4")), np.concatenate(unpacked(table, "ids", "<i8"))
        order = np.lexsort((ids, b, a))
        a, b, ids, who = a[order], b[order], ids[order], who[order]
        first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        least = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
        later = np.flatnonzero(ids > least)
        later = later[np.argsort(who[later], kind="stable")]
        a, b, who = a[later], b[later], who[later]
        lane = key[0].as_py()
        return packed([(lane, groups[g], a[s], b[s]) for g, s in lane_slices(who)], "lane grp a b")

    return dealt.groupBy("lane").applyInArrow(run, "lane long, grp long, a binary, b binary")


# ---------------------------------------------------------------- step 3


def covered(group: Group, runs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each word of the group, whether a repeated run covers it."""
    a, b = group.window_keys()
    at = np.flatnonzero(group.whole(group.window))
    a, b, ids = a[at], b[at], group.ids[group.doc[at]]
    order = np.lexsort((b, a))
    sa, sb = a[order], b[order]
    first = np.r_[True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])][: len(sa)]
    number = np.cumsum(first) - 1
    places = np.flatnonzero(first)
    least = np.minimum.reduceat(ids[order], places) if len(places) else ids
    later = ids[order] > least[number]
    if runs:
        la, lb = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
        o = np.lexsort((lb, la))
        la, lb = la[o], lb[o].astype(np.uint64)
        # places of equal ``a`` among the later runs; the few that share one are walked through
        lo = np.searchsorted(la, sa, "left")
        left = np.searchsorted(la, sa, "right") - lo
        step = 0
        while (left > step).any():
            some = np.flatnonzero(left > step)
            later[some] |= lb[lo[some] + step] == sb[some]
            step += 1
    begin = at[order[later]]
    change = np.zeros(len(group.hashes) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + group.window, -1)
    return np.cumsum(change[:-1]) > 0


def spans_of(gone: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


def cleaned(docs: DataFrame, later: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, spans, kept_text) of each document."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = texts_of(left)
        group = Group(ids, texts, window)
        gone = covered(group, list(zip(unpacked(right, "a", "<u8"), unpacked(right, "b", "<u4"))))
        of = dict(zip(group.members, range(len(group.members))))
        counts, found, kept = [], [], []
        for i, text in enumerate(texts):
            words = words_of(text)
            counts.append(len(words))
            lost = gone[group.start[of[i]] : group.start[of[i]] + len(words)] if i in of else None
            if lost is not None and lost.any():
                found.append(spans_of(lost))
                words = [w for w, x in zip(words, lost.tolist()) if not x]
            else:
                found.append([])
            kept.append(b" ".join(words))
        return pa.table([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(found, spans), pa.array(kept, pa.binary())], ["doc_id", "n_words", "spans", "kept_text"])

    schema = "doc_id long, n_words long, spans array<struct<start: long, length: long>>, kept_text binary"
    return docs.groupBy("grp").cogroup(later.groupBy("grp")).applyInArrow(run, schema)


# ----------------------------------------------------------------- driver


def dealt_out(docs: DataFrame) -> tuple[DataFrame, str, str, int, int]:
    """The documents with their group, in a table bucketed by it: (rows, its
    name, its folder, buckets, characters). Equal rows are told apart by the
    partition they come from, so that no group holds all of them."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    groups = max(1, math.ceil(chars / GROUP_CHARS))
    buckets = max(1, math.ceil(groups / 2))
    grp = F.pmod(F.xxhash64(F.col("doc_id"), text, F.spark_partition_id()), F.lit(groups))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), grp.alias("grp"))
    folder, name = fresh_folder(spark, "anchored"), f"anchored_{uuid.uuid4().hex}"
    rows.repartition(buckets, "grp").write.bucketBy(buckets, "grp").option("path", folder).option("compression", "zstd").saveAsTable(name)
    return spark.table(name), name, folder, buckets, int(chars)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, kept_text) of each row of ``docs``: the maximal
    spans of words that earlier documents hold, too, and the words that stay,
    joined by blanks (binary UTF-8)."""
    return _repeats(docs, window)[0]


def _repeats(docs: DataFrame, window: int) -> tuple[DataFrame, str, str]:
    rows, name, folder, buckets, chars = dealt_out(docs)
    lanes = max(buckets, math.ceil(chars / 6 * 4 / LANE_BYTES))  # about six characters a word, four bytes an entry
    anchors = shared_anchors(probes(rows, window, lanes)).repartition(buckets, "grp")
    later = later_runs(candidate_runs(rows, anchors, window, lanes, 4 * lanes)).repartition(buckets, "grp")
    return cleaned(rows, later, window), name, folder


def repeat_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row of ``docs``."""
    found, name, folder = _repeats(docs, window)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    digests = found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))
    out = settle(digests, "repeats")
    docs.sparkSession.sql(f"DROP TABLE {name}")
    delete_shared(docs.sparkSession, folder)
    return out
