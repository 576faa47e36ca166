"""MinHash near-duplicates with sequential Bayesian verification.

1. Each document becomes the set of its k-word shingles (64-bit hashes). Equal
   sets are one class; a class goes on alone, however many copies it has.
2. Classes that share a band of their MinHash signatures are candidates. Bands
   are so many that a pair at the threshold escapes with probability ``miss``.
3. Two rounds meet candidates star by star: a bucket's members are compared
   with one pivot. The first looks at the buckets of two bands alone, which joins
   most large groups before the other bands are looked at. Members that became
   connected need no further comparison.
4. What is left in buckets with more than one component is compared in blocks of
   at most about BLOCK members: a task holds two blocks and compares them, so a
   candidate pair is no row, and each member travels once a pair of blocks. A
   bucket's largest component meets only the bucket's other members. A pair is
   compared in the first band that it shares; no candidate pair is lost.
5. A comparison reads signatures in batches. In the star rounds the first batch,
   one bit of each value, and the set sizes are compared where members and pivots
   are joined. Then whole values follow: with a uniform prior and m of n equal,
   the similarity is Beta(m + 1, n - m + 1); a pair goes when the posterior
   probability of reaching the threshold falls under ``miss``.
6. Survivors are verified on their full shingle sets; only those are links.
   Components of links come from ``components``, round by round on components
   already found.

Nothing but counts reaches the driver. Defined results: a null or empty text,
or one without words, has no shingles and is linked with nothing; a text
shorter than k words is one shingle; repeated rows are copies; rows without a
doc_id are compared like others and get the smallest doc_id of their component,
or null; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import cut_lineage, delete_shared, fresh_folder, written
from segstream.llm.components import kept_components

ROWS = 5  #: signature values in a band
STEP = 20  #: signature values compared at a time
BITS = 60  #: one-bit values in a long
FIRST_BANDS = 2  #: bands of the first round
BLOCK = 2048  #: members of a bucket in a block
BLOCK_SHINGLES = 1 << 21  #: shingles of a block's members
MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, miss: float, rows: int = ROWS) -> int:
    """Bands by which a pair at the threshold is missed with at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    n = len(h) - width + 1
    s = h[:n].copy()
    for i in range(1, width):
        s = (s ^ (s >> np.uint64(29))) * MIX + h[i : i + n]
    s = (s ^ (s >> np.uint64(32))) * MIX
    return np.unique(s)


def hash_family(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    a = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, size, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = family
    least = None
    for i in range(0, len(shingles), 2048):
        x = shingles[None, i : i + 2048]
        m = (a * (x ^ (x >> np.uint64(31))) + b).min(axis=1)
        least = m if least is None else np.minimum(least, m)
    return (least >> np.uint64(32)).astype("<u4")


def class_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def fewest_matches(n: int, threshold: float, miss: float) -> int:
    """The least m of n equal values that keeps a pair: P(S >= t | m, n) is the
    probability of at most m successes in n + 1 draws with probability t."""
    p, m = 0.0, 0
    while True:
        p += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if p >= miss:
            return m
        m += 1


def most_unequal_bits(n: int, threshold: float, miss: float) -> int:
    """The most of n one-bit values that may differ: a pair at the threshold
    differs in more with a probability under ``miss``."""
    differ = (1 - threshold) / 2
    m, above = 0, 1 - (1 - differ) ** n
    while above >= miss:
        m += 1
        above -= math.comb(n, m) * differ**m * (1 - differ) ** (n - m)
    return m


def bits(sig: np.ndarray) -> tuple[int, int]:
    """The lowest bits of the first values, BITS in each of two numbers."""
    low = (sig[: 2 * BITS] & np.uint32(1)).astype(np.uint8)
    halves = [np.packbits(low[at : at + BITS], bitorder="little").tobytes() for at in (0, BITS)]
    return int.from_bytes(halves[0], "little"), int.from_bytes(halves[1], "little")


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Indices of the pairs (rows of two signature matrices) that stay."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i in range(0, a.shape[1], STEP):
        equal[alive] += (a[alive, i : i + STEP] == b[alive, i : i + STEP]).sum(axis=1)
        alive = alive[equal[alive] >= fewest_matches(min(i + STEP, a.shape[1]), threshold, miss)]
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def describe(docs: DataFrame, k: int, hashes: int) -> DataFrame:
    """(doc_id, row, key, n_shingles, sig, b0, b1) of each row; key, sig and its
    bits are null where there is no shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(hashes)
        for batch in batches:
            keys, sizes, sigs, low = [], [], [], []
            for text in batch["text"]:
                s = shingle_set(text.as_py(), k)
                sizes.append(len(s))
                keys.append(class_key(s) if len(s) else None)
                sig = signature(s, family) if len(s) else None
                sigs.append(None if sig is None else sig.tobytes())
                low.append((None, None) if sig is None else bits(sig))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]
                + [pa.array([x[i] for x in low], pa.int64()) for i in (0, 1)],
                ["doc_id", "row", "key", "n_shingles", "sig", "b0", "b1"],
            )

    return with_row(docs).mapInArrow(run, "doc_id long, row long, key binary, n_shingles long, sig binary, b0 long, b1 long")


SIDE = ("key", "n_shingles", "b0", "b1")


def with_row(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"), text.alias("text"))


def bucket_members(classes: DataFrame, bands: int) -> DataFrame:
    """(bucket, band, key, n_shingles, b0, b1) of the buckets with more than one
    class."""
    width = 4 * ROWS
    hashed = F.array(*[F.xxhash64(F.substring("sig", i * width + 1, width), F.lit(i)) for i in range(bands)])
    rows = classes.select(*SIDE, F.posexplode(hashed).alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where(F.col("lo") != F.col("hi")).select("bucket")
    return rows.join(shared, "bucket")


def prune(pairs: DataFrame, chosen: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) that the signatures don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sides = [np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in ("sa", "sb")]
                yield batch.select(["a", "b"]).take(pa.array(survivors(*sides, threshold, miss)))

    sig_a, sig_b = (chosen.select(F.col("key").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab")
    return pairs.join(sig_a, "a").join(sig_b, "b").mapInArrow(run, "a binary, b binary")


def candidates(members: DataFrame, classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, str]:
    """(key, sig, text) of the classes in shared buckets, written once: the only
    time that texts of all documents may be shuffled. And their folder."""
    wanted = classes.join(members.select("key").distinct(), "key").select("key", "sig", F.col("doc_id").alias("c_id"), F.col("row").alias("c_row"))
    rows = with_row(docs)
    found = rows.join(wanted, (rows["row"] == F.col("c_row")) & rows["doc_id"].eqNullSafe(F.col("c_id"))).dropDuplicates(["key"])
    return written(found.select("key", "sig", "text"), "candidates")


def verify(pairs: DataFrame, chosen: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold. Each side keeps
    its last set, for runs of equals."""
    text_a, text_b = (chosen.select(F.col("key").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple] = {"a": (None, None), "b": (None, None)}
        for batch in batches:
            stay = []
            for i in range(batch.num_rows):
                for x in "ab":
                    key = batch[x][i].as_py()
                    if last[x][0] != key:
                        last[x] = (key, shingle_set(batch[f"t{x}"][i].as_py(), k))
                if linked(last["a"][1], last["b"][1], percent):
                    stay.append(i)
            yield batch.select(["a", "b"]).take(pa.array(stay, pa.int64()))

    return pairs.join(text_a, "a").join(text_b, "b").mapInArrow(run, "a binary, b binary")


def star_pairs(members: DataFrame, percent: int, bits_apart: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of each bucket's pivot with members of other components,
    unless sizes or bits rule them out, and the pivots (bucket, key)."""
    pivots = members.groupBy("bucket").agg(F.min(F.struct(*SIDE, "root")).alias("p"))
    pivots = pivots.select("bucket", F.col("p.key").alias("pivot"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in (*SIDE[1:], "root")])
    apart = F.bit_count(F.col("b0").bitwiseXOR(F.col("p_b0"))) + F.bit_count(F.col("b1").bitwiseXOR(F.col("p_b1")))
    close = 100 * F.least("n_shingles", "p_n_shingles") >= percent * F.greatest("n_shingles", "p_n_shingles")
    on = (members["bucket"] == pivots["bucket"]) & (F.col("root") != F.col("p_root")) & close & (apart <= bits_apart)
    met = members.join(pivots, on)
    pairs = met.select(F.greatest("key", "pivot").alias("a"), F.least("key", "pivot").alias("b")).distinct()
    return pairs, pivots.select("bucket", F.col("pivot").alias("key"))


GROUP = ("bucket", "lo", "hi")


def in_blocks(members: DataFrame) -> DataFrame:
    """(bucket, lo, hi, slot, band, key, n_shingles, root): the members of mixed
    buckets, once for each pair of blocks that they take part in. Blocks of a
    bucket's largest component have slots under 0 and meet only the others."""
    size = [F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w")]
    top = members.groupBy("bucket", "root").agg(*size).groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "w", "root")).alias("top")
    )

    def blocks(n, w):
        return F.ceil(F.greatest(n / F.lit(BLOCK), w / F.lit(BLOCK_SHINGLES)))

    mixed = top.where(F.col("n") > F.col("top.n")).select(
        "bucket",
        F.col("top.root").alias("t_root"),
        blocks(F.col("top.n"), F.col("top.w")).alias("n_top"),
        blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("n_rest"),
    )
    spread = F.xxhash64("key", F.lit(7))
    slot = F.when(F.col("root") == F.col("t_root"), -1 - F.pmod(spread, F.col("n_top"))).otherwise(F.pmod(spread, F.col("n_rest")))
    least = F.when(F.col("slot") < 0, F.lit(0)).otherwise(-F.col("n_top")).cast("long")
    return (
        members.join(mixed, "bucket")
        .withColumn("slot", slot.cast("long"))
        .withColumn("other", F.explode(F.sequence(least, F.col("n_rest").cast("long") - 1)))
        .select("bucket", F.least("slot", "other").alias("lo"), F.greatest("slot", "other").alias("hi"), "slot", "band", "key", "n_shingles", "root")
    )


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (bucket, lo, hi), from batches in that order."""
    held, name = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in GROUP])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            new = tuple(ids[:, at])
            if held and new != name:
                yield pa.Table.from_batches(held)
                held = []
            name = new
            held.append(batch.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(group: pa.Table, threshold: float, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, y) of a pair of blocks that signatures don't rule out: of other
    components, of like sizes, in the first band that they share."""
    n = group.num_rows
    sigs = np.frombuffer(b"".join(group["sig"].to_pylist()), "<u4").reshape(n, -1)
    sizes, slots = group["n_shingles"].to_numpy(), group["slot"].to_numpy()
    roots = np.unique(np.array(group["root"].to_pylist(), object), return_inverse=True)[1]
    earlier = sigs[:, : int(group["band"][0].as_py()) * ROWS].reshape(n, -1, ROWS)
    one_block = group["lo"][0].as_py() == group["hi"][0].as_py()
    xs, ys = [], []
    for x in range(n - 1):
        y = np.arange(x + 1, n)
        keep = (roots[y] != roots[x]) & (100 * np.minimum(sizes[y], sizes[x]) >= percent * np.maximum(sizes[y], sizes[x]))
        y = y[keep if one_block else keep & (slots[y] != slots[x])]
        if len(y):
            y = y[~(earlier[y] == earlier[x]).all(axis=2).any(axis=1)]
        if len(y):
            y = y[survivors(np.broadcast_to(sigs[x], (len(y), sigs.shape[1])), sigs[y], threshold, miss)]
            xs.append(np.full(len(y), x))
            ys.append(y)
    none = np.empty(0, np.int64)
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (none, none)


def prune_blocks(grouped: DataFrame, chosen: DataFrame, percent: int, miss: float) -> DataFrame:
    """(bucket, lo, hi, a, bs): the members b that the signatures don't rule out
    as links of a; a member that is only a b has a row of its own, bs null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            x, y = block_pairs(group, percent / 100, percent, miss)
            if len(x):
                starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
                firsts = pa.array(x[starts])
                bs = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(x)], pa.int32()), group["key"].take(pa.array(y)).combine_chunks())
                rest = pa.array(np.setdiff1d(y, x))
                for at, lists in ((firsts, bs), (rest, pa.nulls(len(rest), bs.type))):
                    cols = [group[c].take(at) for c in (*GROUP, "key")]
                    yield from pa.table([*cols, lists], [*GROUP, "a", "bs"]).to_batches(64)

    rows = grouped.join(chosen.select("key", "sig"), "key").repartition(*GROUP).sortWithinPartitions(*GROUP)
    return rows.mapInArrow(run, "bucket long, lo long, hi long, a binary, bs array<binary>")


def verify_blocks(pairs: DataFrame, roots: DataFrame, chosen: DataFrame, k: int, percent: int) -> DataFrame:
    """Linked components (a, b) of the pairs of ``prune_blocks``. A text travels
    once to each pair of blocks where it has a pair; components that the same
    blocks already link are not compared again."""
    texts = pairs.select(*GROUP, F.col("a").alias("key")).join(chosen.select("key", "text"), "key").join(roots, "key").withColumnRenamed("key", "a")
    rows = texts.withColumn("bs", F.lit(None).cast("array<binary>")).unionByName(pairs.where("bs IS NOT NULL"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            sets, root, above, found = {}, {}, {}, []

            def top(key):
                r = root[key]
                while r in above:
                    r = above[r]
                return r

            for batch in group.to_batches(64):
                for a, bs, r, text in zip(*(batch[c].to_pylist() for c in ("a", "bs", "root", "text"))):
                    if bs is None:
                        sets[a], root[a] = shingle_set(text, k), r
                        continue
                    for b in bs:
                        ends = top(a), top(b)
                        if ends[0] != ends[1] and linked(sets[a], sets[b], percent):
                            above[ends[0]] = ends[1]
                            found.append(ends)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], ["a", "b"])

    order = rows.repartition(*GROUP).sortWithinPartitions(*GROUP, F.col("bs").isNotNull())
    return order.mapInArrow(run, "a binary, b binary")


def joined(roots: DataFrame, links: DataFrame) -> tuple[DataFrame, str]:
    """``roots`` (key, root) after linking the components (a, b), and their folder."""
    moved, folder = kept_components(links)
    after = roots.join(moved, roots["root"] == moved["node"], "left").select("key", F.coalesce(moved["root"], roots["root"]).alias("root"))
    out = written(after, "roots")
    delete_shared(roots.sparkSession, folder)
    return out


def unfinished(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` of the buckets that hold more than one component, with their roots."""
    rest = members.drop("root").join(roots, "key")
    mixed = rest.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where(F.col("lo") != F.col("hi")).select("bucket")
    return cut_lineage(rest.join(mixed, "bucket"))


def link_classes(docs: DataFrame, classes: DataFrame, k: int, percent: int, bands: int, miss: float) -> DataFrame | None:
    """(key, root) of classes in shared buckets; None if there are none."""
    bits_apart = most_unequal_bits(min(2 * BITS, bands * ROWS), percent / 100, miss)
    members = cut_lineage(bucket_members(classes, bands).withColumn("root", F.col("key")))
    if members.isEmpty():
        return None
    chosen, *scratch = candidates(members, classes, docs)
    roots = chosen.select("key", F.col("key").alias("root"))
    for early in (True, False):
        pairs, pivots = star_pairs(members.where(F.col("band") < FIRST_BANDS) if early else members, percent, bits_apart)
        links = verify(prune(pairs, chosen, percent / 100, miss), chosen, k, percent)
        ends = links.join(roots.select(F.col("key").alias("a"), F.col("root").alias("ra")), "a").join(
            roots.select(F.col("key").alias("b"), F.col("root").alias("rb")), "b"
        )
        roots, folder = joined(roots, ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        scratch.append(folder)
        # whoever was a pivot has met its whole bucket
        members = unfinished(members.join(pivots, ["bucket", "key"], "left_anti"), roots)
    pairs, folder = written(prune_blocks(in_blocks(members), chosen, percent, miss), "pairs")
    roots, _ = joined(roots, verify_blocks(pairs, roots, chosen, k, percent))
    for uri in (*scratch, folder):
        delete_shared(docs.sparkSession, uri)
    return roots


def with_components(docs: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """(doc_id, row, n_shingles, root, component_id) of each row of ``docs``;
    ``root`` names the component and is null where there is no shingle."""
    bands = bands_for(percent / 100, miss)
    base, _ = written(describe(docs, k, bands * ROWS), "shingles")
    classes = cut_lineage(base.where("key IS NOT NULL").dropDuplicates(["key"]).select(*SIDE, "doc_id", "row", "sig"))
    roots = link_classes(docs, classes, k, percent, bands, miss)
    first = base.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    if roots is None:
        of_class = first.select("key", F.col("key").alias("root"), F.col("first").alias("component_id"))
    else:
        rooted = first.join(roots, "key", "left").select("key", "first", F.coalesce("root", "key").alias("root"))
        least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        of_class = rooted.join(least, "root").select("key", "root", "component_id")
    out = base.select("doc_id", "row", "key", "n_shingles").join(of_class, "key", "left")
    found = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "row", "n_shingles", "root", found.alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = 1e-5) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) of each row of ``docs``."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return with_components(docs, k, percent, miss).drop("root").withColumn("kept", kept)


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = 1e-5) -> DataFrame:
    """``docs`` with one row of each component; same columns. It is one with the
    component's smallest doc_id, which another component may have, too. A row
    without a doc_id stays only if its whole component has none; rows without
    a shingle stay, equal ones once."""
    found = with_components(docs, k, percent, miss).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ends = F.struct(F.col("doc_id").alias("id"), "row")
    of_root = found.where("root IS NOT NULL").groupBy("root").agg(F.min(ends).alias("c")).select("c.id", "c.row")
    bare = found.where("root IS NULL").select(F.col("doc_id").alias("id"), "row").distinct()
    chosen = of_root.unionByName(bare).toDF("__llm_id", "__llm_k_row")
    keyed = docs.withColumn("__llm_row", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    same = (F.col("__llm_row") == F.col("__llm_k_row")) & F.col("doc_id").eqNullSafe(F.col("__llm_id"))
    return keyed.join(chosen, same).dropDuplicates(["doc_id", "__llm_row"]).select(*docs.columns)
