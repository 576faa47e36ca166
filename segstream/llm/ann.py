"""Nearest neighbours by a hierarchical k-means tree, best bin first.

Fitting, on a bounded sample of the rows (``fit_rows``, chosen by hash): k-means
splits the sample into ``branch`` groups, each group again, until a leaf holds
``leaf_rows`` sampled rows. Then sample queries (``probe_rows``) walk the tree
with a priority queue, the node with the largest bound on the inner product
first (centre times query plus radius times the query's norm), and the number
of leaf visits widens until the wanted recall against brute force over the
sample is reached.

Indexing: every row goes to its leaf. Large leaves are split into blocks of
about ``block_rows`` rows by hash, so no group of equal or close vectors lands
in one task. Searching: each query visits its leaves, and each block of them
scores its queries in one matrix product. The best of all blocks are merged by
two aggregates. Scores are summed in double precision, row by row, so equal
vectors get equal scores whatever the block.

Only the sample, the tree and one count for each leaf reach the driver; all
three are bounded by parameters.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do vectors of another length than the most common
one (the smaller at a tie); rows that repeat an id are candidates of their own,
but not for a query with that id; ties go to the smaller id; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLACK = 1e-9  #: scores this close to the k-th are computed exactly


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the nearest centre of each row (squared distance)."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        for c in range(k):
            rows = x[near == c]
            centres[c] = rows.mean(axis=0) if len(rows) else x[rng.integers(len(x))]
    return centres, nearest(x, centres)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


class Tree:
    """``children[n]`` are node numbers, empty for leaves; ``leaf[n]`` numbers them."""

    def __init__(self, sample: np.ndarray, branch: int, leaf_rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centres, self.radii, self.children, self.leaf, self.leaves = [], [], [], [], 0
        self.grow(sample, branch, leaf_rows, rng)
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def grow(self, x: np.ndarray, branch: int, leaf_rows: int, rng: np.random.Generator) -> int:
        node, centre = len(self.centres), x.mean(axis=0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((x - centre) ** 2).sum(axis=1).mean())))
        self.children.append([])
        self.leaf.append(-1)
        groups: list[np.ndarray] = []
        if len(x) > leaf_rows:
            _, near = kmeans(x, min(branch, len(x)), rng)
            groups = [g for g in (x[near == c] for c in range(branch)) if len(g)]
        if len(groups) > 1:
            self.children[node] = [self.grow(g, branch, leaf_rows, rng) for g in groups]
        else:
            self.leaf[node] = self.leaves
            self.leaves += 1
        return node

    def locate(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre, level by level."""
        out, waiting = np.empty(len(x), np.int64), [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            near = nearest(x[rows], self.centres[below])
            waiting += [(child, part) for i, child in enumerate(below) if len(part := rows[near == i])]
        return out

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, the most promising first."""
        norm, queue = float(np.sqrt(query @ query)), [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf[node]
                continue
            for child, score in zip(below, self.centres[below] @ query):
                heapq.heappush(queue, (-float(score) - norm * self.radii[child], child))


def calibrate(tree: Tree, sample: np.ndarray, probes: np.ndarray, k: int, recall: float) -> float:
    """Share of the leaves to visit: widened until the probes (rows of the
    sample) find ``recall`` of their true neighbours in the sample."""
    at, ranks = tree.locate(sample), []
    for p in probes:
        scores = sample @ sample[p]
        scores[p] = -np.inf
        order = {leaf: i for i, leaf in enumerate(tree.visit(sample[p]))}
        ranks += [order[at[i]] for i in np.argsort(-scores, kind="stable")[:k]]
    if not ranks:
        return 1.0
    visits = int(np.quantile(ranks, recall, method="higher")) + 1
    return visits / tree.leaves


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    named = rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    found = named.where(finite & F.exists("v", lambda x: x != 0.0))
    # bounded: one row for each length there is
    length = found.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.where(F.size("v") == (length["n"] if length else 0))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def best(ids: np.ndarray, x: np.ndarray, query_id: int, q: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows for one query, by exact score, then id."""
    own = ids == query_id
    rough = np.where(own, -np.inf, rough)
    n = len(ids) - int(own.sum())
    if n == 0:
        return ids[:0], rough[:0]
    if n <= k:
        rows = np.flatnonzero(~own)
    else:
        kth = np.partition(rough, len(rough) - k)[len(rough) - k]
        rows = np.flatnonzero(rough >= kth - SLACK * max(1.0, np.abs(rough[~own]).max()))
    exact = (x[rows] * q).sum(axis=1)
    order = np.lexsort((ids[rows], -exact))[:k]
    return ids[rows][order], exact[order]


def score_block(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of one block for each of its queries."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(rows) and len(queries):
        ids, x = rows["id"].to_numpy(), np.stack(rows["v"].to_numpy())
        of, q = queries["query_id"].to_numpy(), np.stack(queries["q"].to_numpy())
        for at in range(0, len(of), 256):
            rough = q[at : at + 256] @ x.T
            for i, r in enumerate(rough, at):
                found, scores = best(ids, x, of[i], q[i], r, k)
                out.append((np.full(len(found), of[i]), found, scores))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


def search(
    rows: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", recall: float = 0.97,
    fit_rows: int = 20_000, probe_rows: int = 300, branch: int = 16, leaf_rows: int = 100, block_rows: int = 2048, visits: float | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``rows`` found for
    each of ``queries`` (same columns; an id that repeats is one query, its
    smallest vector). ``visits`` fixes the share of leaves instead of ``recall``."""
    spark = rows.sparkSession
    vectors = usable(rows, vec_id, vector)
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(fit_rows).collect()  # bounded by fit_rows
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r["v"] for r in picked])
    tree = Tree(sample, branch, leaf_rows)
    share = calibrate(tree, sample, np.arange(min(probe_rows, len(sample))), k, recall) if visits is None else visits
    n_visits = max(1, int(np.ceil(share * tree.leaves)))
    shared = spark.sparkContext.broadcast(tree)  # about fit_rows / leaf_rows centres

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaves = shared.value.locate(matrix(b["v"]))
                yield pa.RecordBatch.from_arrays([b["id"], b["v"], pa.array(leaves)], ["id", "v", "leaf"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, order = matrix(b["q"]), []
                for q in x:
                    visited = shared.value.visit(q)
                    order.append([leaf for _, leaf in zip(range(n_visits), visited)])
                yield pa.RecordBatch.from_arrays([b["query_id"], b["q"], pa.array(order, pa.list_(pa.int64()))], ["query_id", "q", "leaves"])

    placed = vectors.mapInArrow(place, "id long, v array<double>, leaf long")
    asked = usable(queries, vec_id, vector).groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("q"))
    asked = asked.where(F.size("q") == sample.shape[1])
    routed = asked.mapInArrow(route, "query_id long, q array<double>, leaves array<long>").select("query_id", "q", F.explode("leaves").alias("leaf"))
    # bounded: one count for each leaf
    rows_in = {r["leaf"]: -(-r["count"] // block_rows) for r in placed.groupBy("leaf").count().collect()}
    asks_in = {r["leaf"]: -(-r["count"] // block_rows) for r in routed.groupBy("leaf").count().collect()}
    parts = [(leaf, rows_in[leaf], asks_in[leaf]) for leaf in rows_in if leaf in asks_in]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cuts = F.broadcast(spark.createDataFrame(parts, "leaf long, blocks long, chunks long"))
    block, chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")), F.pmod(F.xxhash64("query_id", F.lit(2)), F.col("chunks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.join(cuts, "leaf").select("id", "v", "leaf", block.alias("block"), every("chunks").alias("chunk"))
    right = routed.join(cuts, "leaf").select("query_id", "q", "leaf", chunk.alias("chunk"), every("blocks").alias("block"))
    group = ["leaf", "block", "chunk"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
        lambda key, a, b: score_block(key, a, b, k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
