"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is grown on a bounded sample; every vector goes to one leaf.  A query takes the tree's
nodes from a priority queue, nearest centre first, and so visits leaves best bin first.  How many
it visits is widened until calibration queries, searched against all vectors, find enough of
their true neighbours; a query whose leaves hold too few ids goes on until they hold enough.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from datamove.llm.arrow import quoted, ship_code

# Vectors and bytes of the sample that the tree is grown on.
SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20

BRANCHES = 8
LEAF_SAMPLE = 40

# Queries that are searched exhaustively to set the number of visits, and the recall to reach.
CALIBRATION = 128
RECALL = 0.96

# Vectors, and queries, of a bin of leaves that meet in one task; more of either are split.
CELL = 20_000

# Nearest of a cell that are measured exactly, beyond those asked for.
SLACK = 6


@dataclass
class Tree:
    """Centres of all nodes; the children of each, none for a leaf; each leaf's number, else -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, level by level."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            nearest = squared(x[rows], self.centres[below]).argmin(1)
            todo += [(child, part) for k, child in enumerate(below) if len(part := rows[nearest == k])]
        return out

    def visits(self, query: np.ndarray, most: int, ids: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first, and more until these hold ``enough`` of the ``ids`` of each leaf."""
        far = squared(query[None], self.centres)[0]
        queue, found, have = [(0.0, 0)], [], 0
        while queue and (len(found) < most or have < enough):
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (float(far[child]), child))
            else:
                found.append(int(self.leaf[node]))
                have += 0 if ids is None else int(ids[found[-1]])
        return found


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T))


def _split(x: np.ndarray, branches: int, rng: np.random.Generator) -> np.ndarray:
    """k-means: the cluster of each vector."""
    centres = x[rng.choice(len(x), min(branches, len(x)), replace=False)]
    for _ in range(10):
        of = squared(x, centres).argmin(1)
        centres = np.stack([x[of == k].mean(0) if (of == k).any() else centres[k] for k in range(len(centres))])
    return squared(x, centres).argmin(1)


def grow(x: np.ndarray, *, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE, seed: int = 3) -> Tree:
    rng = np.random.default_rng(seed)
    centres, children, leaf, leaves = [x.mean(0)], [[]], [-1], 0
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        of = _split(x[rows], branches, rng) if len(rows) > leaf_sample else np.zeros(len(rows), int)
        if of.min() == of.max():  # few, or all alike
            leaf[node] = leaves
            leaves += 1
            continue
        for k in np.unique(of):
            part = rows[of == k]
            children[node].append(len(centres))
            todo.append((len(centres), part))
            centres.append(x[part].mean(0))
            children.append([])
            leaf.append(-1)
    return Tree(np.array(centres), children, np.array(leaf, np.int32))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, asked: Callable[[int], np.ndarray] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the rows of its ``k`` nearest ids and their distances, ties by id.

    ``asked`` tells which rows a query asks about, all without it.
    """
    # Rows that repeat an id do not take the place of others.
    wide = min(len(ids), k + 1 + SLACK + len(ids) - len(np.unique(ids)))
    longest = (vectors * vectors).sum(1).max(initial=0.0)
    for begin in range(0, len(queries), 128):
        part = queries[begin : begin + 128]
        rough = squared(part, vectors)
        if asked is not None:
            for i in range(len(part)):
                rough[i, ~asked(begin + i)] = np.inf
        if wide < len(ids):
            cut = np.partition(rough, wide - 1, axis=1)[:, wide - 1 : wide]
            # What rounding may hide in the expanded square is measured too.
            slack = 1e-12 * (longest + (part * part).sum(1))
            candidates = [np.flatnonzero((row <= edge) & (row < np.inf)) for row, edge in zip(rough, cut[:, 0] + slack)]
        else:
            candidates = [np.flatnonzero(row < np.inf) for row in rough]
        for i, at in enumerate(candidates):
            at = at[ids[at] != query_ids[begin + i]]
            far = np.sqrt(((vectors[at] - part[i]) ** 2).sum(1))
            order = np.lexsort((ids[at], far))
            if wide > k + 1 + SLACK:
                order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])]
            order = order[:k]
            yield begin + i, at[order], far[order]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _up_to(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    recall: float = RECALL,
    sample: int = SAMPLE,
    cell: int = CELL,
    calibration: int = CALIBRATION,
) -> DataFrame:
    """The ``k`` nearest of all other vectors for each row where ``is_query`` holds.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance in
    double precision; ties go to the smaller id, and a query gets fewer only where the table has
    no more candidates.

    Vectors that are null, empty, zero, or hold a null, a NaN or an infinity take no part, nor do
    rows without an id or of another length than the most frequent one.  A repeated id counts once,
    with its nearest row, and is never its own neighbour.  Without usable vectors the result is
    empty.  The tree is grown on the ``sample`` vectors with the smallest hashes, every vector is
    indexed, and leaves that hold many rows or queries are dealt over tasks.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    usable = vectors.select(quoted(key).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    usable = usable.where(F.col("id").isNotNull() & _usable(F.col("v")))
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return empty
    width = width["n"]
    usable = usable.where(F.size("v") == width)
    chance = F.xxhash64("id")
    grown_on = usable.orderBy(chance, "id").limit(min(sample, max(1, SAMPLE_BYTES // (8 * width)))).select("v").toArrow()
    tree = spark.sparkContext.broadcast(grow(matrix(grown_on.column("v"), width)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.assign(matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], names=["id", "v", "leaf"])

    indexed = usable.select("id", "v").mapInArrow(index, "id bigint, v array<double>, leaf int")
    asking = usable.where("q").select("id", "v")

    # Calibration queries against all vectors: each task keeps their nearest.
    trial = asking.orderBy(chance, "id").limit(calibration).toArrow()
    if not len(trial):
        return empty
    trial_ids, trial_vectors = trial.column("id").to_numpy(), matrix(trial.column("v"), width)

    def exhaust(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x, leaf = batch.column(0).to_numpy(), matrix(batch.column(1), width), batch.column(2).to_numpy()
            for q, at, far in nearest(x, ids, trial_vectors, trial_ids, k):
                columns = [np.full(len(at), q, np.int32), ids[at], leaf[at], far]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q", "id", "leaf", "far"])

    found = indexed.mapInArrow(exhaust, "q int, id bigint, leaf int, far double")
    truth = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("far", "id"))).where(F.col("rank") <= k)
    order = [tree.value.visits(x, tree.value.n_leaves) for x in trial_vectors]
    needed = sorted(order[r["q"]].index(r["leaf"]) + 1 for r in truth.select("q", "leaf").collect())
    visits = 1
    while needed and np.searchsorted(needed, visits, "right") < recall * len(needed):
        visits += 1

    # Neighbouring leaves share a bin of bounded size; a query asks each bin once for all its leaves
    # there.  Bins with many vectors, as of one large leaf, or many queries are split.
    rows = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    # An id in several leaves counts in one of them, so visited leaves hold no fewer ids than counted.
    ids_in = np.zeros(tree.value.n_leaves, np.int64)
    for r in indexed.groupBy("id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").count().collect():
        ids_in[r["leaf"]] = r["count"]
    bins, held = [], []
    for leaf in range(tree.value.n_leaves):
        many = rows.get(leaf, 0)
        if not held or held[-1] + many > cell:
            held.append(0)
        held[-1] += many
        bins.append(len(held) - 1)
    bin_of = np.array(bins)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names, lists = [], [], []
            for i, x in enumerate(matrix(batch.column(1), width)):
                leaves = np.array(tree.value.visits(x, visits, ids_in, k + 1), np.int32)  # its own id is one of them
                for name in np.unique(bin_of[leaves]):
                    at.append(i)
                    names.append(int(name))
                    lists.append(leaves[bin_of[leaves] == name])
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], names=["id", "v", "bin", "leaves"])

    routed = asking.mapInArrow(route, "id bigint, v array<double>, bin int, leaves array<int>")
    asked = {r["bin"]: r["count"] for r in routed.groupBy("bin").count().collect()}

    def pieces(counts: dict[int, int]) -> Column:
        return F.array(*[F.lit(max(1, math.ceil(counts.get(i, 0) / cell))) for i in range(len(held))])

    own, other = F.get(pieces(dict(enumerate(held))), F.col("bin")), F.get(pieces(asked), F.col("bin"))
    indexed = indexed.withColumn("bin", F.get(F.array(*[F.lit(b) for b in bins]), F.col("leaf")))
    part = F.xxhash64("id")
    placed = indexed.select("id", "v", "leaf", "bin", F.pmod(part, own).alias("a"), F.explode(_up_to(other)).alias("b"))
    sent = routed.select("id", "v", "leaves", "bin", F.explode(_up_to(own)).alias("a"), F.pmod(part, other).alias("b"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(left) and len(right):
            ids, query_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
            leaf, leaves = left.column("leaf").to_numpy(), right.column("leaves").to_pylist()
            among = lambda i: np.isin(leaf, leaves[i])
            for q, at, far in nearest(matrix(left.column("v"), width), ids, matrix(right.column("v"), width), query_ids, k, among):
                for column, values in zip(out, (np.full(len(at), query_ids[q]), ids[at], far)):
                    column.append(values)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table({n: pa.array(np.concatenate([np.zeros(0, t), *c])) for n, t, c in zip(("query_id", "vec_id", "score"), kinds, out)})

    cells = ["bin", "a", "b"]
    met = placed.groupBy(*cells).cogroup(sent.groupBy(*cells)).applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    # An id met twice counts with its nearest row.
    met = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
