"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on the driver on a sample of at most ``FIT_ROWS`` vectors
(the smallest by a hash of their id) and has leaves of about ``LEAF_ROWS`` rows
of the whole table, as far as the sample allows.  Every vector is indexed: the
tasks send it down the tree to its leaf, and the index is written by leaf, a
leaf of more than ``SPLIT_ROWS`` rows in several slices.

A query walks the tree with a priority queue over the branches not taken, the
closest first, and so lists leaves best first.  How many leaves a query visits
is calibrated: on ``TUNE_QUERIES`` sampled rows, whose true neighbours in the
index are known by a full comparison in blocks, the number of leaves is widened
until their recall reaches ``target``; queries take that number.  Each visit is
a join on leaf and slice; a slice's task compares its rows with its queries in
double precision and keeps each query's k best, and the k best of all slices
are the answer.

Distances are Euclidean on the vectors as given; ties go to the smaller id.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as query or candidate; those whose length differs
from the most frequent one take none either; repeated ids are separate rows
and each a candidate, a query finds no row of its own id; rows with a null id
take no part; fewer than k candidates are all returned; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dvspark.llm.common import stored

FIT_ROWS = 40_000
LEAF_ROWS = 256
SPLIT_ROWS = 4096
BRANCHES = 8
ROUNDS = 8
TUNE_QUERIES = 200


class Tree:
    """Branch centres; node 0 is the root, a node's children are nodes or, as -1 - leaf, leaves."""

    def __init__(self) -> None:
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0

    @staticmethod
    def fit(sample: np.ndarray, leaves: int, seed: int = 7) -> Tree:
        tree, rng = Tree(), np.random.default_rng(seed)
        least = max(8, len(sample) // max(1, leaves))

        def grow(rows: np.ndarray) -> int:
            parts, centres = [], None
            if len(rows) > least:
                centres, label = _kmeans(sample[rows], min(BRANCHES, math.ceil(len(rows) / least)), rng)
                parts = [rows[label == k] for k in range(len(centres))]
            if len(parts) < 2:  # small enough, or all alike
                tree.leaves += 1
                return -tree.leaves
            node = len(tree.centres)
            tree.centres.append(centres)
            tree.children.append([])
            tree.children[node] = [grow(p) for p in parts]
            return node

        if grow(np.arange(len(sample))) < 0:
            tree.centres, tree.children = [np.zeros((1, sample.shape[1]))], [[-1]]
        return tree

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            near = np.argmin(_distances(x[rows], self.centres[node]), axis=1)
            for k, child in enumerate(self.children[node]):
                mine = rows[near == k]
                if len(mine) and child < 0:
                    out[mine] = -1 - child
                elif len(mine):
                    work.append((child, mine))
        return out

    def best_bins(self, q: np.ndarray, many: int) -> list[int]:
        """The first ``many`` leaves of a best-bin-first walk."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < many:
            far, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                continue
            for d, child in zip(_distances(q[None], self.centres[node])[0].tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (d, child))
        return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by the expanded form: good enough to walk the tree, not to rank answers."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)[None], 0.0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = np.unique(x[rng.permutation(len(x))[: 4 * k]], axis=0)
    centres = centres[rng.permutation(len(centres))[:k]]
    for _ in range(ROUNDS):
        label = np.argmin(_distances(x, centres), axis=1)
        present, label = np.unique(label, return_inverse=True)
        centres = np.stack([np.bincount(label, weights=x[:, d], minlength=len(present)) for d in range(x.shape[1])], axis=1) / np.bincount(label)[:, None]
    label = np.argmin(_distances(x, centres), axis=1)
    present, label = np.unique(label, return_inverse=True)
    return centres[present], label


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of one query in double precision, component by component."""
    d = x - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def nearest(q: np.ndarray, q_id: int, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k nearest rows of other ids, by distance and id."""
    score = _exact(q, x)
    score[ids == q_id] = np.inf
    if len(score) > k:
        bound = np.partition(score, k - 1)[k - 1]
        keep = np.flatnonzero(score <= bound)
    else:
        keep = np.arange(len(score))
    keep = keep[np.isfinite(score[keep])]
    order = keep[np.lexsort((ids[keep], score[keep]))][:k]
    return [(float(score[i]), int(ids[i])) for i in order]


def valid_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, v (doubles): the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return rows.where((F.size("v") > 0) & fine)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.array(values, dtype=np.float64) if len(values) else np.zeros((0, 1))


def nearest_neighbours(rows: DataFrame, is_query: Column, k: int = 10, target: float = 0.97) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row where ``is_query`` (on vec_id) holds."""
    spark = rows.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    held = stored(valid_vectors(rows), "vectors")
    sizes = held.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], out_schema)
    held, total = held.where(F.size("v") == sizes["size"]), sizes["count"]
    sample = held.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()
    tree = spark.sparkContext.broadcast(Tree.fit(_matrix(pd.Series([r.v for r in sample])), max(1, total // LEAF_ROWS)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.leaf_of(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

    index = stored(held.mapInArrow(assign, "vec_id long, v array<double>, leaf int"), "tree-index")
    leaves = index.groupBy("leaf").count().withColumn("slices", F.ceil(F.col("count") / SPLIT_ROWS).cast("int"))
    slices = {r.leaf: r.slices for r in leaves.collect()}  # one number for each leaf of the fitted tree
    count_of = F.create_map(*[F.lit(x) for pair in slices.items() for x in pair]) if len(slices) <= 64 else None
    by_leaf = leaves.select("leaf", "slices")
    sliced = (index.withColumn("slices", count_of[F.col("leaf")]) if count_of is not None else index.join(F.broadcast(by_leaf), "leaf")).withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.col("slices")).cast("int"))
    sliced = sliced.select("leaf", "slice", "vec_id", "v", F.lit(-1).alias("query"))

    def search(queries: DataFrame, many: int) -> DataFrame:
        """The k best of each query in each slice of the ``many`` leaves it visits."""

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for q_id, q in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)), strict=True):
                    order = [(leaf, s, 1) for leaf in tree.value.best_bins(q, many) for s in range(slices.get(leaf, 0))]
                    if order:
                        leaf, part, asks = (list(c) for c in zip(*order, strict=True))
                        n = len(order)
                        yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(part, pa.int32()), pa.array([q_id] * n, pa.int64()), pa.array([q.tolist()] * n, pa.list_(pa.float64())), pa.array(asks, pa.int32())], names=["leaf", "slice", "vec_id", "v", "query"])

        asked = queries.select("vec_id", "v").mapInArrow(visits, T.StructType(sliced.schema.fields))

        def compare(group: pd.DataFrame) -> pd.DataFrame:
            mine, ask = group[group["query"] < 0], group[group["query"] >= 0]
            found = []
            if len(mine) and len(ask):
                ids, x = mine["vec_id"].to_numpy(), _matrix(mine["v"])
                for q_id, q in zip(ask["vec_id"], _matrix(ask["v"]), strict=True):
                    found += [(q_id, vec_id, d) for d, vec_id in nearest(q, q_id, ids, x, k)]
            return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

        # A slice and the queries that visit it: SPLIT_ROWS rows or so, and at most every query once.
        return sliced.union(asked).groupBy("leaf", "slice").applyInPandas(compare, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        rows_of = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("all"))
        return rows_of.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))

    many = _calibrated(index, tree.value, k, target)
    return best(search(held.where(is_query), many))


def _calibrated(index: DataFrame, tree: Tree, k: int, target: float) -> int:
    """Leaves to visit until the sampled queries' recall of their k true neighbours reaches the target."""
    tune = index.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(TUNE_QUERIES).collect()
    queries = {r.vec_id: np.array(r.v) for r in tune}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[float, int, int]]] = {q: [] for q in queries}
        for batch in batches:
            ids, x, leaf = batch.column(0).to_numpy(), _matrix(batch.column(1)), dict(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for q_id, q in queries.items():
                kept[q_id] = heapq.nsmallest(k, kept[q_id] + [(d, vec_id, leaf[vec_id]) for d, vec_id in nearest(q, q_id, ids, x, k)])
        rows = [(q_id, *found) for q_id, best in kept.items() for found in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.float64(), pa.int64(), pa.int32()), strict=True)], names=["query_id", "score", "vec_id", "leaf"])

    found = index.select("vec_id", "v", "leaf").mapInArrow(compare, "query_id long, score double, vec_id long, leaf int")
    true = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id", "leaf"))), 1, k).alias("best")).select("query_id", "best.leaf").collect()
    places = []
    for r in true:
        place = {leaf: p for p, leaf in enumerate(tree.best_bins(queries[r.query_id], tree.leaves))}
        places += [place[leaf] for leaf in r.leaf]
    places.sort()
    return places[math.ceil(target * len(places)) - 1] + 1 if places else 1
