"""Nearest neighbours by inner product, on low-dimensional stable projections in kd-trees.

Inner products become distances by one more dimension (every vector is filled up to the largest
norm, queries get zero there). Gaussian projections to a few dimensions keep distances in the sense
that the squared ratio of projected to true distance is chi-square distributed. Each shard of the
table keeps its projected points in a kd-tree. A query takes the tree's leaves in order of their
distance in the projection, verifies their vectors exactly, and stops once the chi-square test says
that a nearer neighbour would, with probability ``certainty``, have been met already.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import narrow


@dataclass(frozen=True)
class SearchRules:
    k: int = 20
    dimensions: int = 10
    certainty: float = 0.95
    leaf: int = 64
    shard_rows: int = 20_000  # vectors of one tree
    block_rows: int = 2_000  # queries that meet a tree at once
    seed: int = 7


def chi_square_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


class Tree:
    """A balanced kd-tree kept as its leaves: order of the points, and each leaf's bounding box."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        parts, done = [np.arange(len(points))], []
        while parts:
            part = parts.pop()
            if len(part) <= leaf:
                done.append(part)
                continue
            box = points[part]
            axis = int(np.argmax(box.max(axis=0) - box.min(axis=0)))
            order = part[np.argpartition(box[:, axis], len(part) // 2)]
            parts += [order[: len(part) // 2], order[len(part) // 2 :]]
        self.leaves = done
        self.low = np.array([points[p].min(axis=0) for p in done])
        self.high = np.array([points[p].max(axis=0) for p in done])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each leaf's box."""
        out = np.zeros((len(queries), len(self.leaves)))
        for axis in range(queries.shape[1]):
            x = queries[:, axis, None]
            out += np.square(np.maximum(np.maximum(self.low[:, axis] - x, x - self.high[:, axis]), 0))
        return out


def search_shard(ids, vectors, query_ids, queries, top_norm: float, rules: SearchRules):
    """The ``k`` nearest found of one shard: ``(query row, vector row, score)`` arrays."""
    size = vectors.shape[1]
    projection = np.random.default_rng(rules.seed).standard_normal((size + 1, rules.dimensions))
    fill = np.sqrt(np.maximum(top_norm**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
    tree = Tree(np.hstack([vectors, fill[:, None]]) @ projection, rules.leaf)
    near = tree.distances(np.hstack([queries, np.zeros((len(queries), 1))]) @ projection)
    order = np.argsort(near, axis=1, kind="stable")
    width = max(len(p) for p in tree.leaves)
    table = np.full((len(tree.leaves), width), -1)
    for i, part in enumerate(tree.leaves):
        table[i, : len(part)] = part
    k, lengths = rules.k, np.einsum("ij,ij->i", queries, queries) + top_norm**2
    best_score = np.full((len(queries), k), -np.inf)
    best_row = np.full((len(queries), k), -1)
    sort_ids = np.append(ids, np.iinfo(np.int64).max)  # the last one stands for "none"
    quantile = chi_square_quantile(rules.certainty, rules.dimensions)
    active = np.arange(len(queries))
    for step in range(len(tree.leaves)):
        leaf = order[active, step]
        bound = near[active, leaf]
        # Squared distance of the k-th best so far; the test compares the two as a chi-square value.
        worst = np.maximum(lengths[active] - 2 * best_score[active, k - 1], 1e-300)
        going = bound < quantile * worst
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        rows = table[leaf]
        scores = np.einsum("qd,qpd->qp", queries[active], vectors[rows])
        scores[(rows < 0) | (ids[rows] == query_ids[active, None])] = -np.inf
        all_scores = np.hstack([best_score[active], scores])
        all_rows = np.where(np.isneginf(all_scores), -1, np.hstack([best_row[active], rows]))
        first = np.lexsort((sort_ids[all_rows], -all_scores), axis=1)[:, :k]
        best_score[active] = np.take_along_axis(all_scores, first, axis=1)
        best_row[active] = np.take_along_axis(all_rows, first, axis=1)
    found = best_row >= 0
    return np.nonzero(found)[0], best_row[found], best_score[found]


def valid_vectors(table: DataFrame, id: str, vector: str) -> DataFrame:
    """Rows that take part: finite, not zero, and of the length that most such rows have."""
    rows = narrow(table, vec_id=id, v=vector).withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    usual = lengths.first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0))


def nearest(
    table: DataFrame, rules: SearchRules = SearchRules(), every: int = 20, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the nearest found of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those with
    the query's own id; of rows that share a query's id the smallest vector asks. Rows with a null id, a null, zero or non-finite vector, or a vector of
    another length than most, take no part. Equal scores are ranked by the smaller id; a repeated
    row is a candidate like any other. Other columns are ignored; an empty table gives none.

    Every shard of the table meets the query set in blocks; a task holds one shard and one block,
    and hands on at most ``k`` rows for each query.
    """
    rows = valid_vectors(table, id, vector)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("top"))
    facts = facts.first()
    shards = max(1, -(-facts["n"] // rules.shard_rows))
    blocks = max(1, -(-facts["n"] // (every * rules.block_rows)))
    top_norm = math.sqrt(facts["top"] or 0.0)
    spread = lambda by, n: F.pmod(F.xxhash64(by), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shard = spread(F.monotonically_increasing_id(), shards)  # by place, so that equal ids spread as well
    points = rows.select(shard.alias("shard"), "vec_id", "v").select("shard", all_of(blocks).alias("block"), "vec_id", "v")
    asking = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asking = asking.select(all_of(shards).alias("shard"), spread("vec_id", blocks).alias("block"), "vec_id", "v")
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        ids, query_ids = (t.column("vec_id").to_numpy() for t in (left, right))
        vectors, queries = (
            np.concatenate([c.flatten().to_numpy() for c in t.column("v").chunks]).reshape(t.num_rows, -1)
            for t in (left, right)
        )
        query, row, _ = search_shard(ids, vectors, query_ids, queries, top_norm, rules)
        scores = np.einsum("ij,ij->i", queries[query], vectors[row])
        return pa.table([pa.array(query_ids[query]), pa.array(ids[row]), pa.array(scores)], schema=kind)

    found = (
        points.groupBy("shard", "block")
        .cogroup(asking.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
