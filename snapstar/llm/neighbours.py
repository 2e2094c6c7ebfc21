"""Approximate nearest neighbours by largest inner product, over low-dimensional stable projections in kd-trees.

Inner products become distances: a vector x gets one more component sqrt(M^2 - |x|^2), with M the largest norm, and a
query gets 0; then |q|^2 + M^2 - 2 q.x is the squared distance. Vectors are projected to ``DIMENSIONS`` numbers with
Gaussian weights, which are 2-stable: a projected squared distance over the true one follows the chi-square
distribution. A kd-tree over the projections gives neighbours in the order of projected distance; each is verified in
double precision. A query stops once the next projected distance exceeds what a vector as near as the k-th best so far
would have with probability ``RECALL``.

Vectors are split into bands by norm, each with its own M and tree, so that a long vector doesn't widen the distances of the others.
The top of the trees is fitted on a bounded sample; its cells, cut into blocks of about ``BLOCK`` vectors, are what
tasks hold. Every vector is indexed. Queries stream past the blocks of those cells that the same chi-square test can't
rule out, with the k-th best of the sample as the first bound. Each task returns k per query and block.

Vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite components
take no part, as queries or candidates. Equal scores go to the smaller id. Repeated vectors are all
found; rows that repeat an id are candidates for each other only under different ids. Null ids take no part. With
fewer than k candidates all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

DIMENSIONS = 8
RECALL = 0.95
SAMPLE, MOST_SAMPLED = 2048, 16_384  # vectors that fit the top of the tree and the first bounds: the first, or one in 16 up to the second
MOST_CELLS, MOST_BANDS = 4096, 8
BLOCK = 8192  # vectors in one task's block
LEAF = 128
SEED = 7


def chi_square_quantile(share: float, degrees: int) -> float:
    """For an even number of degrees, by bisection of the closed form of the distribution."""
    low, high = 0.0, 100.0 * degrees
    for _ in range(100):
        mid = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= mid / 2 / i
            total += term
        low, high = (mid, high) if 1 - math.exp(-mid / 2) * total < share else (low, mid)
    return high


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row, components in order, so that equal vectors get equal scores whatever stands around them."""
    total = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        total += queries[:, j] * vectors[:, j]
    return total


@dataclass
class Projection:
    """Gaussian weights for vectors with the added component, and the largest norm."""

    weights: np.ndarray
    square: float  # of the largest norm

    @classmethod
    def make(cls, length: int, square: float) -> Projection:
        return cls(np.random.default_rng(SEED).standard_normal((length + 1, DIMENSIONS)), square)

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - (x**2).sum(1), 0))
        return np.column_stack([x, rest]) @ self.weights

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.weights[:-1]

    def distance(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance behind a score."""
        return np.maximum((q**2).sum(1) + self.square - 2 * score, 0)


@dataclass
class Bands:
    """Candidates by norm: band i has squared norms up to ``squares[i]``, which is its M^2, so one long vector widens the distances of
    its own band only. ``cells`` and their numbers, ``first`` of each band, go on through the bands."""

    squares: np.ndarray
    projections: list[Projection]
    cells: list[Cells]
    first: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, largest: float, cells: int, length: int) -> Bands:
        """Squared norms up to the largest, a quarter of it and so on; what the sample's smallest hundredth lies below is one band."""
        own = (sample**2).sum(1)
        squares = [largest]
        while len(squares) < MOST_BANDS and np.quantile(own, 0.01) <= squares[-1] / 4:
            squares.append(squares[-1] / 4)
        squares = np.array(squares[::-1])
        band = np.searchsorted(squares, own)
        projections = [Projection.make(length, s) for s in squares]
        fitted = []
        for i, p in enumerate(projections):
            part = sample[band == i]
            wanted = max(1, min(cells * len(part) // max(len(sample), 1), len(part) // 4))
            fitted.append(Cells.fit(p.of_vectors(part), wanted.bit_length() - 1))
        return cls(squares, projections, fitted, np.cumsum([0, *(len(c.low) for c in fitted)]))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Cell of each vector."""
        band = np.minimum(np.searchsorted(self.squares, (vectors**2).sum(1)), len(self.squares) - 1)
        out = np.zeros(len(vectors), int)
        for i in np.unique(band):
            rows = band == i
            out[rows] = self.first[i] + self.cells[i].of(self.projections[i].of_vectors(vectors[rows]))
        return out

    def open(self, queries: np.ndarray, floor: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(query row, cell) of the cells that the test can't rule out."""
        rows, numbers = [], []
        for p, c, first in zip(self.projections, self.cells, self.first):
            radius = reach * p.distance(queries, floor)
            row, cell = np.nonzero(box_distances(p.of_queries(queries), c.low, c.high) <= radius[:, None])
            rows.append(row)
            numbers.append(first + cell)
        return np.concatenate(rows), np.concatenate(numbers)

    def projection(self, cell: int) -> Projection:
        return self.projections[int(np.searchsorted(self.first, cell, side="right")) - 1]


@dataclass
class Cells:
    """The top of the kd-tree as a complete binary tree of (dimension, value), with the box of each cell."""

    dims: np.ndarray
    values: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, depth: int) -> Cells:
        dims, values = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
        groups, boxes = [points], [(np.full(DIMENSIONS, -np.inf), np.full(DIMENSIONS, np.inf))]
        for level in range(depth):
            new_groups, new_boxes = [], []
            for i, (group, (low, high)) in enumerate(zip(groups, boxes)):
                d = int(group.var(0).argmax()) if len(group) else 0
                v = float(np.median(group[:, d])) if len(group) else 0.0
                dims[2**level - 1 + i], values[2**level - 1 + i] = d, v
                below, above = high.copy(), low.copy()
                below[d], above[d] = v, v
                new_groups += [group[group[:, d] <= v], group[group[:, d] > v]]
                new_boxes += [(low, below), (above, high)]
            groups, boxes = new_groups, new_boxes
        return cls(dims, values, np.stack([b[0] for b in boxes]), np.stack([b[1] for b in boxes]))

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), int)
        for level in range((len(self.dims) + 1).bit_length() - 1):
            node = 2**level - 1 + at
            at = 2 * at + (points[np.arange(len(points)), self.dims[node]] > self.values[node])
        return at


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        p = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - p, p - high[None, :, d]), 0) ** 2
    return out


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree with at most LEAF points; halves are cut by rank, so equal points split too."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
        else:
            d = points[rows].var(0).argmax()
            order = np.argpartition(points[rows, d], len(rows) // 2)
            todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


class Block:
    """Vectors of one task with their kd-tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection) -> None:
        points = projection.of_vectors(vectors)
        self.ids, self.vectors, self.projection = ids, vectors, projection
        self.leaves = leaves(points)
        self.low = np.stack([points[r].min(0) for r in self.leaves])
        self.high = np.stack([points[r].max(0) for r in self.leaves])

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, reach: float):
        """(query row, vector id, score) of each query's k best here that beat its ``floor``, by incremental search. Queries that are at
        the same leaf meet it in one product. Rounding may move such a rough score a little; the exact one decides."""
        near = box_distances(self.projection.of_queries(queries), self.low, self.high)
        order = np.argsort(near, axis=1)
        best = np.full((len(queries), k), -np.inf)  # the k best rough scores, the least first
        live = np.arange(len(queries))
        found: list[tuple[np.ndarray, ...]] = []
        for step in range(len(self.leaves)):
            bound = np.maximum(best[live, 0], floor[live])
            radius = reach * self.projection.distance(queries[live], bound)
            live = live[near[live, order[live, step]] <= radius]
            if not len(live):
                break
            at = order[live, step]
            for leaf in np.unique(at):
                own, rows = live[at == leaf], self.leaves[leaf]
                rough = queries[own] @ self.vectors[rows].T
                rough[ids[own][:, None] == self.ids[rows][None, :]] = -np.inf
                hit = rough >= _slightly_below(np.maximum(best[own, 0], floor[own]))[:, None]
                some = np.flatnonzero(hit.any(1))
                if len(some):
                    q, r = np.nonzero(hit[some])
                    found.append((own[some[q]], rows[r], rough[some[q], r]))
                    merged = np.concatenate([best[own[some]], rough[some]], axis=1)
                    merged.partition(merged.shape[1] - k, axis=1)
                    best[own[some]] = np.sort(merged[:, -k:], axis=1)
        if not found:
            return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
        q, r, rough = (np.concatenate(c) for c in zip(*found))
        good = (rough >= _slightly_below(np.maximum(best[q, 0], floor[q]))) & np.isfinite(rough)
        q, r = q[good], r[good]
        score = inner_products(queries[q], self.vectors[r])
        order = np.lexsort((self.ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        first = np.searchsorted(q, q)
        top = np.arange(len(q)) - first < k
        return q[top], self.ids[r[top]], score[top]


def _slightly_below(score: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(score), score - 1e-9 * (1 + np.abs(score)), -np.inf)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the vectors that take part, components as doubles."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("vec", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def search(df: DataFrame, key: str, vector: str, is_query, k: int = 20, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of each query row; ``is_query`` makes a condition of the id."""
    valid = usable(df, key, vector)
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    sampled = min(MOST_SAMPLED, max(SAMPLE, valid.count() // 16))
    chosen = valid.orderBy(F.xxhash64("id"), "id").limit(sampled).collect()
    spark = df.sparkSession
    result = "query_id bigint, vec_id bigint, score double"
    if not chosen:
        return spark.createDataFrame([], result).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    lengths = [len(r.vec) for r in chosen]
    length = max(sorted(set(lengths)), key=lengths.count)
    sample_ids = np.array([r.id for r in chosen if len(r.vec) == length], np.int64)
    sample = np.array([r.vec for r in chosen if len(r.vec) == length])
    valid = valid.filter(F.size("vec") == length)
    total, largest = valid.agg(F.count("*"), F.max(square)).first()
    reach = chi_square_quantile(recall, DIMENSIONS)
    bands = Bands.fit(sample, largest, min(MOST_CELLS, max(1, total // (BLOCK // 2))), length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            cell = bands.of(vectors) if len(vectors) else np.zeros(0, int)
            yield pa.record_batch([pa.array(cell.astype(np.int32)), batch.column("id"), batch.column("vec")], names=["cell", "id", "vec"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, queries = batch.column("id").to_numpy(), _matrix(batch.column("vec"))
            if not len(ids):
                continue
            scores = queries @ sample.T
            scores[ids[:, None] == sample_ids[None, :]] = -np.inf
            floor = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(ids), -np.inf)
            floor = floor - 1e-9 * (1 + np.abs(floor))
            row, cell = bands.open(queries, floor, reach)
            yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(ids[row]), batch.column("vec").take(pa.array(row)), pa.array(floor[row])],
                                  names=["cell", "id", "vec", "floor"])

    # The number of a row is fixed once it is written, so rows that repeat an id or a vector are dealt out like any others.
    placed = valid.mapInArrow(place, "cell int, id bigint, vec array<double>").withColumn("salt", F.monotonically_increasing_id())
    placed = materialize(placed, "neighbours")
    # At most MOST_CELLS rows. A cell that holds more than a block, such as copies of one vector, is cut by the rows' numbers.
    blocks = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = F.broadcast(blocks)
    candidates = placed.join(blocks, "cell").select(
        "cell", F.pmod(F.xxhash64("salt"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "id", "vec", F.lit(0.0).alias("floor"))
    routed = valid.filter(is_query(F.col("id"))).mapInArrow(route, "cell int, id bigint, vec array<double>, floor double")
    asking = routed.join(blocks, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "id", "vec", "floor")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, at = None, [], None
        for batch in batches:
            place_, role, ids, floor = (np.asarray(batch.column(n)) for n in ("cell", "role", "id", "floor"))
            part, vectors = np.asarray(batch.column("block")), _matrix(batch.column("vec"))
            edges = np.flatnonzero((place_[1:] != place_[:-1]) | (part[1:] != part[:-1]) | (role[1:] != role[:-1])) + 1
            for start, end in zip([0, *edges], [*edges, len(ids)]):
                if start == end:
                    continue
                if at != (place_[start], part[start]):
                    at, block, parts = (place_[start], part[start]), None, []
                if role[start] == 0:
                    parts.append((ids[start:end], vectors[start:end]))
                    continue
                if block is None and parts:
                    block = Block(*(np.concatenate(c) for c in zip(*parts)), bands.projection(at[0]))
                if block is not None:
                    q, found, score = block.search(ids[start:end], vectors[start:end], floor[start:end], k, reach)
                    yield pa.record_batch([pa.array(ids[start:end][q]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    together = candidates.unionByName(asking).repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    found = together.mapInArrow(answer, result)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
