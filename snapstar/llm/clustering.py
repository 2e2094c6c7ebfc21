"""Lloyd clustering of integer vectors, nearest centroids by a vantage-point tree.

A vector's components x become floor(scale * x). The first centroids are the vectors whose ids hash lowest. Each round
assigns every vector to the nearest centroid by squared Euclidean distance, ties to the smaller number, and moves each
centroid that got vectors to the componentwise floor of their mean; others stay.

Every round the driver builds a vantage-point tree over the centroids and sends it to the tasks. A node holds one
centroid, halves the others by their distance to it, and knows the nearest and farthest distance in either half.
A vector visits nodes best first: always the open node whose lower bound, by the triangle inequality, is least,
until no bound is below or equal to the best distance found. Equality stays open, as an equally near centroid may have the
smaller number. Bounds are square roots in floating point, lowered by a relative ``SLACK`` that exceeds their rounding, so they
only ever open a node too many; distances to centroids are exact integers. A batch of vectors takes its steps together: all
vectors whose next node is the same meet its centroid in one operation.

Tasks return sums and counts of each centroid's vectors, which Spark adds; the driver sees a few rows for each component of
a centroid, whatever the table holds. No row is shuffled and no group gathered, so a centroid may hold any share of the vectors.
Integers beyond 64 bits are kept as Python integers.

Vectors that are null, of another length, or that hold null or non-finite components (or 64-bit ones beyond ``LARGEST``) take no
part. Fewer vectors than centroids make as many centroids as there are vectors. Rows that repeat an id or a vector each count.
Among rows with one hash, and so for rows without an id, which come last, the lesser vector starts. A distance or inertia that 64
bits can't hold is null. An empty table gives an empty result. Only id and vector are read, so further columns can't clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SLACK = 1e-9
LONG = (1 << 63) - 1
LARGEST = 1e300
LIMB = 60  # bits of a sum in one row


@dataclass
class Node:
    """A centroid, and its inner and outer subtree with their nearest and farthest distance to it."""

    centroid: int
    inner: Node | None = None
    outer: Node | None = None
    inner_range: tuple[float, float] = (0.0, 0.0)
    outer_range: tuple[float, float] = (0.0, 0.0)


def _safe(dimensions: int) -> int:
    """Components below this have squared distances within 64 bits."""
    return math.isqrt((1 << 62) // max(dimensions, 1)) // 2


def exact(rows: list[list[int]]) -> np.ndarray:
    """Integers as a matrix, of Python integers if 64 bits are not sure to hold squared distances."""
    wide = any(abs(x) >= _safe(len(row)) for row in rows for x in row)
    return np.array(rows, object if wide else np.int64)


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return (gap * gap).sum(1)


def root_of(distances: np.ndarray) -> np.ndarray:
    """Square roots in floating point, also of integers that no floating-point number holds."""
    if distances.dtype != object:
        return np.sqrt(distances.astype(float))
    return np.array([math.sqrt(d) if d < 1 << 1000 else float(math.isqrt(d)) for d in distances], float)


def build_tree(centroids: list[list[int]]) -> Node | None:
    """A balanced tree. The vantage point of a part is the centroid farthest from the part's first one. Of equal centroids
    only the first can be chosen, so the others are left out."""
    points, firsts = exact(centroids), {}
    for number, centroid in enumerate(centroids):
        firsts.setdefault(tuple(centroid), number)

    def below(members: list[int]) -> Node | None:
        if not members:
            return None
        from_first = squared(points[members], points[members[0]])
        vantage = members[max(range(len(members)), key=lambda i: (from_first[i], -members[i]))]
        rest = [m for m in members if m != vantage]
        node = Node(vantage)
        if rest:
            away = root_of(squared(points[rest], points[vantage]))
            order = np.argsort(away, kind="stable")
            near, far = order[: (len(rest) + 1) // 2], order[(len(rest) + 1) // 2:]
            node.inner, node.inner_range = below([rest[i] for i in near]), (away[near].min(), away[near].max())
            if len(far):
                node.outer, node.outer_range = below([rest[i] for i in far]), (away[far].min(), away[far].max())
        return node

    return below(list(firsts.values()))


def _listed(root: Node) -> list[Node]:
    nodes, at = [root], 0
    while at < len(nodes):
        nodes += [child for child in (nodes[at].inner, nodes[at].outer) if child]
        at += 1
    return nodes


def nearest(vectors: np.ndarray, centroids: np.ndarray, root: Node) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of each vector's nearest centroid, the exact squared distance, and how many distances were taken."""
    nodes = _listed(root)
    place = {id(node): i for i, node in enumerate(nodes)}
    n = len(vectors)
    bound = np.full((n, len(nodes)), np.inf)  # of open nodes; inf for those visited or not reached
    bound[:, 0] = 0.0
    best, reach, chosen = np.full(n, None, object), np.full(n, np.inf), np.full(n, len(centroids))
    if vectors.dtype != object and centroids.dtype != object:
        best = np.full(n, LONG, np.int64)
    taken = 0
    while True:
        step = bound.argmin(1)
        least = bound[np.arange(n), step]
        # Inclusive: a bound equal to the best distance may hide a tie. An infinite bound is no open node.
        going = np.flatnonzero(np.isfinite(least) & (least * (1 - SLACK) <= reach * (1 + SLACK)))
        if not len(going):
            return chosen, best, taken
        for number in np.unique(step[going]):
            node, rows = nodes[number], going[step[going] == number]
            distance = squared(vectors[rows], centroids[node.centroid])
            taken += len(rows)
            known = best[rows]
            if best.dtype == object:
                better = np.array([k is None or (d, node.centroid) < (k, c) for d, k, c in zip(distance, known, chosen[rows])], bool)
            else:
                better = (distance < known) | ((distance == known) & (node.centroid < chosen[rows]))
            best[rows[better]], chosen[rows[better]] = distance[better], node.centroid
            away = root_of(distance)
            reach[rows] = np.minimum(reach[rows], away)
            bounded = bound[rows, number]
            bound[rows, number] = np.inf
            for child, (low, high) in ((node.inner, node.inner_range), (node.outer, node.outer_range)):
                if child:
                    bound[rows, place[id(child)]] = np.maximum(bounded, np.maximum(low - away, away - high) - SLACK * (away + high))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of a matrix of finite numbers."""
    if len(values) and np.abs(values).max() * scale >= _safe(values.shape[1]):
        # A number beyond 2**53 is whole, so it is scaled after it became an integer.
        return np.array([[int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in row] for row in values.tolist()], object)
    return np.floor(values * scale).astype(np.int64)


def _taking_part(vectors: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column take part, and their components."""
    whole = np.array(pc.fill_null(pc.equal(pc.list_value_length(vectors), dimensions), False))
    flat = vectors.filter(pa.array(whole)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    values = flat.reshape(-1, dimensions)
    good = (np.abs(values) <= LARGEST).all(1)
    whole[whole] = good
    return whole, values[good]


def _vectors(batch: pa.RecordBatch, dimensions: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and integer vectors of the rows of a batch that take part."""
    kept, values = _taking_part(batch.column(1), dimensions)
    return batch.column(0).filter(pa.array(kept)), integers(values, scale)


def first_centroids(vectors: DataFrame, k: int, dimensions: int, scale: int, seed: str) -> list[list[int]]:
    """The vectors of the k ids with the least SHA-256 of seed and id."""
    rank = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_taking_part(batch.column(1), dimensions)[0]))

    kept = vectors.mapInArrow(valid, vectors.schema)
    rows = kept.orderBy(rank.asc_nulls_last(), "id", "vector").limit(k).collect()  # k rows
    return integers(np.array([r.vector for r in rows], float), scale).tolist() if rows else []


def limbs(total: int) -> list[int]:
    """A sum in parts that 64 bits hold, the lowest first; the last has the sign."""
    out = []
    while not -(1 << LIMB) <= total < 1 << LIMB:
        out.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return [*out, total]


def moved(vectors: DataFrame, centroids: list[list[int]], dimensions: int, scale: int) -> list[list[int]]:
    """The centroids after one round."""
    points, tree = exact(centroids), build_tree(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = [[0] * dimensions for _ in centroids], [0] * len(centroids)
        for batch in batches:
            _, own = _vectors(batch, dimensions, scale)
            if len(own):
                chosen = nearest(own, points, tree)[0]
                for c in np.unique(chosen):
                    members = own[chosen == c]
                    total[c] = [t + int(s) for t, s in zip(total[c], members.sum(0))]
                    count[c] += len(members)
        rows = [(c, i, place, limb, count[c]) for c in range(len(centroids)) if count[c]
                for i in range(dimensions) for place, limb in enumerate(limbs(total[c][i]))]
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["cluster", "part", "place", "limb", "rows"])

    told = vectors.mapInArrow(sums, "cluster int, part int, place int, limb bigint, rows bigint")
    added = told.groupBy("cluster", "part", "place").agg(F.sum(F.col("limb").cast("decimal(38,0)")).alias("limb"), F.sum("rows").alias("rows"))
    totals: dict[tuple[int, int], int] = {}
    counts: dict[int, int] = {}
    for r in added.collect():  # a few rows for each component of a centroid
        totals[r.cluster, r.part] = totals.get((r.cluster, r.part), 0) + (int(r.limb) << (LIMB * r.place))
        if not r.place:
            counts[r.cluster] = r.rows
    out = [list(c) for c in centroids]
    for (number, part), total in totals.items():
        out[number][part] = total // counts[number]
    return out


def assigned(vectors: DataFrame, centroids: list[list[int]], dimensions: int, scale: int) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` of every vector that takes part."""
    points, tree = exact(centroids), build_tree(centroids)
    kind = vectors.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = _vectors(batch, dimensions, scale)
            if len(own):
                chosen, distance, _ = nearest(own, points, tree)
                short = [int(d) if d <= LONG else None for d in distance]
                yield pa.record_batch([ids, pa.array(chosen, pa.int32()), pa.array(short, pa.int64())],
                                      names=["id", "cluster", "distance"])

    return vectors.mapInArrow(assign, f"id {kind}, cluster int, distance bigint")


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(df: DataFrame, id_col: str, vector_col: str, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024,
            seed: str = "3:") -> DataFrame:
    """``id``, ``cluster``, ``distance``, the inertia of the cluster and of all, and the digest of the final centroid."""
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    centroids = first_centroids(vectors, k, dimensions, scale, seed)
    if not centroids:
        empty = vectors.limit(0)
        return empty.select("id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
                            F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        after = moved(vectors, centroids, dimensions, scale)
        if after == centroids:
            break  # a fixed point: further rounds change nothing
        centroids = after
    told = materialize(assigned(vectors, centroids, dimensions, scale), "clusters")
    # A distance that is null makes its sums null.
    whole = F.count("*") == F.count("distance")
    sums = told.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("own")).collect()  # k rows
    per = {r.cluster: None if r.own is None else int(r.own) for r in sums}
    inertia = None if None in per.values() else sum(per.values())

    def fits(x: int | None) -> int | None:
        return x if x is not None and x <= LONG else None

    rows = [(c, fits(per[c]), fits(inertia), centroid_digest(centroids[c])) for c in per]
    spark = df.sparkSession
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row for each centroid, whatever the table holds.
    return told.join(F.broadcast(named), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
