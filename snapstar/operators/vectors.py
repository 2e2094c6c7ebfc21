"""Exact cosine top-k over stored vectors for query sets of any size, and vector upserts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_dir
from ..sources.landing import is_missing
from .snapshots import dedup_by_key

# Bytes of corpus vectors that a task holds together, and queries it multiplies with them at a time. Every query moves once for each block, so
# blocks are as large as a task holds with ease.
BLOCK_BYTES, QUERY_BLOCK = 8 << 20, 128
# Bounded sample of the corpus that the pivots and the first bounds come from, whatever the corpus holds; both move cost only.
SAMPLE, PIVOTS = 1024, 64
SLACK = 1e-9  # beyond rounding in similarities and angles


def unit_rows(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of length one; NaN for null and zero vectors, those of another width, and those with null or non-finite components."""
    whole = np.array(pc.fill_null(pc.equal(pc.list_value_length(vectors), width), False), dtype=bool)
    rows = np.full((len(vectors), width), np.nan)
    if whole.any():
        flat = vectors.filter(pa.array(whole)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
        rows[whole] = flat.reshape(-1, width)
    with np.errstate(invalid="ignore", over="ignore"):
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.full_like(rows, np.nan), where=(norms > 0) & np.isfinite(norms))


def _best(sims: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row, the places of at most ``k`` similarities that reach the row's bound: the highest, then the first ones. Returns rows,
    places and similarities, rounded to ten digits; only what reaches a bound is rounded and sorted."""
    rows, places = np.nonzero(sims >= bounds[:, None])
    values = np.round(sims[rows, places], 10)
    order = np.lexsort((places, -values, rows))
    rows = rows[order]
    starts = np.searchsorted(rows, np.arange(len(sims)))
    kept = np.arange(len(rows)) - starts[rows] < k
    return rows[kept], places[order][kept], values[order][kept]


@dataclass
class Pivots:
    """A sample of the corpus as unit rows, the rows chosen as pivots, and of each pivot's cell the number of vectors and the least and
    the greatest angle to the pivot."""

    sample: np.ndarray
    rows: np.ndarray
    count: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray

    def cell_of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and the angle to its pivot."""
        sims = units @ self.rows.T
        cell = np.nan_to_num(sims, nan=-2.0).argmax(1)
        return cell, np.arccos(np.clip(sims[np.arange(len(units)), cell], -1, 1))

    def open_cells(self, units: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Which cells may hold one of the k most similar vectors of each row, and a similarity that each of these reaches. By the triangle inequality on the sphere no vector of a
        cell is nearer than the pivot's angle less the cell's greatest, or the cell's least less the pivot's; the k-th best of the sample
        is a similarity that the k-th best of all reaches."""
        known = units @ self.sample.T
        kth = np.round(np.partition(known, -k, axis=1)[:, -k], 10) if known.shape[1] >= k else np.full(len(units), -2.0)
        bound = np.maximum(kth, least) - SLACK
        angle = np.arccos(np.clip(units @ self.rows.T, -1, 1))
        gap = np.maximum(np.maximum(angle - self.farthest, self.nearest - angle), 0.0)
        return (np.cos(np.minimum(gap, np.pi)) + SLACK >= bound[:, None]) & (self.count > 0), bound


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows far from each other: each next one is the least similar to those chosen."""
    if not len(sample):
        return sample
    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        at = int(near.argmin())
        if near[at] >= 1 - SLACK:
            break
        chosen.append(at)
        near = np.maximum(near, sample @ sample[at])
    return sample[chosen]


def _place_corpus(corpus: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, Pivots]:
    """The corpus stored with cell and a number for each row, and the pivots. The driver sees the sample and one row for each cell."""
    spark = corpus.sparkSession
    c = corpus.select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    usable = F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    taken = [r.v for r in c.filter(usable).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()]
    units = unit_rows(pa.array([[float(x) for x in v] for v in taken], pa.list_(pa.float64())), max(map(len, taken), default=0))
    sample = units[~np.isnan(units).any(1)]
    none = np.zeros(0)
    pivots = Pivots(sample, choose_pivots(sample), none, none, none)
    schema = StructType([c.schema["id"], c.schema["v"], StructField("cell", LongType()), *StructType.fromDDL("angle double").fields])
    kinds = [pa.int64(), pa.float64()]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(batch.column(1), pivots.rows.shape[1])
            good = ~np.isnan(rows).any(1)
            if good.any():
                cell, angle = pivots.cell_of(rows[good])
                kept = batch.filter(pa.array(good))
                yield pa.record_batch([*kept.columns, pa.array(cell, kinds[0]), pa.array(angle, kinds[1])], names=schema.names)

    folder = scratch_dir(spark, "cells")
    # Without any usable vector there is no pivot and no cell.
    placed = c.mapInArrow(place, schema) if len(pivots.rows) else spark.createDataFrame([], schema)
    placed.withColumn("salt", F.monotonically_increasing_id()).write.parquet(folder)
    placed = spark.read.schema(StructType([*schema.fields, StructField("salt", LongType())])).parquet(folder)
    count, near, far = (np.zeros(len(pivots.rows)) for _ in range(3))
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("angle").alias("near"), F.max("angle").alias("far")).collect():
        count[r.cell], near[r.cell], far[r.cell] = r.n, r.near, r.far
    pivots.count, pivots.nearest, pivots.farthest = count, near, far
    return placed, pivots


def _place_queries(queries: DataFrame, query_id: str, query_vector: str, pivots: Pivots, k: int, least: float) -> DataFrame:
    """Each query with the cells it has to visit and a similarity that all of its results reach. Queries are dealt out first, as a query makes
    a row for each cell and a file may be one task."""
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).alias("v")).repartition("qid")
    schema = StructType([*q.schema.fields, *StructType.fromDDL("cells array<bigint>, bound double").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(batch.column(1), pivots.rows.shape[1])
            good = ~np.isnan(rows).any(1)
            if good.any():
                visits, bound = pivots.open_cells(rows[good], k, least)
                kept = batch.filter(pa.array(good))
                cells = pa.array([np.flatnonzero(v) for v in visits], pa.list_(pa.int64()))
                yield pa.record_batch([*kept.columns, cells, pa.array(bound, pa.float64())], names=schema.names)

    return q.mapInArrow(place, schema) if len(pivots.rows) else q.sparkSession.createDataFrame([], schema)


def cosine_top_k(
    queries: DataFrame, corpus: DataFrame, k: int = 4, min_sim: float | None = None,
    query_id: str = "query_id", query_vector: str = "query_vector",
    id_col: str = "vec_id", vector: str = "embedding", block_rows: int | None = None,
) -> DataFrame:
    """The ``k`` most similar corpus vectors per query, optionally only those at ``min_sim`` or above.

    The corpus lies in cells around pivots, cut into blocks of about ``block_rows`` vectors (or ``BLOCK_BYTES``); every query goes to the blocks of those
    cells that its bounds can't rule out. A task holds one block and lets its queries stream by, keeping of each query the k rows that reach its
    bound at most, so neither side is bounded in size, no pair is stored, and the driver sees no query. Null and zero vectors take no part.
    """
    c, q = corpus.schema[id_col], queries.schema[query_id]
    placed, pivots = _place_corpus(corpus, id_col, vector)
    # The similarity that is compared with ``min_sim`` is rounded to four digits.
    asked = _place_queries(queries, query_id, query_vector, pivots, k, -2.0 if min_sim is None else min_sim - 1e-4)
    block_rows = block_rows or max(1, BLOCK_BYTES // max(1, 8 * pivots.rows.shape[-1]))
    blocks = F.array(*(F.lit(max(1, -(-int(n) // block_rows))).cast("long") for n in pivots.count), F.lit(1).cast("long"))
    of_cell = F.get(blocks, F.col("cell").cast("int"))
    # Vectors that are floats on both sides move as floats.
    sides = {corpus.schema[vector].dataType.simpleString(), queries.schema[query_vector].dataType.simpleString()}
    v = F.col("v").cast("array<float>" if sides == {"array<float>"} else "array<double>").alias("v")
    held = placed.select(
        "cell", F.pmod("salt", of_cell).alias("block"), F.lit(None).cast(q.dataType).alias("qid"), "id", v, F.lit(None).cast("double").alias("bound"))
    moved = asked.select("qid", "v", "bound", F.explode("cells").alias("cell")).select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), of_cell - 1)).alias("block"), "qid", F.lit(None).cast(c.dataType).alias("id"), v, "bound")
    together = held.withColumn("asks", F.lit(False)).unionByName(moved.withColumn("asks", F.lit(True)))
    together = together.repartition("cell", "block").sortWithinPartitions("cell", "block", "asks")
    schema = StructType([StructField(query_id, q.dataType), StructField(id_col, c.dataType), *StructType.fromDDL("_sim double").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows, units = None, [], [], None
        for batch in batches:
            cell, block, asks = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("cell", "block", "asks"))
            runs = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])]))
            for start, stop in zip(runs, [*runs[1:], batch.num_rows]):
                if at != (cell[start], block[start]):
                    at, ids, rows, units = (cell[start], block[start]), [], [], None
                part = batch.slice(start, stop - start)
                vectors = part.column(part.schema.get_field_index("v"))
                if not asks[start]:
                    ids += part.column(part.schema.get_field_index("id")).to_pylist()
                    rows.append(unit_rows(vectors, pivots.rows.shape[1]))
                    continue
                if units is None:  # by id, so that of equal similarities the first place is the smallest id
                    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
                    units, ids = (np.concatenate(rows)[order] if rows else np.zeros((0, 0))), pa.array(ids, part.schema.field("id").type).take(pa.array(order, pa.int64()))
                if not len(units):
                    continue
                names = part.column(part.schema.get_field_index("qid"))
                asked_units = unit_rows(vectors, pivots.rows.shape[1])
                bounds = part.column(part.schema.get_field_index("bound")).to_numpy(zero_copy_only=False)
                for first in range(0, len(asked_units), QUERY_BLOCK):
                    some = slice(first, first + QUERY_BLOCK)
                    at_row, place, sims = _best(asked_units[some] @ units.T, bounds[some], k)
                    yield pa.record_batch([names.take(pa.array(first + at_row)), ids.take(pa.array(place)), pa.array(sims, pa.float64())], names=schema.names)

    found = together.select("cell", "block", "asks", "qid", "id", "v", "bound").mapInArrow(scan, schema)
    by_query = Window.partitionBy(query_id).orderBy(F.col("_sim").desc(), id_col)
    top = found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select(
        query_id, id_col, F.round("_sim", 4).alias("similarity"), "rank"
    )
    return top if min_sim is None else top.filter(F.col("similarity") >= min_sim)


def visited_share(
    queries: DataFrame, corpus: DataFrame, k: int = 4, query_id: str = "query_id", query_vector: str = "query_vector",
    id_col: str = "vec_id", vector: str = "embedding",
) -> float:
    """Share of all (query, corpus vector) pairs that ``cosine_top_k`` multiplies."""
    placed, pivots = _place_corpus(corpus, id_col, vector)
    asked = _place_queries(queries, query_id, query_vector, pivots, k, -2.0)
    n = F.array(*(F.lit(int(c)).cast("long") for c in pivots.count), F.lit(0).cast("long"))
    visits, total = asked.agg(F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda s, i: s + F.get(n, i.cast("int")))), F.count("*")).first()
    return (visits or 0) / max(total * placed.count(), 1)


def vector_upsert(store: DataFrame, batch: DataFrame, id_col: str) -> DataFrame:
    """The store with the batch's ids replaced or added; nothing is removed."""
    fresh = dedup_by_key(batch, [id_col])
    return store.join(fresh.select(id_col), id_col, "left_anti").unionByName(fresh)


class VectorStore:
    """Vectors on disk in buckets by a hash of their id; an upsert rewrites only the buckets its ids fall into.

    Each write puts whole buckets into a folder of its own and then records which; a reader takes every bucket from its
    newest record. A run that dies before its record can be repeated, and readers never see half of it.
    """

    RECORDS = "number bigint, buckets array<int>"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, id_col: str, buckets: int = 256) -> None:
        self.spark, self.path, self.schema, self.id_col, self.buckets = spark, path, schema, id_col, buckets
        self._layout = StructType([*schema.fields, *StructType.fromDDL("_write bigint, _bucket int").fields])

    def writes(self) -> dict[int, list[int]]:
        """Buckets of every write; one small record for each."""
        try:
            rows = self.spark.read.schema(self.RECORDS).json(f"{self.path}/_writes").collect()
        except AnalysisException as error:
            if is_missing(error):
                return {}
            raise
        return {r.number: r.buckets for r in rows}

    def _newest(self) -> dict[int, int]:
        return {b: number for number, buckets in sorted(self.writes().items()) for b in buckets}

    def _files(self, buckets: dict[int, int]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self._layout)
        by_write: dict[int, list[int]] = {}
        for b, number in buckets.items():
            by_write.setdefault(number, []).append(b)
        kept = F.lit(False)
        for number, own in by_write.items():
            kept = kept | ((F.col("_write") == number) & F.col("_bucket").isin(own))
        return self.spark.read.schema(self._layout).parquet(self.path).filter(kept)  # folder columns, so other files stay closed

    def read(self) -> DataFrame:
        return self._files(self._newest()).select(*self.schema.names)

    def upsert(self, batch: DataFrame) -> list[int]:
        """Replace or add the batch's ids; returns the rewritten buckets. One shuffle of the batch and of the touched buckets."""
        bucket = F.pmod(F.xxhash64(self.id_col), F.lit(self.buckets)).cast("int")
        fresh = dedup_by_key(batch.select(*self.schema.names), [self.id_col])
        touched = sorted(r[0] for r in fresh.select(bucket).distinct().collect())  # at most all bucket numbers
        if not touched:
            return []
        newest = self._newest()
        stored = self._files({b: newest[b] for b in touched if b in newest}).select(*self.schema.names)
        whole = stored.join(fresh.select(self.id_col), self.id_col, "left_anti").select(*self.schema.names).unionByName(fresh)
        number = max(self.writes(), default=0) + 1
        whole.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/_write={number}")
        self.spark.createDataFrame([(number, touched)], self.RECORDS).coalesce(1).write.mode("append").json(f"{self.path}/_writes")
        return touched
