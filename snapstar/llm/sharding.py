"""Weighted rendezvous sharding of records by a stable key, in DataFrame functions only.

A shard s of weight w scores ``-ln(u) / w`` for a key, with u a uniform number taken from MD5 of key and shard; the
lowest score wins. A shard gets a share of keys in proportion to its weight, and another shard takes rows only into
itself, because the scores of the others stay as they were.

Null keys count as one key of their own, distinct from every text. Rows that repeat a key share its shard and get
different slots. An empty table gives an empty result. Columns that clash with the added ones are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HEX_DIGITS = 13  # 52 bits, which a double holds exactly
BUCKETS = 256  # parts into which each shard is numbered; bounds the offset table at shards x BUCKETS rows


def _digest(key: Column, suffix: str) -> Column:
    """MD5 of key and suffix; a null key can't meet a text key, as the two have different prefixes."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))
    return F.md5(F.concat(text, F.lit(f"/{suffix}")).cast("binary"))


def score(key: Column, shard: int, weight: float) -> Column:
    """What a key scores for a shard; the lowest of all shards wins."""
    whole = F.conv(F.substring(_digest(key, str(shard)), 1, HEX_DIGITS), 16, 10).cast("double")
    uniform = (whole + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))
    return -F.log(uniform) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the winning shard; equal scores go to the smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    ranked = [F.struct(score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return (F.least(*ranked) if len(ranked) > 1 else ranked[0])["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] = ()) -> DataFrame:
    """Add ``shard`` under the weights and ``grown_shard`` with the ``grown`` shards appended. No shuffle."""
    _refuse(df, "shard", "grown_shard")
    out = df.withColumn("shard", shard_of(F.col(key), weights))
    return out.withColumn("grown_shard", shard_of(F.col(key), [*weights, *grown]) if grown else F.lit(None).cast("int"))


def number_slots(df: DataFrame, key: str, order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Add ``slot``: consecutive numbers from 0 within each ``shard``, in the order of key bucket, key and ``order``.

    No task sees a whole shard. Rows are ranked in hash buckets of a shard, and a bucket's first slot is the number of
    rows in the buckets before it, from one small aggregate. The frame is read twice, so it should be a stored one.
    """
    _refuse(df, "slot", "__bucket", "__first", "__rank")
    bucket = F.conv(F.substring(_digest(F.col(key), "slot"), 1, 8), 16, 10).cast("long") % buckets
    placed = df.withColumn("__bucket", bucket)
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "__bucket").agg(F.count("*").alias("__rows")).select(
        "shard", "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("shard", "__bucket").orderBy(F.col(key), *order)
    ranked = placed.withColumn("__rank", F.row_number().over(within) - 1)
    # At most shards x buckets rows, whatever the table holds.
    joined = ranked.join(F.broadcast(firsts), ["shard", "__bucket"])
    return joined.withColumn("slot", F.col("__first") + F.col("__rank")).drop("__bucket", "__first", "__rank")


def shard_table(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] = (), order: Sequence[str] = ()) -> DataFrame:
    """Shards and slots of every row. The assignment is stored once, so that counting and numbering agree."""
    return number_slots(materialize(assign_shards(df, key, weights, grown), "shards"), key, order)


def _refuse(df: DataFrame, *names: str) -> None:
    clash = {c.lower() for c in df.columns} & set(names)
    if clash:
        raise ValueError(f"the table already has columns {sorted(clash)}")
