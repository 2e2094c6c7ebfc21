"""Snapshot filters, deduplication and lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START = "__START_AT"
END = "__END_AT"
SNAPSHOT_TS = "_snapshot_ts"
RESCUED = "_rescued_data"


def latest_snapshot(df: DataFrame, ts_col: str = SNAPSHOT_TS) -> DataFrame:
    """Rows of the newest snapshot.

    The maximum is a scalar subquery, so it prunes partitions when the data is
    partitioned by ``ts_col`` and moves no row of the big side.
    """
    newest = df.select(F.max(ts_col)).scalar()
    return df.filter(F.col(ts_col) == newest)


def current(df: DataFrame) -> DataFrame:
    """Open versions of a type 2 history."""
    return df.filter(F.col(END).isNull())


def as_of(df: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """Versions that were valid at ``ts``."""
    at = F.lit(str(ts)).cast("timestamp")
    return df.filter((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


def slice_by(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Keep the selected values; an empty selection keeps everything."""
    return df.filter(F.col(column).isin(*values)) if values else df


def slicer_values(df: DataFrame, column: str) -> DataFrame:
    """What a slicer offers for selection."""
    return df.select(column).distinct()


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all other columns.

    A rank limit of one is applied within every map task before the shuffle (Spark's
    window group limit), so copies collapse early and a key that holds a large share of
    the rows sends one row per task, like any other.
    """
    first = list(order_by or ())
    rest = first + [c for c in df.columns if c not in keys and c not in first]
    if not rest:
        return df.select(*keys).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def lookup_join(big: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join ``big`` to a lookup that is unique per ``on``; any kind of join.

    The planner broadcasts a lookup whose size it knows to be small and otherwise shuffles both sides, where adaptive
    execution splits a key that holds most of ``big``.
    """
    return big.join(lookup, on, how)
