"""Mixing sources to target weights by repeating documents, in DataFrame functions only.

Sizes are summed per source. Weights share a budget, no source gets more than ``limit`` times its own size, and what
exceeds that is shared again among the others. A source's rate is target / size; each of its documents is taken
floor(rate) times, plus once more if a number hashed from seed and key falls below the fraction.

Null sources form one source of their own, placed last. Null texts and texts without words have size 0 and are drawn
like any other. Rows that repeat a key get the same draw. A source without words has rate 0, and so has every source
when nothing has words; an empty table gives an empty result. Columns that clash with added ones are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
BUDGET = 1.5  # of all sizes
LIMIT = 2.0  # times a source's size
BROADCAST_SOURCES = 100_000  # rows of the source table that may be broadcast, about 5 MB
HEX_DIGITS = 13


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from seed and key alone."""
    text = F.coalesce(F.concat(F.lit(f"{seed}/k"), key.cast("string")), F.lit(f"{seed}/n"))
    whole = F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("double")
    return (whole + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))


def source_targets(sizes: DataFrame, source: str, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                   limit: float = LIMIT) -> DataFrame:
    """From one row per source with ``source_size``: its ``target``.

    Sources fill up in the order of cap / weight. The first one whose fair share of what the filled ones leave lies
    below its cap ends the filling; that share per weight holds for it and all after it.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col(source).asc_nulls_last())  # one row per source
    listed = sizes.withColumn("__weight", F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    listed = listed.withColumn("__cap", F.lit(float(limit)) * F.col("source_size"))
    listed = listed.withColumn("__budget", F.lit(float(budget)) * F.sum("source_size").over(everything))
    filling = Window.orderBy(F.col("__cap") / F.col("__weight"), F.col(source).asc_nulls_last())
    earlier, later = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    listed = listed.withColumn("__level", (F.col("__budget") - F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0)))
                               / F.sum("__weight").over(later))
    open_level = F.min(F.when(F.col("__level") * F.col("__weight") <= F.col("__cap"), F.struct(
        (F.col("__cap") / F.col("__weight")).alias("at"), F.col("__level").alias("level")))).over(everything)["level"]
    # No source stays open only if the budget exceeds all caps.
    target = F.least(F.col("__cap"), F.coalesce(open_level * F.col("__weight"), F.col("__cap")))
    return listed.select(source, "source_size", target.alias("target"))


def plan_mix(df: DataFrame, size: str, source: str, key: str, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
             limit: float = LIMIT, seed: str = "mix") -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to every row. ``df`` is read twice.

    Sizes are summed before anything is shuffled. The source table is broadcast if its counted rows are few; beyond
    that the join is left to the planner, which splits a hot source.
    """
    clash = {c.lower() for c in df.columns} & {"source_size", "target", "copies", "__source", "__rate"}
    if clash:
        raise ValueError(f"the table already has columns {sorted(clash)}")
    per_source = df.groupBy(F.col(source).alias("__source")).agg(F.sum(size).alias("source_size"))
    targets = source_targets(per_source, "__source", weights, budget, limit)
    if per_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    joined = df.join(targets, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("__rate"))
    extra = (uniform(F.col(key), seed) < F.col("__rate") - whole).cast("long")
    return joined.withColumn("__rate", rate).withColumn("copies", whole + extra).drop("__rate")


def emit(plan: DataFrame) -> DataFrame:
    """One row per copy, numbered in ``copy`` from 1; documents without copies go."""
    if "copy" in {c.lower() for c in plan.columns}:
        raise ValueError("the table already has a column copy")
    rows = plan.filter("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
