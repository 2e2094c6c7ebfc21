"""Hierarchical matrices and ratio measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact, exact_sum, guarded_ratio, money


def _depth(levels: Sequence[str]) -> Column:
    shown = F.lit(len(levels)).cast("bigint")
    for c in levels:
        shown = shown - F.grouping(c).cast("bigint")
    return shown.alias("level")


def drill_matrix(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column], summed: bool = False) -> DataFrame:
    """Every measure at every depth of the drill path.

    ``level`` counts the shown columns (0 is the grand total), which tells a subtotal
    from a row whose own value is null. Subtotals collapse before the shuffle. A frame that is ``summed`` holds the
    deepest groups once each, in partitions by some of the levels; these groups stay where they are, and only the depths above move.
    """
    shown = [m.alias(name) for name, m in measures.items()]
    if not summed:
        return df.rollup(*levels).agg(_depth(levels), *shown)
    *upper, last = levels
    deepest = df.groupBy(*levels).agg(F.lit(len(levels)).cast("bigint").alias("level"), *shown)
    above = df.rollup(*upper).agg(_depth(upper), *shown).withColumn(last, F.lit(None).cast(df.schema[last].dataType))
    return deepest.unionByName(above)


def date_hierarchy(df: DataFrame, ts_col: str, amount: str) -> DataFrame:
    """Rows and summed amount by year, quarter, month and day with subtotals.

    Days are aggregated first, so the subtotals expand one row per day rather than the data.
    """
    per_day = df.groupBy(F.to_date(ts_col).alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(exact(amount)).alias("_v")
    ).select(
        F.year("_d").cast("bigint").alias("year"),
        F.concat(F.lit("Qtr "), F.quarter("_d").cast("string")).alias("quarter"),
        F.month("_d").cast("bigint").alias("month_no"),
        F.dayofmonth("_d").cast("bigint").alias("day"),
        "_n", "_v",
    )
    out = drill_matrix(
        per_day, ["year", "quarter", "month_no", "day"],
        {"row_count": F.sum("_n"), "total": money(F.sum("_v")).cast("double")},
    )
    name = F.date_format(F.make_date(F.lit(2000), F.col("month_no").cast("int"), F.lit(1)), "MMMM")
    return out.withColumn("month", name)


def ratio_of_sums(df: DataFrame, by: Sequence[str], numerator: str, denominator: str, name: str = "ratio") -> DataFrame:
    """Sum both columns per group, then divide; the right way to roll up a percentage."""
    sums = df.groupBy(*by).agg(
        exact_sum(numerator).alias(numerator),
        exact_sum(denominator).alias(denominator),
    )
    return sums.withColumn(name, guarded_ratio(numerator, denominator))
