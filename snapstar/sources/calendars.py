"""Calendar tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The range of the standing calendar dimension.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2035-12-31"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day with its parts, names and weekend flag."""
    first = dt.date.fromisoformat(start)
    days = (dt.date.fromisoformat(end) - first).days + 1
    day = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    weekday = F.weekday("date")  # Monday is 0
    return spark.range(days).select(day.alias("date")).select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "EEEE").alias("day_of_week_name"),
        (weekday >= 5).alias("is_weekend"),
    )


def calendar_for(df: DataFrame, column: str) -> DataFrame:
    """Days from 1 January of the column's first year to 31 December of its last.

    Only one row of bounds comes out of the data; it unfolds into at most one row per day.
    """
    bounds = df.agg(F.min(F.to_date(column)).alias("_lo"), F.max(F.to_date(column)).alias("_hi"))
    span = F.sequence(
        F.make_date(F.year("_lo"), F.lit(1), F.lit(1)), F.make_date(F.year("_hi"), F.lit(12), F.lit(31)))
    quarter_no = F.quarter("date")
    return bounds.filter(F.col("_lo").isNotNull()).select(F.explode(span).alias("date")).select(
        "date",
        F.year("date").alias("year"),
        quarter_no.alias("quarter_no"),
        F.concat(F.lit("Qtr "), quarter_no.cast("string")).alias("quarter"),
        F.month("date").alias("month_no"),
        F.date_format("date", "MMMM").alias("month"),
        F.dayofmonth("date").alias("day"),
    )
