"""Call traces: JSON lines of model and tool calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import exact

# Both record shapes in one schema; fields a shape lacks are null.
TRACE_SCHEMA = (
    "event string, ts timestamp, model string, tool string, input string, "
    "elapsed_s double, input_tokens bigint, output_tokens bigint"
)


# Size of a stored quantile sketch; a rank read from it is off by less than RANK_ERROR of all rows.
SKETCH_K, RANK_ERROR = 400, 0.0133
# Size of a stored distinct-count sketch, as a power of two; its relative error is about 1 %.
DISTINCT_K = 13


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """Trace records with an explicit schema, so reading needs no inference pass."""
    return spark.read.schema(TRACE_SCHEMA).json(path)


def append_traces(df: DataFrame, path: str) -> None:
    """Add records to the log."""
    df.write.mode("append").json(path)


def trace_summary(df: DataFrame, by: Sequence[str] = ("event",), quantiles: Sequence[float] = ()) -> DataFrame:
    """Calls, time and tokens per group; ``quantiles`` adds sketched latency quantiles."""
    seconds = F.sum(exact("elapsed_s"))
    measures = [
        F.count(F.lit(1)).alias("calls"),
        seconds.cast("double").alias("total_s"),
        F.round(seconds.cast("double") / F.count("elapsed_s"), 4).alias("avg_s"),
        F.max("elapsed_s").alias("max_s"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    ]
    measures += [F.percentile_approx("elapsed_s", q).alias(f"p{round(q * 100)}_s") for q in quantiles]
    return df.groupBy(*by).agg(*measures)


def daily_sketches(df: DataFrame, by: Sequence[str] = ("event",), value: str = "elapsed_s", distinct: str = "input") -> DataFrame:
    """One row per group and day: rows, a quantile sketch of ``value`` and a sketch of the distinct values of ``distinct``.

    Sketches have a fixed size however many rows a day has. They are kept: any range of days is answered by merging them,
    without reading the days again.
    """
    seen = F.col(distinct).cast("string")
    return df.groupBy(*by, F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("calls"), F.count(value).alias("timed"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_K)).alias("quantiles"),
        F.hll_sketch_agg(seen, DISTINCT_K).alias("distincts"))


def merged_summary(
    sketches: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ("event",), first: str | None = None, last: str | None = None,
) -> DataFrame:
    """Calls, quantiles and distinct values per group over the days from ``first`` to ``last``, from their sketches alone."""
    chosen = sketches
    if first is not None:
        chosen = chosen.filter(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        chosen = chosen.filter(F.col("day") <= F.lit(last).cast("date"))
    merged = chosen.groupBy(*by).agg(
        F.sum("calls").alias("calls"), F.sum("timed").alias("timed"),
        F.kll_merge_agg_double(F.when(F.col("timed") > 0, F.col("quantiles"))).alias("_q"), F.hll_union_agg("distincts").alias("_d"))
    levels = [F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("_q", F.lit(float(q)))).alias(f"p{round(q * 100)}_s") for q in quantiles]
    return merged.select(*by, "calls", "timed", *levels, F.hll_sketch_estimate("_d").alias("distinct_values"))


def rank_errors(df: DataFrame, answers: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ("event",), value: str = "elapsed_s") -> DataFrame:
    """Whether each sketched quantile's exact rank among the group's rows is within ``RANK_ERROR``: one more pass over the rows."""
    both = df.filter(F.col(value).isNotNull()).join(answers.select(*by, *(f"p{round(q * 100)}_s" for q in quantiles)), list(by))

    def within(q: float) -> Column:
        told = F.col(f"p{round(q * 100)}_s")
        below, upto = F.count_if(F.col(value) < told), F.count_if(F.col(value) <= told)
        slack, at = F.lit(RANK_ERROR) * F.count(F.lit(1)), F.lit(q) * F.count(F.lit(1))
        return (below <= at + slack) & (upto >= at - slack)

    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("timed"), *(within(q).alias(f"p{round(q * 100)}_within") for q in quantiles))
