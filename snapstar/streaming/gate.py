"""Expectations on a stream: rows that hold go on, refused rows go to quarantine, and every micro-batch is counted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

REASONS, BATCH, PLACE = "_refused_by", "_batch", "_place"
METRICS = "expectations"


def marked(df: DataFrame, expectations: Mapping[str, Column | str]) -> DataFrame:
    """Rows with the names of the expectations they violate; a null result counts as a violation."""
    refusals = [F.when(~F.coalesce(F.expr(p) if isinstance(p, str) else p, F.lit(False)), F.lit(n)) for n, p in expectations.items()]
    return df.withColumn(REASONS, F.filter(F.array(*refusals).cast("array<string>"), lambda n: n.isNotNull()))


class BatchCounts(StreamingQueryListener):
    """Rows, refused rows and violations of each expectation, by batch, as the running query observed them."""

    def __init__(self) -> None:
        self.batches: dict[int, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(METRICS)
        if observed is not None and observed["rows"]:
            self.batches[event.progress.batchId] = observed.asDict()


def gate_stream(stream: DataFrame, expectations: Mapping[str, Column | str], path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived below ``path``, split into kept and refused rows of each micro-batch, and stop.

    Both leave in one job, to folders of their own. Counts are observed while it runs, so they cost no pass; a listener such as
    ``BatchCounts`` receives them. A batch that is retried replaces its own folders, so each row is in one of the two places
    exactly once.
    """
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("refused"),
              *(F.count_if(F.array_contains(REASONS, n)).alias(n) for n in expectations)]
    watched = marked(stream, expectations).observe(METRICS, *counts)

    def split(batch: DataFrame, number: int) -> None:
        batch.withColumn(PLACE, F.when(F.size(REASONS) == 0, "kept").otherwise("refused")).write.mode("overwrite").partitionBy(
            PLACE).parquet(f"{path}/{BATCH}={number}")

    query = watched.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_gate(spark: SparkSession, path: str, schema: StructType, refused: bool = False) -> DataFrame:
    """Rows that were kept, or those in quarantine with the names of what refused them; the other folders stay closed."""
    layout = StructType([*schema.fields, *StructType.fromDDL(f"{REASONS} array<string>, {BATCH} bigint, {PLACE} string").fields])
    rows = spark.read.schema(layout).parquet(path).filter(F.col(PLACE) == ("refused" if refused else "kept"))
    return rows.select(*schema.names, *([REASONS] if refused else []), BATCH)
