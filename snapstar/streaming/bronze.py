"""Incremental ingestion of landed CSV exports into append-only bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators.snapshots import RESCUED, SNAPSHOT_TS
from ..sources.landing import MANIFEST_SCHEMA, MANIFESTS, is_missing

# Records of the exports in bronze, beside its folders: one for each, with what its rows come to.
EXPORTS = "_exports"
EXPORT_SCHEMA = "at bigint, run_id string, rows bigint, checksum string"


def bronze_stream(spark: SparkSession, landing_dir: str, schema: StructType) -> DataFrame:
    """Landed files as a stream; the checkpoint's file log admits each path once.

    Lines that do not fit the schema keep their text in the rescued column; a file whose
    header names other columns, or the same in another order, stops the run.
    """
    full = schema if RESCUED in schema.fieldNames() else StructType([*schema.fields, StructField(RESCUED, StringType())])
    return (
        spark.readStream.schema(full).option("header", True).option("recursiveFileLookup", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
        .option("enforceSchema", False).csv(landing_dir)
        .withColumn(SNAPSHOT_TS, F.col(SNAPSHOT_TS).cast("timestamp"))
    )


def append_bronze(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and stop. One folder per snapshot lets readers of the
    newest snapshot skip all others."""
    query = (
        df.writeStream.format("parquet").outputMode("append").partitionBy(SNAPSHOT_TS)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def ingest_bronze(
    spark: SparkSession, landing_dir: str, schema: StructType, bronze_dir: str, checkpoint: str
) -> StreamingQuery:
    """One triggered ingestion run; a run without new files adds nothing."""
    return append_bronze(bronze_stream(spark, landing_dir, schema), bronze_dir, checkpoint)


class IncompleteRun(Exception):
    """A run does not hold the rows that its manifest declares."""


class LateRows(Exception):
    """Rows arrived for a snapshot that is already taken in."""


def checksum(columns: Sequence[str]) -> tuple[Column, Column]:
    """Aggregates ``rows`` and ``checksum`` of a frame: sums of two hashes of each row, so neither order nor partitioning matters.
    Columns count by name, nulls count as such, and rows count as often as they occur."""
    cells = [F.col(f"`{c}`") for c in sorted(columns)]
    nulls = F.array(*(c.isNull() for c in cells))  # hashing passes over nulls
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), nulls, *cells).cast("decimal(38,0)")), F.lit(0)).cast("string") for seed in (1, 2)]
    return F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *sums).alias("checksum")


def read_exports(spark: SparkSession, bronze_dir: str) -> list[Row]:
    """The exports in bronze by time, as ingestion recorded them; one small row for each run."""
    try:
        listed = spark.read.schema(EXPORT_SCHEMA).json(f"{bronze_dir}/{EXPORTS}").distinct().orderBy("at").collect()
    except AnalysisException as error:
        if is_missing(error):
            return []
        raise
    for one, two in zip(listed, listed[1:]):
        if one["at"] == two["at"]:
            raise LateRows(f"two exports of {one['at']}: runs {one.run_id} and {two.run_id}")
    return listed


def ingest_runs(
    spark: SparkSession, landing_root: str, table: str, schema: StructType, bronze_dir: str, checkpoint: str
) -> StreamingQuery | None:
    """Take in every whole run that is new; None while no run was ever sealed.

    The stream follows the manifests, which are written last, so rows of an unsealed run stay out. A run whose folder
    holds another number of rows than declared stops the ingestion, and so does a second run of the same snapshot. The pass that counts a
    run's rows also takes their checksum, which is recorded once the rows are in bronze.
    Columns go by name: those the schema lacks are kept as text, those a run lacks are null. A repeated batch replaces the folder of its snapshot and adds nothing.
    """
    manifests = f"{landing_root}/{MANIFESTS}/{table}"
    try:
        listed = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(manifests)
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
    twice = listed.groupBy(SNAPSHOT_TS).agg(F.count_distinct("run_id").alias("runs")).filter("runs > 1").head(1)
    if twice:
        raise LateRows(f"{table}: {twice[0].runs} runs of snapshot {twice[0][SNAPSHOT_TS]}")
    types = {f.name: f.dataType for f in schema}

    def admit(batch: DataFrame, _: int) -> None:
        for run in batch.withColumn("at", F.unix_micros(SNAPSHOT_TS)).collect():  # one small row for each run
            here = [StructField(c, types.get(c, StringType())) for c in run.columns]
            rows = (
                spark.read.schema(StructType([*here, StructField(RESCUED, StringType())])).option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", RESCUED).option("enforceSchema", False).csv(run.folder)
                .withColumn(SNAPSHOT_TS, F.col(SNAPSHOT_TS).cast("timestamp"))
            )
            missing = {c: F.lit(None).cast(kind) for c, kind in types.items() if c not in rows.columns}
            rows = rows.withColumns(missing) if missing else rows
            found = rows.agg(*checksum([c for c in rows.columns if c != SNAPSHOT_TS])).first()
            if found.rows != run.rows:
                raise IncompleteRun(f"{table} run {run.run_id}: {found.rows} of {run.rows} rows")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT_TS).option(
                "compression", "zstd").parquet(bronze_dir)
            record = spark.range(1).coalesce(1).select(
                F.lit(run["at"]).cast("long").alias("at"), F.lit(run.run_id).alias("run_id"), F.lit(found.rows).cast("long").alias("rows"), F.lit(found.checksum).alias("checksum"))
            record.write.mode("append").json(f"{bronze_dir}/{EXPORTS}")

    query = (
        spark.readStream.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(manifests)
        .writeStream.foreachBatch(admit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def read_bronze(spark: SparkSession, bronze_dir: str, schema: StructType) -> DataFrame:
    """Bronze as a batch, with the ingestion schema so that folder names get its types."""
    own = [f for f in schema if f.name not in (SNAPSHOT_TS, RESCUED)]
    added = [StructField(RESCUED, StringType()), StructField(SNAPSHOT_TS, TimestampType())]
    return spark.read.schema(StructType([*own, *added])).parquet(bronze_dir)
