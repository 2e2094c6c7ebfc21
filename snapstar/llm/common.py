"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, tune

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows and bytes in one Arrow batch, so that long texts keep Python workers small.
ARROW_ROWS, ARROW_BYTES = "500", str(2 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the Python operators; none depends on the data size."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: lineage ends in files every executor can read.

    ``instead_of`` is a frame from here that nothing reads any more once this one is written; its files are deleted then.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    stored = spark.read.schema(df.schema).parquet(folder)
    stored.scratch_folder = folder
    if instead_of is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(instead_of.scratch_folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return stored


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(values: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, one at a time; null is empty."""
    for value in values:
        yield (value.as_py() or "").encode("utf-8")
