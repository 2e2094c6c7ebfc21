"""Landing area: stamped full exports as CSV, their schemas, and gold table output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.snapshots import SNAPSHOT_TS

# Folder of the run manifests below the landing root.
MANIFESTS = "_manifests"
MANIFEST_SCHEMA = f"run_id string, folder string, columns array<string>, rows bigint, {SNAPSHOT_TS} timestamp"

# Rows of a landed file: compressed files are read whole by a task, so they stay small.
ROWS_A_FILE = 250_000


def is_missing(error: AnalysisException) -> bool:
    """Whether reading failed because nothing was ever written there; any other failure is one."""
    return error.getCondition() == "PATH_NOT_FOUND"


def land_snapshot(frames: Mapping[str, DataFrame], root: str, run_id: str, snapshot_ts: str) -> None:
    """Write one whole export run: ``<root>/<table>/<table>_<run_id>/`` per entity, then its manifests."""
    for table, df in frames.items():
        rows = land_part(df, root, table, run_id, snapshot_ts, mode="errorifexists")
        seal_run(df.sparkSession, root, table, run_id, snapshot_ts, rows)


def land_part(df: DataFrame, root: str, table: str, run_id: str, snapshot_ts: str, mode: str = "append") -> int:
    """Write rows of a run that is not whole yet; returns how many.

    Headers are trimmed and every row carries the run's timestamp. Files are written by
    all tasks in parallel, compressed, and read likewise, a task a file; a run never touches the folder of another.
    """
    seen = Observation()
    stamped = df.toDF(*[c.strip() for c in df.columns]).withColumn(SNAPSHOT_TS, F.lit(snapshot_ts).cast("timestamp"))
    stamped.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("header", True).option(
        "compression", "gzip").option("maxRecordsPerFile", ROWS_A_FILE).csv(f"{root}/{table}/{table}_{run_id}")
    return seen.get["rows"]


def seal_run(spark: SparkSession, root: str, table: str, run_id: str, snapshot_ts: str, rows: int) -> None:
    """Declare a run whole: one small file with its columns and row count, written after its data."""
    folder = f"{root}/{table}/{table}_{run_id}"
    columns = spark.read.option("header", True).csv(folder).columns
    manifest = spark.range(1).coalesce(1).select(
        F.lit(run_id).alias("run_id"), F.lit(folder).alias("folder"), F.array(*map(F.lit, columns)).alias("columns"), F.lit(rows).cast("long").alias("rows"),
        F.lit(snapshot_ts).cast("timestamp").alias(SNAPSHOT_TS))
    manifest.write.mode("errorifexists").json(f"{root}/{MANIFESTS}/{table}/{run_id}")


def infer_csv_schema(spark: SparkSession, folder: str, sampling_ratio: float = 1.0) -> StructType:
    """Types of the landed CSVs, read once; keep the result and pass it to the stream."""
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .option("samplingRatio", sampling_ratio).option("recursiveFileLookup", True).csv(folder).schema
    )


# Types a column of text is tried as, narrowest first; each also holds the values of those before it on its line. Whatever fits
# no type of a line is text.
LATTICE = (("int", "bigint", "double"), ("date", "timestamp"), ("boolean",))


# Every text is of one kind; a type of the lattice holds the kinds up to its own on its line.
KINDS = (*(t for line in LATTICE for t in line), "string")
# What a double looks like: decimal, or hexadecimal with a power of two.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|0[xX][0-9a-fA-F.]+[pP][+-]?\d+)[dDfF]?[\x00-\x20]*$"


def widest_types(df: DataFrame) -> StructType:
    """The narrowest type of the lattice that holds every value of each text column; text if none does, or if there is no value.

    One pass gathers the kinds of value that each column has; the file formats' spelling of numbers and times is Spark's. Null and
    empty text say nothing about a type.
    """
    cells = {f.name: F.nullif(F.trim(F.col(f"`{f.name}`").cast("string")), F.lit("")) for f in df.schema}
    kinds = df.select(*(F.when(c.isNotNull(), _kind(c)).alias(f"{i}") for i, c in enumerate(cells.values())))
    seen = kinds.agg(*(F.bit_or(c).alias(c) for c in kinds.columns)).first()
    holds = [(t, sum(_bit(k) for k in line[:i + 1])) for line in LATTICE for i, t in enumerate(line)]
    fields = []
    for i, name in enumerate(cells):
        fitting = [t for t, bits in holds if seen[i] and not seen[i] & ~bits]
        fields.append(StructField(name, StructType.fromDDL(f"x {fitting[0] if fitting else 'string'}")[0].dataType))
    return StructType(fields)


def _bit(kind: str) -> int:
    return 1 << KINDS.index(kind)


def _kind(text: Column) -> Column:
    """The narrowest type that a text is a value of, as its bit; a date is one without a time of day, a whole number one without a point.

    A text is only cast to types it looks like: a number's cast that fails raises and catches an error, which costs a hundred looks.
    """
    def first(*kinds: str) -> Column:
        return F.coalesce(*(F.when(text.try_cast(k).isNotNull(), F.lit(_bit(k))) for k in kinds), F.lit(_bit("string")))

    whole, day = text.rlike(r"^[+-]?\d+$"), text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return (
        F.when(whole, first("int", "bigint", "double"))
        .when(text.rlike(NUMBER), first("double"))
        .when(day, first("date", "timestamp"))
        .when(text.rlike(r"^\d{4}-"), first("timestamp"))
        .when(F.lower(text).isin("true", "false"), F.lit(_bit("boolean")))
        .otherwise(F.lit(_bit("string")))
    )


def widened(old: StructType, new: StructType) -> StructType:
    """The type that holds the values of both schemas, column by column; columns of either are kept, the old ones first."""
    def join(a: str, b: str) -> str:
        for line in LATTICE:
            if a in line and b in line:
                return max(a, b, key=line.index)
        return a if a == b else "string"

    types = {f.name: f.dataType.simpleString() for f in old}
    for f in new:
        kind = f.dataType.simpleString()
        types[f.name] = join(types[f.name], kind) if f.name in types else kind
    return StructType([StructField(n, StructType.fromDDL(f"x {t}")[0].dataType) for n, t in types.items()])


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """One landed run with every column as text."""
    return spark.read.option("header", True).csv(f"{root}/{table}/{table}_{run_id}")


def widened_schema(spark: SparkSession, root: str, table: str, run_ids: Sequence[str]) -> StructType:
    """Types over all the runs: each run is typed by its own values, and the types are widened run by run."""
    schema = StructType([])
    for run_id in run_ids:
        schema = widened(schema, widest_types(read_run(spark, root, table, run_id)))
    return schema


def retyped(text: DataFrame, schema: StructType, misfits: str = "_misfits") -> DataFrame:
    """Text columns as the types of ``schema``, columns by name. A value that doesn't fit becomes null and is kept, as text under its
    column's name, in the map ``misfits``; columns beyond the schema are kept there, too."""
    known = {f.name: f.dataType for f in schema}
    cells = {c: F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in text.columns}
    values = {c: (cells[c].try_cast(t) if c in cells else F.lit(None).cast(t)) for c, t in known.items()}
    pairs = [F.struct(F.lit(c).alias("k"), F.when(values[c].isNull() if c in known else F.lit(True), v).alias("v")) for c, v in cells.items()]
    kept = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    return text.select(*(v.alias(c) for c, v in values.items()), kept.alias(misfits))


def with_added_columns(spark: SparkSession, root: str, table: str, schema: StructType) -> StructType:
    """The schema and, as text, what sealed runs have beyond it. Manifests are small, one for each run."""
    try:
        listed = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(f"{root}/{MANIFESTS}/{table}")
    except AnalysisException as error:
        if is_missing(error):
            return schema
        raise
    seen = listed.select(F.explode("columns").alias("c")).distinct().orderBy("c").collect()
    added = [StructField(r.c, StringType()) for r in seen if r.c not in schema.fieldNames()]
    return StructType([*schema.fields, *added])


def read_landed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All landed files of one entity as a batch."""
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).csv(folder)
    )


def write_gold(df: DataFrame, path: str) -> None:
    """Replace a table with a full recompute; ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
