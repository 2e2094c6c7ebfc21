"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on; none of them depends on the data size. A skewed join is
# split even where the aggregate above it then needs a shuffle of its own. Shuffle files go
# when their job is done; otherwise they stay until the driver happens to collect its garbage.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# Adaptive execution only merges partitions, so a session that never sized its shuffles starts them with many.
UNSIZED, INITIAL_PARTITIONS = "200", "4096"
# Bytes, compressed, that a task takes from files or from a shuffle. A task sorts or hashes what it takes, several operators at a time, in
# rows up to thirty times as large; Spark's own sizes come to gigabytes a task once tables are large enough to fill them. Setting -> (Spark's
# own value, the one used instead); a session that chose a size keeps it.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", "16MB"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "16MB"),
}


# A row group of a file can't be split, so a task that sorts or hashes what it scans holds whole row groups, which grow with the file. Rows of
# larger files are dealt out in pieces of PIECE bytes first. Up to MOST_OPEN pieces a task writes rows straight to files and holds none of them
# (spark.shuffle.sort.bypassMergeThreshold); only beyond LARGEST bytes a piece there are more.
PIECE, MOST_OPEN, LARGEST = 4 << 20, 200, 64 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Apply the defaults to a session created elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get("spark.sql.shuffle.partitions") == UNSIZED and spark.conf.get(initial, None) is None:
        spark.conf.set(initial, INITIAL_PARTITIONS)
    for key, (own, used) in TASK_BYTES.items():
        if spark.conf.get(key) == own:
            spark.conf.set(key, used)
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a stored file or folder, from its listing; no file is opened."""
    return spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0


# A key is hot if it has more than FEW rows and more than one in MOST_OPEN: it would double a piece. The sketch that tells counts the most
# frequent of KEYS_COUNTED keys.
FEW, KEYS_COUNTED = 10_000, 10_000


def _heaviest_key(df: DataFrame, keys: tuple[str, ...]) -> tuple[int, int]:
    """Rows of a frame, and those of its heaviest key if it stands out; one pass over the keys with a sketch of bounded size."""
    found = df.select(F.xxhash64(*keys).alias("k")).agg(
        F.get(F.expr(f"approx_top_k(k, 1, {KEYS_COUNTED})"), F.lit(0))["count"].alias("most"), F.count(F.lit(1)).alias("rows")).first()
    return found["rows"], found["most"] or 0


def has_hot_key(df: DataFrame, *keys: str) -> bool:
    """Whether a key holds far more rows than others. It moves cost only."""
    rows, most = _heaviest_key(df, keys)
    return most > max(FEW, rows // MOST_OPEN)


def is_large_and_even(df: DataFrame, *keys: str) -> bool:
    """Whether there are more than a few rows, and no key holds far more of them than others. It moves cost only."""
    rows, most = _heaviest_key(df, keys)
    return rows > FEW and most <= max(FEW, rows // MOST_OPEN)


def deal_out(df: DataFrame, stored: int, *keys: str) -> DataFrame:
    """The rows of files of ``stored`` bytes in even pieces, whatever their row groups and values; files below ``PIECE`` stay as they are.

    Rows are dealt by their position in the file, so a repeated task deals them alike and equal rows don't meet in one piece. With ``keys``, of
    which none may be hot, they are dealt by these: steps by the same keys then move no row again.
    """
    if stored <= PIECE:
        return df
    pieces = max(min(-(-stored // PIECE), MOST_OPEN), -(-stored // LARGEST), min(df.sparkSession.sparkContext.defaultParallelism, MOST_OPEN))
    return df.repartition(pieces, *(keys or [F.monotonically_increasing_id()]))


def local_session(app: str = "snapstar", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which names storage that all executors share.

    A cluster has to name it, and tests and the benchmark do. A local session that doesn't, where driver and executor
    are one process, gets a folder for the rest of the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="snapstar-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_scratch(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`scratch_dir` named, or one in it, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
