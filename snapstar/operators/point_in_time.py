"""Lookups of many timestamps in a history: which version of its key was valid when an event happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .snapshots import END, START

# Events of one key beyond which it is dealt out by time, and into how many ranges.
HOT_EVENTS, RANGES = 1_000_000, 64


def valid_versions(
    events: DataFrame, history: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str],
    hot_events: int = HOT_EVENTS, ranges: int = RANGES,
) -> DataFrame:
    """Every event with ``columns`` of the version that was valid at its time ``at``; null if there was none.

    Events and versions meet in one union, sorted by key and time, where the last version is carried on to the events after it: the
    work is a sort of both sides, whatever the number of events and versions of a key. Keys with more than ``hot_events`` events are cut
    into ``ranges`` time ranges with about as many events each; a version goes to every range that it touches, so each range starts with the
    version it inherits. A key's versions do not overlap, so this repeats at most one version per range.

    A version is valid from its start to before its end. Null times have no version; null keys equal each other. Keys are columns of
    both frames, and further columns with equal names are kept apart.
    """
    spark = events.sparkSession
    key = [F.col(k) for k in keys]
    asked = events.select(F.struct(*key).alias("_key"), F.unix_micros(F.col(at).cast("timestamp")).alias("_at"),
                          F.struct(*(F.col(f"`{c}`") for c in events.columns)).alias("_event"))
    known = history.select(F.struct(*key).alias("_key"), F.unix_micros(START).alias("_at"), F.unix_micros(END).alias("_until"),
                           F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_version"))

    crowded = asked.filter(F.col("_at").isNotNull()).groupBy("_key").count().filter(F.col("count") > hot_events).select("_key")
    folder = scratch_dir(spark, "hot-keys")
    crowded.write.parquet(folder)
    crowded = spark.read.schema(crowded.schema).parquet(folder)
    if crowded.isEmpty():
        asked, known = (df.withColumn("_range", F.lit(0)) for df in (asked, known))
    else:
        cuts = [i / ranges for i in range(1, ranges)]
        same = F.col("_key").eqNullSafe(F.col("_hot"))
        hot = crowded.select(F.col("_key").alias("_hot"))
        bounds = asked.join(hot, same).groupBy("_hot").agg(F.percentile_approx("_at", cuts).alias("_bounds"))
        place = lambda t: F.size(F.filter(F.coalesce("_bounds", F.array().cast("array<bigint>")), lambda b: b <= t))
        asked = asked.join(bounds, same, "left").select("_key", "_at", "_event", F.coalesce(place(F.col("_at")), F.lit(0)).alias("_range"))
        # The end is not part of a version; one that ends on a bound doesn't reach the next range.
        last = F.when(F.col("_until").isNull(), F.coalesce(F.size("_bounds"), F.lit(0))).otherwise(
            F.greatest(place(F.col("_until") - 1), place(F.col("_at"))))
        known = known.join(bounds, same, "left").select("_key", "_at", "_until", "_version", F.explode(F.sequence(place(F.col("_at")), last)).alias("_range"))

    version = F.struct("_until", "_version")
    rows = known.select("_key", "_range", "_at", F.lit(0).alias("_order"), version.alias("_from"), F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"))
    rows = rows.unionByName(asked.select("_key", "_range", "_at", F.lit(1).alias("_order"), F.lit(None).cast(rows.schema["_from"].dataType).alias("_from"), "_event"))
    so_far = Window.partitionBy("_key", "_range").orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.withColumn("_from", F.last("_from", ignorenulls=True).over(so_far)).filter("_order = 1")
    valid = F.col("_at").isNotNull() & (F.col("_from._until").isNull() | (F.col("_from._until") > F.col("_at")))
    found = F.when(valid, F.col("_from._version"))
    clash = {c for c in columns if c in events.columns}
    return carried.select("_event.*", *(found[c].alias(f"valid_{c}" if c in clash else c) for c in columns))
