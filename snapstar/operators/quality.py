"""Expectations and integrity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ExpectationFailed(Exception):
    """A fail-hard expectation was violated."""


def _holds(predicate: Column | str) -> Column:
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(condition, F.lit(False))


def expect(
    df: DataFrame, name: str, predicate: Column | str, action: str = "fail",
    observation: Observation | None = None,
) -> DataFrame:
    """Attach a row expectation; a null predicate counts as a violation.

    ``warn`` keeps every row and counts violations in ``observation`` while the job runs;
    ``drop`` removes violating rows; ``fail`` aborts the job that reads the first one.
    None of them adds a pass over the data.
    """
    ok = _holds(predicate)
    if action == "drop":
        return df.filter(ok)
    if action == "warn":
        seen = observation or Observation(name)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("violations"))
    if action == "fail":
        return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation failed: {name}"))))
    raise ValueError(f"unknown action {action!r}")


def check(df: DataFrame, name: str, predicate: Column | str) -> DataFrame:
    """One row: expectation name, rows seen, rows in violation."""
    ok = _holds(predicate)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("violations")).select(
        F.lit(name).alias("expectation"), "rows", "violations"
    )


def require(df: DataFrame, name: str, predicate: Column | str) -> None:
    """Count violations now and raise if there are any."""
    found = check(df, name, predicate).first()
    if found["violations"]:
        raise ExpectationFailed(f"{name}: {found['violations']} of {found['rows']} rows")


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries per key; a unique key has ``num_entries`` 1 throughout."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_entries"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return uniqueness(df, keys).filter(F.col("num_entries") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Distinct child keys without a parent; null keys refer to nothing and are left out."""
    keys = child.select(F.col(fk)).filter(F.col(fk).isNotNull()).distinct()
    return keys.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def fk_containment(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Share of distinct child keys found in the parent, in percent."""
    keys = child.select(F.col(fk).alias("_k")).filter(F.col(fk).isNotNull()).distinct()
    known = parent.select(F.col(pk).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    return keys.join(known, "_k", "left").agg(
        F.count(F.lit(1)).alias("child_keys"), F.count("_hit").alias("matched_keys")
    ).withColumn(
        "containment_pct",
        F.round(F.when(F.col("child_keys") > 0, F.col("matched_keys") * 100.0 / F.col("child_keys")).cast("double"), 4),
    )


def relationship_check(
    a: DataFrame, ka: str, b: DataFrame, kb: str, cardinality: str = "many_to_one"
) -> DataFrame:
    """Test a declared ``one_to_one`` or ``many_to_one`` relationship from ``a`` to ``b``.

    Each side is counted per key first, so the join meets every key once.
    """
    left = a.filter(F.col(ka).isNotNull()).groupBy(F.col(ka).alias("_k")).agg(F.count(F.lit(1)).alias("_a"))
    right = b.filter(F.col(kb).isNotNull()).groupBy(F.col(kb).alias("_k")).agg(F.count(F.lit(1)).alias("_b"))
    found = left.join(right, "_k", "full_outer").agg(
        F.count_if(F.col("_a") > 1).alias("repeated_from_keys"),
        F.count_if(F.col("_b") > 1).alias("repeated_to_keys"),
        F.count_if(F.col("_b").isNull()).alias("orphan_keys"),
    )
    holds = (F.col("repeated_to_keys") == 0) & (F.col("orphan_keys") == 0)
    if cardinality == "one_to_one":
        holds = holds & (F.col("repeated_from_keys") == 0)
    elif cardinality != "many_to_one":
        raise ValueError(f"unknown cardinality {cardinality!r}")
    return found.select(F.lit(cardinality).alias("declared"), "*", holds.alias("holds"))


def schema_drift(spark: SparkSession, old: StructType, new: StructType) -> DataFrame:
    """Columns that appeared, vanished or changed type between two schemas."""
    was = {f.name: f.dataType.simpleString() for f in old}
    now = {f.name: f.dataType.simpleString() for f in new}
    rows = [(c, "missing", t, None) for c, t in was.items() if c not in now]
    rows += [(c, "new", None, t) for c, t in now.items() if c not in was]
    rows += [(c, "retyped", was[c], now[c]) for c in was if c in now and was[c] != now[c]]
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string")
