"""The 15 source entities and the generic way from landed files to silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.columns import invoice_status, serial_to_date, with_invoice_status
from ..operators.history import apply_snapshot_scd1
from ..operators.snapshots import RESCUED, SNAPSHOT_TS, dedup_by_key, latest_snapshot
from ..sources.landing import is_missing, with_added_columns, write_gold
from ..streaming.bronze import LateRows, ingest_runs, read_bronze, read_exports
from ..streaming.history import AT, Export, HistoryTable, View, micros


@dataclass(frozen=True)
class EntityConfig:
    """How one entity is typed, keyed and kept."""

    name: str
    keys: tuple[str, ...]
    scd_type: int = 2
    serial_dates: tuple[str, ...] = ()
    has_invoice_status: bool = False
    untracked: tuple[str, ...] = (SNAPSHOT_TS, RESCUED)


ENTITIES: Mapping[str, EntityConfig] = {
    e.name: e
    for e in (
        EntityConfig("projects", ("project_id",)),
        EntityConfig("budget_plan", ("budget_item_id",)),
        EntityConfig("procurement_plan", ("evidence_number",)),
        EntityConfig("procurement_procedures", ("procedure_id",),
                     serial_dates=("publication_date", "selection_decision_date")),
        EntityConfig("procurement_bids", ("bid_id",)),
        EntityConfig("contracts", ("contract_id",), serial_dates=("signature_date", "contract_deadline")),
        EntityConfig("contract_annexes", ("annex_id",), serial_dates=("annex_date", "new_deadline")),
        EntityConfig("purchase_orders", ("purchase_order_id",), serial_dates=("order_date",)),
        EntityConfig("invoices", ("invoice_id",), serial_dates=("issue_date", "due_date", "payment_date"),
                     has_invoice_status=True),
        EntityConfig("cpv_lookup", ("cpv_code",), scd_type=1),
        EntityConfig("department_lookup", ("department_id",), scd_type=1),
        EntityConfig("supplier_lookup", ("supplier_id",), scd_type=1),
        EntityConfig("dashboard_summary", ("metric",), scd_type=1),
        EntityConfig("summary_by_year", ("year",), scd_type=1),
        EntityConfig("source_notes", ("source_name",), scd_type=1),
    )
}


def typed(df: DataFrame, cfg: EntityConfig, as_of_date: dt.date | str | Column | None = None) -> DataFrame:
    """Cast serial dates and derive the entity's extra columns."""
    out = df.withColumns({c: serial_to_date(c) for c in cfg.serial_dates}) if cfg.serial_dates else df
    if cfg.has_invoice_status:
        if as_of_date is None:
            raise ValueError("invoice status needs an as-of date")
        out = with_invoice_status(out, as_of_date)
    return out


def _derived(cfg: EntityConfig, seen: Column) -> dict[str, Column]:
    """The typed columns that depend on the date an entity is seen on."""
    return invoice_status(seen) if cfg.has_invoice_status else {}


def latest_typed(bronze: DataFrame, cfg: EntityConfig, as_of_date: dt.date | str | None = None) -> DataFrame:
    """The newest snapshot of an entity, typed, one row per key."""
    return dedup_by_key(typed(latest_snapshot(bronze), cfg, as_of_date), cfg.keys)


def ingest_entity(
    spark: SparkSession, cfg: EntityConfig, root: str, schema: StructType,
    as_of_date: dt.date | str | None = None, every_snapshot: bool = True,
) -> DataFrame:
    """One run for one entity below ``root``: landing to bronze to silver; returns silver.

    Only whole runs are taken in. An invoice's status is the one on its snapshot's own date; the newest snapshot is then
    seen again on ``as_of_date``, so that a later run date opens versions without a new export. Such a re-dating is kept apart from
    exports: one that arrives later, stamped up to that date or like it, takes its own place in the history.
    A lookup's state goes to a folder of its own per snapshot and counts once its commit record exists; without a new
    snapshot nothing is written. ``schema`` is the landed files' schema; columns that only later runs have are carried
    as text, null in versions from before. ``every_snapshot`` applies all snapshots that
    arrived since the last run in one pass, otherwise just the newest one.
    """
    bronze_dir, silver_dir = f"{root}/bronze/{cfg.name}", f"{root}/silver/{cfg.name}"
    schema = with_added_columns(spark, f"{root}/landing", cfg.name, schema)
    ingest_runs(spark, f"{root}/landing", cfg.name, schema, bronze_dir, f"{root}/_checkpoints/{cfg.name}")
    exports = [Export(r["at"], r["rows"], r["checksum"]) for r in read_exports(spark, bronze_dir)]
    if exports:
        bronze = read_bronze(spark, bronze_dir, schema)
    else:  # no whole run so far
        bronze = spark.createDataFrame([], StructType([f for f in schema if f.name != SNAPSHOT_TS] + [
            StructField(RESCUED, StringType()), StructField(SNAPSHOT_TS, TimestampType())]))
    own_date = F.to_date(SNAPSHOT_TS)
    if cfg.scd_type == 1:
        return _keep_lookup(spark, typed(latest_snapshot(bronze), cfg, own_date), cfg, silver_dir, exports)
    history = HistoryTable(spark, silver_dir, typed(bronze, cfg, own_date).schema, cfg.keys, cfg.untracked)
    if not every_snapshot:
        known = {v.export for v in history.views()}
        exports = [e for e in exports if e in known or e == exports[-1]]
    redate = micros(spark, str(as_of_date)) if cfg.has_invoice_status and as_of_date is not None else None
    history.catch_up(exports, lambda views: _as_seen(bronze, cfg, views), redate, lambda at: _derived(cfg, F.to_date(at)))
    return history.read()


def _as_seen(bronze: DataFrame, cfg: EntityConfig, views: Sequence[View]) -> DataFrame:
    """Rows of some views, typed on the date of each. Exports at their own time are read together, one folder each."""
    at = F.unix_micros(SNAPSHOT_TS)

    def of(times: list[int]) -> DataFrame:
        return bronze.filter(F.col(SNAPSHOT_TS).isin(*(F.timestamp_micros(F.lit(t)) for t in times)))

    own = [v.at for v in views if v.is_export]
    parts = [typed(of(own), cfg, F.to_date(SNAPSHOT_TS)).withColumn(AT, at)] if own else []
    for v in views:
        if not v.is_export:
            seen = F.to_date(F.timestamp_micros(F.lit(v.at)))
            parts.append(typed(of([v.export.at]), cfg, seen).withColumn(AT, F.lit(v.at).cast("long")))
    return reduce(DataFrame.unionByName, parts)


LOOKUP_RECORDS = "version bigint, rows bigint, checksum string"


def _keep_lookup(spark: SparkSession, fresh: DataFrame, cfg: EntityConfig, path: str, exports: Sequence[Export]) -> DataFrame:
    """Store the newest state of a lookup if it is new, and read the last committed one. Other rows under a known time raise."""
    try:
        known = {r.version: r.checksum for r in spark.read.schema(LOOKUP_RECORDS).json(f"{path}/_commits").collect()}
    except AnalysisException as error:
        if not is_missing(error):
            raise
        known = {}
    for e in exports:
        if known.get(e.at, e.checksum) != e.checksum:
            raise LateRows(f"{cfg.name} snapshot {e.at}: other content than was applied")
    if exports and exports[-1].at not in known:
        newest = exports[-1]
        write_gold(apply_snapshot_scd1(fresh, fresh, cfg.keys), f"{path}/_version={newest.at}")
        spark.createDataFrame([(newest.at, newest.rows, newest.checksum)], LOOKUP_RECORDS).coalesce(1).write.mode("append").json(f"{path}/_commits")
        known[newest.at] = newest.checksum
    if not known:
        return fresh.limit(0)
    return spark.read.schema(fresh.schema).parquet(f"{path}/_version={max(known)}")
