"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import AWARDED, date_to_serial, exact_sum
from ..functions.measures import awarded_amount, count_other_than, rejected_amount, selected_value, sum_where
from ..operators import history, matrix, point_in_time, profile, quality, relations, surface, vectors
from ..operators.snapshots import (
    END, RESCUED, SNAPSHOT_TS, START, as_of, current, dedup_by_key, latest_snapshot,
    slice_by, slicer_values,
)
from ..session import delete_scratch, scratch_dir, tune
from ..sources import calendars, landing, traces
from ..streaming import gate
from ..streaming.bronze import ingest_bronze, read_bronze
from ..streaming.history import HistoryTable, follow_snapshots
from . import report
from .gold import build_gold, side_by_side
from .entities import ENTITIES, ingest_entity
from .metadata import GOLD_TABLES, PRIMARY_KEYS, RELATIONSHIPS
from .sample_model import AS_OF, LINE, SampleModel

Query = Callable[[SparkSession, str], DataFrame]
UNTRACKED = (SNAPSHOT_TS, RESCUED)
REGISTER = ["order_id", "customer_id", "status", "amount", START, END]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[SampleModel], DataFrame]], None]:
    """Register a function of the sample model under ``name``."""

    def register(build: Callable[[SampleModel], DataFrame]) -> None:
        QUERIES[name] = lambda spark, sf_dir: build(SampleModel(tune(spark), sf_dir))

    return register


# Gold tables and their uniqueness gates

GOLD_QUERIES = {
    "avg_payment_delay_kpi": "mv_avg_payment_delay_kpi",
    "dim_department": "dim_department",
    "dim_supplier": "dim_supplier",
    "dim_cpv": "dim_cpv",
    "dim_project": "dim_project",
    "dim_contract": "dim_contract",
    "dim_procedure": "dim_procedure",
    "invoices": "fact_invoices",
    "purchase_orders": "fact_purchase_orders",
    "contract_financials": "fact_contract_financials",
    "procurement_bids": "fact_procurement_bids",
    "procurement_performance": "fact_procurement_performance",
    "project_financials": "fact_project_financials",
    "procurement_savings_kpi": "mv_procurement_savings_kpi",
    "project_realization_kpi": "mv_project_realization_kpi",
}
for _name, _table in GOLD_QUERIES.items():
    query(_name)(lambda m, t=_table: m.gold[t])
for _table, _key in PRIMARY_KEYS.items():
    if _table != "dim_date":
        query(f"uniqueness_{_table}")(lambda m, t=_table, k=_key: quality.uniqueness(m.gold[t], [k]))


@query("uniqueness_dim_date")
def _(m: SampleModel) -> DataFrame:
    """The calendar's gate, on the calendar that spans the orders."""
    return quality.uniqueness(calendars.calendar_for(m.table("orders"), "o_orderdate"), ["date"])


@query("expect_unique_violations")
def _(m: SampleModel) -> DataFrame:
    counted = quality.uniqueness(m.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return quality.check(counted, "unique_line", "num_entries = 1")


@query("expect_fail")
def _(m: SampleModel) -> DataFrame:
    """A gate that holds lets every row through; one that doesn't stops its job."""
    counted = quality.uniqueness(m.gold["fact_invoices"], ["invoice_id"])
    try:
        quality.expect(counted, "no_key", "num_entries = 0").write.format("noop").mode("overwrite").save()
        raised = False
    except Exception as error:
        raised = "expectation failed: no_key" in str(error)
    return quality.expect(counted, "unique_key", "num_entries = 1").withColumn("raised", F.lit(raised))


@query("expect_drop")
def _(m: SampleModel) -> DataFrame:
    return quality.expect(m.gold["fact_invoices"], "paid", "days_late IS NOT NULL AND days_late <= 0", "drop").groupBy(
        "payment_status").agg(F.count(F.lit(1)).alias("kept"), exact_sum("invoice_amount").alias("amount"))


@query("expect_warn")
def _(m: SampleModel) -> DataFrame:
    """Every row stays, and the running job counts the violations."""
    seen = Observation("paid")
    kept = quality.expect(m.gold["fact_invoices"], "paid", "days_late <= 0", "warn", seen).groupBy("payment_status").agg(
        F.count(F.lit(1)).alias("rows"))
    folder = scratch_dir(m.spark, "warn")
    kept.write.parquet(folder)
    return m.spark.read.schema(kept.schema).parquet(folder).withColumn("violations", F.lit(seen.get["violations"]).cast("bigint"))


# Calendars and dates

@query("dim_date")
def _(m: SampleModel) -> DataFrame:
    """Calendar days that have invoices due, with their number."""
    due = m.gold["fact_invoices"].groupBy(F.col("due_date").alias("date")).agg(F.count(F.lit(1)).alias("due_invoices"))
    days = m.gold["dim_date"]
    whole = {c: F.col(c).cast("bigint") for c in ("year", "quarter", "month", "day")}
    return due.join(days, "date").withColumns(whole).select(*days.columns, "due_invoices")


@query("calendar_for_column")
def _(m: SampleModel) -> DataFrame:
    days = calendars.calendar_for(m.table("lineitem"), "l_shipdate")
    return days.withColumns({c: F.col(c).cast("bigint") for c in ("year", "quarter_no", "month_no", "day")})


@query("date_hierarchy_rollup")
def _(m: SampleModel) -> DataFrame:
    return matrix.date_hierarchy(m.table("lineitem"), "l_shipdate", "l_extendedprice")


@query("date_part_join")
def _(m: SampleModel) -> DataFrame:
    events = m.table("events")
    return relations.join_on_date_part(events, "ts", calendars.calendar_for(events, "ts")).groupBy(
        F.col("year").cast("bigint").alias("year"), "month", F.col("day").cast("bigint").alias("day")).agg(
            F.count(F.lit(1)).alias("events"), exact_sum("value").alias("value"))


@query("invoices_by_due_month")
def _(m: SampleModel) -> DataFrame:
    months = report.invoices_by_month(m.gold["fact_invoices"], m.gold["dim_date"])
    return months.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


@query("invoice_status")
def _(m: SampleModel) -> DataFrame:
    return m.gold["fact_invoices"].groupBy("payment_status", "invoice_status").agg(
        F.count(F.lit(1)).alias("invoices"), F.min("days_late").cast("bigint").alias("min_days_late"),
        F.max("days_late").cast("bigint").alias("max_days_late"),
        F.sum(F.col("days_late").cast("bigint")).alias("sum_days_late"))


# Snapshots and history

@query("latest_snapshot")
def _(m: SampleModel) -> DataFrame:
    return latest_snapshot(m.snapshots)


@query("dedup_by_key")
def _(m: SampleModel) -> DataFrame:
    return dedup_by_key(m.table("lineitem").select(*LINE), ["l_orderkey", "l_linenumber"])


@query("scd2_replay")
def _(m: SampleModel) -> DataFrame:
    return history.replay_scd2(m.snapshots, ["order_id"], untracked=UNTRACKED).select(*REGISTER)


@query("scd2_apply")
def _(m: SampleModel) -> DataFrame:
    """The last export applied to the history of all earlier ones."""
    last = f"{m.export_years[-1]}-12-31"
    earlier = m.snapshots.filter(F.col(SNAPSHOT_TS) < F.lit(last).cast("timestamp"))
    target = history.replay_scd2(earlier, ["order_id"], untracked=UNTRACKED)
    return history.apply_snapshot_scd2(
        target, m.snapshot(m.export_years[-1]), ["order_id"], last, UNTRACKED).select(*REGISTER)


@query("scd2_rerun")
def _(m: SampleModel) -> DataFrame:
    """The newest export applied once more, under a later time: nothing changes."""
    done = history.replay_scd2(m.snapshots, ["order_id"], untracked=UNTRACKED)
    again = m.snapshot(m.export_years[-1])
    return history.apply_snapshot_scd2(done, again, ["order_id"], f"{m.export_years[-1] + 1}-12-31", UNTRACKED).select(*REGISTER)


@query("scd2_untracked")
def _(m: SampleModel) -> DataFrame:
    """The amount is not tracked: a change opens no version and the newest value is kept."""
    return history.replay_scd2(m.snapshots, ["order_id"], untracked=(*UNTRACKED, "amount")).select(*REGISTER)


@query("scd2_stored")
def _(m: SampleModel) -> DataFrame:
    """The exports streamed one file set at a time into a stored history."""
    base = scratch_dir(m.spark, "scd2-stored")
    m.snapshots.write.parquet(f"{base}/bronze")
    table = HistoryTable(m.spark, f"{base}/silver", m.snapshots.schema, ["order_id"], UNTRACKED)
    stream = m.spark.readStream.schema(m.snapshots.schema).parquet(f"{base}/bronze")
    follow_snapshots(stream, table, f"{base}/checkpoint")
    return table.read().select(*REGISTER)


@query("scd2_current")
def _(m: SampleModel) -> DataFrame:
    return current(history.replay_scd2(m.snapshots, ["order_id"], untracked=UNTRACKED)).select(*REGISTER[:-1])


@query("scd2_as_of")
def _(m: SampleModel) -> DataFrame:
    return as_of(history.replay_scd2(m.snapshots, ["order_id"], untracked=UNTRACKED), "1998-06-30").select(*REGISTER)


def _customer_history(m: SampleModel) -> DataFrame:
    """Type 2 history of each customer's number of orders and of orders with an amount."""
    counted = m.snapshots.groupBy("customer_id", SNAPSHOT_TS).agg(F.count(F.lit(1)).alias("orders"), F.count("amount").alias("amounts"))
    return history.replay_scd2(counted, ["customer_id"], unique_per_snapshot=True)


@query("history_lookup")
def _(m: SampleModel) -> DataFrame:
    """Every event with the version of its customer that was valid at its time, its month stretched over the years of the orders."""
    since = F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    at = F.timestamp_micros((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(since)) * 80 + F.unix_micros(F.lit("1995-06-01").cast("timestamp")))
    events = m.table("events").select("event_id", F.col("user_id").alias("customer_id"), at.alias("at"))
    return point_in_time.valid_versions(events, _customer_history(m), ["customer_id"], "at", ["orders", "amounts", START])


@query("scd2_lost_keys")
def _(m: SampleModel) -> DataFrame:
    """Keys the open versions lack: exactly those the last exports dropped."""
    kept = current(history.replay_scd2(m.snapshots, ["order_id"], untracked=UNTRACKED))
    return history.lost_keys(m.snapshots, kept, ["order_id"])


@query("scd1_apply")
def _(m: SampleModel) -> DataFrame:
    return history.apply_snapshot_scd1(m.snapshot(1999), m.snapshot(2000), ["order_id"])


@query("snapshot_deletes")
def _(m: SampleModel) -> DataFrame:
    return history.snapshot_deletes(m.snapshot(1999), m.snapshot(2000), ["order_id"]).select(
        "order_id", "customer_id", "status", "amount")


@query("snapshot_diff")
def _(m: SampleModel) -> DataFrame:
    return history.snapshot_diff(m.snapshot(1999), m.snapshot(2000), ["order_id"], UNTRACKED)


# Landing and bronze

def _land_orders(m: SampleModel, base: str) -> None:
    for year in m.export_years:
        frame = m.snapshot(year).drop(SNAPSHOT_TS, RESCUED).withColumnRenamed("amount", " amount ")
        landing.land_snapshot({"orders": frame}, f"{base}/landing", f"r{year}", f"{year}-12-31")


def _export_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(SNAPSHOT_TS, "status").agg(
        F.count(F.lit(1)).alias("rows"), F.count("amount").alias("amounts"), exact_sum("amount").alias("amount"))


@query("land_snapshot")
def _(m: SampleModel) -> DataFrame:
    base = scratch_dir(m.spark, "landing")
    _land_orders(m, base)
    schema = "order_id bigint, customer_id bigint, status string, amount double, _snapshot_ts timestamp"
    return _export_totals(landing.read_landed(m.spark, f"{base}/landing/orders", StructType.fromDDL(schema)))


@query("csv_infer")
def _(m: SampleModel) -> DataFrame:
    base = scratch_dir(m.spark, "infer")
    _land_orders(m, base)
    folder = f"{base}/landing/orders"
    return _export_totals(landing.read_landed(m.spark, folder, landing.infer_csv_schema(m.spark, folder)))


@query("bronze_ingest")
def _(m: SampleModel) -> DataFrame:
    """Landed exports streamed into bronze; the second run finds nothing new."""
    base = scratch_dir(m.spark, "bronze")
    _land_orders(m, base)
    folder = f"{base}/landing/orders"
    schema = landing.infer_csv_schema(m.spark, folder)
    for _ in range(2):
        ingest_bronze(m.spark, folder, schema, f"{base}/bronze", f"{base}/checkpoint")
    return _export_totals(read_bronze(m.spark, f"{base}/bronze", schema))


def _kept(m: SampleModel, rows: DataFrame, base: str) -> DataFrame:
    """Rows of which several exports are made, computed once; ``rows`` below the base can go when all have landed."""
    landing.write_gold(rows, f"{base}/rows")
    return m.spark.read.schema(rows.schema).parquet(f"{base}/rows")


@query("ingest_entity")
def _(m: SampleModel) -> DataFrame:
    """Invoices through all layers: two exports, the first with those issued before 1998."""
    base, cfg = scratch_dir(m.spark, "entity"), ENTITIES["invoices"]
    rows = _kept(m, m.raw_invoices, base)  # two exports are made of them
    early = rows.filter(F.col("issue_date") < F.datediff(F.lit("1998-01-01"), F.lit("1899-12-30")))
    landing.land_snapshot({cfg.name: early}, f"{base}/landing", "r1", "1997-12-31")
    landing.land_snapshot({cfg.name: rows}, f"{base}/landing", "r2", "2001-12-31")
    delete_scratch(m.spark, f"{base}/rows")
    schema = landing.infer_csv_schema(m.spark, f"{base}/landing/{cfg.name}")
    silver = ingest_entity(m.spark, cfg, base, schema, AS_OF)
    return silver.select("invoice_id", "due_date", "payment_date", "invoice_amount", "invoice_status", "days_late",
                         START, END)


def _ingest_invoices(m: SampleModel, base: str, as_of: str) -> DataFrame:
    cfg = ENTITIES["invoices"]
    schema = landing.infer_csv_schema(m.spark, f"{base}/landing/{cfg.name}")
    return ingest_entity(m.spark, cfg, base, schema, as_of).select("invoice_id", "invoice_amount", "invoice_status", START, END)


@query("status_flip")
def _(m: SampleModel) -> DataFrame:
    """One export, ingested twice: the later date makes unpaid invoices overdue without a new export."""
    base = scratch_dir(m.spark, "flip")
    landing.land_snapshot({"invoices": m.raw_invoices}, f"{base}/landing", "r1", "1997-12-31")
    _ingest_invoices(m, base, "1997-12-31")
    return _ingest_invoices(m, base, AS_OF)


@query("same_day_export")
def _(m: SampleModel) -> DataFrame:
    """Exports between and on the dates of earlier runs: each takes its place, and re-datings show the export that is newest then."""
    base, cents = scratch_dir(m.spark, "same-day"), F.col("invoice_amount")
    third = F.split_part("invoice_id", F.lit("-"), F.lit(2)).cast("int") % 3 == 0
    rows = _kept(m, m.raw_invoices, base)  # three exports are made of them

    def land(run: str, at: str, amount: Column) -> None:
        landing.land_snapshot({"invoices": rows.withColumn("invoice_amount", amount)}, f"{base}/landing", run, at)

    land("r1", "1997-12-31", cents)
    _ingest_invoices(m, base, "1998-06-30")
    _ingest_invoices(m, base, "1999-12-31")
    land("r2", "1998-12-31", cents + 1)
    _ingest_invoices(m, base, "1999-12-31")
    land("r3", "1999-12-31", F.when(third, cents + 2).otherwise(cents + 1))
    delete_scratch(m.spark, f"{base}/rows")
    return _ingest_invoices(m, base, "1999-12-31")


@query("exports_in_one_pass")
def _(m: SampleModel) -> DataFrame:
    """All exports folded into a stored history in one pass, after the first one has been applied."""
    base = scratch_dir(m.spark, "one-pass")
    table = HistoryTable(m.spark, f"{base}/silver", m.snapshots.schema, ["order_id"], UNTRACKED)
    table.apply(m.snapshot(m.export_years[0]), f"{m.export_years[0]}-12-31")
    table.apply_all(m.snapshots)
    return table.read().select(*REGISTER).withColumn("folds", F.lit(len(table.folds())).cast("bigint"))


@query("ingest_partial_run")
def _(m: SampleModel) -> DataFrame:
    """An export that lands in two parts, with an ingestion between them: it counts once it is whole."""
    base, at = scratch_dir(m.spark, "partial"), "1997-12-31"
    half = F.crc32(F.col("invoice_id").cast("binary")) % 2 == 0
    rows = landing.land_part(m.raw_invoices.filter(half), f"{base}/landing", "invoices", "r1", at)
    early = _ingest_invoices(m, base, at).count()
    rows += landing.land_part(m.raw_invoices.filter(~half), f"{base}/landing", "invoices", "r1", at)
    landing.seal_run(m.spark, f"{base}/landing", "invoices", "r1", at, rows)
    return _ingest_invoices(m, base, at).withColumn("rows_before", F.lit(early).cast("long"))


@query("ingest_added_column")
def _(m: SampleModel) -> DataFrame:
    """A column that only the second export has: nulls before, and a new version for each project that has a value."""
    base, cfg = scratch_dir(m.spark, "added"), ENTITIES["projects"]
    first = m.table("customer").select(F.col("c_custkey").alias("project_id"), F.col("c_name").alias("project_name"))
    second = m.table("customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"), "c_name").toDF(
        "project_id", "segment", "project_name")
    landing.land_snapshot({cfg.name: first}, f"{base}/landing", "r1", "1997-12-31")
    schema = landing.infer_csv_schema(m.spark, f"{base}/landing/{cfg.name}")
    ingest_entity(m.spark, cfg, base, schema)
    landing.land_snapshot({cfg.name: second}, f"{base}/landing", "r2", "1998-12-31")
    return ingest_entity(m.spark, cfg, base, schema).select(F.col("project_id").cast("bigint"), "project_name", "segment", START, END)


@query("ingest_lookup")
def _(m: SampleModel) -> DataFrame:
    """A type 1 entity through all layers: two exports, the second without some suppliers and with new names."""
    base, cfg = scratch_dir(m.spark, "lookup"), ENTITIES["supplier_lookup"]
    named = m.table("supplier").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"))
    later = named.filter("supplier_id % 3 <> 0").withColumn("supplier_name", F.upper("supplier_name"))
    landing.land_snapshot({cfg.name: named}, f"{base}/landing", "r1", "1997-12-31")
    schema = landing.infer_csv_schema(m.spark, f"{base}/landing/{cfg.name}")
    ingest_entity(m.spark, cfg, base, schema)
    landing.land_snapshot({cfg.name: later}, f"{base}/landing", "r2", "1998-12-31")
    return ingest_entity(m.spark, cfg, base, schema).select(F.col("supplier_id").cast("bigint"), "supplier_name")


# What each entity exports here: its rows, and the column that changes.
ENTITY_ROWS: dict[str, tuple[Callable[[SampleModel], DataFrame], str]] = {
    "projects": (lambda m: m.projects, "project_name"),
    "budget_plan": (lambda m: m.table("part").select(F.col("p_partkey").alias("budget_item_id"), F.col("p_retailprice").alias("amount"), "p_brand"), "amount"),
    "procurement_plan": (lambda m: m.plan, "estimated_value"),
    "procurement_procedures": (lambda m: m.procedures, "procedure_status"),
    "procurement_bids": (lambda m: m.bids, "bid_amount"),
    "contracts": (lambda m: current(m.contracts), "contract_status"),
    "contract_annexes": (lambda m: m.annexes, "contract_id"),
    "purchase_orders": (lambda m: m.purchase_orders, "order_description"),
    "cpv_lookup": (lambda m: m.cpv, "cpv_description"),
    "department_lookup": (lambda m: m.departments, "department_name"),
    "dashboard_summary": (lambda m: m.table("events").groupBy(F.col("event_type").alias("metric")).agg(F.count(F.lit(1)).alias("value")), "value"),
    "summary_by_year": (lambda m: m.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders")), "orders"),
    "source_notes": (lambda m: m.table("nation").select(F.col("n_name").alias("source_name"), F.col("n_regionkey").cast("string").alias("note")), "note"),
}


def _ingest(m: SampleModel, name: str) -> DataFrame:
    """Two exports of an entity through all layers: the first lacks some rows, the second lacks others and has changed ones."""
    base, cfg = scratch_dir(m.spark, name), ENTITIES[name]
    rows, changing = ENTITY_ROWS[name]
    silver = rows(m)
    raw = _kept(m, silver.drop(START, END).withColumns({c: date_to_serial(c) for c in cfg.serial_dates}), base)  # two exports are made of them
    key = cfg.keys[0]
    n = F.ascii(F.right(F.col(key).cast("string"), F.lit(1)))
    is_text = raw.schema[changing].dataType.simpleString() == "string"
    changed = F.concat(F.col(changing), F.lit("!")) if is_text else F.col(changing) + 1
    landing.land_snapshot({name: raw.filter(n % 5 != 1)}, f"{base}/landing", "r1", "1997-12-31")
    ingest_entity(m.spark, cfg, base, raw.schema)
    landing.land_snapshot({name: raw.filter(n % 7 != 2).withColumn(changing, F.when(n % 3 == 0, changed).otherwise(F.col(changing)))},
                          f"{base}/landing", "r2", "1998-12-31")
    delete_scratch(m.spark, f"{base}/rows")
    history_ = ingest_entity(m.spark, cfg, base, raw.schema)
    value = F.col(changing) if raw.schema[changing].dataType.simpleString() == "double" else F.col(changing).cast("string").alias(changing)
    return history_.select(F.col(key).cast("string").alias(key), value, *cfg.serial_dates, *([START, END] if cfg.scd_type == 2 else []))


for _name in ENTITY_ROWS:
    query(f"ingest_{_name}")(lambda m, n=_name: _ingest(m, n))


def _two_exports(m: SampleModel, base: str) -> None:
    """The orders, then again with customers as codes, prices halved, a new column and without priorities."""
    orders = m.table("orders")
    landing.land_snapshot({"orders": orders}, base, "r1", "2000-12-31")
    landing.land_snapshot({"orders": orders.select(
        "o_orderkey", F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("C"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        (F.col("o_orderkey") * 5_000_000_000).alias("o_batch"), "o_orderstatus", F.floor("o_totalprice").alias("o_totalprice"), "o_orderdate")},
        base, "r2", "2001-12-31")


@query("schema_drift")
def _(m: SampleModel) -> DataFrame:
    """What changed between two exports: columns that came, went, or hold values of another type."""
    base = scratch_dir(m.spark, "drift")
    _two_exports(m, base)
    old, new = (landing.widest_types(landing.read_run(m.spark, base, "orders", run)) for run in ("r1", "r2"))
    return quality.schema_drift(m.spark, old, new)


@query("widened_types")
def _(m: SampleModel) -> DataFrame:
    """The type of each column over both exports, with the values that did not fit the first export's types."""
    base = scratch_dir(m.spark, "widened")
    _two_exports(m, base)
    first, later = (landing.read_run(m.spark, base, "orders", run) for run in ("r1", "r2"))
    types = landing.widest_types(first)
    schema = landing.widened(types, landing.widest_types(later))
    misfits = landing.retyped(later, types).select(F.explode("_misfits").alias("column", "value"))
    counted = misfits.groupBy("column").agg(F.count(F.lit(1)).alias("misfits"), F.min("value").alias("least_misfit"))
    listed = m.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column string, type string")
    return listed.join(counted, "column", "left").withColumn("misfits", F.coalesce("misfits", F.lit(0)))


# Filters and relationships

@query("slicer_filter")
def _(m: SampleModel) -> DataFrame:
    chosen = slice_by(m.gold["mv_project_realization_kpi"], "department_id", [3, 7])
    return chosen.select("department_id", "project_id", "total_contracted_value", "realization_pct")


@query("slicer_values")
def _(m: SampleModel) -> DataFrame:
    return slicer_values(m.gold["mv_project_realization_kpi"], "department_id")


@query("cross_filter")
def _(m: SampleModel) -> DataFrame:
    """Pending contracts restrict the projects, on-hold projects the contracts."""
    projects, contracts = relations.cross_filter(
        m.gold["dim_project"], m.gold["dim_contract"], "project_id",
        F.col("project_status") == "On hold", F.col("contract_status") == "P")
    return projects.select(F.lit("project").alias("side"), F.col("project_id").alias("id")).unionByName(
        contracts.select(F.lit("contract").alias("side"), F.col("contract_id").alias("id")))


@query("graph_selection")
def _(m: SampleModel) -> DataFrame:
    """Two departments and the pending contracts, carried to all 16 tables: rows left, and their first and last key."""
    left = relations.select_across(m.stored_gold.build_all(), RELATIONSHIPS, {
        "dim_department": F.col("department_id").isin(3, 7), "dim_contract": F.col("contract_status") == "P"})
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.min(PRIMARY_KEYS[name]).cast("string").alias("first_key"),
                    F.max(PRIMARY_KEYS[name]).cast("string").alias("last_key")) for name, df in left.items()]
    return reduce(DataFrame.unionByName, parts)


@query("awarded_estimated_value")
def _(m: SampleModel) -> DataFrame:
    facts = relations.related(
        m.gold["fact_procurement_bids"], m.gold["fact_procurement_performance"], "procedure_id", "estimated_value")
    return facts.groupBy("supplier_id").agg(
        sum_where(F.col("bid_status") == AWARDED, "estimated_value").alias("estimated_value_awarded"))


@query("awarded_savings")
def _(m: SampleModel) -> DataFrame:
    facts = relations.related(
        m.gold["fact_procurement_bids"], m.gold["mv_procurement_savings_kpi"], "procedure_id",
        "procurement_savings", "department_id")
    return facts.groupBy("department_id").agg(
        sum_where(F.col("bid_status") == AWARDED, "procurement_savings").alias("procurement_savings_awarded"))


@query("rejected_bid_count")
def _(m: SampleModel) -> DataFrame:
    return m.gold["fact_procurement_bids"].groupBy("procedure_id").agg(
        count_other_than("bid_status", AWARDED).alias("rejected_bid_count"))


@query("selected_value_measures")
def _(m: SampleModel) -> DataFrame:
    return m.gold["fact_procurement_bids"].groupBy("procedure_id").agg(
        selected_value("bid_status").alias("bid_status"), awarded_amount().alias("awarded_bid_amount"),
        rejected_amount().alias("rejected_bid_amount"))


@query("savings_pct_by_department")
def _(m: SampleModel) -> DataFrame:
    return report.savings_pct_by_department(m.gold["mv_procurement_savings_kpi"])


# Report pages and questions

@query("savings_matrix")
def _(m: SampleModel) -> DataFrame:
    g = m.gold_storing("fact_procurement_bids", "mv_procurement_savings_kpi")
    return report.savings_matrix(g["mv_procurement_savings_kpi"], g["fact_procurement_bids"])


@query("savings_cards")
def _(m: SampleModel) -> DataFrame:
    g = m.gold_storing("fact_procurement_bids")
    return report.savings_cards(g["mv_procurement_savings_kpi"], g["fact_procurement_bids"])


@query("realization_matrix")
def _(m: SampleModel) -> DataFrame:
    g = m.gold_storing("mv_project_realization_kpi", "mv_procurement_savings_kpi")
    return report.realization_matrix(g["mv_project_realization_kpi"], g["mv_procurement_savings_kpi"])


@query("realization_cards")
def _(m: SampleModel) -> DataFrame:
    return report.realization_cards(m.gold["mv_project_realization_kpi"])


@query("invoice_drilldown")
def _(m: SampleModel) -> DataFrame:
    return report.invoice_drilldown(
        m.gold["fact_invoices"], m.gold["fact_purchase_orders"], m.gold["dim_contract"], m.gold["dim_project"])


@query("drillthrough")
def _(m: SampleModel) -> DataFrame:
    return report.drillthrough(
        3, m.gold["fact_invoices"], m.gold["fact_purchase_orders"], m.gold["dim_contract"], m.gold["dim_project"])


@query("worst_savings_department")
def _(m: SampleModel) -> DataFrame:
    return report.worst_department(m.gold["mv_procurement_savings_kpi"], m.gold["dim_project"], 2004)


@query("supplier_win_rate")
def _(m: SampleModel) -> DataFrame:
    return report.supplier_win_rate(m.gold["fact_procurement_bids"], m.gold["dim_supplier"])


# Profiling and integrity

@query("profile_columns")
def _(m: SampleModel) -> DataFrame:
    return profile.profile(m.gold["fact_invoices"])


@query("candidate_keys")
def _(m: SampleModel) -> DataFrame:
    return profile.candidate_keys(m.table("orders"))


@query("composite_keys")
def _(m: SampleModel) -> DataFrame:
    """Minimal keys of the line items, of one or two columns."""
    return profile.composite_keys(m.table("lineitem"), most=2).withColumn("size", F.col("size").cast("bigint"))


@query("inclusion_dependencies")
def _(m: SampleModel) -> DataFrame:
    """Columns of all star tables that hold nearly only values of another one: every foreign key, with its share."""
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return profile.inclusion_dependencies({t: m.dealt(t) for t in tables}, least_pct=90.0)


@query("fk_containment")
def _(m: SampleModel) -> DataFrame:
    """Orders that have line items, as a share of all orders."""
    return quality.fk_containment(m.table("orders"), "o_orderkey", m.table("lineitem"), "l_orderkey")


@query("duplicate_keys")
def _(m: SampleModel) -> DataFrame:
    return quality.duplicate_keys(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("relationship_check")
def _(m: SampleModel) -> DataFrame:
    """Two declared relationships; a project with several contracts breaks the first."""
    one = quality.relationship_check(
        m.gold["dim_contract"], "project_id", m.gold["dim_project"], "project_id", "one_to_one")
    many = quality.relationship_check(
        m.gold["fact_procurement_bids"], "procedure_id", m.gold["dim_procedure"], "procedure_id")
    return one.unionByName(many)


@query("orphans")
def _(m: SampleModel) -> DataFrame:
    return quality.orphans(m.table("orders"), "o_orderkey", m.table("lineitem"), "l_orderkey")


# Query surface

@query("governed_select")
def _(m: SampleModel) -> DataFrame:
    allowed = {
        t: (lambda s, p=f"{m.sf_dir}/{t}.parquet": s.read.parquet(p)) for t in ("customer", "nation")
    }
    return surface.governed_select(
        m.spark,
        "WITH c AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey) "
        "SELECT n_name, customers FROM c JOIN nation ON n_nationkey = c_nationkey ORDER BY n_name LIMIT 10000",
        allowed)


@query("governed_answers")
def _(m: SampleModel) -> DataFrame:
    """Six statements as answers: two that run, one of them capped, and four that are refused or fail."""
    allowed = {t: (lambda s, p=f"{m.sf_dir}/{t}.parquet": s.read.parquet(p)) for t in ("customer", "nation")}
    statements = (
        "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name", "SELECT c_custkey FROM customer",
        "DROP TABLE customer", "SELECT * FROM orders", "SELECT nothing FROM nation", "SELECT raise_error('no') FROM nation")
    answers = [(i, surface.governed_answer(m.spark, sql, allowed)) for i, sql in enumerate(statements, 1)]
    rows = [(i, a.error is not None, ", ".join(a.columns), a.row_count, a.capped) for i, a in answers]
    return m.spark.createDataFrame(rows, "statement int, is_error boolean, columns string, row_count bigint, capped boolean")


@query("catalog_tables")
def _(m: SampleModel) -> DataFrame:
    """The table list with the rows each table holds, as counted while it was written."""
    written = m.stored_gold.build_all()
    counts = m.spark.createDataFrame([(t.name, written.rows(t.name)) for t in GOLD_TABLES], "table_name string, rows bigint")
    return surface.catalog_tables(m.spark, GOLD_TABLES).join(counts, "table_name")


@query("catalog_columns")
def _(m: SampleModel) -> DataFrame:
    """Declared columns of every table with the profile of their data."""
    written, folder = m.stored_gold.build_all(), scratch_dir(m.spark, "profiles")

    def keep(table: str) -> None:
        """A profile moves every value of its table; what it moved goes before many others are made."""
        profile.profile(written[table]).select(F.lit(table).alias("table_name"), "column", "nulls", "distinct_values").write.parquet(f"{folder}/{table}")

    side_by_side(m.spark, [lambda n=t.name: keep(n) for t in GOLD_TABLES], at_once=2)
    profiled = m.spark.read.schema("table_name string, column string, nulls bigint, distinct_values bigint").parquet(
        *(f"{folder}/{t.name}" for t in GOLD_TABLES))
    listed = surface.catalog_columns(m.spark, written, GOLD_TABLES, described=True)
    return listed.join(profiled, ["table_name", "column"])


@query("table_sample")
def _(m: SampleModel) -> DataFrame:
    return surface.sample_rows(m.table("orders"), 3, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("table_document")
def _(m: SampleModel) -> DataFrame:
    return surface.table_document(m.stored_gold.build_all(), GOLD_TABLES)


@query("build_gold")
def _(m: SampleModel) -> DataFrame:
    """All gold tables written in order and read back: rows and exact totals of each."""
    m.store_shared()
    silver = {
        "department_lookup": m.departments, "supplier_lookup": m.suppliers, "cpv_lookup": m.cpv, "projects": m.projects,
        "contracts": m.contracts, "contract_annexes": m.annexes, "procurement_procedures": m.procedures,
        "procurement_plan": m.plan, "procurement_bids": m.bids, "purchase_orders": m.purchase_orders, "invoices": m.invoices}
    written = build_gold(m.spark, silver, scratch_dir(m.spark, "build-gold"))
    totals = {"fact_invoices": "invoice_amount", "fact_contract_financials": "total_contract_value",
              "mv_project_realization_kpi": "total_paid_amount", "mv_procurement_savings_kpi": "procurement_savings"}
    parts = None
    for name, df in written.items():
        total = exact_sum(totals[name]) if name in totals else F.lit(None).cast("double")
        one = df.agg(F.count(F.lit(1)).alias("rows"), total.alias("total")).select(F.lit(name).alias("table_name"), "rows", "total")
        parts = one if parts is None else parts.unionByName(one)
    return parts


def _prototypes(m: SampleModel) -> DataFrame:
    """The mean vector of every label, as queries."""
    parts = m.table("embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vector = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return means.groupBy(F.col("label").alias("query_id")).agg(vector.alias("query_vector"))


@query("cosine_top_k")
def _(m: SampleModel) -> DataFrame:
    return vectors.cosine_top_k(_prototypes(m), m.table("embeddings"))


@query("cosine_top_k_all")
def _(m: SampleModel) -> DataFrame:
    """The nearest of all vectors to every vector but itself."""
    stored = m.table("embeddings")
    asked = stored.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = vectors.cosine_top_k(asked, stored, k=4).filter("rank > 1")
    return found.select("query_id", (F.col("rank") - 1).alias("rank"), "similarity")


@query("vector_store")
def _(m: SampleModel) -> DataFrame:
    """Vectors in stored buckets after two upserts, the second of a few ids, and how many buckets each upsert rewrote."""
    store = m.table("embeddings").select("vec_id", "embedding", "label")
    kept = vectors.VectorStore(m.spark, scratch_dir(m.spark, "vectors"), store.schema, "vec_id", buckets=32)
    kept.upsert(store)
    few = store.orderBy("vec_id").limit(3).withColumn("label", F.lit(103))
    touched = kept.upsert(few)
    expected = few.select(F.pmod(F.xxhash64("vec_id"), F.lit(32)).alias("b")).distinct().count()
    return kept.read().select("vec_id", "label", F.size("embedding").cast("bigint").alias("dimensions"),
                              F.lit(len(touched) == expected).alias("only_touched"))


@query("cosine_top_k_threshold")
def _(m: SampleModel) -> DataFrame:
    return vectors.cosine_top_k(_prototypes(m), m.table("embeddings"), k=25, min_sim=0.2)


@query("vector_upsert")
def _(m: SampleModel) -> DataFrame:
    """Label 3 is relabelled in place, label 4 added again under new ids."""
    store = m.table("embeddings")
    top = store.select(F.max("vec_id")).scalar()
    changed = store.filter("label = 3").withColumn("label", F.lit(103))
    added = store.filter("label = 4").withColumn("vec_id", F.col("vec_id") + top + 1)
    merged = vectors.vector_upsert(store, changed.unionByName(added), "vec_id")
    return merged.select("vec_id", "label", F.size("embedding").cast("bigint").alias("dimensions"))


def _traces(m: SampleModel) -> DataFrame:
    base = scratch_dir(m.spark, "traces")
    events = m.table("events").select(
        F.col("event_type").alias("event"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("elapsed_s"), F.get_json_object("props", "$.k").cast("bigint").alias("input_tokens"))
    model = events.filter("event IN ('view', 'click')").withColumn("model", F.lit("m"))
    tool = events.filter("event NOT IN ('view', 'click')").drop("input_tokens").withColumn("tool", F.lit("t"))
    traces.append_traces(model, base)
    traces.append_traces(tool, base)
    return traces.read_traces(m.spark, base)


@query("trace_summary")
def _(m: SampleModel) -> DataFrame:
    """Two record shapes appended to one JSON log, read back and summed up."""
    return traces.trace_summary(_traces(m), ["event", "model", "tool"])


@query("trace_quantiles")
def _(m: SampleModel) -> DataFrame:
    """Quantiles of a range of days from stored daily sketches: whether their exact ranks are within the stated error."""
    levels, log = [0.05, 0.5, 0.95], _traces(m)
    folder = scratch_dir(m.spark, "sketches")
    daily = traces.daily_sketches(log, distinct="elapsed_s")
    daily.write.parquet(folder)
    answers = traces.merged_summary(m.spark.read.schema(daily.schema).parquet(folder), levels, first="2024-01-05", last="2024-01-20")
    of_range = log.filter(F.to_date("ts").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))
    within = traces.rank_errors(of_range, answers, levels)
    exact = of_range.groupBy("event").agg(F.count_distinct("elapsed_s").alias("_exact"))
    near = F.abs(F.col("distinct_values") / F.col("_exact") - 1) < 0.05
    return answers.select("event", "calls", "distinct_values").join(within, "event").join(exact, "event").select(
        "event", "calls", "timed", *(f"p{round(q * 100)}_within" for q in levels), near.alias("distinct_within"))


@query("stream_gate")
def _(m: SampleModel) -> DataFrame:
    """Events streamed through two expectations: rows kept and refused, by what refused them, and as the listener counted them."""
    base = scratch_dir(m.spark, "gate")
    m.table("events").write.parquet(f"{base}/landed")
    events = m.spark.read.parquet(f"{base}/landed").schema
    counts = gate.BatchCounts()
    m.spark.streams.addListener(counts)
    try:
        stream = m.spark.readStream.schema(events).parquet(f"{base}/landed")
        done = gate.gate_stream(stream, {"no_error": "event_type <> 'error'", "small": "value < 90"}, f"{base}/events", f"{base}/checkpoint")
        for _ in range(200):  # the listener is told a moment after the query ends
            if counts.batches or not done.lastProgress or not done.lastProgress["numInputRows"]:
                break
            time.sleep(0.05)
    finally:
        m.spark.streams.removeListener(counts)
    kept = gate.read_gate(m.spark, f"{base}/events", events).select(F.lit("kept").alias("place"))
    refused = gate.read_gate(m.spark, f"{base}/events", events, refused=True).select(F.array_join(gate.REASONS, "+").alias("place"))
    seen = {k: sum(b[k] for b in counts.batches.values()) for k in ("rows", "refused")}
    return kept.unionByName(refused).groupBy("place").agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"observed_rows": F.lit(seen["rows"]).cast("bigint"), "observed_refused": F.lit(seen["refused"]).cast("bigint")})
