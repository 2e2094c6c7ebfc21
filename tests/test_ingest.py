from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapstar.operators.snapshots import END, RESCUED, SNAPSHOT_TS, START, current, latest_snapshot
from snapstar.plans.entities import ENTITIES, ingest_entity, latest_typed
from snapstar.plans.gold import fact_invoices
from snapstar.sources.landing import infer_csv_schema, land_part, land_snapshot, seal_run
from snapstar.streaming.bronze import LateRows, ingest_bronze, read_bronze
from snapstar.streaming.history import HistoryTable

COLUMNS = ("invoice_id string, purchase_order_id string, contract_id string, project_id string, issue_date int, "
           "due_date int, payment_date double, invoice_amount double, currency string, payment_status string")


def invoice(key, amount, paid):
    return (key, "O1", "C1", "P1", 45305, 45365, paid, amount, "EUR", "Plaćeno" if paid else "Otvoreno")


def land(spark, root, run, ts, rows):
    land_snapshot({"invoices": spark.createDataFrame(rows, COLUMNS)}, f"{root}/landing", run, ts)


def test_invoice_through_all_layers(spark, tmp_path):
    root = str(tmp_path)
    cfg = ENTITIES["invoices"]
    first = [invoice("INV-2", 100.5, 45380.0), invoice("INV-1", 7.0, None), invoice("INV-1", 7.0, None)]
    land(spark, root, "r1", "2024-04-01", first)
    schema = infer_csv_schema(spark, f"{root}/landing/invoices")
    assert schema["payment_date"].dataType.simpleString() == "double"
    silver = ingest_entity(spark, cfg, root, schema, "2024-04-01")
    row = fact_invoices(silver).filter("invoice_id = 'INV-2'").first()
    assert (row["issue_date"], row["due_date"], row["payment_date"]) == (
        date(2024, 1, 14), date(2024, 3, 14), date(2024, 3, 29))
    assert (row["invoice_status"], row["days_late"], row["invoice_amount"]) == ("Plaćeno", 15, 100.5)
    assert silver.filter("invoice_id = 'INV-1'").first()["invoice_status"] == "Overdue"

    # A run without a new export changes nothing.
    assert ingest_entity(spark, cfg, root, schema, "2024-04-01").count() == 2
    assert read_bronze(spark, f"{root}/bronze/invoices", schema).count() == 3

    # Two exports arrive before the next run: INV-1 is paid, then INV-2 leaves.
    land(spark, root, "r2", "2024-05-01", [invoice("INV-2", 100.5, 45380.0), invoice("INV-1", 7.0, 45400.0)])
    land(spark, root, "r3", "2024-06-01", [invoice("INV-1", 7.0, 45400.0)])
    silver = ingest_entity(spark, cfg, root, schema, "2024-06-01")
    spans = {(r["invoice_id"], r["invoice_status"], r[START], r[END]) for r in silver.collect()}
    t1, t2, t3 = (datetime(2024, m, 1) for m in (4, 5, 6))
    assert spans == {("INV-1", "Overdue", t1, t2), ("INV-1", "Plaćeno", t2, None), ("INV-2", "Plaćeno", t1, t3)}
    assert current(silver).count() == 1


def test_lookup_entity_is_overwritten(spark, tmp_path):
    root, cfg = str(tmp_path), ENTITIES["department_lookup"]
    frame = spark.createDataFrame([("D1", "Roads"), ("D2", "Parks")], "`department_id ` string, department_name string")
    land_snapshot({cfg.name: frame}, f"{root}/landing", "r1", "2024-01-01")
    schema = infer_csv_schema(spark, f"{root}/landing/{cfg.name}")
    assert schema.fieldNames()[0] == "department_id"
    assert ingest_entity(spark, cfg, root, schema).count() == 2
    later = spark.createDataFrame([("D1", "Streets")], "department_id string, department_name string")
    land_snapshot({cfg.name: later}, f"{root}/landing", "r2", "2024-02-01")
    got = ingest_entity(spark, cfg, root, schema).select("department_id", "department_name").collect()
    assert [tuple(r) for r in got] == [("D1", "Streets")]


def test_malformed_lines_are_rescued(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("id,amount,_snapshot_ts\n1,2.5,2024-01-01\n2,oops,2024-01-01\n")
    schema = spark.createDataFrame([], "id int, amount double, _snapshot_ts timestamp").schema
    ingest_bronze(spark, str(folder), schema, str(tmp_path / "b"), str(tmp_path / "c"))
    got = {r["id"]: (r["amount"], r[RESCUED]) for r in read_bronze(spark, str(tmp_path / "b"), schema).collect()}
    assert got == {1: (2.5, None), 2: (None, "2,oops,2024-01-01")}


def test_reordered_header_stops_the_run(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("amount,id,_snapshot_ts\n2,1,2024-01-01\n")
    schema = spark.createDataFrame([], "id int, amount int, _snapshot_ts timestamp").schema
    with pytest.raises(Exception, match="header"):
        ingest_bronze(spark, str(folder), schema, str(tmp_path / "b"), str(tmp_path / "c"))


def test_latest_snapshot_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(6).select("id", F.make_timestamp(F.lit(2024), (F.col("id") % 3 + 1).cast("int"), *[F.lit(1)] * 1,
                          F.lit(0), F.lit(0), F.lit(0)).alias(SNAPSHOT_TS)).write.partitionBy(SNAPSHOT_TS).parquet(path)
    schema = spark.createDataFrame([], f"id bigint, {SNAPSHOT_TS} timestamp").schema
    newest = latest_snapshot(read_bronze(spark, path, schema).drop(RESCUED))
    assert sorted(r["id"] for r in newest.collect()) == [2, 5]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("Subquery" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in filters)


def test_status_needs_a_date(spark):
    frame = spark.createDataFrame([], f"{COLUMNS}, {SNAPSHOT_TS} timestamp")
    with pytest.raises(ValueError):
        latest_typed(frame, ENTITIES["invoices"])


def test_fifteen_entities():
    assert len(ENTITIES) == 15
    assert sum(e.scd_type == 1 for e in ENTITIES.values()) == 6


def test_only_whole_runs_are_taken_in(spark, tmp_path):
    root, cfg = str(tmp_path), ENTITIES["invoices"]
    one, two = (spark.createDataFrame([invoice(k, 1.0, None)], COLUMNS) for k in ("INV-1", "INV-2"))
    rows = land_part(one, f"{root}/landing", cfg.name, "r1", "2024-02-01")
    schema = infer_csv_schema(spark, f"{root}/landing/{cfg.name}")
    assert ingest_entity(spark, cfg, root, schema, "2024-02-01").count() == 0
    seal_run(spark, f"{root}/landing", cfg.name, "r1", "2024-02-01", rows + 1)
    with pytest.raises(Exception, match="1 of 2 rows"):
        ingest_entity(spark, cfg, root, schema, "2024-02-01")
    land_part(two, f"{root}/landing", cfg.name, "r1", "2024-02-01")
    # Unpaid and due on 2024-03-14: open on the export's date, overdue on a later run's date without a new export.
    assert {r["invoice_status"] for r in ingest_entity(spark, cfg, root, schema, "2024-02-01").collect()} == {"Otvoreno"}
    flipped = ingest_entity(spark, cfg, root, schema, "2024-12-01")
    assert sorted((r["invoice_status"], r[START].date(), r[END] and r[END].date()) for r in flipped.collect()) == 2 * [
        ("Otvoreno", date(2024, 2, 1), date(2024, 12, 1))] + 2 * [("Overdue", date(2024, 12, 1), None)]
    assert ingest_entity(spark, cfg, root, schema, "2024-12-05").count() == 4


def test_late_rows_raise(spark, tmp_path):
    bronze = spark.createDataFrame(
        [("a", 1, datetime(2024, 1, 1)), ("a", 2, datetime(2024, 2, 1))], f"id string, v int, {SNAPSHOT_TS} timestamp")
    table = HistoryTable(spark, str(tmp_path / "h"), bronze.schema, ["id"], (SNAPSHOT_TS,))
    assert table.apply_all(bronze) == 2
    assert table.apply_all(bronze) == 0
    for late in (datetime(2024, 2, 1), datetime(2024, 1, 15)):
        with pytest.raises(LateRows):
            table.apply_all(bronze.unionByName(spark.createDataFrame([("b", 1, late)], bronze.schema)))


def test_a_second_run_of_a_snapshot_raises(spark, tmp_path):
    root, cfg = str(tmp_path), ENTITIES["department_lookup"]
    frame = spark.createDataFrame([("D1", "Roads")], "department_id string, department_name string")
    for run in ("r1", "r2"):
        land_snapshot({cfg.name: frame}, f"{root}/landing", run, "2024-01-01")
    with pytest.raises(LateRows):
        ingest_entity(spark, cfg, root, infer_csv_schema(spark, f"{root}/landing/{cfg.name}"))
