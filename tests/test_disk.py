"""What moves between tasks or lies on disk, and that moving less changes no row."""

import datetime as dt
import os
import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar import session
from snapstar.operators.history import fold_scd2
from snapstar.operators.matrix import drill_matrix
from snapstar.plans import report
from snapstar.plans.queries import QUERIES
from snapstar.plans.sample_model import SampleModel
from snapstar.sources import landing
from snapstar.streaming.history import AT, Export, HistoryTable

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(session, "PIECE", 16384)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """The star tables with rows that come twice, and with keys and other columns that are null."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        df = spark.read.parquet(f"{FOLDER}/{t}.parquet")
        key = df.columns[0]
        some = {c: F.when(F.xxhash64(F.lit(c), *df.columns) % 40 != 0, F.col(c)).alias(c) for c in df.columns}
        odd = df.select(*some.values()) if t in ("orders", "lineitem") else df
        twice = odd.filter(F.xxhash64(key) % 9 == 0)
        odd.unionByName(twice).unionByName(twice.limit(3)).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return folder


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_hot_key_is_told(spark):
    even = spark.range(60000).select((F.col("id") % 20000).alias("a"), F.col("id").cast("string").alias("b"))
    hot = even.withColumn("a", F.when(F.col("b") % 3 == 0, 7).otherwise(F.col("a")))
    assert not session.has_hot_key(even, "a") and not session.has_hot_key(even, "a", "b") and session.has_hot_key(hot, "a")
    assert not session.has_hot_key(even.limit(0), "a") and session.has_hot_key(even.withColumn("a", F.lit(None).cast("int")), "a")
    assert session.is_large_and_even(even, "a") and not session.is_large_and_even(hot, "a") and not session.is_large_and_even(even.limit(100), "a")


def test_shuffle_files_go_with_their_job(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sum("shuffle_" in blocks.getAllBlocks().apply(i).toString() for i in range(blocks.getAllBlocks().size()))

    df = session.tune(spark).range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffles()
    assert len(df.collect()) == 7
    for _ in range(50):  # they are removed a moment after the job ends
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert len(df.collect()) == 7


@pytest.mark.parametrize("name, exchanges", [("lines", 1), ("_billed", 2), ("purchase_orders", 2), ("bids", 3), ("contracts", 2)])
def test_steps_by_order_move_each_table_once(spark, small_pieces, name, exchanges):
    assert _plan(getattr(SampleModel(spark, FOLDER), name)).count("Exchange") == exchanges


def test_a_hot_order_is_dealt_evenly(spark, small_pieces, monkeypatch):
    monkeypatch.setattr("snapstar.plans.sample_model.has_hot_key", lambda df, *keys: True)
    m = SampleModel(spark, FOLDER)
    assert "monotonically_increasing_id" in _plan(m.lines) and _plan(m.lines).count("Exchange") == 2
    m.store_shared()
    assert "l_linenumber" in m.lines.columns and _rows(m.invoices) == _rows(SampleModel(spark, FOLDER).invoices)


@pytest.mark.parametrize("name", ["invoices", "purchase_orders", "annexes", "bids", "contracts", "plan"])
def test_stored_parts_change_no_row(spark, awkward, monkeypatch, name):
    whole = _rows(getattr(SampleModel(spark, awkward), name))
    monkeypatch.setattr(session, "PIECE", 16384)
    assert _rows(getattr(SampleModel(spark, awkward), name)) == whole
    stored = SampleModel(spark, awkward).store_shared()
    assert whole and _rows(getattr(stored, name)) == whole


def test_stored_lines_carry_their_headers(spark, small_pieces):
    """Invoices are read from the stored lines; nothing moves."""
    m = SampleModel(spark, FOLDER).store_shared()
    assert "Exchange" not in _plan(m.invoices)
    assert _plan(m.purchase_orders).count("Exchange") == 2


@pytest.mark.parametrize("name", ["invoice_drilldown", "savings_matrix", "build_gold", "ingest_entity", "ingest_purchase_orders", "ingest_procurement_bids"])
def test_moving_less_changes_no_result(spark, awkward, monkeypatch, name):
    whole = _rows(QUERIES[name](spark, awkward))
    for setting, value in (("PIECE", 16384), ("FEW", 0), ("MOST_OPEN", 1)):
        monkeypatch.setattr(session, setting, value)
    assert whole and _rows(QUERIES[name](spark, awkward)) == whole


def _fold(spark):
    t = [dt.datetime(2024, m, 1) for m in (1, 2, 3)]
    at = [int(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for x in t]
    rows = [(f"k{k % 50}" if k % 11 else None, k % 4, (k + i) % 3, at[i]) for i in (1, 2) for k in range(90)]
    views = spark.createDataFrame(rows * 2, "id string, part int, v int, _view_at bigint")
    opened = spark.createDataFrame([(f"k{k}", p, 1, t[0], None) for k in range(60) for p in range(4)], "id string, part int, v int, __START_AT timestamp, __END_AT timestamp")
    return fold_scd2(opened, views, at[1:], ["id", "part"], "_view_at")


def test_many_even_rows_move_once_to_a_fold(spark, monkeypatch):
    twice = _fold(spark)
    assert _plan(twice).count("Exchange hashpartitioning") == 2
    want = _rows(twice)
    for setting, value in (("FEW", 0), ("MOST_OPEN", 1)):
        monkeypatch.setattr(session, setting, value)
    once = _fold(spark)
    assert _plan(once).count("Exchange hashpartitioning") == 1 and _rows(once) == want


def test_summed_groups_stay_where_they_are(spark):
    df = spark.createDataFrame([(a, b, c, (a or 5) * (b or 3) + c) for a in (1, 2, None) for b in (1, None) for c in (1, 2)], "a int, b int, c int, v int")
    levels, measures = ["a", "b", "c"], {"v": F.sum("v"), "n": F.min("v")}
    sums = df.repartition(4, "b").groupBy(*levels).agg(F.sum("v").alias("v"))
    plain, summed = drill_matrix(sums, levels, measures), drill_matrix(sums, levels, measures, summed=True)
    assert _rows(summed.select(*plain.columns)) == _rows(plain)
    moved = [x for x in _plan(summed).splitlines() if "Exchange hashpartitioning(a" in x]
    assert len(moved) == 1 and "c#" not in moved[0]


def _wide_moves(plan, column):
    """Exchanges for joins of rows with a column: those right above a projection or join that shows it."""
    lines = plan.splitlines()
    return [x for x, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in x and "grouping" not in x and column in below]


def test_invoices_move_once_to_their_chain(spark):
    """Lookups that miss, and ones with several rows, come out as if each were joined to the invoices in turn."""
    invoices = spark.createDataFrame([(f"I{i}", f"P{i % 5}" if i % 4 else None, float(i), "x", "y", i) for i in range(20)],
                                     "invoice_id string, purchase_order_id string, invoice_amount double, payment_status string, invoice_status string, days_late int")
    orders = spark.createDataFrame([("P0", 1), ("P1", 2), ("P1", 3), ("P2", None), ("P3", 9)], "purchase_order_id string, contract_id int")
    contracts = spark.createDataFrame([(1, 1), (2, 7), (3, 2), (3, 2), (5, 1)], "contract_id int, project_id int")
    projects = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "project_id int, department_id int")
    chain = invoices.join(orders, "purchase_order_id", "left").join(contracts, "contract_id", "left").join(projects, "project_id", "left")
    want = report._invoice_levels(chain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = report.invoice_drilldown(invoices, orders, contracts, projects)
        assert _rows(got.select(*want.columns)) == _rows(want)
        assert len(_wide_moves(_plan(want), "invoice_amount")) > 2  # by order, contract and project, in each branch
        assert all("hashpartitioning(purchase_order_id" in x for x in _wide_moves(_plan(got), "invoice_amount"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["ingest_entity", "ingest_purchase_orders", "ingest_procurement_bids", "same_day_export"])
def test_exports_are_made_of_rows_computed_once(spark, monkeypatch, name):
    landed, land, folders = [], landing.land_snapshot, []
    monkeypatch.setattr(landing, "land_snapshot", lambda frames, root, *rest: (landed.extend(map(_plan, frames.values())), folders.append(root), land(frames, root, *rest)))
    assert QUERIES[name](spark, FOLDER).count() > 0
    assert len(landed) > 1 and not any("lineitem.parquet" in x for x in landed)
    assert not os.path.exists(os.path.join(os.path.dirname(folders[0]), "rows"))


def test_profiles_are_made_table_by_table(spark, monkeypatch):
    """What a profile moved is gone before the last one is made: the result reads stored profiles, it computes none."""
    plan = _plan(QUERIES["catalog_columns"](spark, FOLDER))
    assert "bids" not in plan and "Expand" not in plan and "profiles-" in plan


def test_an_export_in_place_of_a_re_dating_moves_no_earlier_one(spark, tmp_path):
    day = [int(dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6) for m in range(1, 7)]

    def late(at):
        return {"late": F.col("due") < F.month(at)}

    exports = {day[i]: spark.createDataFrame([(f"k{k}", k % 7, None, i + k % 2) for k in range(20)], "id string, due int, late boolean, v int").withColumns(
        late(F.timestamp_micros(F.lit(day[i])))) for i in (0, 2, 4)}
    asked = []

    def rows_of(views):
        asked.append([v.at for v in views])
        return reduce(DataFrame.unionByName, [exports[v.export.at].withColumn(AT, F.lit(v.at)) for v in views])

    known = [Export(at, 20, str(at)) for at in exports]
    table = HistoryTable(spark, str(tmp_path / "steps"), exports[day[0]].schema, ["id"])
    table.catch_up(known[:1], rows_of, day[1], late)
    table.catch_up(known[:1], rows_of, day[4], late)
    table.catch_up(known[:2], rows_of, day[4], late)
    table.catch_up(known, rows_of, day[4], late)
    assert asked == [[day[0]], [day[2]], [day[4]]]
    assert [v.at for v in table.views()] == [day[0], day[1], day[2], day[4]]
    at_once = HistoryTable(spark, str(tmp_path / "at_once"), exports[day[0]].schema, ["id"])
    at_once.catch_up(known[:1], rows_of, day[1], late)
    at_once.catch_up(known, rows_of, None, late)
    assert _rows(table.read()) == _rows(at_once.read())
