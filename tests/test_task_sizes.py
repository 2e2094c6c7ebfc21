"""Tasks that sort or hash what they scan take pieces of a file, not its row groups."""

import pytest
from pyspark.sql import functions as F

from snapstar import session
from snapstar.plans.queries import QUERIES
from snapstar.plans.sample_model import SampleModel

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(session, "PIECE", 16384)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def _hashed_after_dealing(plan, operator):
    """Every scan of line items is dealt out below the first ``operator`` that reads it."""
    lines = plan.splitlines()
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "l_orderkey" in x]
    below = [next(x for x in reversed(lines[:i]) if operator in x or "REPARTITION_BY_NUM" in x) for i in scans]
    return bool(scans) and all("REPARTITION_BY_NUM" in x for x in below)


def test_one_row_group_of_equal_rows_is_dealt_evenly(spark, tmp_path, small_pieces):
    path = str(tmp_path / "t")
    spark.range(40000).select((F.col("id") % 2).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(path)
    stored, df = session.stored_bytes(spark, path), spark.read.parquet(path)
    dealt = session.deal_out(df, stored)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    pieces = -(-stored // 16384)
    assert df.select(F.spark_partition_id()).distinct().count() < pieces / 4
    assert sum(sizes) == 40000 and max(sizes) < 1.5 * 40000 / pieces
    assert session.deal_out(df, 16384) is df
    assert _rows(dealt.agg(F.sum(F.xxhash64("k", "v").cast("decimal(38,0)")))) == _rows(df.agg(F.sum(F.xxhash64("k", "v").cast("decimal(38,0)"))))


@pytest.mark.parametrize("most, largest, stored, pieces", [(200, 64, 100, 100), (200, 64, 1000, 200), (200, 64, 64000, 1000), (8, 64, 20, 8)])
def test_pieces_stay_few_enough_to_be_written_without_buffers(spark, monkeypatch, most, largest, stored, pieces):
    for name, value in (("PIECE", 1), ("MOST_OPEN", most), ("LARGEST", largest)):
        monkeypatch.setattr(session, name, value)
    assert session.deal_out(spark.range(10).toDF("id"), stored).rdd.getNumPartitions() == pieces


def test_lines_are_dealt_before_copies_are_dropped(spark, small_pieces):
    assert _hashed_after_dealing(_plan(SampleModel(spark, FOLDER).lines), "WindowGroupLimit")


def test_columns_are_dealt_before_their_values_are_hashed(spark, small_pieces):
    assert _hashed_after_dealing(_plan(QUERIES["inclusion_dependencies"](spark, FOLDER)), "HashAggregate")


def test_line_items_are_dealt_before_bids_are_made(spark, small_pieces):
    assert _hashed_after_dealing(_plan(SampleModel(spark, FOLDER).bids), "HashAggregate")


@pytest.mark.parametrize("name", ["bids", "contracts", "plan"])
def test_rows_of_orders_are_dealt_and_never_broadcast(spark, small_pieces, name):
    lines = _plan(getattr(SampleModel(spark, FOLDER), name)).splitlines()
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "o_orderkey" in x]
    below = [next(x for x in reversed(lines[:i]) if "Exchange" in x) for i in scans]
    assert scans and all("REPARTITION_BY_NUM" in x for x in below)
    assert not any("Broadcast" in x for x in lines)


@pytest.mark.parametrize("name", ["profile_columns", "inclusion_dependencies", "savings_matrix", "uniqueness_fact_procurement_bids"])
def test_pieces_change_no_result(spark, monkeypatch, name):
    whole = _rows(QUERIES[name](spark, FOLDER))
    monkeypatch.setattr(session, "PIECE", 16384)
    assert _rows(QUERIES[name](spark, FOLDER)) == whole
