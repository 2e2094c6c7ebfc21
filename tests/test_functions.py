from datetime import date

import pytest
from pyspark.sql import functions as F

from snapstar.functions.columns import guarded_ratio, money, serial_to_date, with_invoice_status
from snapstar.functions.measures import awarded_amount, count_other_than, rejected_amount, selected_value
from snapstar.session import tune
from snapstar.sources.calendars import calendar_for, dim_date


def test_serial_dates(spark):
    df = spark.createDataFrame([("45305",), ("45365.0",), ("45380.75",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(serial_to_date("s")).collect()]
    assert got == [date(2024, 1, 14), date(2024, 3, 14), date(2024, 3, 29), None, None]


def test_invoice_status_and_days_late(spark):
    rows = [
        ("late", date(2024, 3, 14), date(2024, 3, 29), "Plaćeno"),
        ("early", date(2024, 3, 14), date(2024, 3, 10), "Plaćeno"),
        ("overdue", date(2024, 3, 14), None, "Open"),
        ("due today", date(2024, 6, 1), None, "Open"),
        ("no due date", None, None, "Open"),
    ]
    df = spark.createDataFrame(rows, "id string, due_date date, payment_date date, payment_status string")
    got = {r["id"]: (r["invoice_status"], r["days_late"]) for r in with_invoice_status(df, "2024-06-01").collect()}
    assert got == {
        "late": ("Plaćeno", 15), "early": ("Plaćeno", -4), "overdue": ("Overdue", None),
        "due today": ("Open", None), "no due date": ("Open", None),
    }


def test_money_and_ratio(spark):
    df = spark.createDataFrame([(9846353.430000002, 2.0), (1.0, 0.0), (1.0, -3.0), (1.0, None)], "n double, d double")
    got = df.select(money("n"), guarded_ratio("n", "d")).collect()
    assert got[0] == (9846353.43, 4923176.715)
    assert [r[1] for r in got[1:]] == [None, None, None]


@pytest.mark.parametrize("bids, one_status, awarded, rejected, others", [
    ([("Odabrana", 5.0)], "Odabrana", 5.0, None, None),
    ([("x", 5.0), ("y", 5.0)], None, None, 5.0, 2),
    ([("Odabrana", 5.0), ("y", 7.0)], None, None, None, 1),
    ([(None, 5.0)], None, None, 5.0, 1),
    ([(None, 5.0), ("Odabrana", 5.0)], None, None, 5.0, 1),
])
def test_report_measures(spark, bids, one_status, awarded, rejected, others):
    df = spark.createDataFrame(bids, "bid_status string, bid_amount double")
    got = df.agg(selected_value("bid_status"), awarded_amount(), rejected_amount(),
                 count_other_than("bid_status", "Odabrana")).first()
    assert tuple(got) == (one_status, awarded, rejected, others)


def test_standing_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 5844
    row = days.filter("date = '2024-03-30'").first()
    assert (row["quarter"], row["month_name"], row["day_of_week_name"], row["is_weekend"]) == (
        1, "March", "Saturday", True)
    assert days.filter("is_weekend").select(F.dayofweek("date")).distinct().count() == 2


def test_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([(date(2023, 5, 1),), (date(2024, 2, 29),), (None,)], "d date")
    assert calendar_for(df, "d").count() == 365 + 366
    assert calendar_for(df.filter("d IS NULL"), "d").count() == 0


def test_tasks_take_few_bytes_unless_the_session_chose(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "8MB")
    tuned = tune(own)
    assert tuned.conf.get("spark.sql.files.maxPartitionBytes") == "8MB"
    assert tuned.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"
    assert tune(spark.newSession()).conf.get("spark.sql.files.maxPartitionBytes") == "16MB"
