"""Scalar column functions: serial dates, money, ratios, invoice status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Day zero of spreadsheet serial dates; the status label of a late invoice;
# the source system's label of a winning bid.
SERIAL_EPOCH = "1899-12-30"
OVERDUE = "Overdue"
AWARDED = "Odabrana"

# Addends of sums; wider than cents, so that a sum is rounded once, at its end.
MONEY = "decimal(38,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def serial_to_date(c: Column | str) -> Column:
    """Day serial (int, double or text) to date; fractions truncate, junk gives null."""
    days = _col(c).try_cast("double").try_cast("int")
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days)


def date_to_serial(c: Column | str) -> Column:
    """The inverse of :func:`serial_to_date`, for writing exports."""
    return F.datediff(_col(c), F.lit(SERIAL_EPOCH).cast("date"))


def money(c: Column | str) -> Column:
    """Round an amount to cents."""
    return F.round(_col(c), 2)


def exact(c: Column | str) -> Column:
    """An amount as an exact decimal, so sums do not depend on row order; up to six decimals count."""
    return _col(c).cast(MONEY)


def exact_sum(c: Column | str) -> Column:
    """Order-independent sum of amounts, rounded to cents as a whole, returned as double."""
    return money(F.sum(exact(c))).cast("double")


def guarded_ratio(numerator: Column | str, denominator: Column | str, scale: int = 4) -> Column:
    """``numerator / denominator`` where the denominator is positive, else null."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.round(F.when(d > 0, n / d), scale)


def with_invoice_status(df: DataFrame, as_of_date: dt.date | str | Column) -> DataFrame:
    """Add ``invoice_status`` and ``days_late`` as seen on ``as_of_date``, one for all rows or a column.

    Unpaid invoices past their due date turn overdue; paid early counts negative days.
    """
    today = as_of_date if isinstance(as_of_date, Column) else F.lit(str(as_of_date)).cast("date")
    return df.withColumns(invoice_status(today))


def invoice_status(today: Column) -> dict[str, Column]:
    """The columns of :func:`with_invoice_status`."""
    unpaid = F.col("payment_date").isNull()
    late = unpaid & (F.col("due_date") < today)
    return {
        "invoice_status": F.when(late, F.lit(OVERDUE)).otherwise(F.col("payment_status")),
        "days_late": F.when(~unpaid, F.datediff("payment_date", "due_date")),
    }
