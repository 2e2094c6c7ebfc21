"""Aggregate columns with report semantics, for use inside ``agg``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import AWARDED, exact_sum


def selected_value(c: str) -> Column:
    """The column's value when the group holds exactly one distinct value, else null.

    A null next to a value makes two distinct values, hence null.
    """
    lo, hi = F.min(c), F.max(c)
    return F.when(lo.eqNullSafe(hi) & (F.count_if(F.col(c).isNull()) == 0), hi)


def sum_where(condition: Column, amount: str) -> Column:
    """Sum of ``amount`` over the rows that meet ``condition``; null when none does."""
    return exact_sum(F.when(condition, F.col(amount)))


def count_other_than(c: str, value: object) -> Column:
    """Rows whose column differs from ``value`` (null differs); null instead of zero."""
    n = F.count_if(~F.col(c).eqNullSafe(F.lit(value)))
    return F.when(n > 0, n)


def _all_awarded(status: str, awarded: str) -> Column:
    # The only status of a group is the awarded one exactly when every row has it; counting
    # keeps strings out of the aggregation buffer, so the aggregate can hash instead of sort.
    return F.count_if(F.col(status) == F.lit(awarded)) == F.count(F.lit(1))


def awarded_amount(status: str = "bid_status", amount: str = "bid_amount", awarded: str = AWARDED) -> Column:
    """The single amount of a group whose only status is the awarded one."""
    return F.when(_all_awarded(status, awarded), selected_value(amount))


def rejected_amount(status: str = "bid_status", amount: str = "bid_amount", awarded: str = AWARDED) -> Column:
    """The single amount of a group whose status is another one, mixed, or missing."""
    return F.when(~_all_awarded(status, awarded), selected_value(amount))
