"""Durations, reject reasons and rounded aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.parse import as_col


def duration_min(start: str | Column, end: str | Column) -> Column:
    """Minutes from start to end, for timestamps with and without time zone."""
    return (F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))) / F.lit(60.0)


def month_of(c: str | Column) -> Column:
    return F.date_trunc("month", as_col(c)).cast("date")


def reasons(rules: Mapping[str, Column]) -> Column:
    """Array of the names whose condition holds; an empty array means accepted."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def exact(c: str | Column) -> Column:
    """An amount as a decimal with ten places; what does not fit one (NaN, infinity, beyond 28 digits) is null.

    Decimal sums do not depend on the order of rows, so a task that is run again on another
    executor, or another partitioning, gives the same last digit.
    """
    return as_col(c).try_cast("decimal(38,10)")


def sum_2dp(c: str | Column) -> Column:
    """Sum of an amount, to two places. Rows are summed as they are; only the sum is rounded. ``left_out`` counts
    the NaN and infinities among them."""
    rounded = F.round(F.try_sum(exact(c)), 2).cast("double")
    return F.coalesce(F.when(_lost(c) == 0, rounded), F.round(_doubles(c), 2))


def avg_2dp(c: str | Column) -> Column:
    """Average of an amount, rounded half away from zero to two places."""
    rounded = F.round(F.try_divide(F.try_sum(exact(c)), F.count(exact(c))), 2).cast("double")
    return F.coalesce(F.when(_lost(c) == 0, rounded), F.round(_doubles(c) / F.count(_amount(c)), 2))


def left_out(c: str | Column) -> Column:
    """How many amounts no sum can hold, which the two above leave out as gaps: NaN and infinities."""
    return F.count_if(as_col(c).cast("double").isNotNull() & _amount(c).isNull())


def _amount(c: str | Column) -> Column:
    """NaN and infinities are gaps."""
    value = as_col(c).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def _lost(c: str | Column) -> Column:
    """Finite amounts that no decimal holds. Where there are any, or the sum outgrows its decimal, doubles are
    summed instead, so a huge amount shows in the result."""
    return F.count_if(_amount(c).isNotNull() & exact(c).isNull())


def _doubles(c: str | Column) -> Column:
    return F.sum(_amount(c))
