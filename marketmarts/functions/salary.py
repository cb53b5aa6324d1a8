"""Salary and calendar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import ANNUAL_MONTHLY_THRESHOLD, ANNUAL_UNIT, MONTHS_PER_YEAR


def midpoint(low: Column, high: Column) -> Column:
    """(low + high) / 2 as DOUBLE; NULL when either bound is NULL.

    Both sides are widened first so two large INT bounds cannot overflow
    under ANSI arithmetic.
    """
    return (low.cast("double") + high.cast("double")) / F.lit(2.0)


def disclosed_midpoint(disclosed: Column, low: Column, high: Column) -> Column:
    """Midpoint only for rows flagged as disclosed."""
    return F.when(F.coalesce(disclosed, F.lit(False)), midpoint(low, high))


def annual_to_monthly(value: Column) -> Column:
    """NULL/0 -> NULL; > 25,000 is already monthly; else 10k-TWD annual -> monthly (truncated)."""
    return (
        F.when(value.isNull() | (value == 0), F.lit(None).cast("int"))
        .when(value > ANNUAL_MONTHLY_THRESHOLD, value.try_cast("int"))
        .otherwise((value.cast("double") * ANNUAL_UNIT / MONTHS_PER_YEAR).try_cast("int"))
    )


def week_ending_sunday(ts: Column) -> Column:
    """Label of the Monday..Sunday week holding ``ts``: that week's Sunday."""
    return F.next_day(F.date_sub(F.to_date(ts), 1), "Sun")
