"""Counts, shares and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_value(text: Column) -> Column:
    """Passenger count of a text cell: whole part of a plain number, else 0.

    The pattern is only evaluated for cells that are not whole numbers already.
    """
    whole_part = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(
        text.try_cast("bigint"), whole_part.try_cast("bigint"), F.lit(0).cast("bigint")
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, NULL where ``whole`` is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def millions(count: Column) -> Column:
    return count.cast("double") / F.lit(1_000_000.0)
