"""Names and categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from walkshed.functions.numbers import ratio


def strip_alias(name: Column) -> Column:
    """Drop everything from the first ``(`` to the last ``)``; blanks stay.

    The pattern only runs on names that hold a bracket: the optimizer pushes the join key's
    null check down to the facts, where it would run on every row.
    """
    return F.when(name.contains("("), F.regexp_replace(name, r"\(.*\)", "")).otherwise(name)


def renamed(value: Column, renames: Mapping[str, str]) -> Column:
    """``value`` looked up in ``renames``, unchanged where it is not listed."""
    if not renames:
        return value
    table = F.create_map(*[F.lit(x) for pair in renames.items() for x in pair])
    return F.coalesce(F.element_at(table, value), value)


def category(value: Column, members: Mapping[str, Sequence[str]], other: str) -> Column:
    """Name of the first category listing ``value``; ``other`` for the rest and for NULL."""
    first: dict[str, str] = {}
    for name, listed in members.items():
        for member in listed:
            first.setdefault(member, name)
    by_member = [F.lit(x) for pair in first.items() for x in pair]
    if not by_member:
        return F.lit(other)
    return F.coalesce(F.element_at(F.create_map(*by_member), value), F.lit(other))


def direction(board: Column, total: Column, inflow_below: float, outflow_above: float) -> Column:
    """INFLOW when few of the passengers board, OUTFLOW when most do, else BALANCED."""
    boarding = ratio(board, total)
    return (
        F.when(boarding < inflow_below, "INFLOW")
        .when(boarding > outflow_above, "OUTFLOW")
        .otherwise("BALANCED")
    )


def match_flag(one: Column, other: Column) -> Column:
    return F.when(one == other, "MATCH").otherwise("MISMATCH")


def station_label(station: Column, line: Column) -> Column:
    return F.concat(station, F.lit(" ("), line, F.lit(")"))
