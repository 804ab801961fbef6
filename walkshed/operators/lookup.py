"""Joining a large table to a lookup table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in Spark's row format, counted by a job over its rows."""
    width = F.lit(_ROW_OVERHEAD + 8 * len(df.schema))
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)) + 8, F.lit(0))
        elif isinstance(f.dataType, T.DecimalType):
            width = width + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # Written out with its field names; twice that is above what the row format takes.
            width = width + F.coalesce(2 * F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return df.agg(F.sum(width.cast("bigint")).alias("bytes")).first().bytes or 0


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join row-level facts to a lookup table without shuffling the facts if it can be avoided.

    The lookup is broadcast when its measured size is within the limit. Above it, both
    sides are shuffled on the key and adaptive execution splits a key that holds much
    of the facts.
    """
    if measured_bytes(lookup) <= limit_bytes:
        lookup = F.broadcast(lookup)
    return fact.join(lookup, list(on), how)
