"""Totals and rail share of each zone: a station on a line, with the stops in reach of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.functions.labels import category
from walkshed.functions.numbers import share_pct
from walkshed.plans.study import Study

def trips() -> Column:
    """Boardings and alightings together."""
    return F.col("on_cnt") + F.col("off_cnt")


def rail_total(study: Study) -> DataFrame:
    """All rail use per station and line."""
    return study.rail_by_station(rail_total=F.sum(trips())).select("station", "line", "rail_total")


def bus_total(study: Study) -> DataFrame:
    """All bus use per located stop."""
    return (
        study.bus_by_stop(bus_total=F.sum(trips()))
        .join(study.stops, "stop_id")
        .select("stop_id", "bus_total")
    )


def bus_in_reach(
    study: Study, radii_m: Sequence[int], *dims: str, hours: Sequence[int] | None = None, **sums: Column
) -> DataFrame:
    """Sums over the stops in reach of each station site, by ``dims``, with ``n_stops``.

    The ridership is summed per stop, then per position, before it meets the stations.
    """
    per_stop = study.bus_by_stop(*dims, hours=hours, **sums).join(study.stops, "stop_id")
    if len(dims) == 1:
        rows = per_stop.select("stop_lat", "stop_lon", *dims, *sums, F.lit(1).cast("bigint").alias("n_stops"))
        return study.sums_in_reach_by(rows, radii_m, *dims, [*sums, "n_stops"])
    per_site = per_stop.groupBy("stop_lat", "stop_lon", *dims).agg(
        *[F.sum(k).alias(k) for k in sums], F.count("*").alias("n_stops")
    )
    return study.sums_in_reach(
        per_site, study.sites[1], radii_m, ["sta_lat", "sta_lon", *dims], [*sums, "n_stops"]
    )


def zone_stats(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Rail and bus totals, number of stops and rail share per zone and radius."""

    def build(radii: Sequence[int]) -> DataFrame:
        rail = study.rail_by_station(rail_total=F.sum(trips()))
        bus = bus_in_reach(study, radii, bus_total=F.sum(trips()))
        both = F.col("rail_total") + F.col("bus_total")
        return (
            rail.join(bus, ["sta_lat", "sta_lon"])
            .select("radius_m", "station", "line", "rail_total", "bus_total", "n_stops")
            .withColumn("total_in_zone", both)
            .withColumn("rail_share_pct", share_pct(F.col("rail_total"), both))
        )

    return study.shared_by_radius("zones", radii_m, build)


def with_line_type(study: Study, df: DataFrame) -> DataFrame:
    """Add ``line_type`` by the line name as it is in the ridership."""
    s = study.settings
    return df.withColumn("line_type", category(F.col("line"), s.line_types, s.other_line_type))


def zone_typed(study: Study, radii_m: Sequence[int]) -> DataFrame:
    return with_line_type(study, zone_stats(study, radii_m))
