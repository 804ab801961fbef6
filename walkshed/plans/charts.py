"""Tables ready to draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.functions.labels import station_label
from walkshed.functions.numbers import millions
from walkshed.plans import analysis
from walkshed.plans.study import Study
from walkshed.plans.zones import zone_stats

HOURS = list(range(24))


def share_histogram(study: Study, radii_m: Sequence[int], bins: int = 40) -> DataFrame:
    """Zones per rail share bin; bins are closed on the left, the last one on both sides."""
    width = 100.0 / bins
    share = F.col("rail_share_pct")
    bin_no = F.least(F.floor(share / width), F.lit(bins - 1)).cast("int")
    return (
        zone_stats(study, radii_m)
        .where(share.isNotNull())
        .groupBy("radius_m", bin_no.alias("bin"))
        .agg(F.count("*").alias("n_zones"))
        .withColumn("share_from", F.col("bin") * width)
        .withColumn("share_to", (F.col("bin") + 1) * width)
        .orderBy("radius_m", "bin")
    )


def type_share(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Share of the sums by line type and radius, radius ascending, largest share first."""
    return (
        analysis.share_by_type(study, radii_m, digits)
        .select("radius_m", "line_type", "overall_share", "n_zones")
        .orderBy("radius_m", F.desc("overall_share"), "line_type")
    )


def heatmap(study: Study, radius_m: int, digits: int | None = 2) -> DataFrame:
    """Rail share as a matrix: one row per line type, one column ``h0`` to ``h23`` per hour."""
    matrix = (
        analysis.share_hour_type(study, [radius_m], digits)
        .groupBy("line_type")
        .pivot("hr", HOURS)
        .agg(F.max("share"))
    )
    return matrix.withColumnsRenamed({str(h): f"h{h}" for h in HOURS}).orderBy("line_type")


def hourly_use(study: Study, radius_m: int) -> DataFrame:
    """Use of both modes by hour in millions, not rounded."""
    return (
        analysis.share_hour(study, [radius_m])
        .select(
            "hr",
            millions(F.col("rail_trips")).alias("rail_m"),
            millions(F.col("bus_trips")).alias("bus_m"),
        )
        .orderBy("hr")
    )


def peak(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Peak-hour part by mode and radius; the rail value is the same at every radius."""
    rail = analysis.peak_rail(study, digits).select(
        F.lit("rail").alias("mode"), F.explode(F.array(*map(F.lit, radii_m))).alias("radius_m"), "peak_pct"
    )
    bus = analysis.peak_bus(study, radii_m, digits).select(F.lit("bus").alias("mode"), "radius_m", "peak_pct")
    return rail.unionByName(bus).orderBy("mode", "radius_m")


def top_stations(study: Study, n: int = 15) -> DataFrame:
    """The busiest stations, least first."""
    return (
        analysis.top_stations(study, n)
        .select(
            station_label(F.col("station"), F.col("line")).alias("station_line"),
            millions(F.col("total_trips")).alias("total_m"),
        )
        .orderBy("total_m", F.desc("station_line"))
    )


def top_stops(study: Study, radius_m: int, n: int = 15) -> DataFrame:
    """The busiest stops in reach of a station, least first."""
    return (
        analysis.top_stops(study, radius_m, n)
        .select("stop_name", millions(F.col("total_trips")).alias("total_m"))
        .orderBy("total_m", F.desc("stop_name"))
    )
