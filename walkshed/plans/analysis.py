"""The three questions: which mode is preferred, what decides it, how each mode is used.

Every function takes the radii and returns one table with a ``radius_m`` column. Shares are
percentages rounded to ``digits``; ``digits=None`` leaves them as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.functions.labels import direction, match_flag
from walkshed.functions.numbers import millions, ratio, share_pct
from walkshed.plans.places import stop_memberships, typed_memberships
from walkshed.plans.study import Study
from walkshed.plans.zones import bus_in_reach, trips, with_line_type, zone_stats, zone_typed

SHARE = "rail_share_pct"


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


# --- which mode is preferred ---------------------------------------------------------


def share_distribution(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Number of zones and the spread of their rail share."""
    return (
        zone_stats(study, radii_m)
        .groupBy("radius_m")
        .agg(
            F.count("*").alias("n_zones"),
            _rounded(F.avg(SHARE), digits).alias("avg_share"),
            *[
                _rounded(F.percentile_approx(SHARE, p), digits).alias(name)
                for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))
            ],
            _rounded(F.min(SHARE), digits).alias("min_share"),
            _rounded(F.max(SHARE), digits).alias("max_share"),
        )
    )


def share_by_type(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Zones, mean share and share of the sums by line type, largest share first."""
    rail, bus = F.sum("rail_total"), F.sum("bus_total")
    return (
        zone_typed(study, radii_m)
        .groupBy("radius_m", "line_type")
        .agg(
            F.count("*").alias("n_zones"),
            _rounded(F.avg(SHARE), digits).alias("avg_share"),
            rail.alias("rail_sum"),
            bus.alias("bus_sum"),
            F.round(millions(rail), 1).alias("rail_m"),
            F.round(millions(bus), 1).alias("bus_m"),
            _rounded(share_pct(rail, rail + bus), digits).alias("overall_share"),
        )
        .orderBy("radius_m", F.desc("overall_share"), "line_type")
    )


def radius_comparison(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Number of zones, mean, median and deviation of the rail share per radius."""
    return (
        zone_stats(study, radii_m)
        .groupBy("radius_m")
        .agg(
            F.count("*").alias("n_zones"),
            _rounded(F.avg(SHARE), digits).alias("avg_share"),
            _rounded(F.percentile_approx(SHARE, 0.5), digits).alias("median"),
            _rounded(F.stddev(SHARE), digits).alias("std_dev"),
        )
        .orderBy(F.desc("radius_m"))
    )


# --- what decides it: hour and line type ---------------------------------------------


def rail_hour_type(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Rail use by line type and hour, over stations that form a zone."""
    used = study.stop_keys.select("stop_lat", "stop_lon").distinct().withColumn("n_sites", F.lit(1).cast("bigint"))
    zones = study.sums_in_reach(used, study.sites[1], radii_m, ["sta_lat", "sta_lon"], ["n_sites"]).drop("n_sites")
    rail = study.rail_by_station("hr", rail_trips=F.sum(trips()))
    per_site = (
        with_line_type(study, rail)
        .groupBy("sta_lat", "sta_lon", "line_type", "hr")
        .agg(F.sum("rail_trips").alias("rail_trips"))
    )
    return (
        per_site.join(zones, ["sta_lat", "sta_lon"])
        .groupBy("radius_m", "line_type", "hr")
        .agg(F.sum("rail_trips").alias("rail_trips"))
    )


def bus_hour_type(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Bus use by line type and hour; a stop counts once for every zone it lies in."""
    stations = with_line_type(study, study.station_keys)
    zones = typed_memberships(study, radii_m, stations)
    return (
        study.bus_by_stop("hr", bus_trips=F.sum(trips()))
        .join(zones, "stop_id")
        .groupBy("radius_m", "line_type", "hr")
        .agg(F.sum(F.col("bus_trips") * F.col("n_zones")).alias("bus_trips"))
    )


def share_hour_type(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Rail share by line type and hour, where both modes are used."""
    rail, bus = F.col("rail_trips"), F.col("bus_trips")

    def build(radii: Sequence[int]) -> DataFrame:
        return rail_hour_type(study, radii).join(
            bus_hour_type(study, radii), ["radius_m", "line_type", "hr"]
        )

    sums = study.shared_by_radius("hour-type", radii_m, build)
    return sums.withColumn("share", _rounded(share_pct(rail, rail + bus), digits))


def share_hour_type_matrix(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """The same as a matrix: one row per hour, one column per line type."""
    return (
        share_hour_type(study, radii_m, digits)
        .groupBy("radius_m", "hr")
        .pivot("line_type", study.settings.all_line_types)
        .agg(F.max("share"))
        .orderBy("radius_m", "hr")
    )


# --- what decides it: morning direction ----------------------------------------------


def _labelled(study: Study, df: DataFrame) -> DataFrame:
    s = study.settings
    board, total = F.col("board"), F.col("total")
    return df.withColumn("board_ratio", ratio(board, total)).withColumn(
        "direction", direction(board, total, s.inflow_below, s.outflow_above)
    )


def direction_rail(study: Study) -> DataFrame:
    """Boarding ratio and direction of each station in the morning hours."""
    rail = study.rail_by_station(
        hours=study.settings.morning_hours, board=F.sum("on_cnt"), total=F.sum(trips())
    )
    return _labelled(study, rail.select("station", "line", "board", "total"))


def direction_bus(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Boarding ratio and direction of the stops in reach of each station in the morning hours."""
    bus = bus_in_reach(
        study, radii_m, hours=study.settings.morning_hours, board=F.sum("on_cnt"), total=F.sum(trips())
    )
    zones = bus.join(study.station_keys, ["sta_lat", "sta_lon"])
    return _labelled(study, zones.select("radius_m", "station", "line", "board", "total"))


def direction_join(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Whether rail and bus point the same way in each zone."""
    rail = direction_rail(study).select("station", "line", F.col("direction").alias("rail_direction"))
    bus = direction_bus(study, radii_m).select(
        "radius_m", "station", "line", F.col("direction").alias("bus_direction")
    )
    return (
        rail.join(bus, ["station", "line"])
        .select("radius_m", "station", "line", "rail_direction", "bus_direction")
        .withColumn("direction_match", match_flag(F.col("rail_direction"), F.col("bus_direction")))
    )


def _morning_sums(study: Study, total_name: str) -> dict[str, Column]:
    """Sums over all hours and over the morning hours in one pass."""
    morning = F.col("hr").isin(*study.settings.morning_hours)
    return {
        total_name: F.sum(trips()),
        "board": F.sum(F.when(morning, F.col("on_cnt"))),
        "total": F.sum(F.when(morning, trips())),
        "n_morning": F.count_if(morning),
    }


def direction_share(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Zones, mean and median rail share by whether the directions match.

    Takes the zones that ``direction_join`` has, those with morning rows of both modes, but
    gets directions and shares from one scan of each mode.
    """

    def labelled(df: DataFrame, mode: str) -> DataFrame:
        found = _labelled(study, df.where(F.col("n_morning") > 0))
        return found.withColumnRenamed("direction", f"{mode}_direction").drop(
            "board", "total", "n_morning", "board_ratio"
        )

    rail = study.rail_by_station(**_morning_sums(study, "rail_total"))
    bus = bus_in_reach(study, radii_m, **_morning_sums(study, "bus_total"))
    both = F.col("rail_total") + F.col("bus_total")
    return (
        labelled(rail, "rail")
        .join(labelled(bus, "bus"), ["sta_lat", "sta_lon"])
        .withColumn(SHARE, share_pct(F.col("rail_total"), both))
        .withColumn("direction_match", match_flag(F.col("rail_direction"), F.col("bus_direction")))
        .groupBy("radius_m", "direction_match")
        .agg(
            F.count("*").alias("n_zones"),
            _rounded(F.avg(SHARE), digits).alias("avg_share"),
            _rounded(F.percentile_approx(SHARE, 0.5), digits).alias("median"),
        )
    )


# --- how each mode is used -----------------------------------------------------------


def _times(study: Study) -> Column:
    """How often the use of a stop counts."""
    return F.lit(1) if study.settings.distinct_stops else F.col("n_zones")


def _share_by(study: Study, radii_m: Sequence[int], dim: str, digits: int | None) -> DataFrame:
    """Both modes by ``dim``: all located rail use, bus use once per zone a stop lies in, or once."""

    def build(radii: Sequence[int]) -> DataFrame:
        rail = (
            study.rail_by_station(dim, rail_trips=F.sum(trips()))
            .groupBy(dim)
            .agg(F.sum("rail_trips").alias("rail_trips"))
        )
        bus = (
            study.bus_by_stop(dim, bus_trips=F.sum(trips()))
            .join(stop_memberships(study, radii), "stop_id")
            .groupBy("radius_m", dim)
            .agg(F.sum(F.col("bus_trips") * _times(study)).alias("bus_trips"))
        )
        return rail.join(bus, dim).select("radius_m", dim, "rail_trips", "bus_trips")

    both = F.col("rail_trips") + F.col("bus_trips")
    return (
        study.shared_by_radius(f"use-by-{dim}", radii_m, build)
        .withColumn("rail_m", F.round(millions(F.col("rail_trips")), 1))
        .withColumn("bus_m", F.round(millions(F.col("bus_trips")), 1))
        .withColumn("total_m", F.round(millions(both), 1))
        .withColumn("share", _rounded(share_pct(F.col("rail_trips"), both), digits))
        .orderBy("radius_m", dim)
    )


def share_month(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Use of both modes and rail share by month."""
    return _share_by(study, radii_m, "ym", digits)


def share_hour(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Use of both modes and rail share by hour."""
    return _share_by(study, radii_m, "hr", digits)


def _peak_sums(study: Study) -> dict[str, Column]:
    at_peak = F.col("hr").isin(*study.settings.peak_hours)
    return {"peak_trips": F.sum(F.when(at_peak, trips()).otherwise(0)), "all_trips": F.sum(trips())}


def peak_rail(study: Study, digits: int | None = 2) -> DataFrame:
    """Part of all located rail use that falls in the peak hours."""
    peak, whole = F.sum("peak_trips"), F.sum("all_trips")
    return study.rail_by_station(**_peak_sums(study)).agg(
        peak.alias("peak_trips"),
        whole.alias("all_trips"),
        _rounded(share_pct(peak, whole), digits).alias("peak_pct"),
    )


def peak_bus(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Part of bus use in reach of stations that falls in the peak hours."""
    peak = F.sum(F.col("peak_trips") * _times(study))
    whole = F.sum(F.col("all_trips") * _times(study))
    return (
        study.bus_by_stop(**_peak_sums(study))
        .join(stop_memberships(study, radii_m), "stop_id")
        .groupBy("radius_m")
        .agg(
            peak.alias("peak_trips"),
            whole.alias("all_trips"),
            _rounded(share_pct(peak, whole), digits).alias("peak_pct"),
        )
    )


def top_stations(study: Study, n: int = 20) -> DataFrame:
    """The ``n`` busiest stations, ties by name."""
    return (
        study.rail_by_station(total_trips=F.sum(trips()))
        .select("station", "line", "total_trips", F.round(millions(F.col("total_trips")), 1).alias("total_m"))
        .orderBy(F.desc("total_trips"), "station", "line")
        .limit(n)
    )


def top_stops(study: Study, radius_m: int, n: int = 20) -> DataFrame:
    """The ``n`` busiest stops in reach of a station, ties by id.

    ``total_trips`` counts a stop once for every zone it lies in; ``stop_trips`` is its plain sum.
    """
    return (
        study.bus_by_stop(stop_trips=F.sum(trips()))
        .join(stop_memberships(study, [radius_m]), "stop_id")
        .join(study.stop_names, "stop_id", "left")
        .withColumn("total_trips", F.col("stop_trips") * F.col("n_zones"))
        .select(
            "stop_id",
            "stop_name",
            "n_zones",
            "stop_trips",
            "total_trips",
            F.round(millions(F.col("total_trips")), 2).alias("total_m"),
        )
        .orderBy(F.desc("total_trips"), "stop_id")
        .limit(n)
    )
