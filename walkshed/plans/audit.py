"""Counts that show whether each step did what it should."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.functions.numbers import share_pct
from walkshed.plans.study import Study, has_place
from walkshed.plans.zones import bus_in_reach


def value_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(F.col(column).alias(name))
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), name)
    )


def duplicate_stops(study: Study) -> DataFrame:
    """Rows, distinct ids and surplus rows of the stop master."""
    per_id = study.stop_master.groupBy("STOPS_NO").agg(F.count("*").alias("n"))
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_ids"),
        F.sum(F.col("n") - 1).alias("n_surplus"),
    )


def unlocated_rows(study: Study) -> DataFrame:
    """Rows of each coordinate master, and those without a coordinate, which locate nothing."""

    def count(master: DataFrame, name: str, lat: str, lon: str) -> DataFrame:
        return master.agg(
            F.count("*").alias("n_rows"), F.count_if(~has_place(lat, lon)).alias("n_unlocated")
        ).select(F.lit(name).alias("master"), "*")

    rail = count(study.station_master, "rail", "LAT", "LOT")
    return rail.unionByName(count(study.stop_master, "bus", "YCRD", "XCRD"))


def match_rate(study: Study) -> DataFrame:
    """How much of each mode's ridership has coordinates, by rows and by keys."""
    stations = study.stations.select("sta_norm", "line_norm", F.lit(1).alias("found"))
    stops = study.stops.select("stop_id", F.lit(1).alias("found"))
    rail = study.normalised(study.all_rail(n=F.sum("n_rows"))).join(stations, ["sta_norm", "line_norm"], "left")
    bus = study.bus_by_stop(n=F.sum("n_rows")).join(stops, "stop_id", "left")

    def rates(df: DataFrame, mode: str) -> DataFrame:
        found = F.col("found").isNotNull()
        return df.agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(found, F.col("n")).otherwise(0)).alias("n_matched_rows"),
            F.count("*").alias("n_keys"),
            F.count_if(found).alias("n_matched_keys"),
        ).select(
            F.lit(mode).alias("mode"),
            "*",
            share_pct(F.col("n_matched_rows"), F.col("n_rows")).alias("row_pct"),
            share_pct(F.col("n_matched_keys"), F.col("n_keys")).alias("key_pct"),
        )

    return rates(rail, "rail").unionByName(rates(bus, "bus"))


def stage_counts(study: Study) -> DataFrame:
    """Rows of every table between the hourly input and the zones."""

    def count(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")

    def total(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")

    def both(df: DataFrame, geo: str, total: str) -> DataFrame:
        sums = df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(geo), F.count("*").alias(total))
        return sums.unpivot([], [geo, total], "stage", "n_rows")

    rail = study.rail_by_station(n=F.sum("n_rows"))
    every_stop = study.bus_by_stop(n=F.sum("n_rows"))
    bus = every_stop.join(study.stops, "stop_id")
    reached = bus_in_reach(study, study.radii_m, n=F.sum("n_rows")).join(
        study.station_keys, ["sta_lat", "sta_lon"]
    )
    per_radius = reached.groupBy("radius_m").agg(
        F.sum("n_stops").alias("pairs"), F.count("*").alias("zones")
    )
    zones = per_radius.unpivot(["radius_m"], ["pairs", "zones"], "what", "n_rows").select(
        F.concat_ws("_", "what", F.col("radius_m").cast("string")).alias("stage"), "n_rows"
    )
    tables = [
        total(study.all_rail(n=F.sum("n_rows")), "rail_hourly"),
        total(every_stop, "bus_hourly"),
        count(study.station_master, "rail_coord"),
        count(study.stop_master, "bus_coord"),
        both(rail, "rail_geo", "rail_total"),
        both(bus, "bus_geo", "bus_total"),
        zones,
    ]
    return reduce(DataFrame.unionByName, tables)
