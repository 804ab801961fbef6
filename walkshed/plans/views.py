"""The study's tables as temporary views, for analyses written in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.plans import analysis, places, zones
from walkshed.plans.study import Study
from walkshed.schema import BUS, RAIL
from walkshed.sources.hourly import to_official_names

# Column names under which SQL written for the views addresses the tables.
VIEW_COLUMNS = {
    "rail_total": "subway_total",
    "n_stops": "n_stops_in_zone",
    "rail_share_pct": "subway_share_pct",
    "stop_type": "STOPS_TYPE",
    "rail_trips": "subway_h",
    "bus_trips": "bus_h",
    "rail_direction": "subway_label",
    "bus_direction": "bus_label",
}


def view_tables(study: Study, radii_m: Sequence[int]) -> dict[str, DataFrame]:
    """View name -> table; names of tables that depend on the radius end in it."""
    tables = {
        "subway_hourly": to_official_names(study.rail, RAIL),
        "bus_hourly": to_official_names(study.bus, BUS),
        "sub_coord": study.station_master,
        "bus_coord": study.stop_master,
        "subway_geo": to_official_names(places.rail_geo(study), RAIL),
        "bus_geo": to_official_names(places.bus_geo(study), BUS),
        "sub_total": zones.rail_total(study),
        "bus_total": zones.bus_total(study),
    }
    rail_direction = analysis.direction_rail(study)
    for r in radii_m:
        bus_direction = analysis.direction_bus(study, [r])
        at_radius = {
            "pairs": places.pairs(study, [r]),
            "zone_stats": zones.zone_stats(study, [r]),
            "zone_typed": zones.zone_typed(study, [r]),
            "sub_hr_type": analysis.rail_hour_type(study, [r]),
            "bus_hr_type": analysis.bus_hour_type(study, [r]),
            "sub_dir_base": rail_direction.drop("board_ratio", "direction"),
            "sub_dir": rail_direction.withColumnRenamed("direction", "rail_direction"),
            "bus_dir_base": bus_direction.drop("board_ratio", "direction"),
            "bus_dir": bus_direction.withColumnRenamed("direction", "bus_direction"),
            "direction_join": analysis.direction_join(study, [r]),
        }
        if study.few_stations:
            # At most a row per station: broadcast, it does not have the pairs shuffled.
            at_radius |= {name: F.broadcast(at_radius[name]) for name in ("zone_stats", "zone_typed")}
        tables |= {f"{name}_{r}": df.drop("radius_m") for name, df in at_radius.items()}
    return {
        name: df.withColumnsRenamed({k: v for k, v in VIEW_COLUMNS.items() if k in df.columns})
        for name, df in tables.items()
    }


def register_views(study: Study, radii_m: Sequence[int] | None = None) -> list[str]:
    """Register every table as a temporary view and return the names."""
    tables = view_tables(study, study.radii_m if radii_m is None else radii_m)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
