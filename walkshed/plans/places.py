"""Ridership with coordinates, and the stops around each station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.operators.lookup import lookup_join
from walkshed.plans.study import Study


def rail_geo(study: Study) -> DataFrame:
    """Rail rows with their station's coordinates; rows without a match drop out."""
    return lookup_join(study.normalised(study.rail), study.stations, ["sta_norm", "line_norm"]).drop(
        "sta_norm", "line_norm"
    )


def bus_geo(study: Study) -> DataFrame:
    """Bus rows with their stop's coordinates and type; rows without a match drop out."""
    return lookup_join(study.bus, study.stops, ["stop_id"])


def pairs(study: Study, radii_m: Sequence[int], box_only: bool = False) -> DataFrame:
    """Every stop with traffic in reach of every station with traffic, one row per radius."""
    return study.key_pairs(radii_m, box_only).select(
        "radius_m", "station", "line", "stop_id", "sta_lat", "sta_lon", "stop_lat", "stop_lon", "dist_km"
    )


def _memberships(
    study: Study, radii_m: Sequence[int], stations: DataFrame, *station_columns: str
) -> DataFrame:
    per_site = stations.groupBy("sta_lat", "sta_lon", *station_columns).agg(F.count("*").alias("n_zones"))
    per_stop_site = study.sums_in_reach(
        study.sites[0], per_site, radii_m, ["stop_lat", "stop_lon", *station_columns], ["n_zones"]
    )
    return study.stops.join(per_stop_site, ["stop_lat", "stop_lon"]).select(
        "radius_m", "stop_id", *station_columns, "n_zones"
    )


def stop_memberships(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """In how many zones each stop lies: ``radius_m, stop_id, n_zones``.

    A zone is a (station, line), so a stop counts once for every line of an interchange.
    """
    return study.shared_by_radius(
        "memberships", radii_m, lambda radii: _memberships(study, radii, study.station_keys)
    )


def typed_memberships(study: Study, radii_m: Sequence[int], stations: DataFrame) -> DataFrame:
    """The same by the ``line_type`` of the stations."""
    return _memberships(study, radii_m, stations, "line_type")
