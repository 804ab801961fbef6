"""Rail shares of zones month by month, as sketches whose quantiles can be had for any set of months.

A sketch (KLL) of one month is some kilobytes, whatever the number of zones. Sketches of months merge
into one of all of them, so that quantiles over a year, or over the months around an event, need
neither the shares nor the ridership again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.functions.numbers import share_pct
from walkshed.plans.study import Study
from walkshed.plans.zones import bus_in_reach, trips

SHARE = "rail_share_pct"

#: Size of a sketch. Up to this many shares, all are kept and quantiles are exact. Beyond, the rank of a
#: quantile is off by less than 0.1 % of the shares with a probability of 99 %, and differs between runs by that.
SKETCH_K = 8192
QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def zone_stats_by_month(study: Study, radii_m: Sequence[int]) -> DataFrame:
    """Rail and bus totals and rail share per zone and month, where both modes have rows.

    ``n_stops`` counts the stops in reach with rows in the month. A share of no trips is NULL.
    """
    rail = study.rail_by_station("ym", rail_total=F.sum(trips()))
    bus = bus_in_reach(study, radii_m, "ym", bus_total=F.sum(trips()))
    both = F.col("rail_total") + F.col("bus_total")
    return (
        rail.join(bus, ["sta_lat", "sta_lon", "ym"])
        .select("radius_m", "ym", "station", "line", "rail_total", "bus_total", "n_stops")
        .withColumn(SHARE, share_pct(F.col("rail_total"), both))
    )


def share_sketches(study: Study, radii_m: Sequence[int], k: int = SKETCH_K) -> DataFrame:
    """``radius_m, ym, n_zones, sketch``: the rail shares of a month's zones. NULL shares are in no sketch.

    Staged studies write those of the default size once.
    """

    def build(radii: Sequence[int]) -> DataFrame:
        shares = zone_stats_by_month(study, radii).where(F.col(SHARE).isNotNull())
        return shares.groupBy("radius_m", "ym").agg(
            F.count("*").alias("n_zones"), F.kll_sketch_agg_double(SHARE, k).alias("sketch")
        )

    return study.shared_by_radius(f"share-sketches-{k}", radii_m, build)


def merged_quantiles(sketches: DataFrame, *by: str, digits: int | None = 2, k: int = SKETCH_K) -> DataFrame:
    """Quantiles over all months that agree in ``by``: columns of the sketches, or derived from ``ym``.

    A quantile is the smallest share that at least that part of the shares do not exceed.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("n_zones").alias("n_zones"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )

    def at(rank: float):
        value = F.kll_sketch_get_quantile_double("sketch", F.lit(rank).cast("double"))
        return value if digits is None else F.round(value, digits)

    return merged.select(*by, "n_zones", *[at(rank).alias(name) for name, rank in QUANTILES.items()])


def share_quantiles_by_year(study: Study, radii_m: Sequence[int], digits: int | None = 2) -> DataFrame:
    """Quartiles of the monthly rail shares of all zones, by year."""
    sketches = share_sketches(study, radii_m).withColumn("year", F.substring("ym", 1, 4).cast("int"))
    return merged_quantiles(sketches, "radius_m", "year", digits=digits)
