"""The jobs of the study: raw files to hourly tables, hourly tables to results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from walkshed.operators.reshape import dedup_audit, packed_records, standardize
from walkshed.plans import analysis, audit, charts, zones
from walkshed.plans.study import KeptSums, Study
from walkshed.schema import BUS, RADII_M, RAIL, ModeSpec, Settings
from walkshed.sources import month_sums
from walkshed.sources.hourly import read_hourly, write_hourly
from walkshed.sources.raw_csv import scan_station_master, scan_stop_master, scan_wide


def preprocess(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    spec: ModeSpec,
    one_header_per: str = "file",
    only_given_months: bool = False,
    official_names: bool = True,
) -> dict[str, int]:
    """Raw monthly CSV of one mode to its hourly Parquet table.

    Returns the rows read, kept, removed as copies and written, counted while they pass. A stage that
    runs again after a lost executor can count rows twice; ``preprocess_audit`` counts anew.
    """
    read, kept = Observation("read"), Observation("kept")
    raw = scan_wide(spark, source, one_header_per).observe(read, F.count(F.lit(1)).alias("n"))
    once = packed_records(raw, spec).observe(
        kept, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("hr")), F.lit(0)).alias("n_written")
    )
    write_hourly(once, target, spec, only_given_months, official_names)
    n_before, n_after = read.get["n"], kept.get["n"]
    return {
        "n_before": n_before, "n_after": n_after, "n_removed": n_before - n_after, "n_written": kept.get["n_written"]
    }


def preprocess_audit(
    spark: SparkSession, source: str | list[str], spec: ModeSpec, one_header_per: str = "file"
) -> DataFrame:
    """Rows of the raw files before and after deduplication."""
    return dedup_audit(standardize(scan_wide(spark, source, one_header_per), spec), spec.key)


def load_study(
    spark: SparkSession,
    rail: str,
    bus: str,
    stations: str,
    stops: str,
    settings: Settings = Settings(),
    staged: bool = True,
    radii_m: Sequence[int] = RADII_M,
    first_ym: int | None = None,
    last_ym: int | None = None,
) -> Study:
    """A study over the hourly tables and coordinate files at the given paths, of a period if given."""
    return Study(
        read_hourly(spark, rail, RAIL, first_ym, last_ym),
        read_hourly(spark, bus, BUS, first_ym, last_ym),
        scan_station_master(spark, stations),
        scan_stop_master(spark, stops),
        settings,
        staged,
        radii_m,
    )


def load_kept_study(
    spark: SparkSession,
    rail: str,
    bus: str,
    stations: str,
    stops: str,
    kept: str,
    settings: Settings = Settings(),
    radii_m: Sequence[int] = RADII_M,
) -> Study:
    """A staged study from sums kept by month under ``kept``; of the ridership it reads the months that changed."""
    for spec, hourly in ((RAIL, rail), (BUS, bus)):
        month_sums.refresh(spark, hourly, f"{kept}/{spec.name}", spec)
    sums = KeptSums(
        month_sums.read_sums(spark, f"{kept}/{RAIL.name}", RAIL),
        month_sums.read_sums(spark, f"{kept}/{BUS.name}", BUS),
        month_sums.read_names(spark, f"{kept}/{BUS.name}", BUS),
    )
    return Study(
        read_hourly(spark, rail, RAIL),
        read_hourly(spark, bus, BUS),
        scan_station_master(spark, stations),
        scan_stop_master(spark, stops),
        settings,
        True,
        radii_m,
        sums,
    )


def report(study: Study) -> Mapping[str, DataFrame]:
    """Every result table of the study, by name, for all its radii."""
    radii = study.radii_m
    tables = {
        "match_rate": audit.match_rate(study),
        "stage_counts": audit.stage_counts(study),
        "zones": zones.zone_typed(study, radii),
        "share_distribution": analysis.share_distribution(study, radii),
        "share_by_type": analysis.share_by_type(study, radii),
        "share_hour_type": analysis.share_hour_type_matrix(study, radii),
        "direction_share": analysis.direction_share(study, radii),
        "share_month": analysis.share_month(study, radii),
        "share_hour": analysis.share_hour(study, radii),
        "peak_rail": analysis.peak_rail(study),
        "peak_bus": analysis.peak_bus(study, radii),
        "top_stations": analysis.top_stations(study),
        "radius_comparison": analysis.radius_comparison(study, radii),
        "chart_share_histogram": charts.share_histogram(study, radii),
        "chart_type_share": charts.type_share(study, radii),
        "chart_peak": charts.peak(study, radii),
        "chart_top_stations": charts.top_stations(study),
    }
    for r in radii:
        tables[f"top_stops_{r}"] = analysis.top_stops(study, r)
        tables[f"chart_heatmap_{r}"] = charts.heatmap(study, r)
        tables[f"chart_hourly_{r}"] = charts.hourly_use(study, r)
        tables[f"chart_top_stops_{r}"] = charts.top_stops(study, r)
    return tables


def write_report(study: Study, target: str, at_once: int = 4) -> None:
    """Write every result table as Parquet under ``target/<name>``, a few small jobs at once."""
    tables = report(study)

    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(f"{target}/{name}")

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(write, tables))
