"""Registered queries: every operator and analysis over the test tables, with its SQL twin.

The tables are read as two ridership feeds and their coordinate masters
(``walkshed.testdata``). Shares and distances are rounded to a number of digits at which
both engines agree; the columns in millions are compared as they are presented.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import oracle_queries
from walkshed import testdata
from walkshed.functions.geo import great_circle_km
from walkshed.operators import reshape
from walkshed.plans import analysis, audit, charts, places, quantiles, study as studies, views, zones
from walkshed.schema import BUS, RAIL, SERVICE_DATASETS
from walkshed.session import new_folder
from walkshed.sources import bucketed, hourly, month_sums, pages, raw_csv

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
KM_DIGITS = 9


def entry(spark: SparkSession) -> DataFrame:
    """Zones of 500 m with their totals, rail share and line type."""
    return queries()["zone_typed_500"](spark, "/root/testdata/sf0.001")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources ---------------------------------------------------------------------------


def _raw_files(wide: DataFrame, ym: str) -> str:
    """Write raw records as CSV by month; from 1998 on the columns come in another order."""
    spark = wide.sparkSession
    base = new_folder(spark, "raw")
    old = F.col(ym) < "199801"
    for name, part, columns in (
        ("old", wide.where(old), wide.columns),
        ("new", wide.where(~old), wide.columns[::-1]),
    ):
        (
            part.select(*columns, F.col(ym).alias("delivered"))
            .hint("rebalance", "delivered")
            .write.option("header", "true")
            .partitionBy("delivered")
            .csv(f"{base}/{name}")
        )
    return base


def _scan(wide: Callable, ym: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = wide(spark, sf_dir)
        found = raw_csv.scan_wide(spark, _raw_files(source, ym), one_header_per="folder")
        return found.select(*source.columns)

    return run


def _scan_master(master: Callable, scan: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_folder(spark, "coords")
        master(spark, sf_dir).write.option("header", "true").csv(path)
        return scan(spark, path)

    return run


def _roundtrip_rail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "hourly-rail")
    packed = reshape.packed_records(testdata.rail_wide(spark, sf_dir), RAIL)
    hourly.write_hourly(packed, path, RAIL, official_names=True)
    return hourly.read_hourly(spark, path, RAIL)


def _roundtrip_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "hourly-bus")
    hourly.write_hourly(reshape.packed_records(testdata.bus_wide(spark, sf_dir), BUS), path, BUS)
    per_stop = (
        hourly.read_hourly(spark, path, BUS)
        .groupBy("year", "month", "hr", "stop_id")
        .agg(F.count("*").alias("n"), F.sum("on_cnt").alias("on_cnt"), F.sum("off_cnt").alias("off_cnt"))
    )
    return per_stop.groupBy("year", "month", "hr").agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_stops"),
        F.sum("on_cnt").alias("on_cnt"),
        F.sum("off_cnt").alias("off_cnt"),
    )


def _bus_by_stop_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per stop from a bucketed version of the hourly table, without a shuffle."""
    path = new_folder(spark, "hourly-versions")
    bucketed.write_version(reshape.packed_records(testdata.bus_wide(spark, sf_dir), BUS), path, BUS, buckets=8)
    return bucketed.read_version(spark, path, BUS).groupBy("stop_id").agg(
        F.count("*").alias("n_rows"), F.sum("on_cnt").alias("on_cnt"), F.sum("off_cnt").alias("off_cnt")
    )


def _kept_bus_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums kept by month, first of the older months, then of those that came and changed since."""
    path, kept = new_folder(spark, "hourly-bus"), new_folder(spark, "kept-bus")
    wide = testdata.bus_wide(spark, sf_dir)
    older = F.col("USE_YM") < "199801"
    hourly.write_hourly(reshape.packed_records(wide.where(older), BUS), path, BUS)
    month_sums.refresh(spark, path, kept, BUS)
    hourly.write_hourly(reshape.packed_records(wide.where(~older), BUS), path, BUS, only_given_months=True)
    month_sums.refresh(spark, path, kept, BUS)
    ym = F.col("ym").cast("int")
    return (
        month_sums.read_sums(spark, kept, BUS)
        .groupBy(F.floor(ym / 100).cast("int").alias("year"), (ym % 100).alias("month"), "hr")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count("*").alias("n_stops"),
            F.sum("on_cnt").alias("on_cnt"),
            F.sum("off_cnt").alias("off_cnt"),
        )
    )


PAGE_COLUMNS = {
    testdata.RAIL_SERVICE: testdata.RAIL_COLUMNS,
    testdata.BUS_SERVICE: testdata.BUS_COLUMNS,
}


def _page_rows(service: str) -> Query:
    return lambda spark, d: pages.page_rows(testdata.pages(spark, d), PAGE_COLUMNS[service], service)


def _page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = pages.month_status(testdata.pages(spark, sf_dir))
    missing = (F.col("list_total_count") - F.col("n_rows")).alias("n_missing")
    return status.select("service", "ym", "n_rows", "list_total_count", missing)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "landed")
    pages.land(testdata.pages(spark, sf_dir), path, PAGE_COLUMNS)
    return path


def _landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir)

    def counts(service: str, ym: str) -> DataFrame:
        dataset = SERVICE_DATASETS[service]
        rows = raw_csv.scan_wide(spark, f"{path}/{dataset}", one_header_per="folder")
        return rows.groupBy(F.lit(dataset).alias("dataset"), F.col(ym).alias("ym")).agg(F.count("*").alias("n_rows"))

    return counts(testdata.RAIL_SERVICE, "USE_MM").unionByName(counts(testdata.BUS_SERVICE, "USE_YM"))


def _landing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after all pages were landed, and those of one service a second time."""
    path = new_folder(spark, "landed")
    found = testdata.pages(spark, sf_dir)
    pages.land(found, path, PAGE_COLUMNS)
    pages.land(found.where(F.col("service") == testdata.RAIL_SERVICE), path, PAGE_COLUMNS)
    landed = F.col("n_files").isNotNull().alias("landed")
    return pages.landing_log(spark, path).select("service", "ym", "attempt", "status", "n_pages", "n_rows", landed)


def _sources() -> dict[str, Query]:
    return {
        "scan_rail_wide": _scan(testdata.rail_wide, "USE_MM"),
        "scan_bus_wide": _scan(testdata.bus_wide, "USE_YM"),
        "scan_bus_coord": _scan_master(testdata.stop_master, raw_csv.scan_stop_master),
        "scan_rail_coord": _scan_master(testdata.station_master, raw_csv.scan_station_master),
        "hourly_roundtrip": _roundtrip_rail,
        "hourly_roundtrip_bus": _roundtrip_bus,
        "bus_by_stop_bucketed": _bus_by_stop_bucketed,
        "bus_month_sums": _kept_bus_sums,
        "page_status": lambda spark, d: pages.page_status(testdata.pages(spark, d)),
        "page_rows": _page_rows(testdata.BUS_SERVICE),
        "page_rows_rail": _page_rows(testdata.RAIL_SERVICE),
        "page_completeness": _page_completeness,
        "landing_status": lambda spark, d: pages.month_status(testdata.pages(spark, d)).select(
            "service", "ym", "n_pages", "n_failed_pages", "status"
        ),
        "landing_counts": _landing_counts,
        "landing_sizes": lambda spark, d: pages.reconciled(spark, _landed(spark, d)).select(
            "dataset", "ym", "n_rows", "state"
        ),
        "landing_log": _landing_log,
    }


# --- reshape ---------------------------------------------------------------------------


def _row_digest(*columns: str):
    """Sum over the rows of 48 bits of an md5 of all columns; any cell that differs changes it."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint"))


def _reshape() -> dict[str, Query]:
    def standard(wide, spec):
        return lambda spark, d: reshape.standardize(wide(spark, d), spec)

    def on_standard(wide, spec, operator):
        return lambda spark, d: operator(reshape.standardize(wide(spark, d), spec), spec)

    def long(wide, spec, *columns):
        return lambda spark, d: reshape.hourly(wide(spark, d), spec).select(*columns)

    rail, bus = testdata.rail_wide, testdata.bus_wide
    return {
        "standardize_rail": standard(rail, RAIL),
        "standardize_bus": standard(bus, BUS),
        "dedup_rail": on_standard(rail, RAIL, lambda df, s: reshape.dedup(df, s.key, s.delivered)),
        "dedup_bus": on_standard(bus, BUS, lambda df, s: reshape.dedup(df, s.key, s.delivered)),
        "dedup_audit_rail": on_standard(rail, RAIL, lambda df, s: reshape.dedup_audit(df, s.key)),
        "dedup_audit_bus": on_standard(bus, BUS, lambda df, s: reshape.dedup_audit(df, s.key)),
        "unpivot_rail": long(rail, RAIL, *RAIL.key, "job_ymd", "hr", "on_cnt", "off_cnt"),
        "unpivot_bus": lambda spark, d: reshape.hourly(bus(spark, d), BUS)
        .groupBy("stop_id", "hr")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("on_cnt").alias("on_cnt"),
            F.sum("off_cnt").alias("off_cnt"),
            _row_digest(*BUS.raw_columns.values(), "hr", "on_cnt", "off_cnt", "year", "month").alias("row_digest"),
        ),
        "derive_period": lambda spark, d: reshape.with_period(testdata.rail_hourly(spark, d))
        .groupBy("ym", "year", "month")
        .agg(F.count("*").alias("n_rows")),
    }


# --- places and zones ------------------------------------------------------------------


def _on_study(plan: Callable, *args, **kwargs) -> Query:
    return lambda spark, d: plan(testdata.study(spark, d), *args, **kwargs)


def _name_counts(column: str, normed: str) -> Query:
    return (
        lambda spark, d: testdata.study(spark, d)
        .normalised(testdata.rail_hourly(spark, d))
        .groupBy(column, normed)
        .agg(F.count("*").alias("n_rows"))
    )


def _haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every stop from the middle of the city."""
    km = great_circle_km(F.col("YCRD"), F.col("XCRD"), F.lit(37.55), F.lit(126.9625))
    return testdata.stop_master(spark, sf_dir).select(
        F.col("STOPS_NO").alias("stop_id"),
        F.col("YCRD").alias("lat"),
        F.col("XCRD").alias("lon"),
        F.round(km, KM_DIGITS).alias("dist_km"),
    )


def _view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the registered views, as a notebook would write it."""
    views.register_views(testdata.study(spark, sf_dir), [500])
    return spark.sql("""
        SELECT z.line_type, COUNT(*) AS n_pairs, COUNT(DISTINCT p.stop_id) AS n_stops, SUM(t.bus_total) AS bus_total
        FROM zone_typed_500 z
        JOIN pairs_500 p ON z.station = p.station AND z.line = p.line
        JOIN bus_total t ON p.stop_id = t.stop_id
        GROUP BY z.line_type
    """)


def _places() -> dict[str, Query]:
    stop_master, station_master = testdata.stop_master, testdata.station_master
    return {
        "station_norm": _name_counts("station", "sta_norm"),
        "line_norm": _name_counts("line", "line_norm"),
        "rail_coord_unique": _on_study(lambda s: s.stations),
        "bus_coord_unique": _on_study(lambda s: s.stops),
        "bus_coord_duplicates": _on_study(audit.duplicate_stops),
        "unlocated_rows": _on_study(audit.unlocated_rows),
        "stops_without_ferry": lambda spark, d: studies.without_ferry(
            stop_master(spark, d), testdata.SETTINGS.ferry_stop_type
        ),
        "stop_type_counts": lambda spark, d: audit.value_counts(stop_master(spark, d), "STOPS_TYPE", "stop_type"),
        "route_counts": lambda spark, d: audit.value_counts(station_master(spark, d), "ROUTE", "route"),
        "rail_geo": _on_study(places.rail_geo),
        "bus_geo": _on_study(places.bus_geo),
        "match_rate": _on_study(lambda s: _rounded(audit.match_rate(s), DIGITS, "row_pct", "key_pct")),
        "station_locations": _on_study(lambda s: s.station_keys),
        "stop_locations": _on_study(lambda s: s.stop_keys),
        "haversine": _haversine,
        "rail_total": _on_study(zones.rail_total),
        "bus_total": _on_study(zones.bus_total),
        "stage_counts": _on_study(audit.stage_counts),
        "view_query": _view_query,
    }


# --- analyses --------------------------------------------------------------------------


def _pairs(study: studies.Study, radii, box_only: bool = False) -> DataFrame:
    found = places.pairs(study, radii, box_only).select("radius_m", "station", "line", "stop_id", "dist_km")
    return _rounded(found, KM_DIGITS, "dist_km")


def _per_radius() -> dict[str, Callable]:
    """Key pattern -> plan over (study, radii)."""
    share = "rail_share_pct"
    return {
        "pairs_{r}": _pairs,
        "pairs_bbox_{r}": partial(_pairs, box_only=True),
        "zone_stats_{r}": lambda s, r: _rounded(zones.zone_stats(s, r), DIGITS, share),
        "zone_typed_{r}": lambda s, r: _rounded(zones.zone_typed(s, r), DIGITS, share),
        "share_distribution_{r}": partial(analysis.share_distribution, digits=DIGITS),
        "share_by_type_{r}": partial(analysis.share_by_type, digits=DIGITS),
        "rail_hour_type_{r}": analysis.rail_hour_type,
        "bus_hour_type_{r}": analysis.bus_hour_type,
        "share_hour_type_{r}": partial(analysis.share_hour_type, digits=DIGITS),
        "share_hour_type_pivot_{r}": partial(analysis.share_hour_type_matrix, digits=DIGITS),
        "direction_bus_{r}": lambda s, r: _rounded(analysis.direction_bus(s, r), DIGITS, "board_ratio"),
        "direction_join_{r}": analysis.direction_join,
        "direction_share_{r}": partial(analysis.direction_share, digits=DIGITS),
        "share_month_{r}": partial(analysis.share_month, digits=DIGITS),
        "share_hour_{r}": partial(analysis.share_hour, digits=DIGITS),
        "peak_bus_{r}": partial(analysis.peak_bus, digits=DIGITS),
        "zone_month_{r}": lambda s, r: _rounded(quantiles.zone_stats_by_month(s, r), DIGITS, share),
        "share_quantiles_year_{r}": partial(quantiles.share_quantiles_by_year, digits=DIGITS),
        "top_stops_{r}": lambda s, r: analysis.top_stops(s, r[0]),
    }


def _with_settings(plan: Callable, **changes) -> Query:
    """A plan at all radii, under other settings."""
    settings = replace(testdata.SETTINGS, **changes)
    return lambda spark, d: plan(testdata.study(spark, d, settings=settings), testdata.RADII)


def _analyses() -> dict[str, Query]:
    def at_radius(plan: Callable, radius_m: int) -> Query:
        return lambda spark, d: plan(testdata.study(spark, d), [radius_m]).drop("radius_m")

    found = {
        key.format(r=radius_m): at_radius(plan, radius_m)
        for key, plan in _per_radius().items()
        for radius_m in testdata.RADII
    }
    return found | {
        "pairs_exact_circle": _with_settings(_pairs, exact_circle=True),
        "share_month_distinct_stops": _with_settings(
            partial(analysis.share_month, digits=DIGITS), distinct_stops=True
        ),
        "share_hour_distinct_stops": _with_settings(partial(analysis.share_hour, digits=DIGITS), distinct_stops=True),
        "peak_bus_distinct_stops": _with_settings(partial(analysis.peak_bus, digits=DIGITS), distinct_stops=True),
        "direction_rail": _on_study(lambda s: _rounded(analysis.direction_rail(s), DIGITS, "board_ratio")),
        "peak_rail": _on_study(analysis.peak_rail, digits=DIGITS),
        "top_stations": _on_study(analysis.top_stations),
        "radius_comparison": _on_study(analysis.radius_comparison, testdata.RADII, digits=DIGITS),
    }


def _charts() -> dict[str, Query]:
    radii = testdata.RADII
    return {
        "chart_share_hist": _on_study(charts.share_histogram, radii),
        "chart_type_share": _on_study(charts.type_share, radii, digits=DIGITS),
        "chart_heatmap_200": _on_study(charts.heatmap, 200, digits=DIGITS),
        "chart_hourly_200": _on_study(
            lambda s: _rounded(charts.hourly_use(s, 200), DIGITS, "rail_m", "bus_m")
        ),
        "chart_peak": _on_study(charts.peak, radii, digits=DIGITS),
        "chart_top_stations": _on_study(lambda s: _rounded(charts.top_stations(s), DIGITS, "total_m")),
        "chart_top_stops_200": _on_study(lambda s: _rounded(charts.top_stops(s, 200), DIGITS, "total_m")),
    }


def _walkshed_queries() -> dict[str, Query]:
    return _sources() | _reshape() | _places() | _analyses() | _charts()


# --- training-data operators, which may be absent ---------------------------------------


def _llm() -> list:
    """The modules that register training-data queries; none if they are not installed."""
    found = []
    for name in ("walkshed.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ModuleNotFoundError as missing:
            if missing.name not in ("walkshed.llm", "walkshed.llm.queries", "corpus_pipeline"):
                raise
    return found


def queries() -> dict[str, Query]:
    found = _walkshed_queries()
    for module in _llm():
        found |= module.queries()
    return found


def oracle_sql() -> dict[str, str]:
    """DuckDB twins of the queries of the study, all of them, and of the operators that SQL can express."""
    found = oracle_queries()
    for module in _llm():
        found |= module.oracle_sql()
    return found
