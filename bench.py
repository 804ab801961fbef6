"""Time the two jobs end to end: raw CSV to hourly tables, hourly tables to results.

Prints one JSON line. The raw files are made from the test tables first, outside the timings.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from walkshed import jobs, testdata
from walkshed.plans import analysis, places, zones
from walkshed.plans.study import Study
from walkshed.schema import BUS, RAIL
from walkshed.session import build_session, new_folder
from walkshed.sources.hourly import read_hourly
from walkshed.sources.raw_csv import scan_station_master, scan_stop_master

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = new_folder(spark, "bench")
    for name, wide, ym in (
        ("rail", testdata.rail_wide(spark, SF_DIR), "USE_MM"),
        ("bus", testdata.bus_wide(spark, SF_DIR), "USE_YM"),
    ):
        (
            wide.withColumn("delivered", F.col(ym))
            .hint("rebalance", "delivered")
            .write.option("header", "true")
            .partitionBy("delivered")
            .csv(f"{base}/raw/{name}")
        )
    testdata.station_master(spark, SF_DIR).write.option("header", "true").csv(f"{base}/stations")
    testdata.stop_master(spark, SF_DIR).write.option("header", "true").csv(f"{base}/stops")

    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)

    def table(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def study(staged: bool = False) -> Study:
        return Study(
            read_hourly(spark, f"{base}/hourly/rail", RAIL),
            read_hourly(spark, f"{base}/hourly/bus", BUS),
            scan_station_master(spark, f"{base}/stations"),
            scan_stop_master(spark, f"{base}/stops"),
            testdata.SETTINGS,
            staged,
            testdata.RADII,
        )

    for spec in (RAIL, BUS):
        timed(
            f"preprocess_{spec.name}",
            lambda: jobs.preprocess(spark, f"{base}/raw/{spec.name}", f"{base}/hourly/{spec.name}", spec, "folder"),
        )
    queries = {
        "bus_geo": lambda s: places.bus_geo(s),
        "pairs_500": lambda s: places.pairs(s, [500]),
        "zone_stats_500": lambda s: zones.zone_stats(s, [500]),
        "share_distribution_500": lambda s: analysis.share_distribution(s, [500]),
        "share_by_type_500": lambda s: analysis.share_by_type(s, [500]),
        "share_hour_type_pivot_500": lambda s: analysis.share_hour_type_matrix(s, [500]),
        "direction_share_500": lambda s: analysis.direction_share(s, [500]),
        "share_month_500": lambda s: analysis.share_month(s, [500]),
        "share_hour_500": lambda s: analysis.share_hour(s, [500]),
        "peak_bus_500": lambda s: analysis.peak_bus(s, [500]),
        "top_stops_500": lambda s: analysis.top_stops(s, 500),
        "radius_comparison": lambda s: analysis.radius_comparison(s, testdata.RADII),
    }
    for name, plan in queries.items():
        timed(name, lambda: table(plan(study())))
    # All result tables at both radii from staged facts, as one session would make them.
    timed("report_all_tables", lambda: jobs.write_report(study(staged=True), f"{base}/report"))

    records = {
        "rail": testdata.rail_wide(spark, SF_DIR).count(),
        "bus": testdata.bus_wide(spark, SF_DIR).count(),
    }
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "raw_records": records,
                "raw_records_per_sec": {m: round(n / seconds[f"preprocess_{m}"]) for m, n in records.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
