"""The two ridership feeds and coordinate masters, derived from the generic test tables.

Suppliers act as rail stations (nation = line), parts as bus stops, and every line item
is a journey at both. All rows of the tables take part. Some places are spelled or
numbered differently in the masters, so that matching has something to miss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walkshed.plans.study import Study
from walkshed.schema import BUS_RAW_COLUMNS, RAIL_RAW_COLUMNS, SERVICE_DATASETS, PEAK_HOURS, Settings

RADII = (500, 200)
LINE_RENAMES = {"NATION_5": "NATION_5(ext)", "NATION_6": "NATION_6 line"}
LINE_TYPES = {
    "urban": ["NATION_0", "NATION_1", "NATION_2", "NATION_3"],
    "airport": ["NATION_4"],
    "central": ["NATION_5", "NATION_6", "NATION_7"],
    "light": ["NATION_8", "NATION_9"],
    "south": ["NATION_10", "NATION_11", "NATION_12", "NATION_13"],
    "regional": ["NATION_14", "NATION_15", "NATION_16", "NATION_17", "NATION_18", "NATION_19"],
}
SETTINGS = Settings(
    line_renames=LINE_RENAMES, line_types=LINE_TYPES, other_line_type="other", ferry_stop_type="FERRY"
)
# Faults of the feeds: a month delivered twice, and months whose pages are not all there.
DOUBLED_MONTH = "199503"
ERROR_MONTH = "199607"
SHORT_MONTH = "199704"
NO_BODY_MONTH = "199808"
EMPTY_MONTH = "199912"
PLACES_PER_PAGE = 20
# A bus month whose hour 1 ends in the other suffix.
OTHER_SUFFIX_MONTH = "199410"

RAIL_SERVICE, BUS_SERVICE = SERVICE_DATASETS
HOURS = range(24)
RAIL_HOUR_COLUMNS = [f"HR_{h}_GET_{kind}_NOPE" for h in HOURS for kind in ("ON", "OFF")]
BUS_HOUR_COLUMNS = [
    f"HR_{h}_GET_{kind}_{'NOPE' if h == 1 else 'TNOPE'}" for h in HOURS for kind in ("ON", "OFF")
]
OTHER_SUFFIX_COLUMNS = {f"HR_1_GET_{kind}_NOPE": f"HR_1_GET_{kind}_TNOPE" for kind in ("ON", "OFF")}
RAIL_COLUMNS = [*RAIL_RAW_COLUMNS, *RAIL_HOUR_COLUMNS]
BUS_COLUMNS = [*BUS_RAW_COLUMNS, *BUS_HOUR_COLUMNS, *OTHER_SUFFIX_COLUMNS.values()]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ym() -> Column:
    return (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym")


def _peak_factor(factor: int) -> Column:
    return F.when(F.col("hr").isin(*PEAK_HOURS), factor).otherwise(1)


def rail_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ym, line, station, hr, on_cnt, off_cnt``."""
    items = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        _ym(),
        ((F.col("l_orderkey") + 7 * F.col("l_linenumber")) % 24).cast("int").alias("hr"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_partkey") % 50).alias("off"),
    )
    per_supplier = items.groupBy("l_suppkey", "ym", "hr").agg(
        F.sum("quantity").alias("quantity"), F.sum("off").alias("off")
    )
    key = F.col("s_suppkey")
    stations = (
        _table(spark, sf_dir, "supplier")
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "s_suppkey",
            F.col("n_name").alias("line"),
            F.concat(F.lit("ST"), key.cast("string"), F.when(key % 5 == 0, "(alias)").otherwise("")).alias("station"),
        )
    )
    return per_supplier.join(stations, F.col("l_suppkey") == key).select(
        F.col("ym").cast("string").alias("ym"),
        "line",
        "station",
        "hr",
        (F.col("quantity") * (1 + 2 * (key % 3)) * _peak_factor(3)).alias("on_cnt"),
        (F.col("off") * (1 + 2 * ((key + 1) % 3)) * _peak_factor(3)).alias("off_cnt"),
    )


def bus_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ym, route_no, stop_id, stop_name, hr, on_cnt, off_cnt``."""
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_linenumber",
        _ym(),
        ((5 * F.col("l_orderkey") + F.col("l_linenumber")) % 24).cast("int").alias("hr"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        ((F.col("l_suppkey") * 13 + F.col("l_orderkey")) % 50).alias("off"),
    )
    per_stop = items.groupBy("l_partkey", "l_linenumber", "ym", "hr").agg(
        F.sum("quantity").alias("quantity"), F.sum("off").alias("off")
    )
    band = F.floor(((F.col("l_partkey") * 6101) % 10007) / 1250.0)
    stop, route = F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")
    return per_stop.select(
        F.col("ym").cast("string").alias("ym"),
        route.alias("route_no"),
        stop.alias("stop_id"),
        F.concat(F.lit("Stop "), stop, F.lit("/"), route).alias("stop_name"),
        "hr",
        (F.col("quantity") * (1 + 2 * (band % 3)) * _peak_factor(2)).alias("on_cnt"),
        (F.col("off") * (1 + 2 * ((band + 1) % 3)) * _peak_factor(2)).alias("off_cnt"),
    )


def _twice(df: DataFrame, when: Column, unlocated: Column | None = None) -> DataFrame:
    """Add ``copy``: every row as copy 0, the rows of ``when`` as copy 1 and of ``unlocated`` as copy 2 too."""
    copies = [F.lit(0), F.when(when, 1)] + ([] if unlocated is None else [F.when(unlocated, 2)])
    return df.withColumn("copy", F.explode(F.array_compact(F.array(*copies))))


def _grid(key: Column, factor: int, modulus: int, origin: float, extent: float) -> Column:
    return F.lit(origin) + ((key * factor) % modulus).cast("double") / float(modulus) * extent


def station_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``BLDN_ID, BLDN_NM, ROUTE, LAT, LOT``; every 20th station has a second, shifted row.

    Every 30th has one more without coordinates.
    """
    key = F.col("s_suppkey")
    stations = _table(spark, sf_dir, "supplier").join(
        _table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    name = F.concat(
        F.when(key % 50 == 49, "Old ST").otherwise("ST"), key.cast("string"), F.when(key % 7 == 0, "(sub)").otherwise("")
    )
    route = (
        F.when(F.col("n_name") == "NATION_5", "NATION_5(ext)")
        .when(F.col("n_name") == "NATION_6", "NATION_6 line")
        .otherwise(F.col("n_name"))
    )
    there = F.col("copy") != 2
    return _twice(stations, key % 20 == 0, key % 30 == 0).select(
        F.lpad(key.cast("string"), 12, "0").alias("BLDN_ID"),
        name.alias("BLDN_NM"),
        route.alias("ROUTE"),
        F.when(there, _grid(key, 7919, 10007, 37.5, 0.1) + F.col("copy") * 0.0005).alias("LAT"),
        F.when(there, _grid(key, 4729, 10009, 126.9, 0.125)).alias("LOT"),
    )


def stop_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STOPS_NO, STOPS_NM, NODE_ID, STOPS_TYPE, XCRD, YCRD``; every 50th stop has a second row.

    Every 40th has one more without a latitude.
    """
    key = F.col("p_partkey")
    number = key.cast("string")
    return _twice(_table(spark, sf_dir, "part"), key % 50 == 0, key % 40 == 0).select(
        F.when(key % 6 == 0, F.concat(F.lit("0"), number)).otherwise(number).alias("STOPS_NO"),
        F.col("p_name").alias("STOPS_NM"),
        F.lpad(number, 12, "0").alias("NODE_ID"),
        F.when(key % 97 == 0, "FERRY").when(key % 89 == 0, None).otherwise(F.col("p_type")).alias("STOPS_TYPE"),
        _grid(key, 8191, 10009, 126.9, 0.125).alias("XCRD"),
        F.when(F.col("copy") != 2, _grid(key, 6101, 10007, 37.5, 0.1) + F.col("copy") * 0.0005).alias("YCRD"),
    )


def study(spark: SparkSession, sf_dir: str, staged: bool = False, settings: Settings = SETTINGS) -> Study:
    return Study(
        rail_hourly(spark, sf_dir),
        bus_hourly(spark, sf_dir),
        station_master(spark, sf_dir),
        stop_master(spark, sf_dir),
        settings,
        staged,
        RADII,
    )


def _hour_cells(names: list[str], decimal: str | None = None) -> list[Column]:
    """Cell text per hour column; the column named ``decimal`` writes 26 as 26.0."""
    cells = []
    for h in HOURS:
        for kind, count in (("ON", "on_cnt"), ("OFF", "off_cnt")):
            name = next(n for n in names if n.startswith(f"HR_{h}_GET_{kind}_"))
            cell = F.max(F.when(F.col("hr") == h, F.col(count))).cast("string")
            cells.append((F.concat(cell, F.lit(".0")) if name == decimal else cell).alias(name))
    return cells


def rail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rail records, all text; the doubled month comes with a later job date."""
    wide = rail_hourly(spark, sf_dir).groupBy("ym", "line", "station").agg(*_hour_cells(RAIL_HOUR_COLUMNS))
    return _twice(wide, F.col("ym") == DOUBLED_MONTH).select(
        F.col("ym").alias("USE_MM"),
        F.col("line").alias("SBWY_ROUT_LN_NM"),
        F.col("station").alias("STTN"),
        F.concat(F.col("ym"), F.when(F.col("copy") == 0, "03").otherwise("05")).alias("JOB_YMD"),
        *RAIL_HOUR_COLUMNS,
    )


def bus_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bus records, all text; the doubled month comes with a later registration date."""
    wide = (
        bus_hourly(spark, sf_dir)
        .groupBy("ym", "route_no", "stop_id")
        .agg(F.max("stop_name").alias("stop_name"), *_hour_cells(BUS_HOUR_COLUMNS, "HR_3_GET_ON_TNOPE"))
    )
    other = F.col("ym") == OTHER_SUFFIX_MONTH
    wide = wide.withColumns({new: F.when(other, F.col(name)) for name, new in OTHER_SUFFIX_COLUMNS.items()})
    wide = wide.withColumns({name: F.when(~other, F.col(name)) for name in OTHER_SUFFIX_COLUMNS})
    return _twice(wide, F.col("ym") == DOUBLED_MONTH).select(
        F.col("ym").alias("USE_YM"),
        F.col("route_no").alias("RTE_NO"),
        F.concat(F.lit("Route "), F.col("route_no")).alias("RTE_NM"),
        F.col("stop_id").alias("STOPS_ID"),
        F.lpad("stop_id", 12, "0").alias("STOPS_ARS_NO"),
        F.col("stop_name").alias("SBWY_STNS_NM"),
        F.lit("001").alias("TRFC_MNS_TYPE_CD"),
        F.lit("city bus").alias("TRFC_MNS_TYPE_NM"),
        F.concat(F.col("ym"), F.when(F.col("copy") == 0, "03").otherwise("05")).alias("REG_YMD"),
        *BUS_HOUR_COLUMNS,
        *OTHER_SUFFIX_COLUMNS.values(),
    )


def _pages(wide: DataFrame, service: str, ym: str, place_no: Column, columns: list[str]) -> DataFrame:
    keyed = wide.withColumn("ym", F.col(ym)).withColumn(
        "page", F.floor(place_no / PLACES_PER_PAGE).cast("bigint")
    )
    months = keyed.groupBy("ym").agg(F.count("*").alias("total"), F.max("page").alias("last_page"))
    row = F.collect_list(F.struct(*columns))
    # One row per month, so the broadcast stays in the kilobytes.
    pages = keyed.groupBy("ym", "page").agg(row.alias("row")).join(F.broadcast(months), "ym")
    info = F.struct(F.lit("INFO-000").alias("CODE"), F.lit("ok").alias("MESSAGE"))
    error = F.struct(F.lit("ERROR-500").alias("CODE"), F.lit("server error").alias("MESSAGE"))
    none = F.struct(F.lit("INFO-200").alias("CODE"), F.lit("no data").alias("MESSAGE"))

    def payload(*body: Column) -> Column:
        return F.to_json(F.struct(F.struct(*body).alias(service)))

    text = (
        F.when(F.col("ym") == ERROR_MONTH, payload(error.alias("RESULT")))
        .when(F.col("ym") == NO_BODY_MONTH, F.to_json(F.struct(none.alias("RESULT"))))
        .when(F.col("ym") == EMPTY_MONTH, payload(F.lit(0).alias("list_total_count"), info.alias("RESULT")))
        .otherwise(payload(F.col("total").alias("list_total_count"), info.alias("RESULT"), "row"))
    )
    return pages.where((F.col("ym") != SHORT_MONTH) | (F.col("page") != F.col("last_page"))).select(
        F.lit(service).alias("service"),
        "ym",
        (F.col("page") * 1000 + 1).alias("page_start"),
        (F.col("page") * 1000 + 1000).alias("page_end"),
        text.alias("payload"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of both services, 20 places a page, with the faults named above."""
    rail_no = F.regexp_extract("STTN", "[0-9]+", 0).cast("bigint")
    bus_no = F.col("STOPS_ID").cast("bigint")
    rail = _pages(rail_wide(spark, sf_dir), RAIL_SERVICE, "USE_MM", rail_no, RAIL_COLUMNS)
    bus = _pages(bus_wide(spark, sf_dir), BUS_SERVICE, "USE_YM", bus_no, BUS_COLUMNS)
    return rail.unionByName(bus)
