"""Names, coordinates, distances and the radius join."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from walkshed.functions.labels import category, direction, renamed, strip_alias
from walkshed.operators.lookup import lookup_join, measured_bytes
from walkshed.functions.geo import great_circle_km
from walkshed.operators.radius import Grid, busy_cells, radius_pairs, radius_sums, with_radius
from walkshed import testdata
from walkshed.plans import places, views
from walkshed.plans.study import Study, unique_stations, unique_stops
from walkshed.schema import LINE_RENAMES, LINE_TYPES, OTHER_LINE_TYPE, STATION_MASTER, STOP_MASTER


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("name", "norm"), [("A(b)C(d)", "A"), ("A (b)", "A "), ("A", "A"), ("(b)A", "A"), ("A(b", "A(b"), (None, None)]
)
def test_strip_alias(spark, name, norm):
    assert one(spark, name, strip_alias) == norm


@pytest.mark.parametrize(("line", "norm"), [("경의선", "경의중앙선"), ("9호선2~3단계", "9호선(연장)"), ("2호선", "2호선"), (None, None)])
def test_line_renames(spark, line, norm):
    assert one(spark, line, lambda c: renamed(c, LINE_RENAMES)) == norm


@pytest.mark.parametrize(
    ("line", "kind"), [("2호선", "서교공_1-8호선"), ("9호선2~3단계", "9호선"), ("신림선", "경전철"), ("새 노선", "기타"), (None, "기타")]
)
def test_line_type(spark, line, kind):
    assert one(spark, line, lambda c: category(c, LINE_TYPES, OTHER_LINE_TYPE)) == kind


@pytest.mark.parametrize(
    ("board", "total", "label"),
    [(39, 100, "INFLOW"), (40, 100, "BALANCED"), (60, 100, "BALANCED"), (61, 100, "OUTFLOW"), (0, 0, "BALANCED"),
     (2, 5, "BALANCED"), (3, 5, "BALANCED")],
)
def test_direction(spark, board, total, label):
    df = spark.range(1).select(direction(F.lit(board), F.lit(total), 0.4, 0.6).alias("d"))
    assert df.first().d == label


def test_masters_keep_the_smallest_coordinates(spark):
    stations = spark.createDataFrame(
        [("1", "A(x)", "L1", 37.6, 127.0), ("2", "A", "L1", 37.5, 127.1), ("3", "A", "L2", 37.7, 127.0)],
        "BLDN_ID string, BLDN_NM string, ROUTE string, LAT double, LOT double",
    )
    assert rows(unique_stations(stations)) == [("A", "L1", 37.5, 127.1), ("A", "L2", 37.7, 127.0)]
    stops = spark.createDataFrame(
        [("1", "bus", 127.0, 37.6), ("1", "bus", 127.0, 37.5), ("2", None, 127.0, 37.5), ("3", "ferry", 127.0, 37.5)],
        "STOPS_NO string, STOPS_TYPE string, XCRD double, YCRD double",
    )
    assert rows(unique_stops(stops, "ferry")) == [("1", 37.5, 127.0, "bus")]


def haversine(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    b = math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(a + b))


def brute_force(stops, stations, radius_m, box_only=False):
    km = radius_m / 1000
    return sorted(
        (i, j)
        for i, (la, lo) in stops.items()
        for j, (sa, so) in stations.items()
        if sa - km / 111 <= la <= sa + km / 111
        and so - km / 88.7 <= lo <= so + km / 88.7
        and (box_only or haversine(la, lo, sa, so) <= km)
    )


def frames(spark, stops, stations):
    return (
        spark.createDataFrame([(i, *p) for i, p in stops.items()], "stop_id int, stop_lat double, stop_lon double"),
        spark.createDataFrame([(i, *p) for i, p in stations.items()], "station int, sta_lat double, sta_lon double"),
    )


def scattered(seed, n, spread):
    rng = random.Random(seed)
    return {i: (37.5 + rng.uniform(-spread, spread), 127.0 + rng.uniform(-spread, spread)) for i in range(n)}


@pytest.mark.parametrize(("seed", "radius_m"), [(1, 500), (2, 200), (3, 1370), (4, 37)])
@pytest.mark.parametrize("box_only", [False, True])
def test_grid_join_equals_brute_force(spark, seed, radius_m, box_only):
    stops, stations = scattered(seed, 300, 0.02), scattered(seed + 100, 60, 0.02)
    found = radius_pairs(*frames(spark, stops, stations), [radius_m], box_only=box_only)
    assert sorted((r.stop_id, r.station) for r in found.collect()) == brute_force(stops, stations, radius_m, box_only)


def test_all_radii_in_one_join(spark):
    stops, stations = scattered(7, 300, 0.01), scattered(8, 40, 0.01)
    found = radius_pairs(*frames(spark, stops, stations), [200, 500]).collect()
    for radius_m in (200, 500):
        pairs = sorted((r.stop_id, r.station) for r in found if r.radius_m == radius_m)
        assert pairs == brute_force(stops, stations, radius_m)


def test_busy_cells_are_split_without_changing_the_pairs(spark):
    stops = scattered(9, 400, 0.0005) | {1000: (37.9, 127.9), 1001: (37.5, 127.0), 1002: (37.5, 127.0)}
    stations = scattered(10, 30, 0.0005) | {1000: (37.9, 127.9)}
    found = radius_pairs(*frames(spark, stops, stations), [500], pairs_per_task=100)
    assert sorted((r.stop_id, r.station) for r in found.collect()) == brute_force(stops, stations, 500)
    assert "_part" in plan_text(found)
    assert "_part" not in plan_text(radius_pairs(*frames(spark, stops, stations), [500]))


def test_busy_cells_get_parts_by_their_work(spark):
    cell = F.lit(0).cast("bigint")
    stops = spark.range(50).select(cell.alias("_cx"), cell.alias("_cy"))
    stations = spark.range(10).select(cell.alias("_cx"), cell.alias("_cy"))
    assert rows(busy_cells(stops, stations, 100)) == [(0, 0, 5)]
    assert rows(busy_cells(stops, stations, 1)) == [(0, 0, 50)]
    assert busy_cells(stops, stations, 500).isEmpty()


def test_missing_coordinates_pair_with_nothing(spark):
    stops, stations = frames(spark, {1: (None, None), 2: (37.5, 127.0)}, {1: (37.5, 127.0), 2: (None, 127.0)})
    assert [(r.stop_id, r.station) for r in radius_pairs(stops, stations, [500]).collect()] == [(2, 1)]


def test_box_clips_the_circle_to_the_east(spark):
    lat, km_per_degree = 37.55, 2 * math.pi * 6371 / 360 * math.cos(math.radians(37.55))
    stops = {1: (lat, 127.0 + 0.498 / km_per_degree), 2: (lat, 127.0 + 0.490 / km_per_degree)}
    found = radius_pairs(*frames(spark, stops, {1: (lat, 127.0)}), [500]).collect()
    assert [r.stop_id for r in found] == [2]
    assert haversine(*stops[1], lat, 127.0) < 0.5


def test_smaller_radius_is_a_subset(spark):
    stops, stations = scattered(11, 300, 0.01), scattered(12, 40, 0.01)
    found = radius_pairs(*frames(spark, stops, stations), [150, 300, 600]).collect()
    by_radius = {r: {(x.stop_id, x.station) for x in found if x.radius_m == r} for r in (150, 300, 600)}
    assert by_radius[150] < by_radius[300] < by_radius[600]


def test_radius_join_is_no_nested_loop(spark, tmp_path):
    stops, stations = frames(spark, scattered(1, 10, 0.01), scattered(2, 10, 0.01))
    plan = plan_text(radius_pairs(stops, stations, [500]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup_is_broadcast_only_within_the_limit(spark):
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    lookup = spark.range(10).select(F.col("id").alias("k"), F.lit("name").alias("name"))
    size = measured_bytes(lookup)
    assert size >= 10 * (8 + 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = lookup_join(fact, lookup, ["k"]), lookup_join(fact, lookup, ["k"], limit_bytes=size - 1)
        assert "BroadcastHashJoin" in plan_text(small) and "SortMergeJoin" not in plan_text(small)
        assert "BroadcastHashJoin" not in plan_text(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_closing_a_study_deletes_its_staged_tables(spark):
    from pathlib import Path

    with testdata.study(spark, "/root/testdata/sf0.001", staged=True) as study:
        n = study.stops.count()
        folder = Path(study.folder.removeprefix("file:"))
        assert list(folder.glob("stops/*.parquet"))
    assert not folder.exists() and study.stops.count() == n
    study.close()


def test_views_of_one_study_share_their_plans(spark):
    study = testdata.study(spark, "/root/testdata/sf0.001")
    assert study.reach([500]) is study.reach([500]) and study.stops is study.shared("stops", None)


def test_top_stops_sort_no_facts(spark, tmp_path):
    study = testdata.study(spark, "/root/testdata/sf0.001")
    assert "SortAggregate" not in plan_text(study.bus_by_stop(n=F.sum("on_cnt")))


@pytest.mark.parametrize("lat", [0.0, 37.55, -60.0, 75.0])
def test_exact_circle_holds_every_pair_within_the_distance_at_any_latitude(spark, lat):
    stops = spark.range(1600).select(
        (F.lit(lat) + (F.col("id") % 40 - 20) * 0.0004).alias("stop_lat"),
        (F.lit(127.0) + (F.floor(F.col("id") / 40) - 20) * 0.0011).alias("stop_lon"),
    )
    stations = spark.createDataFrame([(lat, 127.0), (lat + 0.003, 126.9961)], "sta_lat double, sta_lon double")
    km = great_circle_km(F.col("stop_lat"), F.col("stop_lon"), F.col("sta_lat"), F.col("sta_lon"))
    every = stops.crossJoin(F.broadcast(stations)).withColumn("km", km)
    found = radius_pairs(stops, stations, [500, 200], exact_circle=True)
    split = radius_pairs(stops, stations, [500, 200], exact_circle=True, pairs_per_task=50)
    for r in (500, 200):
        expected = rows(every.where(F.col("km") <= r / 1000), "stop_lat", "stop_lon", "sta_lat")
        assert expected
        for pairs in (found, split):
            assert rows(pairs.where(F.col("radius_m") == r), "stop_lat", "stop_lon", "sta_lat") == expected


def test_sums_of_pairs_equal_brute_force_with_and_without_a_split(spark):
    stops, stations = scattered(21, 200, 0.01), scattered(22, 40, 0.01)
    left, right = frames(spark, stops, stations)
    left = left.withColumn("n", F.col("stop_id").cast("bigint"))
    grid = Grid([500, 200])
    for busy in (None, grid.busy(left, right, 50)):
        found = radius_sums(grid, grid.near(left, right, busy), ["station"], ["n"])
        wanted = {}
        for radius_m in (200, 500):
            for stop, station in brute_force(stops, stations, radius_m):
                wanted[radius_m, station] = wanted.get((radius_m, station), 0) + stop
        assert {(r.radius_m, r.station): r.n for r in found.collect()} == wanted
        # No pair is shuffled: the task that finds them adds them up.
        assert "sta_lat" not in "".join(x for x in plan_text(found).splitlines() if "hashpartitioning(station" in x)


@pytest.mark.parametrize("exact_circle", [False, True])
def test_pairs_from_a_broadcast_are_those_of_the_cells(spark, exact_circle):
    left, right = frames(spark, scattered(23, 200, 0.01), scattered(24, 40, 0.01))
    grid = Grid([500, 200], exact_circle=exact_circle)
    pairs = [with_radius(grid, found) for found in (grid.near(left, right, None), grid.near_broadcast(left, right))]
    columns = ["radius_m", "stop_id", "station", "dist_km"]
    assert rows(pairs[0], *columns) == rows(pairs[1], *columns)
    kept = left.repartition(4, "stop_id")
    exchanges = [x for x in plan_text(with_radius(grid, grid.near_broadcast(kept, right))).splitlines() if "hashpartitioning" in x]
    assert len(exchanges) == 1


def small_study(spark):
    rail = spark.createDataFrame([("199801", "L", "A", 1, 2, 3)], "ym string, line string, station string, hr int, on_cnt long, off_cnt long")
    bus = spark.createDataFrame([("199801", "1", "s", "S", 1, 2, 3)], "ym string, route_no string, stop_id string, stop_name string, hr int, on_cnt long, off_cnt long")
    stations = spark.createDataFrame([("1", "A", "L", 37.5, 127.0)], STATION_MASTER)
    stops = spark.createDataFrame([("s", "S", "1", "bus", 127.0, 37.5)], STOP_MASTER)
    return Study(rail, bus, stations, stops)


def test_pairs_of_a_study_meet_no_second_join_by_position(spark):
    found = places.pairs(small_study(spark), [500])
    assert rows(found, "station", "stop_id") == [("A", "s")]
    assert not [x for x in plan_text(found).splitlines() if "Join" in x and "stop_lat" in x.split(", Inner")[0]]


def test_sql_over_the_views_shuffles_no_pairs(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        views.register_views(small_study(spark), [500])
        found = spark.sql("SELECT p.stop_id, z.line_type FROM zone_typed_500 z JOIN pairs_500 p ON z.station = p.station AND z.line = p.line")
        assert rows(found) == [("s", "기타")]
        assert [x for x in plan_text(found).splitlines() if "BroadcastHashJoin [station" in x]
        assert not [x for x in plan_text(found).splitlines() if "SortMergeJoin [station" in x]
    finally:
        spark.conf.set(threshold, before)
