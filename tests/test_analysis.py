"""Zones and analyses on a small city worked out by hand, and staged against unstaged."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from walkshed import jobs, testdata
from walkshed.plans import analysis, audit, charts, places, views, zones
from walkshed.plans.study import Study
from walkshed.schema import Settings

SF = "/root/testdata/sf0.001"
METRE = 1 / 111_195  # degrees of latitude

# Station A is on lines L1 and L2 (two zones at one position), B is 300 m north of it, C far away.
STATIONS = [("1", "A(x)", "L1", 37.5, 127.0), ("2", "A", "L2 ext", 37.5, 127.0), ("3", "B", "L1", 37.5 + 300 * METRE, 127.0),
            ("4", "C", "L1", 38.5, 127.0), ("5", "Unused", "L1", 37.5, 127.0)]
# Stop s1 stands at A, s2 at B, s3 and s4 share a position 450 m south of A; f is a ferry, u has no type.
STOPS = [("s1", "bus", 127.0, 37.5), ("s2", "bus", 127.0, 37.5 + 300 * METRE), ("s3", "bus", 127.0, 37.5 - 450 * METRE),
         ("s4", "bus", 127.0, 37.5 - 450 * METRE), ("f", "ferry", 127.0, 37.5), ("u", None, 127.0, 37.5), ("idle", "bus", 127.0, 37.5)]
RAIL = [("202501", "L1", "A(y)", 8, 30, 70), ("202501", "L1", "A(y)", 12, 50, 50), ("202502", "L2", "A", 8, 10, 0),
        ("202501", "L1", "B", 8, 0, 0), ("202501", "L1", "B", 20, 100, 0), ("202501", "L1", "C", 9, 500, 500),
        ("202501", "L9", "Nowhere", 8, 999, 999)]
BUS = [("202501", "r1", "s1", "Stop one", 8, 10, 30), ("202501", "r2", "s1", "Stop one east", 8, 0, 10), ("202502", "r1", "s2", "Stop two", 18, 40, 0),
       ("202501", "r1", "s3", "Stop three", 8, 5, 0), ("202501", "r1", "s4", "Stop four", 13, 0, 7),
       ("202501", "r1", "f", "Pier", 8, 900, 900), ("202501", "r1", "u", "Untyped", 8, 900, 900), ("202501", "r1", "gone", "Gone", 8, 900, 900)]
SETTINGS = Settings(line_renames={"L2": "L2 ext"}, line_types={"one": ["L1"], "two": ["L2"]}, other_line_type="other", ferry_stop_type="ferry")


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "staged"])
def city(spark, request):
    return Study(
        spark.createDataFrame(RAIL, "ym string, line string, station string, hr int, on_cnt bigint, off_cnt bigint"),
        spark.createDataFrame(BUS, "ym string, route_no string, stop_id string, stop_name string, hr int, on_cnt bigint, off_cnt bigint"),
        spark.createDataFrame(STATIONS, "BLDN_ID string, BLDN_NM string, ROUTE string, LAT double, LOT double"),
        spark.createDataFrame(STOPS, "STOPS_NO string, STOPS_TYPE string, XCRD double, YCRD double"),
        SETTINGS,
        staged=request.param,
    )


def test_geo_keeps_only_matched_rows(city):
    assert places.rail_geo(city).count() == 6
    assert places.bus_geo(city).count() == 5


def test_pairs(city):
    found = places.pairs(city, [500, 200])
    assert rows(found, "radius_m", "station", "line", "stop_id") == [
        (200, "A", "L2", "s1"), (200, "A(y)", "L1", "s1"), (200, "B", "L1", "s2"),
        (500, "A", "L2", "s1"), (500, "A", "L2", "s2"), (500, "A", "L2", "s3"), (500, "A", "L2", "s4"),
        (500, "A(y)", "L1", "s1"), (500, "A(y)", "L1", "s2"), (500, "A(y)", "L1", "s3"), (500, "A(y)", "L1", "s4"),
        (500, "B", "L1", "s1"), (500, "B", "L1", "s2"),
    ]


def test_zone_stats(city):
    found = rows(zones.zone_typed(city, [500]), "station", "line", "rail_total", "bus_total", "n_stops", "total_in_zone", "line_type")
    assert found == [("A", "L2", 10, 102, 4, 112, "two"), ("A(y)", "L1", 200, 102, 4, 302, "one"), ("B", "L1", 100, 90, 2, 190, "one")]
    share = {r.station: r.rail_share_pct for r in zones.zone_stats(city, [500]).collect()}
    assert share["B"] == pytest.approx(100 * 100 / 190)


def test_stop_in_several_zones_counts_once_per_zone(city):
    assert rows(places.stop_memberships(city, [500]), "stop_id", "n_zones") == [
        ("idle", 3), ("s1", 3), ("s2", 3), ("s3", 2), ("s4", 2)
    ]
    top = analysis.top_stops(city, 500, n=3).collect()
    assert [(r.stop_id, r.stop_name, r.n_zones, r.stop_trips, r.total_trips) for r in top] == [
        ("s1", "Stop one east", 3, 50, 150), ("s2", "Stop two", 3, 40, 120), ("s4", "Stop four", 2, 7, 14)
    ]


def test_month_and_hour_use_all_located_rail(city):
    assert rows(analysis.share_month(city, [500]), "ym", "rail_trips", "bus_trips") == [("202501", 1300, 174), ("202502", 10, 120)]
    assert rows(analysis.share_hour(city, [500]), "hr", "rail_trips", "bus_trips") == [(8, 110, 160)]


def test_hour_type_uses_matched_zones_only(city):
    assert rows(analysis.rail_hour_type(city, [500]), "line_type", "hr", "rail_trips") == [
        ("one", 12, 100), ("one", 20, 100), ("one", 8, 100), ("two", 8, 10)
    ]
    assert rows(analysis.bus_hour_type(city, [500]), "line_type", "hr", "bus_trips") == [
        ("one", 13, 7), ("one", 18, 80), ("one", 8, 105), ("two", 13, 7), ("two", 18, 40), ("two", 8, 55)
    ]
    matrix = analysis.share_hour_type_matrix(city, [500])
    assert matrix.columns == ["radius_m", "hr", "one", "two", "other"]
    assert rows(matrix) == [(500, 8, round(100 * 100 / 205, 2), round(100 * 10 / 65, 2), None)]


def test_directions(city):
    assert rows(analysis.direction_rail(city), "station", "board", "total", "direction") == [
        ("A", 10, 10, "OUTFLOW"), ("A(y)", 30, 100, "INFLOW"), ("B", 0, 0, "BALANCED"), ("C", 500, 1000, "BALANCED")
    ]
    assert rows(analysis.direction_join(city, [500]), "station", "bus_direction", "direction_match") == [
        ("A", "INFLOW", "MISMATCH"), ("A(y)", "INFLOW", "MATCH"), ("B", "INFLOW", "MISMATCH")
    ]
    assert rows(analysis.direction_share(city, [500]), "direction_match", "n_zones") == [("MATCH", 1), ("MISMATCH", 2)]


def test_peaks(city):
    rail = analysis.peak_rail(city).first()
    assert (rail.peak_trips, rail.all_trips) == (1110, 1310)
    assert rows(analysis.peak_bus(city, [500]), "peak_trips", "all_trips") == [(280, 294)]
    assert rows(charts.peak(city, [500, 200]), "mode", "radius_m")[0] == ("bus", 200)


def test_distribution_and_comparison(city):
    found = analysis.share_distribution(city, [500]).first()
    shares = sorted([100 * 10 / 112, 100 * 200 / 302, 100 * 100 / 190])
    assert (found.n_zones, found.min_share, found.median, found.max_share) == (3, *[round(s, 2) for s in shares])
    assert [r.radius_m for r in analysis.radius_comparison(city, [200, 500]).collect()] == [500, 200]


def test_zone_without_any_use_has_no_share(spark):
    empty = Study(
        spark.createDataFrame([("202501", "L1", "A", 8, 0, 0)], "ym string, line string, station string, hr int, on_cnt bigint, off_cnt bigint"),
        spark.createDataFrame([("202501", "r", "s", "n", 8, 0, 0)], "ym string, route_no string, stop_id string, stop_name string, hr int, on_cnt bigint, off_cnt bigint"),
        spark.createDataFrame([("1", "A", "L1", 37.5, 127.0)], "BLDN_ID string, BLDN_NM string, ROUTE string, LAT double, LOT double"),
        spark.createDataFrame([("s", "bus", 127.0, 37.5)], "STOPS_NO string, STOPS_TYPE string, XCRD double, YCRD double"),
        SETTINGS,
    )
    assert zones.zone_stats(empty, [500]).first().rail_share_pct is None
    assert analysis.peak_rail(empty).first().peak_pct is None
    assert charts.share_histogram(empty, [500]).count() == 0


def test_audits(city):
    counts = {r.stage: r.n_rows for r in audit.stage_counts(city).collect()}
    assert counts == {"rail_hourly": 7, "bus_hourly": 8, "rail_coord": 5, "bus_coord": 7, "rail_geo": 6, "rail_total": 4,
                      "bus_geo": 5, "bus_total": 4, "pairs_500": 10, "zones_500": 3, "pairs_200": 3, "zones_200": 3}
    assert rows(audit.match_rate(city), "mode", "n_rows", "n_matched_rows", "n_keys", "n_matched_keys") == [
        ("bus", 8, 5, 7, 4), ("rail", 7, 6, 5, 4)
    ]


def test_charts(city):
    assert charts.heatmap(city, 500).columns == ["line_type", *[f"h{h}" for h in range(24)]]
    assert [r.station_line for r in charts.top_stations(city, 2).collect()] == ["A(y) (L1)", "C (L1)"]
    assert [r.stop_name for r in charts.top_stops(city, 200, 2).collect()] == ["Stop two", "Stop one east"]
    assert sum(r.n_zones for r in charts.share_histogram(city, [500]).collect()) == 3


def test_zone_bus_totals_are_stop_totals_times_memberships(spark):
    study = testdata.study(spark, SF)
    in_zones = zones.zone_stats(study, [500]).agg(F.sum("bus_total")).first()[0]
    per_stop = zones.bus_total(study).join(places.stop_memberships(study, [500]), "stop_id")
    assert in_zones == per_stop.agg(F.sum(F.col("bus_total") * F.col("n_zones"))).first()[0]


def test_staged_study_equals_plain(spark):
    plain, staged = testdata.study(spark, SF), testdata.study(spark, SF, staged=True)
    for plan in (analysis.share_month, analysis.direction_share):
        assert rows(plan(plain, [500, 200])) == rows(plan(staged, [500, 200])), plan.__name__
    assert rows(zones.zone_typed(plain, [350])) == rows(zones.zone_typed(staged, [350]))


def test_report_writes_every_table(city, tmp_path):
    if not city.staged:
        pytest.skip("the report runs on staged tables")
    jobs.write_report(city, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == set(jobs.report(city))


def test_views_answer_sql(spark, city):
    if not city.staged:
        pytest.skip("one registration is enough")
    assert len(views.register_views(city)) == 8 + 2 * 10
    assert rows(spark.sql("SELECT `지하철역`, `승차인원` FROM subway_geo WHERE `시간` = 9")) == [("C", 500)]
    assert rows(spark.sql("SELECT SUM(`승차총승객수`), MAX(`역명`) FROM bus_geo")) == [(55, "Stop two")]
    assert rows(spark.sql("SELECT station, n_stops_in_zone, subway_total, line_type FROM zone_typed_200")) == [
        ("A", 1, 10, "two"), ("A(y)", 1, 200, "one"), ("B", 1, 100, "one")
    ]
    assert rows(spark.sql("SELECT j.subway_label, d.bus_label FROM direction_join_500 j JOIN bus_dir_500 d USING (station, line)"
                          " WHERE j.direction_match = 'MATCH'")) == [("INFLOW", "INFLOW")]
    assert rows(spark.sql("SELECT COUNT(*) FROM pairs_500")) == [(10,)]
    assert rows(spark.sql("SELECT s.hr, s.subway_h, b.bus_h FROM sub_hr_type_500 s JOIN bus_hr_type_500 b"
                          " ON s.line_type = b.line_type AND s.hr = b.hr WHERE s.line_type = 'two'")) == [(8, 10, 55)]


def test_facts_are_summed_before_they_meet_the_pairs(spark):
    plan = plan_text(analysis.share_month(testdata.study(spark, SF), [500]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "TakeOrderedAndProject" in plan_text(analysis.top_stops(testdata.study(spark, SF), 500))
