"""Sums kept month by month, and both kinds of sums from one pass."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from walkshed import jobs, testdata
from walkshed.operators.reshape import packed_records
from walkshed.plans import analysis, audit, zones
from walkshed.plans.study import KeptSums, Study, sums_by_hour_and_month
from walkshed.schema import BUS, RAIL
from walkshed.sources import month_sums
from walkshed.sources.bucketed import current_version
from walkshed.sources.hourly import read_hourly, write_hourly

SF = "/root/testdata/sf0.001"


def hourly_rows(spark, *cells):
    """(ym, stop_id, hr, on_cnt) as packed records of one hour each."""
    return spark.createDataFrame(
        [(ym, stop, f"name of {stop}", [hr], [on], [1], int(ym[:4]), int(ym[4:])) for ym, stop, hr, on in cells],
        "ym string, stop_id string, stop_name string, hr array<int>, on_cnt array<bigint>, off_cnt array<bigint>, year int, month int",
    )


def test_only_changed_months_are_summed(spark, tmp_path):
    hourly, kept = str(tmp_path / "hourly"), str(tmp_path / "kept")
    write_hourly(hourly_rows(spark, ("202501", "a", 8, 5), ("202501", "a", 8, 6), ("202502", "b", 9, 7)), hourly, BUS)
    assert month_sums.refresh(spark, hourly, kept, BUS) == ["202501", "202502"]
    assert month_sums.refresh(spark, hourly, kept, BUS) == []
    write_hourly(hourly_rows(spark, ("202502", "b", 9, 1), ("202503", None, 1, 2)), hourly, BUS, only_given_months=True)
    assert month_sums.refresh(spark, hourly, kept, BUS) == ["202502", "202503"]
    columns = ["stop_id", "ym", "hr", "on_cnt", "off_cnt", "n_rows"]
    found = month_sums.read_sums(spark, kept, BUS)
    assert found.columns == columns
    assert rows(found) == [("a", "202501", 8, 11, 2, 2), ("b", "202502", 9, 1, 1, 1), (None, "202503", 1, 2, 1, 1)]
    assert rows(month_sums.read_names(spark, kept, BUS).distinct()) == [("a", "name of a"), ("b", "name of b"), (None, "name of None")]
    write_hourly(hourly_rows(spark, ("202503", "c", 1, 2)), hourly, BUS)
    assert month_sums.refresh(spark, hourly, kept, BUS) == ["202503"]
    assert rows(month_sums.read_sums(spark, kept, BUS), *columns) == [("c", "202503", 1, 2, 1, 1)]
    assert len(month_sums.drop_old_sums(spark, kept)) == 8
    assert rows(month_sums.read_sums(spark, kept, BUS), "stop_id") == [("c",)]


def test_a_refresh_that_fails_leaves_the_old_sums(spark, tmp_path, monkeypatch):
    hourly, kept = str(tmp_path / "hourly"), str(tmp_path / "kept")
    write_hourly(hourly_rows(spark, ("202501", "a", 8, 5)), hourly, BUS)
    month_sums.refresh(spark, hourly, kept, BUS)
    before = current_version(spark, kept)
    write_hourly(hourly_rows(spark, ("202501", "a", 8, 9)), hourly, BUS)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(month_sums, "set_pointer", fails)
        with pytest.raises(RuntimeError):
            month_sums.refresh(spark, hourly, kept, BUS)
    assert current_version(spark, kept) == before
    assert rows(month_sums.read_sums(spark, kept, BUS), "on_cnt") == [(5,)]
    assert month_sums.refresh(spark, hourly, kept, BUS) == ["202501"]
    assert rows(month_sums.read_sums(spark, kept, BUS), "on_cnt") == [(9,)]


def test_no_sums_kept(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        month_sums.read_sums(spark, str(tmp_path), BUS)


def test_kept_study_gives_the_same_results(spark, tmp_path):
    paths = {}
    for spec, wide in ((RAIL, testdata.rail_wide), (BUS, testdata.bus_wide)):
        paths[spec.name] = str(tmp_path / spec.name)
        write_hourly(packed_records(wide(spark, SF), spec), paths[spec.name], spec, official_names=spec is RAIL)
        assert month_sums.refresh(spark, paths[spec.name], str(tmp_path / "kept" / spec.name), spec)
        assert month_sums.refresh(spark, paths[spec.name], str(tmp_path / "kept" / spec.name), spec) == []
    sums = KeptSums(
        month_sums.read_sums(spark, str(tmp_path / "kept" / RAIL.name), RAIL),
        month_sums.read_sums(spark, str(tmp_path / "kept" / BUS.name), BUS),
        month_sums.read_names(spark, str(tmp_path / "kept" / BUS.name), BUS),
    )
    hourly = [read_hourly(spark, paths[s.name], s) for s in (RAIL, BUS)]
    masters = (testdata.station_master(spark, SF), testdata.stop_master(spark, SF), testdata.SETTINGS)
    plain = Study(*hourly, *masters, False, testdata.RADII)
    with Study(*[h.where("false") for h in hourly], *masters, True, testdata.RADII, sums) as kept:
        for plan in (
            lambda s: zones.zone_stats(s, [500]),
            lambda s: analysis.share_month(s, [500]),
            lambda s: analysis.direction_share(s, [500]),
            lambda s: analysis.top_stops(s, 500),
            audit.stage_counts,
            audit.match_rate,
        ):
            wanted = plan(plain)
            assert rows(plan(kept), *wanted.columns) == rows(wanted)


def test_sums_of_one_pass(spark):
    facts = spark.createDataFrame(
        [("a", "202501", 8, 1, 2, 1), ("a", "202501", 9, 3, 4, 1), ("a", "202502", 8, 5, 6, 1), (None, None, 8, 7, 8, 2)],
        "stop_id string, ym string, hr int, on_cnt bigint, off_cnt bigint, n_rows bigint",
    )
    sums = sums_by_hour_and_month(facts, "stop_id")
    assert plan_text(sums).count("Exchange hashpartitioning") == 1
    assert rows(sums.where("by_month = 0"), "stop_id", "hr", "on_cnt", "off_cnt", "n_rows") == [
        ("a", 8, 6, 8, 2), ("a", 9, 3, 4, 1), (None, 8, 7, 8, 2),
    ]
    assert rows(sums.where("by_month = 1"), "stop_id", "ym", "on_cnt", "off_cnt", "n_rows") == [
        ("a", "202501", 4, 6, 2), ("a", "202502", 5, 6, 1), (None, None, 7, 8, 2),
    ]


def test_staged_tables_of_sums_answer_without_the_facts(spark):
    with testdata.study(spark, SF, staged=True) as study:
        bus, rail = study.bus_sums, study.rail_sums
        assert rows(bus.agg(F.sum("n_rows")).select("*")) == [(2 * testdata.bus_hourly(spark, SF).count(),)]
        study.bus = study.rail = None  # nothing below goes back to the ridership
        for dims in ((), ("hr",), ("ym",)):
            assert study.bus_by_stop(*dims, n=F.sum("n_rows")).count() and study.all_rail(*dims, n=F.sum("n_rows")).count()
        assert rail.count()


def test_load_kept_study_reads_one_new_month(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("rail", "bus", "stations", "stops", "kept")]
    write_hourly(packed_records(testdata.rail_wide(spark, SF), RAIL), paths[0], RAIL)
    write_hourly(packed_records(testdata.bus_wide(spark, SF).where("USE_YM < '199801'"), BUS), paths[1], BUS)
    testdata.station_master(spark, SF).write.option("header", "true").csv(paths[2])
    testdata.stop_master(spark, SF).write.option("header", "true").csv(paths[3])
    jobs.load_kept_study(spark, *paths, testdata.SETTINGS, testdata.RADII).close()
    before = current_version(spark, f"{paths[4]}/bus")
    month = packed_records(testdata.bus_wide(spark, SF).where("USE_YM = '199801'"), BUS)
    write_hourly(month, paths[1], BUS, only_given_months=True)
    with jobs.load_kept_study(spark, *paths, testdata.SETTINGS, testdata.RADII) as study:
        after = current_version(spark, f"{paths[4]}/bus")
        assert {m for m in after if after[m] != before.get(m)} == {"199801"}
        wanted = read_hourly(spark, paths[1], BUS).groupBy("ym").agg(F.sum("on_cnt").alias("n"))
        assert rows(study.bus_facts.groupBy("ym").agg(F.sum("on_cnt").alias("n"))) == rows(wanted)
