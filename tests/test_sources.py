"""Raw CSV, hourly Parquet and landed pages."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from walkshed import __main__ as command_line
from walkshed import jobs
from walkshed.operators.reshape import packed_records
from walkshed.plans import analysis
from walkshed.plans.study import Study
from walkshed.schema import LANDED_PAGE, RAIL, STATION_MASTER, STOP_MASTER
from walkshed.sources import pages, raw_csv
from walkshed.sources.hourly import read_hourly, write_hourly
from walkshed.sources.raw_csv import HEADER_BYTES, header_lines, scan_stop_master, scan_station_master, scan_wide
from walkshed.streaming import landing
from walkshed.streaming.landing import land_new_pages


def test_values_follow_the_header_of_their_file(spark, tmp_path):
    (tmp_path / "bus_202501.csv").write_text("USE_YM,RTE_NO,STOPS_ID\n202501,100,0123\n")
    (tmp_path / "bus_202502.csv").write_text("STOPS_ID,USE_YM,RTE_NO\n0456,202502,200\n")
    (tmp_path / "bus_202503.csv").write_text("STOPS_ID,USE_YM,RTE_NO,REG_YMD\n0789,202503,300,x\n")
    found = scan_wide(spark, f"{tmp_path}/*.csv")
    assert rows(found, "USE_YM", "RTE_NO", "STOPS_ID", "REG_YMD") == [
        ("202501", "100", "0123", None),
        ("202502", "200", "0456", None),
        ("202503", "300", "0789", "x"),
    ]


def test_files_of_one_folder_that_differ_fail_loudly(spark, tmp_path):
    (tmp_path / "a.csv").write_text("USE_YM,RTE_NO\n202501,100\n")
    (tmp_path / "b.csv").write_text("RTE_NO,USE_YM\n200,202502\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_wide(spark, str(tmp_path), one_header_per="folder").collect()


def test_byte_order_mark_is_not_part_of_the_first_name(spark, tmp_path):
    (tmp_path / "rail.csv").write_text("﻿USE_MM,STTN\n202501,역\n", encoding="utf-8")
    assert rows(scan_wide(spark, str(tmp_path)), "USE_MM", "STTN") == [("202501", "역")]
    stops = tmp_path / "coords" / "stops.csv"
    stops.parent.mkdir()
    stops.write_text("﻿STOPS_NO,STOPS_NM,NODE_ID,STOPS_TYPE,XCRD,YCRD\n0123,A,0009,bus,126.9,37.5\n", encoding="utf-8")
    assert rows(scan_stop_master(spark, str(stops)), "STOPS_NO", "NODE_ID", "YCRD") == [("0123", "0009", 37.5)]
    stations = tmp_path / "coords" / "stations.csv"
    stations.write_text("﻿BLDN_ID,BLDN_NM,ROUTE,LAT,LOT\n007,A(b),L1,37.5,126.9\n", encoding="utf-8")
    assert rows(scan_station_master(spark, str(stations))) == [("007", "A(b)", "L1", 37.5, 126.9)]


@pytest.mark.parametrize("size", [1_000, 1_000_000, 64_000_000])
def test_headers_are_read_without_the_data(spark, tmp_path, size):
    for n in range(3):
        line = f"2025{n:02},100,0123\n"
        (tmp_path / f"month+{n} .csv").write_text("USE_YM,RTE_NO,STOPS_ID\r\n" + line * (size // len(line)))
    (tmp_path / "empty.csv").write_text("")
    found = header_lines(spark, str(tmp_path)).collect()
    assert len(found) == 3 and {r.header for r in found} == {"USE_YM,RTE_NO,STOPS_ID"}
    assert sum(r.n_bytes for r in found) <= 3 * HEADER_BYTES


def test_headers_of_compressed_long_and_unfinished_files(spark, tmp_path):
    long = ",".join(f"C{i}" for i in range(20_000))
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"USE_YM,RTE_NO\n202501,1\n"))
    (tmp_path / "b.csv").write_text(long)
    assert {r.header for r in header_lines(spark, str(tmp_path)).collect()} == {"USE_YM,RTE_NO", long}
    found = scan_wide(spark, [str(tmp_path / "a.csv.gz")])
    assert rows(found) == [("202501", "1")]


def test_files_that_only_spark_can_open(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("USE_YM,RTE_NO\n202501,1\n")
    (tmp_path / "b.csv").write_text("RTE_NO,USE_YM\n2,202502\n")
    lines = [(str(tmp_path), str(tmp_path / name), None, None) for name in ("a.csv", "b.csv")]
    made = spark.createDataFrame(lines, "folder string, file string, header string, n_bytes bigint")
    monkeypatch.setattr(raw_csv, "header_lines", lambda spark, path: made)
    assert rows(scan_wide(spark, str(tmp_path)), "USE_YM", "RTE_NO") == [("202501", "1"), ("202502", "2")]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_wide(spark, str(tmp_path))


def wide(spark, *months, on="5"):
    return spark.createDataFrame(
        [(ym, "L1", f"S{i}", "20250101", on, "1") for ym in months for i in range(3)],
        "USE_MM string, SBWY_ROUT_LN_NM string, STTN string, JOB_YMD string, HR_0_GET_ON_NOPE string, HR_0_GET_OFF_NOPE string",
    )


def test_hourly_table_round_trip_with_official_names(spark, tmp_path):
    path = str(tmp_path / "hourly")
    write_hourly(packed_records(wide(spark, "202412", "202501"), RAIL), path, RAIL, official_names=True)
    assert sorted(p.name for p in (tmp_path / "hourly").glob("년=*")) == ["년=2024", "년=2025"]
    assert "승차인원" in spark.read.parquet(path).columns
    back = read_hourly(spark, path, RAIL)
    assert rows(back, "year", "month", "ym", "station", "hr", "on_cnt")[0] == (2024, 12, "202412", "S0", 0, 5)
    assert back.count() == 6


def test_reload_of_one_month_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "hourly")
    write_hourly(packed_records(wide(spark, "202412", "202501"), RAIL), path, RAIL)
    write_hourly(packed_records(wide(spark, "202501", on="7"), RAIL), path, RAIL, only_given_months=True)
    sums = read_hourly(spark, path, RAIL).groupBy("ym").agg(F.sum("on_cnt"))
    assert rows(sums) == [("202412", 15), ("202501", 21)]
    write_hourly(packed_records(wide(spark, "202501", on="7"), RAIL), path, RAIL)
    assert rows(read_hourly(spark, path, RAIL).select("ym").distinct()) == [("202501",)]


def test_months_written_with_other_columns_are_read_by_the_declared_schema(spark, tmp_path):
    for n, order in enumerate((("202412", "202501"), ("202501", "202412"))):
        path = str(tmp_path / f"hourly{n}")
        for ym in order:
            month = wide(spark, ym)
            month = month.drop("JOB_YMD") if ym == "202501" else month
            write_hourly(packed_records(month, RAIL), path, RAIL, only_given_months=True)
        found = read_hourly(spark, path, RAIL)
        assert rows(found.select("ym", "job_ymd").distinct()) == [("202412", "20250101"), ("202501", None)]


def test_period_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "hourly")
    write_hourly(packed_records(wide(spark, "202412", "202501", "202502"), RAIL), path, RAIL)
    df = read_hourly(spark, path, RAIL, first_ym=202501, last_ym=202501)
    assert rows(df.select("ym").distinct()) == [("202501",)]
    assert "PartitionFilters: [" in plan_text(df) and "PartitionFilters: []" not in plan_text(df)


def test_analysis_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "hourly")
    write_hourly(packed_records(wide(spark, "202412"), RAIL), path, RAIL)
    empty = spark.createDataFrame([], STATION_MASTER), spark.createDataFrame([], STOP_MASTER)
    study = Study(read_hourly(spark, path, RAIL), None, *empty)
    plan = plan_text(analysis.direction_rail(study))
    assert "In(hr, [7,8,9])" in plan
    assert "job_ymd" not in plan


def test_preprocess_job(spark, tmp_path):
    raw = tmp_path / "raw"
    wide(spark, "202412", "202412", "202501").coalesce(1).write.option("header", "true").csv(str(raw))
    jobs.preprocess(spark, f"{raw}/*.csv", str(tmp_path / "out"), RAIL)
    assert read_hourly(spark, str(tmp_path / "out"), RAIL).count() == 6
    audit = jobs.preprocess_audit(spark, f"{raw}/*.csv", RAIL).first()
    assert (audit.n_before, audit.n_after, audit.n_removed) == (9, 6, 3)


SERVICE = "CardBusTimeNew"


def page(ym, start, body):
    return (SERVICE, ym, start, start + 999, body if isinstance(body, str) else json.dumps(body))


def body(n, total, code="INFO-000", first=0):
    result = {"list_total_count": total, "RESULT": {"CODE": code, "MESSAGE": "m"}}
    if n is not None:
        result["row"] = [{"STOPS_ID": f"0{first + i}", "CNT": 26.0 if i else None} for i in range(n)]
    return {SERVICE: result}


PAGES = [
    page("202501", 1, body(2, 3)),
    page("202501", 1001, body(1, 3, first=2)),
    page("202502", 1, body(2, 5)),
    page("202503", 1, body(2, 4)),
    page("202503", 1001, body(None, 4, "ERROR-500")),
    page("202504", 1, {"RESULT": {"CODE": "INFO-200", "MESSAGE": "none"}}),
    page("202505", 1, body(0, 0)),
    page("202506", 1, "not json"),
    page("202507", 1, body(1, 1, code="")),
]


def test_page_status(spark):
    found = pages.page_status(spark.createDataFrame(PAGES, LANDED_PAGE))
    assert rows(found, "ym", "page_start", "status", "code", "n_rows") == [
        ("202501", 1, "ok", "INFO-000", 2),
        ("202501", 1001, "ok", "INFO-000", 1),
        ("202502", 1, "ok", "INFO-000", 2),
        ("202503", 1, "ok", "INFO-000", 2),
        ("202503", 1001, "error", "ERROR-500", 0),
        ("202504", 1, "no_body", "INFO-200", 0),
        ("202505", 1, "empty", "INFO-000", 0),
        ("202506", 1, "no_body", None, 0),
        ("202507", 1, "ok", "", 1),
    ]


def test_month_status(spark):
    found = pages.month_status(spark.createDataFrame(PAGES, LANDED_PAGE))
    assert rows(found, "ym", "status", "n_rows") == [
        ("202501", "complete", 3),
        ("202502", "incomplete", 2),
        ("202503", "failed", 2),
        ("202504", "failed", 0),
        ("202505", "empty", 0),
        ("202506", "failed", 0),
        ("202507", "complete", 1),
    ]


def test_of_repeated_pages_the_latest_good_one_counts(spark):
    delivered = [
        page("202501", 1, body(2, 4)), page("202501", 1, body(2, 4)),  # the second half is missing
        page("202502", 1, body(None, 2, "ERROR-500")), page("202502", 1, body(2, 2)),
        page("202503", 1, body(3, 2)),
    ]
    df = spark.createDataFrame(delivered, LANDED_PAGE)
    assert rows(pages.month_status(df), "ym", "status", "n_pages", "n_rows") == [
        ("202501", "incomplete", 1, 2), ("202502", "complete", 1, 2), ("202503", "excess", 1, 3),
    ]
    assert pages.page_rows(df, ["STOPS_ID"], SERVICE).count() == 7
    at = [F.lit(t).cast("timestamp").alias("fetched_at") for t in ("2025-01-01", "2025-02-01")]
    first, second = (spark.createDataFrame([page("202501", 1, body(2, 2, first=n))], LANDED_PAGE).select("*", t) for n, t in zip((5, 0), at))
    assert rows(pages.page_rows(first.unionByName(second), ["STOPS_ID"], SERVICE), "STOPS_ID") == [("00",), ("01",)]


def test_landing_from_the_command_line(spark, tmp_path, capsys):
    source, target, columns = str(tmp_path / "pages"), str(tmp_path / "landed"), json.dumps({SERVICE: ["STOPS_ID", "CNT"]})
    spark.createDataFrame(PAGES[:3], LANDED_PAGE).write.json(source)
    command_line.main(["land", source, target, "--columns", columns])
    command_line.main(["status", source, "--columns", columns])
    command_line.main(["sizes", target])
    shown = capsys.readouterr().out
    assert shown.count("incomplete") == 2 and "total" in shown
    assert sorted(p.name for p in (tmp_path / "landed" / "bus").glob("ym=*")) == ["ym=202501", "ym=202502"]


def test_a_month_with_undeclared_keys_is_not_landed(spark, tmp_path):
    df = spark.createDataFrame([page("202501", 1, body(2, 2)), page("202502", 1, body(0, 0))], LANDED_PAGE)
    status = pages.land(df, str(tmp_path / "landed"), {SERVICE: ["STOPS_ID"]})
    assert rows(status, "ym", "status", "n_undeclared_keys") == [("202501", "changed", 1), ("202502", "empty", 0)]
    assert not list((tmp_path / "landed").glob("bus/ym=*"))


def test_page_rows_have_the_declared_columns(spark):
    found = pages.page_rows(spark.createDataFrame(PAGES, LANDED_PAGE), ["STOPS_ID", "CNT", "NEW"], SERVICE)
    assert rows(found.where("page_ym = '202501'"), "STOPS_ID", "CNT", "NEW") == [
        ("00", None, None), ("01", "26.0", None), ("02", None, None)
    ]


def test_landing_skips_failed_and_empty_months(spark, tmp_path):
    path = str(tmp_path / "landed")
    source = spark.createDataFrame(PAGES, LANDED_PAGE)
    pages.land(source, path, {SERVICE: ["STOPS_ID", "CNT"]})
    assert sorted(p.name for p in (tmp_path / "landed" / "bus").glob("ym=*")) == ["ym=202501", "ym=202502", "ym=202507"]
    assert scan_wide(spark, f"{path}/bus", one_header_per="folder").count() == 6
    sizes = pages.landed_sizes(spark, path).collect()
    assert [(r.dataset, r.ym) for r in sizes] == [
        ("bus", "202501"), ("bus", "202502"), ("bus", "202507"), ("total", None)
    ]
    assert sizes[-1].mb == pytest.approx(sum(r.mb for r in sizes[:-1]))


def test_new_pages_land_their_months_whole(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("pages", "landed", "checkpoint"))
    columns = {SERVICE: ["STOPS_ID", "CNT"]}

    def deliver(*delivered):
        spark.createDataFrame(list(delivered), LANDED_PAGE).coalesce(1).write.mode("append").json(source)
        land_new_pages(spark, source, path, columns, checkpoint).awaitTermination()
        return rows(spark.read.option("header", "true").csv(f"{path}/bus").groupBy("ym").count())

    assert deliver(PAGES[0], PAGES[2]) == [(202501, 2), (202502, 2)]
    assert deliver(PAGES[1]) == [(202501, 3), (202502, 2)]


def jobs_run(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_come_from_few_jobs(spark, tmp_path):
    names = ["USE_YM,RTE_NO,STOPS_ID", "STOPS_ID,USE_YM,RTE_NO"]
    for i in range(50):
        folder = tmp_path / ("mixed one+1" if i < 20 else f"even {i % 3}")
        folder.mkdir(exist_ok=True)
        cells = {"USE_YM": f"2025{i:02}", "RTE_NO": "r", "STOPS_ID": f"s{i}"}
        header = names[i % 2 if i < 20 else i % 3 == 0]
        (folder / f"f{i}.csv").write_text(header + "\n" + ",".join(cells[c] for c in header.split(",")) + "\n")
    (tmp_path / "even 1" / "empty.csv").write_text("")
    spark.sparkContext.setJobGroup("headers", "headers of 50 files")
    try:
        found = scan_wide(spark, str(tmp_path))
        assert jobs_run(spark, "headers") <= 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(found, "USE_YM", "RTE_NO", "STOPS_ID") == sorted((f"2025{i:02}", "r", f"s{i}") for i in range(50))
    # Folders whose files agree are scanned as folders: two of even names, and the mixed one's files.
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(1 << 40)


def test_one_header_in_all_folders_is_one_scan(spark, tmp_path):
    for ym in ("202501", "202502"):
        (tmp_path / f"ym={ym}").mkdir()
        (tmp_path / f"ym={ym}" / "a.csv").write_text(f"USE_YM,RTE_NO\n{ym},100\n")
    found = scan_wide(spark, str(tmp_path))
    assert found.columns == ["USE_YM", "RTE_NO"] and rows(found) == [("202501", "100"), ("202502", "100")]
    assert plan_text(found).count("FileScan csv") == 1


def test_preprocess_says_what_it_did_and_sorts_before_hours_are_spread(spark, tmp_path):
    raw = tmp_path / "raw"
    wide(spark, "202412", "202412", "202501").coalesce(1).write.option("header", "true").csv(str(raw))
    done = jobs.preprocess(spark, str(raw), str(tmp_path / "out"), RAIL)
    assert done == {"n_before": 9, "n_after": 6, "n_removed": 3, "n_written": 6}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def landed(spark, source, path, **kwargs):
    pages.land(spark.createDataFrame(source, LANDED_PAGE), path, {SERVICE: ["STOPS_ID", "CNT"]}, **kwargs)


def test_log_holds_every_attempt_and_what_was_landed(spark, tmp_path):
    path = str(tmp_path / "landed")
    assert pages.landing_log(spark, path).count() == 0
    landed(spark, [page("202501", 1, body(2, 2)), page("202502", 1, body(None, 0, code="ERROR-500"))], path)
    landed(spark, [page("202502", 1, body(3, 3))], path)
    log = rows(pages.landing_log(spark, path), "ym", "attempt", "status", "n_rows", "n_files")
    assert log == [("202501", 1, "complete", 2, 1), ("202502", 1, "failed", 0, None), ("202502", 2, "complete", 3, 1)]
    assert rows(pages.landed_months(spark, path), "ym", "attempt") == [("202501", 1), ("202502", 2)]
    on_disk = {p.parent.name: p.stat().st_size for p in (tmp_path / "landed" / "bus").glob("ym=*/*.csv")}
    assert rows(pages.landed_months(spark, path), "ym", "n_bytes") == [(k[3:], v) for k, v in sorted(on_disk.items())]
    found = {(r.dataset, r.ym): (r.n_rows, r.n_files, r.mb, r.state) for r in pages.reconciled(spark, path).collect()}
    assert found["total", None] == (5, 2, sum(on_disk.values()) / 2**20, "as logged") and len(found) == 3


def test_files_that_differ_from_the_log(spark, tmp_path):
    path, columns = str(tmp_path / "landed"), {SERVICE: ["STOPS_ID", "CNT"]}
    landed(spark, [page(ym, 1, body(2, 2)) for ym in ("202501", "202502", "202503", "202504")], path)
    assert pages.damaged_months(spark, path, columns).count() == 0
    base = tmp_path / "landed" / "bus"
    cut = next((base / "ym=202501").glob("*.csv"))
    cut.write_text("".join(cut.read_text().splitlines(True)[:-1]))
    other = next((base / "ym=202502").glob("*.csv"))
    other.write_text(other.read_text().replace("26", "27"))  # as many bytes
    for file in (base / "ym=202503").iterdir():
        file.unlink()
    (base / "ym=209901").mkdir()
    (base / "ym=209901" / "x.csv").write_text("STOPS_ID,CNT\n1,2\n")
    for crc in base.glob("ym=*/.*.crc"):
        crc.unlink()
    states = rows(pages.reconciled(spark, path).where("ym is not null"), "ym", "state")
    assert states == [("202501", "altered"), ("202502", "as logged"), ("202503", "gone"), ("202504", "as logged"), ("209901", "not logged")]
    damaged = rows(pages.damaged_months(spark, path, columns), "ym", "n_rows", "n_found")
    assert damaged == [("202501", 2, 1), ("202502", 2, 2), ("202503", 2, 0)]


def test_services_without_a_list_are_undeclared(spark, tmp_path):
    path = str(tmp_path / "landed")
    other = ("Other", "202501", 1, 1000, json.dumps({"Other": body(2, 2)[SERVICE]}))
    status = pages.land(spark.createDataFrame([page("202501", 1, body(2, 2)), other], LANDED_PAGE), path, {SERVICE: ["STOPS_ID", "CNT"]})
    assert rows(status, "service", "status") == [(SERVICE, "complete"), ("Other", "undeclared")]
    assert rows(pages.landing_log(spark, path), "service", "status", "n_files") == [(SERVICE, "complete", 1), ("Other", "undeclared", None)]
    with pytest.raises(ValueError, match="Nameless"):
        pages.land(spark.createDataFrame([page("202502", 1, body(2, 2))], LANDED_PAGE), path, {SERVICE: ["STOPS_ID", "CNT"], "Nameless": ["A"]})
    assert rows(pages.landing_log(spark, path).select("ym").distinct()) == [("202501",)]  # nothing was written


def arrive(folder, name, *pages_, extra=""):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(dict(zip(LANDED_PAGE.fieldNames(), p))) for p in pages_]
    (folder / name).write_text("".join(f"{line}\n" for line in lines) + extra)


def run_stream(spark, tmp_path):
    args = (str(tmp_path / "pages"), str(tmp_path / "landed"), {SERVICE: ["STOPS_ID", "CNT"]}, str(tmp_path / "checkpoint"))
    land_new_pages(spark, *args).awaitTermination()


def landed_rows(spark, tmp_path):
    found = scan_wide(spark, str(tmp_path / "landed"), one_header_per="folder")
    log = pages.landed_months(spark, str(tmp_path / "landed"))
    return found.count(), rows(log, "ym", "attempt", "n_rows", "status")


def test_a_run_reads_the_folders_of_its_months_alone(spark, tmp_path):
    arrive(tmp_path / "pages", "a.json", page("202501", 1, body(2, 3)), page("202502", 1, body(2, 2)))
    run_stream(spark, tmp_path)
    assert landed_rows(spark, tmp_path) == (4, [("202501", 1, 2, "incomplete"), ("202502", 1, 2, "complete")])
    run_stream(spark, tmp_path)  # nothing new: nothing is landed again
    assert landed_rows(spark, tmp_path)[1][0][1] == 1
    (tmp_path / "pages" / "a.json").write_text("the pages of earlier runs are not read again")
    for file in (tmp_path / "checkpoint" / "pages").glob("service=*/ym=202502/*/*.parquet"):
        file.write_text("nor are those of other months")
    for crc in (tmp_path / "checkpoint" / "pages").glob("service=*/ym=202502/*/.*.crc"):
        crc.unlink()
    arrive(tmp_path / "pages", "b.json", page("202501", 1001, body(1, 3, first=2)))
    run_stream(spark, tmp_path)
    assert landed_rows(spark, tmp_path) == (5, [("202501", 2, 3, "complete"), ("202502", 1, 2, "complete")])


def test_a_batch_lost_before_its_end_is_run_again(spark, tmp_path, monkeypatch):
    arrive(tmp_path / "pages", "a.json", page("202501", 1, body(2, 2)))
    with monkeypatch.context() as broken:
        def lost(*args):
            raise RuntimeError("executor lost")

        broken.setattr(landing, "land", lost)
        with pytest.raises(Exception, match="executor lost"):
            run_stream(spark, tmp_path)
    run_stream(spark, tmp_path)
    assert landed_rows(spark, tmp_path) == (2, [("202501", 1, 2, "complete")])
    assert landing.known_pages(spark, str(tmp_path / "checkpoint")).count() == 1  # written twice, there once


def test_damaged_lines_are_set_aside(spark, tmp_path):
    whole = json.dumps(dict(zip(LANDED_PAGE.fieldNames(), page("202502", 1, body(2, 2)))))
    arrive(tmp_path / "pages", "a.json", page("202501", 1, body(2, 2)), extra=whole[:40] + "\n" + '{"page_start": 1}\n')
    path = str(tmp_path / "pages")
    assert rows(pages.scan_pages(spark, path), "ym") == [("202501",)]
    bad = pages.damaged_lines(spark, path)
    assert {r.line for r in bad.collect()} == {whole[:40], '{"page_start":1}'}
    assert [r["count"] for r in bad.groupBy("file").count().collect()] == [2]
    run_stream(spark, tmp_path)
    assert landed_rows(spark, tmp_path) == (2, [("202501", 1, 2, "complete")])
    assert spark.read.parquet(str(tmp_path / "checkpoint" / "damaged")).count() == 2


def test_declared_keys_become_columns_the_first_of_a_key_that_comes_twice(spark):
    body = '{"S": {"list_total_count": 3, "RESULT": {"CODE": "INFO-000"}, "row": [%s]}}'
    records = '{"a": "1", "b": null, "x": "9"}, {"b": "2", "a": "3", "b": "4"}, {}, {"a": ""}'
    page = spark.createDataFrame([("S", "199801", 1, 4, body % records)], LANDED_PAGE)
    found = pages.page_rows(page, ["b", "a", "c"])
    assert found.columns == ["service", "page_ym", "b", "a", "c"]
    assert [tuple(r)[2:] for r in found.collect()] == [(None, "1", None), ("2", "3", None), (None, None, None), (None, "", None)]
    # One pass over the keys of a record, and no lookup for each name.
    assert "MapInArrow" in plan_text(found) and "element_at(r" not in plan_text(found)
