"""DuckDB SQL for every registered query, over the same test tables.

``TABLES`` holds named sub-queries; a query is sent with the ones it uses, directly or not.
"""

from __future__ import annotations

import re

PEAK = "(7,8,9,17,18,19)"
MORNING = "(7,8,9)"
HOURS = range(24)
RADII = (500, 200)
LINE_TYPES = ("urban", "airport", "central", "light", "south", "regional", "other")


def hour_column(mode: str, hour: int, kind: str) -> str:
    suffix = "NOPE" if mode == "rail" or hour == 1 else "TNOPE"
    return f"HR_{hour}_GET_{kind}_{suffix}"


def hour_columns(mode: str) -> list[str]:
    return [hour_column(mode, h, kind) for h in HOURS for kind in ("ON", "OFF")]


TABLES: dict[str, str] = {
    "rail_hourly": f"""
        SELECT CAST(year(l.l_shipdate)*100+month(l.l_shipdate) AS VARCHAR) AS ym,
               n.n_name AS line,
               concat('ST', CAST(s.s_suppkey AS VARCHAR), CASE WHEN s.s_suppkey % 5 = 0 THEN '(alias)' ELSE '' END) AS station,
               CAST((l.l_orderkey + 7*l.l_linenumber) % 24 AS INT) AS hr,
               CAST(SUM(CAST(l.l_quantity AS BIGINT) * (1+2*(s.s_suppkey % 3))
                 * CASE WHEN (l.l_orderkey + 7*l.l_linenumber) % 24 IN {PEAK} THEN 3 ELSE 1 END) AS BIGINT) AS on_cnt,
               CAST(SUM((l.l_partkey % 50) * (1+2*((s.s_suppkey+1) % 3))
                 * CASE WHEN (l.l_orderkey + 7*l.l_linenumber) % 24 IN {PEAK} THEN 3 ELSE 1 END) AS BIGINT) AS off_cnt
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
             JOIN nation n ON s.s_nationkey = n.n_nationkey
        GROUP BY 1,2,3,4""",
    "bus_hourly": f"""
        SELECT CAST(year(l_shipdate)*100+month(l_shipdate) AS VARCHAR) AS ym,
               CAST(l_linenumber AS VARCHAR) AS route_no,
               CAST(l_partkey AS VARCHAR) AS stop_id,
               concat('Stop ', CAST(l_partkey AS VARCHAR), '/', CAST(l_linenumber AS VARCHAR)) AS stop_name,
               CAST((5*l_orderkey + l_linenumber) % 24 AS INT) AS hr,
               CAST(SUM(CAST(l_quantity AS BIGINT)
                 * (1+2*(CAST(floor(((l_partkey*6101) % 10007)/1250e0) AS BIGINT) % 3))
                 * CASE WHEN (5*l_orderkey + l_linenumber) % 24 IN {PEAK} THEN 2 ELSE 1 END) AS BIGINT) AS on_cnt,
               CAST(SUM(((l_suppkey*13+l_orderkey) % 50)
                 * (1+2*(CAST(1+floor(((l_partkey*6101) % 10007)/1250e0) AS BIGINT) % 3))
                 * CASE WHEN (5*l_orderkey + l_linenumber) % 24 IN {PEAK} THEN 2 ELSE 1 END) AS BIGINT) AS off_cnt
        FROM lineitem GROUP BY 1,2,3,4,5""",
    "station_master": """
        SELECT lpad(CAST(s.s_suppkey AS VARCHAR), 12, '0') AS BLDN_ID,
               concat(CASE WHEN s.s_suppkey % 50 = 49 THEN 'Old ST' ELSE 'ST' END, CAST(s.s_suppkey AS VARCHAR),
                      CASE WHEN s.s_suppkey % 7 = 0 THEN '(sub)' ELSE '' END) AS BLDN_NM,
               CASE n.n_name WHEN 'NATION_5' THEN 'NATION_5(ext)' WHEN 'NATION_6' THEN 'NATION_6 line' ELSE n.n_name END AS ROUTE,
               CASE WHEN c.copy <> 2 THEN 37.5e0  + CAST((s.s_suppkey*7919) % 10007 AS DOUBLE)/10007e0*0.1e0 + c.copy*0.0005e0 END AS LAT,
               CASE WHEN c.copy <> 2 THEN 126.9e0 + CAST((s.s_suppkey*4729) % 10009 AS DOUBLE)/10009e0*0.125e0 END AS LOT
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
             JOIN (SELECT 0 AS copy UNION ALL SELECT 1 UNION ALL SELECT 2) c
               ON c.copy = 0 OR c.copy = 1 AND s.s_suppkey % 20 = 0 OR c.copy = 2 AND s.s_suppkey % 30 = 0""",
    "stop_master": """
        SELECT CASE WHEN p_partkey % 6 = 0 THEN concat('0', CAST(p_partkey AS VARCHAR)) ELSE CAST(p_partkey AS VARCHAR) END AS STOPS_NO,
               p_name AS STOPS_NM,
               lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS NODE_ID,
               CASE WHEN p_partkey % 97 = 0 THEN 'FERRY' WHEN p_partkey % 89 = 0 THEN NULL ELSE p_type END AS STOPS_TYPE,
               126.9e0 + CAST((p_partkey*8191) % 10009 AS DOUBLE)/10009e0*0.125e0 AS XCRD,
               CASE WHEN c.copy <> 2 THEN 37.5e0  + CAST((p_partkey*6101) % 10007 AS DOUBLE)/10007e0*0.1e0 + c.copy*0.0005e0 END AS YCRD
        FROM part JOIN (SELECT 0 AS copy UNION ALL SELECT 1 UNION ALL SELECT 2) c
               ON c.copy = 0 OR c.copy = 1 AND p_partkey % 50 = 0 OR c.copy = 2 AND p_partkey % 40 = 0""",
    "stations": """
        SELECT sta_norm, line_norm, sta_lat, sta_lon FROM (
          SELECT regexp_replace(BLDN_NM, '[(].*[)]', '') AS sta_norm, ROUTE AS line_norm, LAT AS sta_lat, LOT AS sta_lon,
                 row_number() OVER (PARTITION BY regexp_replace(BLDN_NM, '[(].*[)]', ''), ROUTE ORDER BY LAT, LOT) AS rn
          FROM station_master WHERE LAT IS NOT NULL AND LOT IS NOT NULL) t WHERE rn = 1""",
    "stops": """
        SELECT stop_id, stop_lat, stop_lon, stop_type FROM (
          SELECT STOPS_NO AS stop_id, YCRD AS stop_lat, XCRD AS stop_lon, STOPS_TYPE AS stop_type,
                 row_number() OVER (PARTITION BY STOPS_NO ORDER BY YCRD, XCRD, STOPS_TYPE) AS rn
          FROM stop_master WHERE STOPS_TYPE <> 'FERRY' AND YCRD IS NOT NULL AND XCRD IS NOT NULL) t WHERE rn = 1""",
    "rail_normed": """
        SELECT r.*, regexp_replace(r.station, '[(].*[)]', '') AS sta_norm,
               CASE r.line WHEN 'NATION_5' THEN 'NATION_5(ext)' WHEN 'NATION_6' THEN 'NATION_6 line' ELSE r.line END AS line_norm
        FROM rail_hourly r""",
    "rail_geo": """
        SELECT r.ym, r.line, r.station, r.hr, r.on_cnt, r.off_cnt, c.sta_lat, c.sta_lon
        FROM rail_normed r JOIN stations c ON r.sta_norm = c.sta_norm AND r.line_norm = c.line_norm""",
    "bus_geo": """
        SELECT b.*, c.stop_type, c.stop_lat, c.stop_lon FROM bus_hourly b JOIN stops c ON b.stop_id = c.stop_id""",
    "station_locations": "SELECT DISTINCT station, line, sta_lat, sta_lon FROM rail_geo",
    "stop_locations": "SELECT DISTINCT stop_id, stop_lat, stop_lon FROM bus_geo",
    "box": " UNION ALL ".join(f"""
        SELECT {r} AS radius_m, b.stop_id, r.station, r.line,
               2e0*6371e0*asin(sqrt(power(sin(radians(r.sta_lat-b.stop_lat)/2e0),2e0)
                 + cos(radians(b.stop_lat))*cos(radians(r.sta_lat))
                 * power(sin(radians(r.sta_lon-b.stop_lon)/2e0),2e0))) AS dist_km
        FROM stop_locations b JOIN station_locations r
          ON b.stop_lat BETWEEN r.sta_lat-{r / 1000}e0/111e0  AND r.sta_lat+{r / 1000}e0/111e0
         AND b.stop_lon BETWEEN r.sta_lon-{r / 1000}e0/88.7e0 AND r.sta_lon+{r / 1000}e0/88.7e0""" for r in RADII),
    "pairs": "SELECT * FROM box WHERE dist_km <= CAST(radius_m AS DOUBLE)/1000e0",
    "rail_total": "SELECT station, line, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS rail_total FROM rail_geo GROUP BY 1,2",
    "bus_total": "SELECT stop_id, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS bus_total FROM bus_geo GROUP BY 1",
    "zone": """
        SELECT radius_m, station, line, rail_total, bus_total, n_stops, rail_total+bus_total AS total_in_zone,
               100e0*CAST(rail_total AS DOUBLE)/CAST(rail_total+bus_total AS DOUBLE) AS share,
               CASE WHEN line IN ('NATION_0','NATION_1','NATION_2','NATION_3') THEN 'urban'
                    WHEN line = 'NATION_4' THEN 'airport'
                    WHEN line IN ('NATION_5','NATION_6','NATION_7') THEN 'central'
                    WHEN line IN ('NATION_8','NATION_9') THEN 'light'
                    WHEN line IN ('NATION_10','NATION_11','NATION_12','NATION_13') THEN 'south'
                    WHEN line IN ('NATION_14','NATION_15','NATION_16','NATION_17','NATION_18','NATION_19') THEN 'regional'
                    ELSE 'other' END AS line_type
        FROM (SELECT p.radius_m, p.station, p.line, s.rail_total,
                     CAST(SUM(b.bus_total) AS BIGINT) AS bus_total, COUNT(p.stop_id) AS n_stops
              FROM pairs p JOIN rail_total s ON p.station = s.station AND p.line = s.line
                   JOIN bus_total b ON p.stop_id = b.stop_id
              GROUP BY 1,2,3,4) z""",
    "bus_in_zone": "SELECT p.radius_m, p.station, p.line, b.* FROM bus_geo b JOIN pairs p ON b.stop_id = p.stop_id",
    "rail_hour_type": """
        SELECT z.radius_m, z.line_type, r.hr, CAST(SUM(r.on_cnt+r.off_cnt) AS BIGINT) AS rail_trips
        FROM rail_geo r JOIN zone z ON r.station = z.station AND r.line = z.line GROUP BY 1,2,3""",
    "bus_hour_type": """
        SELECT z.radius_m, z.line_type, b.hr, CAST(SUM(b.on_cnt+b.off_cnt) AS BIGINT) AS bus_trips
        FROM bus_in_zone b JOIN zone z ON b.radius_m = z.radius_m AND b.station = z.station AND b.line = z.line
        GROUP BY 1,2,3""",
    "hour_type": """
        SELECT r.radius_m, r.line_type, r.hr, r.rail_trips, b.bus_trips,
               round(100e0*CAST(r.rail_trips AS DOUBLE)/CAST(r.rail_trips+b.bus_trips AS DOUBLE), 6) AS share
        FROM rail_hour_type r JOIN bus_hour_type b
          ON r.radius_m = b.radius_m AND r.line_type = b.line_type AND r.hr = b.hr""",
    "direction_rail": f"""
        SELECT station, line, board, total, CAST(board AS DOUBLE)/CAST(total AS DOUBLE) AS board_ratio,
               CASE WHEN CAST(board AS DOUBLE)/CAST(total AS DOUBLE) < 0.4e0 THEN 'INFLOW'
                    WHEN CAST(board AS DOUBLE)/CAST(total AS DOUBLE) > 0.6e0 THEN 'OUTFLOW' ELSE 'BALANCED' END AS direction
        FROM (SELECT station, line, CAST(SUM(on_cnt) AS BIGINT) AS board, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS total
              FROM rail_geo WHERE hr IN {MORNING} GROUP BY 1,2) t""",
    "direction_bus": f"""
        SELECT radius_m, station, line, board, total, CAST(board AS DOUBLE)/CAST(total AS DOUBLE) AS board_ratio,
               CASE WHEN CAST(board AS DOUBLE)/CAST(total AS DOUBLE) < 0.4e0 THEN 'INFLOW'
                    WHEN CAST(board AS DOUBLE)/CAST(total AS DOUBLE) > 0.6e0 THEN 'OUTFLOW' ELSE 'BALANCED' END AS direction
        FROM (SELECT radius_m, station, line, CAST(SUM(on_cnt) AS BIGINT) AS board, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS total
              FROM bus_in_zone WHERE hr IN {MORNING} GROUP BY 1,2,3) t""",
    "direction_join": """
        SELECT b.radius_m, s.station, s.line, s.direction AS rail_direction, b.direction AS bus_direction,
               CASE WHEN s.direction = b.direction THEN 'MATCH' ELSE 'MISMATCH' END AS direction_match
        FROM direction_rail s JOIN direction_bus b ON s.station = b.station AND s.line = b.line""",
    "month_share": """
        SELECT b.radius_m, r.ym, r.rail_trips, b.bus_trips,
               round(100e0*CAST(r.rail_trips AS DOUBLE)/CAST(r.rail_trips+b.bus_trips AS DOUBLE), 6) AS share
        FROM (SELECT ym, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS rail_trips FROM rail_geo GROUP BY 1) r
        JOIN (SELECT radius_m, ym, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS bus_trips FROM bus_in_zone GROUP BY 1,2) b
          ON r.ym = b.ym""",
    "hour_share": """
        SELECT b.radius_m, r.hr, r.rail_trips, b.bus_trips,
               round(100e0*CAST(r.rail_trips AS DOUBLE)/CAST(r.rail_trips+b.bus_trips AS DOUBLE), 6) AS share
        FROM (SELECT hr, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS rail_trips FROM rail_geo GROUP BY 1) r
        JOIN (SELECT radius_m, hr, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS bus_trips FROM bus_in_zone GROUP BY 1,2) b
          ON r.hr = b.hr""",
    "peak_rail": f"""
        SELECT peak_trips, all_trips, round(100e0*CAST(peak_trips AS DOUBLE)/CAST(all_trips AS DOUBLE), 6) AS peak_pct
        FROM (SELECT CAST(SUM(CASE WHEN hr IN {PEAK} THEN on_cnt+off_cnt ELSE 0 END) AS BIGINT) AS peak_trips,
                     CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS all_trips FROM rail_geo) t""",
    "peak_bus": f"""
        SELECT radius_m, peak_trips, all_trips, round(100e0*CAST(peak_trips AS DOUBLE)/CAST(all_trips AS DOUBLE), 6) AS peak_pct
        FROM (SELECT radius_m, CAST(SUM(CASE WHEN hr IN {PEAK} THEN on_cnt+off_cnt ELSE 0 END) AS BIGINT) AS peak_trips,
                     CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS all_trips FROM bus_in_zone GROUP BY 1) t""",
    "stop_ranking": """
        SELECT radius_m, stop_id, MAX(stop_name) AS stop_name, COUNT(DISTINCT concat(station, '|', line)) AS n_zones,
               CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS total_trips
        FROM bus_in_zone GROUP BY 1,2""",
}
for mode, key in (("rail", "ym, line, station"), ("bus", "ym, route_no, stop_id")):
    cells = ",\n".join(
        f"CAST(MAX(CASE WHEN hr = {h} THEN {count} END) AS VARCHAR)"
        + (" || '.0'" if hour_column(mode, h, kind) == "HR_3_GET_ON_TNOPE" else "")
        + f" AS {hour_column(mode, h, kind)}"
        for h in HOURS
        for kind, count in (("ON", "on_cnt"), ("OFF", "off_cnt"))
    )
    names = ", ".join(hour_columns(mode))
    if mode == "bus":  # one month has hour 1 under the other suffix
        for kind in ("ON", "OFF"):
            names = names.replace(f"HR_1_GET_{kind}_NOPE", f"CASE WHEN ym <> '199410' THEN HR_1_GET_{kind}_NOPE END AS HR_1_GET_{kind}_NOPE")
            names += f", CASE WHEN ym = '199410' THEN HR_1_GET_{kind}_NOPE END AS HR_1_GET_{kind}_TNOPE"
    if mode == "rail":
        head = "ym AS USE_MM, line AS SBWY_ROUT_LN_NM, station AS STTN, concat(ym, CASE WHEN copy = 0 THEN '03' ELSE '05' END) AS JOB_YMD"
        extra = ""
    else:
        head = """ym AS USE_YM, route_no AS RTE_NO, concat('Route ', route_no) AS RTE_NM, stop_id AS STOPS_ID,
            lpad(stop_id, 12, '0') AS STOPS_ARS_NO, stop_name AS SBWY_STNS_NM, '001' AS TRFC_MNS_TYPE_CD,
            'city bus' AS TRFC_MNS_TYPE_NM, concat(ym, CASE WHEN copy = 0 THEN '03' ELSE '05' END) AS REG_YMD"""
        extra = "MAX(stop_name) AS stop_name, "
    TABLES[f"{mode}_wide"] = f"""
        SELECT {head}, {names}
        FROM (SELECT {key}, {extra}{cells} FROM {mode}_hourly GROUP BY {key}) w
             JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c ON c.copy = 0 OR w.ym = '199503'"""

TABLES["rail_standard"] = "SELECT USE_MM AS ym, SBWY_ROUT_LN_NM AS line, STTN AS station, JOB_YMD AS job_ymd, * EXCLUDE (USE_MM, SBWY_ROUT_LN_NM, STTN, JOB_YMD) FROM rail_wide"
TABLES["bus_standard"] = """
    SELECT USE_YM AS ym, RTE_NO AS route_no, RTE_NM AS route_name, STOPS_ID AS stop_id, STOPS_ARS_NO AS stop_ars_no,
           SBWY_STNS_NM AS stop_name, TRFC_MNS_TYPE_CD AS mode_code, TRFC_MNS_TYPE_NM AS mode_name, REG_YMD AS reg_ymd,
           * EXCLUDE (USE_YM, RTE_NO, RTE_NM, STOPS_ID, STOPS_ARS_NO, SBWY_STNS_NM, TRFC_MNS_TYPE_CD, TRFC_MNS_TYPE_NM, REG_YMD)
    FROM bus_wide"""
for mode, key, date in (("rail", "ym, line, station", "job_ymd"), ("bus", "ym, route_no, stop_id", "reg_ymd")):
    TABLES[f"{mode}_dedup"] = f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {date} DESC) AS rn FROM {mode}_standard) t WHERE rn = 1"""

    def long_count(kind: str) -> str:
        arms = " ".join(f"WHEN {h} THEN {hour_column(mode, h, kind)}" for h in HOURS)
        if mode == "bus":
            arms = arms.replace(f"HR_1_GET_{kind}_NOPE", f"coalesce(HR_1_GET_{kind}_NOPE, HR_1_GET_{kind}_TNOPE)")
        return f"coalesce(CAST(CAST(CASE h.hr {arms} END AS DOUBLE) AS BIGINT), 0)"

    TABLES[f"{mode}_long"] = f"""
        SELECT d.* EXCLUDE ({', '.join(hour_columns(mode) + (["HR_1_GET_ON_TNOPE", "HR_1_GET_OFF_TNOPE"] if mode == "bus" else []))}), CAST(h.hr AS INT) AS hr,
               {long_count('ON')} AS on_cnt, {long_count('OFF')} AS off_cnt,
               CAST(CAST(d.ym AS INT) // 100 AS INT) AS year, CAST(CAST(d.ym AS INT) % 100 AS INT) AS month
        FROM {mode}_dedup d CROSS JOIN (SELECT unnest(range(24)) AS hr) h"""

for mode, service, ym, number in (
    ("rail", "CardSubwayTime", "USE_MM", "CAST(regexp_extract(STTN, '[0-9]+') AS BIGINT)"),
    ("bus", "CardBusTimeNew", "USE_YM", "CAST(STOPS_ID AS BIGINT)"),
):
    TABLES[f"{mode}_numbered"] = f"""
        SELECT '{service}' AS service, {ym} AS page_ym, {number} // 20 AS page, w.*,
               COUNT(*) OVER (PARTITION BY {ym}) AS total, MAX({number} // 20) OVER (PARTITION BY {ym}) AS last_page
        FROM {mode}_wide w"""
    TABLES[f"{mode}_paged"] = f"SELECT * FROM {mode}_numbered WHERE page_ym <> '199704' OR page <> last_page"
TABLES["page"] = """
    SELECT service, ym, page_start, status,
           CASE ym WHEN '199607' THEN 'ERROR-500' WHEN '199808' THEN 'INFO-200' ELSE 'INFO-000' END AS code,
           CASE WHEN status = 'ok' THEN n ELSE 0 END AS n_rows,
           CASE status WHEN 'ok' THEN total WHEN 'empty' THEN 0 END AS list_total_count
    FROM (SELECT service, page_ym AS ym, page*1000+1 AS page_start, COUNT(*) AS n, MAX(total) AS total,
                 CASE page_ym WHEN '199607' THEN 'error' WHEN '199808' THEN 'no_body' WHEN '199912' THEN 'empty' ELSE 'ok' END AS status
          FROM (SELECT service, page_ym, page, total FROM rail_paged UNION ALL SELECT service, page_ym, page, total FROM bus_paged) u
          GROUP BY service, page_ym, page) t"""
TABLES["month_state"] = """
    SELECT service, ym, COUNT(*) AS n_pages, CAST(SUM(CASE WHEN status IN ('error','no_body') THEN 1 ELSE 0 END) AS BIGINT) AS n_failed_pages,
           CAST(SUM(n_rows) AS BIGINT) AS n_rows, MAX(list_total_count) AS list_total_count,
           CASE WHEN SUM(CASE WHEN status IN ('error','no_body') THEN 1 ELSE 0 END) > 0 THEN 'failed'
                WHEN SUM(n_rows) = 0 THEN 'empty' WHEN SUM(n_rows) < MAX(list_total_count) THEN 'incomplete' ELSE 'complete' END AS status
    FROM page GROUP BY service, ym"""


# A stop once per radius, however many zones it lies in.
TABLES["bus_near"] = "SELECT p.radius_m, b.* FROM bus_geo b JOIN (SELECT DISTINCT radius_m, stop_id FROM pairs) p ON b.stop_id = p.stop_id"
for once in ("month_share", "hour_share", "peak_bus"):
    TABLES[f"{once}_once"] = TABLES[once].replace("bus_in_zone", "bus_near")
TABLES["zone_month"] = """
    SELECT b.radius_m, b.ym, b.station, b.line, r.rail_total, b.bus_total, b.n_stops,
           100e0*CAST(r.rail_total AS DOUBLE)/CAST(nullif(r.rail_total+b.bus_total, 0) AS DOUBLE) AS share
    FROM (SELECT ym, station, line, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS rail_total FROM rail_geo GROUP BY 1,2,3) r
    JOIN (SELECT radius_m, ym, station, line, CAST(SUM(on_cnt+off_cnt) AS BIGINT) AS bus_total, COUNT(DISTINCT stop_id) AS n_stops
          FROM bus_in_zone GROUP BY 1,2,3,4) b ON r.ym = b.ym AND r.station = b.station AND r.line = b.line"""
TABLES["circle"] = """
    SELECT c.radius_m, b.stop_id, r.station, r.line,
           2e0*6371e0*asin(sqrt(power(sin(radians(r.sta_lat-b.stop_lat)/2e0),2e0)
             + cos(radians(b.stop_lat))*cos(radians(r.sta_lat))
             * power(sin(radians(r.sta_lon-b.stop_lon)/2e0),2e0))) AS dist_km
    FROM stop_locations b CROSS JOIN station_locations r CROSS JOIN (SELECT 500 AS radius_m UNION ALL SELECT 200) c"""


def in_millions(count: str, digits: int) -> str:
    """A count in millions, rounded half up in whole numbers."""
    return f"CAST(({count} + {5 * 10 ** (5 - digits)}) // {10 ** (6 - digits)} AS DOUBLE) / {10 ** digits}e0"


def both_in_millions() -> str:
    columns = {"rail_m": "rail_trips", "bus_m": "bus_trips", "total_m": "rail_trips + bus_trips"}
    return ", ".join(f"{in_millions(f'({count})', 1)} AS {name}" for name, count in columns.items())


def with_tables(sql: str) -> str:
    """``sql`` preceded by the sub-queries it uses, each after the ones it needs itself."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in TABLES and name not in needed:
                visit(TABLES[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + "\n" + sql


FAULTY = "('199607','199808','199912')"
DIST = "round(dist_km, 9) AS dist_km"
DISTRIBUTION = """COUNT(*) AS n_zones, round(AVG(share), 6) AS avg_share, round(quantile_disc(share, 0.25), 6) AS p25,
    round(quantile_disc(share, 0.5), 6) AS median, round(quantile_disc(share, 0.75), 6) AS p75,
    round(MIN(share), 6) AS min_share, round(MAX(share), 6) AS max_share"""
OVERALL = "round(100e0*CAST(SUM(rail_total) AS DOUBLE)/CAST(SUM(rail_total+bus_total) AS DOUBLE), 6)"

PLAIN: dict[str, str] = {
    "scan_rail_wide": "SELECT * FROM rail_wide",
    "scan_bus_wide": "SELECT * FROM bus_wide",
    "scan_bus_coord": "SELECT * FROM stop_master",
    "scan_rail_coord": "SELECT * FROM station_master",
    "standardize_rail": "SELECT * FROM rail_standard",
    "standardize_bus": "SELECT * FROM bus_standard",
    "dedup_rail": "SELECT * FROM rail_dedup",
    "dedup_bus": "SELECT * FROM bus_dedup",
    "dedup_audit_rail": "SELECT (SELECT COUNT(*) FROM rail_standard) AS n_before, (SELECT COUNT(*) FROM rail_dedup) AS n_after, (SELECT COUNT(*) FROM rail_standard) - (SELECT COUNT(*) FROM rail_dedup) AS n_removed",
    "dedup_audit_bus": "SELECT (SELECT COUNT(*) FROM bus_standard) AS n_before, (SELECT COUNT(*) FROM bus_dedup) AS n_after, (SELECT COUNT(*) FROM bus_standard) - (SELECT COUNT(*) FROM bus_dedup) AS n_removed",
    "unpivot_rail": "SELECT ym, line, station, job_ymd, hr, on_cnt, off_cnt FROM rail_long",
    "unpivot_bus": """SELECT stop_id, hr, COUNT(*) AS n_rows, CAST(SUM(on_cnt) AS BIGINT) AS on_cnt, CAST(SUM(off_cnt) AS BIGINT) AS off_cnt,
        CAST(SUM(CAST('0x' || substr(md5(concat_ws('|', ym, route_no, route_name, stop_id, stop_ars_no, stop_name, mode_code, mode_name, reg_ymd, hr, on_cnt, off_cnt, year, month)), 1, 12) AS BIGINT)) AS BIGINT) AS row_digest
        FROM bus_long GROUP BY 1,2""",
    "derive_period": "SELECT ym, CAST(CAST(ym AS INT) // 100 AS INT) AS year, CAST(CAST(ym AS INT) % 100 AS INT) AS month, COUNT(*) AS n_rows FROM rail_hourly GROUP BY 1,2,3",
    "hourly_roundtrip": "SELECT year, month, ym, line, station, job_ymd, hr, on_cnt, off_cnt FROM rail_long",
    "hourly_roundtrip_bus": "SELECT year, month, hr, COUNT(*) AS n_rows, COUNT(DISTINCT stop_id) AS n_stops, CAST(SUM(on_cnt) AS BIGINT) AS on_cnt, CAST(SUM(off_cnt) AS BIGINT) AS off_cnt FROM bus_long GROUP BY 1,2,3",
    "bus_month_sums": "SELECT year, month, hr, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_stops, CAST(SUM(on_cnt) AS BIGINT) AS on_cnt, CAST(SUM(off_cnt) AS BIGINT) AS off_cnt FROM (SELECT year, month, hr, stop_id, COUNT(*) AS n, SUM(on_cnt) AS on_cnt, SUM(off_cnt) AS off_cnt FROM bus_long GROUP BY 1,2,3,4) t GROUP BY 1,2,3",
    "bus_by_stop_bucketed": "SELECT stop_id, COUNT(*) AS n_rows, CAST(SUM(on_cnt) AS BIGINT) AS on_cnt, CAST(SUM(off_cnt) AS BIGINT) AS off_cnt FROM bus_long GROUP BY 1",
    "page_status": "SELECT * FROM page",
    "page_rows": f"SELECT * EXCLUDE (page, total, last_page) FROM bus_paged WHERE page_ym NOT IN {FAULTY}",
    "page_rows_rail": f"SELECT * EXCLUDE (page, total, last_page) FROM rail_paged WHERE page_ym NOT IN {FAULTY}",
    "page_completeness": "SELECT service, ym, n_rows, list_total_count, list_total_count - n_rows AS n_missing FROM month_state",
    "landing_status": "SELECT service, ym, n_pages, n_failed_pages, status FROM month_state",
    "landing_counts": f"""SELECT dataset, ym, COUNT(*) AS n_rows FROM (
        SELECT 'subway' AS dataset, page_ym AS ym FROM rail_paged WHERE page_ym NOT IN {FAULTY}
        UNION ALL SELECT 'bus', page_ym FROM bus_paged WHERE page_ym NOT IN {FAULTY}) t GROUP BY 1,2""",
    "landing_sizes": f"""SELECT dataset, ym, COUNT(*) AS n_rows, 'as logged' AS state FROM (
        SELECT 'subway' AS dataset, page_ym AS ym FROM rail_paged WHERE page_ym NOT IN {FAULTY}
        UNION ALL SELECT 'bus', page_ym FROM bus_paged WHERE page_ym NOT IN {FAULTY}) t GROUP BY 1,2
        UNION ALL SELECT 'total', NULL, (SELECT COUNT(*) FROM rail_paged WHERE page_ym NOT IN {FAULTY}) + (SELECT COUNT(*) FROM bus_paged WHERE page_ym NOT IN {FAULTY}), 'as logged'""",
    "landing_log": """SELECT service, ym, CAST(attempt AS BIGINT) AS attempt, status, n_pages, n_rows, status IN ('complete','incomplete') AS landed
        FROM month_state, (SELECT 1 AS attempt UNION ALL SELECT 2) a WHERE attempt = 1 OR service IN (SELECT service FROM rail_paged)""",
    "station_norm": "SELECT station, sta_norm, COUNT(*) AS n_rows FROM rail_normed GROUP BY 1,2",
    "line_norm": "SELECT line, line_norm, COUNT(*) AS n_rows FROM rail_normed GROUP BY 1,2",
    "rail_coord_unique": "SELECT * FROM stations",
    "bus_coord_unique": "SELECT * FROM stops",
    "bus_coord_duplicates": "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT STOPS_NO) AS n_ids, COUNT(*) - COUNT(DISTINCT STOPS_NO) AS n_surplus FROM stop_master",
    "unlocated_rows": """SELECT 'rail' AS master, COUNT(*) AS n_rows, COUNT(*) FILTER (LAT IS NULL OR LOT IS NULL) AS n_unlocated FROM station_master
        UNION ALL SELECT 'bus', COUNT(*), COUNT(*) FILTER (YCRD IS NULL OR XCRD IS NULL) FROM stop_master""",
    "stops_without_ferry": "SELECT * FROM stop_master WHERE STOPS_TYPE <> 'FERRY'",
    "stop_type_counts": "SELECT STOPS_TYPE AS stop_type, COUNT(*) AS n_rows FROM stop_master GROUP BY 1",
    "route_counts": "SELECT ROUTE AS route, COUNT(*) AS n_rows FROM station_master GROUP BY 1",
    "rail_geo": "SELECT * FROM rail_geo",
    "bus_geo": "SELECT * FROM bus_geo",
    "match_rate": """SELECT mode, n_rows, n_matched_rows, n_keys, n_matched_keys,
        round(100e0*n_matched_rows/n_rows, 6) AS row_pct, round(100e0*n_matched_keys/n_keys, 6) AS key_pct FROM (
        SELECT 'rail' AS mode, COUNT(*) AS n_rows, COUNT(c.sta_norm) AS n_matched_rows,
               COUNT(DISTINCT concat(r.station, '|', r.line)) AS n_keys,
               COUNT(DISTINCT CASE WHEN c.sta_norm IS NOT NULL THEN concat(r.station, '|', r.line) END) AS n_matched_keys
        FROM rail_normed r LEFT JOIN stations c ON r.sta_norm = c.sta_norm AND r.line_norm = c.line_norm
        UNION ALL SELECT 'bus', COUNT(*), COUNT(c.stop_id), COUNT(DISTINCT b.stop_id), COUNT(DISTINCT c.stop_id)
        FROM bus_hourly b LEFT JOIN stops c ON b.stop_id = c.stop_id) t""",
    "station_locations": "SELECT * FROM station_locations",
    "stop_locations": "SELECT * FROM stop_locations",
    "haversine": """SELECT STOPS_NO AS stop_id, YCRD AS lat, XCRD AS lon,
        round(2e0*6371e0*asin(sqrt(power(sin(radians(37.55e0-YCRD)/2e0),2e0)
          + cos(radians(YCRD))*cos(radians(37.55e0))*power(sin(radians(126.9625e0-XCRD)/2e0),2e0))), 9) AS dist_km
        FROM stop_master""",
    "rail_total": "SELECT * FROM rail_total",
    "bus_total": "SELECT * FROM bus_total",
    "direction_rail": "SELECT station, line, board, total, round(board_ratio, 6) AS board_ratio, direction FROM direction_rail",
    "peak_rail": "SELECT * FROM peak_rail",
    "pairs_exact_circle": f"SELECT radius_m, station, line, stop_id, {DIST} FROM circle WHERE dist_km <= CAST(radius_m AS DOUBLE)/1000e0",
    "share_month_distinct_stops": f"SELECT *, {both_in_millions()} FROM month_share_once",
    "share_hour_distinct_stops": f"SELECT *, {both_in_millions()} FROM hour_share_once",
    "peak_bus_distinct_stops": "SELECT * FROM peak_bus_once",
    "top_stations": f"SELECT station, line, rail_total AS total_trips, {in_millions('rail_total', 1)} AS total_m FROM rail_total ORDER BY rail_total DESC, station, line LIMIT 20",
    "radius_comparison": "SELECT radius_m, COUNT(*) AS n_zones, round(AVG(share), 6) AS avg_share, round(quantile_disc(share, 0.5), 6) AS median, round(stddev_samp(share), 6) AS std_dev FROM zone GROUP BY 1",
    "stage_counts": """
        SELECT 'rail_hourly' AS stage, COUNT(*) AS n_rows FROM rail_hourly
        UNION ALL SELECT 'bus_hourly', COUNT(*) FROM bus_hourly
        UNION ALL SELECT 'rail_coord', COUNT(*) FROM station_master
        UNION ALL SELECT 'bus_coord', COUNT(*) FROM stop_master
        UNION ALL SELECT 'rail_geo', COUNT(*) FROM rail_geo
        UNION ALL SELECT 'rail_total', COUNT(*) FROM rail_total
        UNION ALL SELECT 'bus_geo', COUNT(*) FROM bus_geo
        UNION ALL SELECT 'bus_total', COUNT(*) FROM bus_total
        UNION ALL SELECT concat('pairs_', radius_m), COUNT(*) FROM pairs GROUP BY radius_m
        UNION ALL SELECT concat('zones_', radius_m), COUNT(*) FROM zone GROUP BY radius_m""",
    "view_query": """SELECT z.line_type, COUNT(*) AS n_pairs, COUNT(DISTINCT p.stop_id) AS n_stops, CAST(SUM(t.bus_total) AS BIGINT) AS bus_total
        FROM zone z JOIN pairs p ON z.radius_m = p.radius_m AND z.station = p.station AND z.line = p.line
             JOIN bus_total t ON p.stop_id = t.stop_id
        WHERE z.radius_m = 500 GROUP BY 1""",
    "chart_share_hist": """SELECT radius_m, bin, n_zones, bin*2.5e0 AS share_from, (bin+1)*2.5e0 AS share_to FROM (
        SELECT radius_m, CAST(least(floor(share/2.5e0), 39) AS INT) AS bin, COUNT(*) AS n_zones FROM zone GROUP BY 1,2) t""",
    "chart_type_share": f"SELECT radius_m, line_type, {OVERALL} AS overall_share, COUNT(*) AS n_zones FROM zone GROUP BY 1,2",
    "chart_heatmap_200": "SELECT line_type, " + ", ".join(f"MAX(CASE WHEN hr = {h} THEN share END) AS h{h}" for h in HOURS) + " FROM hour_type WHERE radius_m = 200 GROUP BY 1",
    "chart_hourly_200": "SELECT hr, round(CAST(rail_trips AS DOUBLE)/1e6, 6) AS rail_m, round(CAST(bus_trips AS DOUBLE)/1e6, 6) AS bus_m FROM hour_share WHERE radius_m = 200",
    "chart_peak": "SELECT 'bus' AS mode, radius_m, peak_pct FROM peak_bus UNION ALL SELECT 'rail', r.radius_m, p.peak_pct FROM peak_rail p CROSS JOIN (SELECT 500 AS radius_m UNION ALL SELECT 200) r",
    "chart_top_stations": "SELECT concat(station, ' (', line, ')') AS station_line, round(CAST(rail_total AS DOUBLE)/1e6, 6) AS total_m FROM rail_total ORDER BY rail_total DESC, station, line LIMIT 15",
    "chart_top_stops_200": "SELECT stop_name, round(CAST(total_trips AS DOUBLE)/1e6, 6) AS total_m FROM stop_ranking WHERE radius_m = 200 ORDER BY total_trips DESC, stop_id LIMIT 15",
}

PER_RADIUS: dict[str, str] = {
    "pairs_bbox_{r}": f"SELECT station, line, stop_id, {DIST} FROM box WHERE radius_m = {{r}}",
    "pairs_{r}": f"SELECT station, line, stop_id, {DIST} FROM pairs WHERE radius_m = {{r}}",
    "zone_stats_{r}": "SELECT station, line, rail_total, bus_total, n_stops, total_in_zone, round(share, 6) AS rail_share_pct FROM zone WHERE radius_m = {r}",
    "zone_typed_{r}": "SELECT station, line, rail_total, bus_total, n_stops, total_in_zone, round(share, 6) AS rail_share_pct, line_type FROM zone WHERE radius_m = {r}",
    "share_distribution_{r}": f"SELECT {DISTRIBUTION} FROM zone WHERE radius_m = {{r}}",
    "share_by_type_{r}": f"SELECT line_type, COUNT(*) AS n_zones, round(AVG(share), 6) AS avg_share, CAST(SUM(rail_total) AS BIGINT) AS rail_sum, CAST(SUM(bus_total) AS BIGINT) AS bus_sum, {in_millions('CAST(SUM(rail_total) AS BIGINT)', 1)} AS rail_m, {in_millions('CAST(SUM(bus_total) AS BIGINT)', 1)} AS bus_m, {OVERALL} AS overall_share FROM zone WHERE radius_m = {{r}} GROUP BY 1",
    "rail_hour_type_{r}": "SELECT line_type, hr, rail_trips FROM rail_hour_type WHERE radius_m = {r}",
    "bus_hour_type_{r}": "SELECT line_type, hr, bus_trips FROM bus_hour_type WHERE radius_m = {r}",
    "share_hour_type_{r}": "SELECT line_type, hr, rail_trips, bus_trips, share FROM hour_type WHERE radius_m = {r}",
    "share_hour_type_pivot_{r}": "SELECT hr, " + ", ".join(f"MAX(CASE WHEN line_type = '{t}' THEN share END) AS {t}" for t in LINE_TYPES) + " FROM hour_type WHERE radius_m = {r} GROUP BY 1",
    "direction_bus_{r}": "SELECT station, line, board, total, round(board_ratio, 6) AS board_ratio, direction FROM direction_bus WHERE radius_m = {r}",
    "direction_join_{r}": "SELECT station, line, rail_direction, bus_direction, direction_match FROM direction_join WHERE radius_m = {r}",
    "direction_share_{r}": "SELECT d.direction_match, COUNT(*) AS n_zones, round(AVG(z.share), 6) AS avg_share, round(quantile_disc(z.share, 0.5), 6) AS median FROM direction_join d JOIN zone z ON d.radius_m = z.radius_m AND d.station = z.station AND d.line = z.line WHERE d.radius_m = {r} GROUP BY 1",
    "share_month_{r}": f"SELECT ym, rail_trips, bus_trips, {both_in_millions()}, share FROM month_share WHERE radius_m = {{r}}",
    "share_hour_{r}": f"SELECT hr, rail_trips, bus_trips, {both_in_millions()}, share FROM hour_share WHERE radius_m = {{r}}",
    "peak_bus_{r}": "SELECT peak_trips, all_trips, peak_pct FROM peak_bus WHERE radius_m = {r}",
    "zone_month_{r}": "SELECT ym, station, line, rail_total, bus_total, n_stops, round(share, 6) AS rail_share_pct FROM zone_month WHERE radius_m = {r}",
    "share_quantiles_year_{r}": """SELECT year, CAST(MAX(n) AS BIGINT) AS n_zones, """
    + ", ".join(f"round(MIN(CASE WHEN nth >= ceil(n * {q}) THEN share END), 6) AS {name}" for name, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)))
    + """ FROM (SELECT CAST(substr(ym, 1, 4) AS INT) AS year, share, COUNT(*) OVER (PARTITION BY substr(ym, 1, 4)) AS n,
               row_number() OVER (PARTITION BY substr(ym, 1, 4) ORDER BY share) AS nth
          FROM zone_month WHERE radius_m = {r} AND share IS NOT NULL) t GROUP BY 1""",
    "top_stops_{r}": f"SELECT r.stop_id, r.stop_name, r.n_zones, b.bus_total AS stop_trips, r.total_trips, {in_millions('r.total_trips', 2)} AS total_m FROM stop_ranking r JOIN bus_total b ON r.stop_id = b.stop_id WHERE r.radius_m = {{r}} ORDER BY r.total_trips DESC, r.stop_id LIMIT 20",
}


def oracle_queries() -> dict[str, str]:
    found = {key: with_tables(sql) for key, sql in PLAIN.items()}
    for key, sql in PER_RADIUS.items():
        for r in RADII:
            found[key.format(r=r)] = with_tables(sql.replace("{r}", str(r)))
    return found
