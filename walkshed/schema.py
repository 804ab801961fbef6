"""Names, key columns and lookup values of the two ridership feeds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names, patterns and categories of the public feeds.
# --------------------------------------------------------------------------

RAIL_RAW_COLUMNS = {
    "USE_MM": "ym",
    "SBWY_ROUT_LN_NM": "line",
    "STTN": "station",
    "JOB_YMD": "job_ymd",
}
RAIL_OFFICIAL_NAMES = {
    "ym": "사용월",
    "line": "호선명",
    "station": "지하철역",
    "job_ymd": "작업일자",
    "hr": "시간",
    "on_cnt": "승차인원",
    "off_cnt": "하차인원",
    "year": "년",
    "month": "월",
}

BUS_RAW_COLUMNS = {
    "USE_YM": "ym",
    "RTE_NO": "route_no",
    "RTE_NM": "route_name",
    "STOPS_ID": "stop_id",
    "STOPS_ARS_NO": "stop_ars_no",
    "SBWY_STNS_NM": "stop_name",
    "TRFC_MNS_TYPE_CD": "mode_code",
    "TRFC_MNS_TYPE_NM": "mode_name",
    "REG_YMD": "reg_ymd",
}
BUS_OFFICIAL_NAMES = {
    "ym": "사용년월",
    "route_no": "노선번호",
    "route_name": "노선명",
    "stop_id": "표준버스정류장ID",
    "stop_ars_no": "버스정류장ARS번호",
    "stop_name": "역명",
    "mode_code": "교통수단타입코드",
    "mode_name": "교통수단타입명",
    "reg_ymd": "등록일자",
    "hr": "시간",
    "on_cnt": "승차총승객수",
    "off_cnt": "하차총승객수",
    "year": "년",
    "month": "월",
}

# Hour columns of both feeds. The suffix changes between feeds, hours and months.
HOUR_COLUMN = r"HR_(\d+)_GET_(ON|OFF)(?:_.*)?"

SERVICE_DATASETS = {"CardSubwayTime": "subway", "CardBusTimeNew": "bus"}

# Line names of the ridership feed that the coordinate master spells differently.
LINE_RENAMES = {
    "9호선2~3단계": "9호선(연장)",
    "경의선": "경의중앙선",
    "공항철도 1호선": "공항철도1호선",
}

LINE_TYPES = {
    "서교공_1-8호선": ["1호선", "2호선", "3호선", "4호선", "5호선", "6호선", "7호선", "8호선"],
    "9호선": ["9호선", "9호선2~3단계"],
    "경의중앙": ["경의선", "경의중앙선", "중앙선"],
    "공항철도": ["공항철도 1호선", "공항철도1호선"],
    "경전철": ["우이신설선", "신림선"],
    "강남광역": ["분당선", "수인선", "신분당선", "신분당선(연장)", "신분당선(연장2)"],
    "수도권광역": [
        "경부선", "경인선", "경원선", "경춘선", "경강선", "일산선",
        "과천선", "안산선", "장항선", "서해선", "별내선", "진접선",
    ],
}
OTHER_LINE_TYPE = "기타"
FERRY_STOP_TYPE = "한강선착장"

MORNING_HOURS = (7, 8, 9)
PEAK_HOURS = (7, 8, 9, 17, 18, 19)
INFLOW_BELOW = 0.4
OUTFLOW_ABOVE = 0.6
RADII_M = (500, 200)
KM_PER_DEGREE_LAT = 111.0
KM_PER_DEGREE_LON = 88.7
EARTH_RADIUS_KM = 6371.0

# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ModeSpec:
    """How one transport mode's wide monthly records are laid out."""

    name: str
    raw_columns: Mapping[str, str]
    key: tuple[str, ...]
    place: str
    official_names: Mapping[str, str]
    delivered: str


RAIL = ModeSpec("rail", RAIL_RAW_COLUMNS, ("ym", "line", "station"), "station", RAIL_OFFICIAL_NAMES, "job_ymd")
BUS = ModeSpec("bus", BUS_RAW_COLUMNS, ("ym", "route_no", "stop_id"), "stop_id", BUS_OFFICIAL_NAMES, "reg_ymd")

# Ids are declared as text, so zero padding survives.
STOP_MASTER = T.StructType([
    T.StructField("STOPS_NO", T.StringType()),
    T.StructField("STOPS_NM", T.StringType()),
    T.StructField("NODE_ID", T.StringType()),
    T.StructField("STOPS_TYPE", T.StringType()),
    T.StructField("XCRD", T.DoubleType()),
    T.StructField("YCRD", T.DoubleType()),
])
STATION_MASTER = T.StructType([
    T.StructField("BLDN_ID", T.StringType()),
    T.StructField("BLDN_NM", T.StringType()),
    T.StructField("ROUTE", T.StringType()),
    T.StructField("LAT", T.DoubleType()),
    T.StructField("LOT", T.DoubleType()),
])

# A landed page: what was asked for, and the response body as it came.
LANDED_PAGE = T.StructType([
    T.StructField("service", T.StringType()),
    T.StructField("ym", T.StringType()),
    T.StructField("page_start", T.LongType()),
    T.StructField("page_end", T.LongType()),
    T.StructField("payload", T.StringType()),
])
PAGE_BODY = T.StructType([
    T.StructField("list_total_count", T.LongType()),
    T.StructField("RESULT", T.StructType([
        T.StructField("CODE", T.StringType()),
        T.StructField("MESSAGE", T.StringType()),
    ])),
    T.StructField("row", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])


@dataclass(frozen=True)
class Settings:
    """Values an analysis can vary; the defaults are the published study's."""

    line_renames: Mapping[str, str] = field(default_factory=lambda: LINE_RENAMES)
    line_types: Mapping[str, list[str]] = field(default_factory=lambda: LINE_TYPES)
    other_line_type: str = OTHER_LINE_TYPE
    ferry_stop_type: str = FERRY_STOP_TYPE
    morning_hours: tuple[int, ...] = MORNING_HOURS
    peak_hours: tuple[int, ...] = PEAK_HOURS
    inflow_below: float = INFLOW_BELOW
    outflow_above: float = OUTFLOW_ABOVE
    km_per_degree_lat: float = KM_PER_DEGREE_LAT
    km_per_degree_lon: float = KM_PER_DEGREE_LON
    #: Pairs by distance alone, without the degree box that clips the circle.
    exact_circle: bool = False
    #: In sums by month, by hour and of peaks a stop counts once, not once for every zone it lies in.
    distinct_stops: bool = False

    @property
    def all_line_types(self) -> list[str]:
        return [*self.line_types, self.other_line_type]
