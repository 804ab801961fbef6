"""Inputs of an analysis and the intermediate tables its queries share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.functions.labels import renamed, strip_alias
from walkshed.operators.lookup import BROADCAST_LIMIT_BYTES, measured_bytes
from walkshed.operators.radius import Grid, radius_pairs, radius_sums, with_radius
from walkshed.operators.radius_matrix import busy_blocks, radius_sums_by
from walkshed.schema import RADII_M, Settings
from walkshed.session import delete_folder, new_folder, stage_table

MEASURES = ("on_cnt", "off_cnt", "n_rows")


def has_place(lat: str, lon: str) -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def located(master: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with both coordinates; a place without them is not a place to be near to."""
    return master.where(has_place(lat, lon))


def unique_stations(master: DataFrame) -> DataFrame:
    """One row per normalised station name and line: the smallest coordinates win."""
    return (
        located(master, "LAT", "LOT").select(
            strip_alias(F.col("BLDN_NM")).alias("sta_norm"),
            F.col("ROUTE").alias("line_norm"),
            F.struct(F.col("LAT").alias("sta_lat"), F.col("LOT").alias("sta_lon")).alias("at"),
        )
        .groupBy("sta_norm", "line_norm")
        .agg(F.min("at").alias("at"))
        .select("sta_norm", "line_norm", "at.*")
    )


def without_ferry(master: DataFrame, ferry_stop_type: str) -> DataFrame:
    """Stops of other types; a stop without a type fails the comparison and drops out too."""
    return master.where(F.col("STOPS_TYPE") != ferry_stop_type)


def unique_stops(master: DataFrame, ferry_stop_type: str) -> DataFrame:
    """One row per stop id outside the ferry type: the smallest coordinates win."""
    return (
        located(without_ferry(master, ferry_stop_type), "YCRD", "XCRD")
        .select(
            F.col("STOPS_NO").alias("stop_id"),
            F.struct(
                F.col("YCRD").alias("stop_lat"),
                F.col("XCRD").alias("stop_lon"),
                F.col("STOPS_TYPE").alias("stop_type"),
            ).alias("at"),
        )
        .groupBy("stop_id")
        .agg(F.min("at").alias("at"))
        .select("stop_id", "at.*")
    )


def sums_by_hour_and_month(facts: DataFrame, *place: str) -> DataFrame:
    """Counts per place and hour over all months, and per place and month over all hours, in one shuffle.

    ``by_month`` tells the two kinds apart; the column summed over is NULL. Sums only: a text
    among the aggregates would make Spark sort all facts.
    """
    return facts.groupingSets([[*place, "hr"], [*place, "ym"]], *place, "hr", "ym").agg(
        *[F.sum(c).alias(c) for c in MEASURES], F.grouping("hr").cast("int").alias("by_month")
    )


def _counted(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("n_rows", F.lit(1).cast("bigint"))


@dataclass(frozen=True)
class KeptSums:
    """Sums of both modes by place, month and hour with ``n_rows``, and every name of every stop."""

    rail: DataFrame
    bus: DataFrame
    stop_names: DataFrame


class Study:
    """Hourly tables and coordinate masters of one city, with the tables derived from them.

    Coordinates and the pairs within a radius depend on the masters alone, so they are
    worked out on the masters and met by the ridership only after it has been summed per
    place. Points at the same position are one *site*: a position shared by many stops
    or stations takes part in the distance join once.

    With ``staged=True`` the tables every query starts from are written to the session's
    shared folder on first use and read from there; a session that runs many queries then
    scans the ridership once. ``kept`` has sums by month that an earlier session left
    (``sources.month_sums``); a staged study then reads these in place of the ridership.
    """

    def __init__(
        self,
        rail: DataFrame,
        bus: DataFrame,
        station_master: DataFrame,
        stop_master: DataFrame,
        settings: Settings = Settings(),
        staged: bool = False,
        radii_m: Sequence[int] = RADII_M,
        kept: KeptSums | None = None,
    ) -> None:
        self.rail = rail
        self.bus = bus
        self.station_master = station_master
        self.stop_master = stop_master
        self.settings = settings
        self.staged = staged
        self.radii_m = tuple(radii_m)
        self.kept = kept

        self._tables: dict[str, DataFrame] = {}

    @cached_property
    def folder(self) -> str:
        """Where this study's staged tables are; ``close`` deletes it."""
        return new_folder(self.station_master.sparkSession, "study")

    def close(self) -> None:
        """Delete the staged tables. The study can be used again; it then stages them anew."""
        if "folder" in self.__dict__:
            delete_folder(self.station_master.sparkSession, self.folder)
        for name in [n for n, v in vars(type(self)).items() if isinstance(v, cached_property)]:
            self.__dict__.pop(name, None)
        self._tables.clear()

    def __enter__(self) -> Study:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def shared(self, name: str, build: Callable[[], DataFrame], *folders: str) -> DataFrame:
        """A table several queries use: built once, and written if the study is staged, in ``folders`` by column."""
        if name not in self._tables:
            self._tables[name] = stage_table(build(), name, self.folder, folders) if self.staged else build()
        return self._tables[name]

    def shared_by_radius(
        self, name: str, radii_m: Sequence[int], build: Callable[[Sequence[int]], DataFrame]
    ) -> DataFrame:
        """The same for a table with a ``radius_m`` column, staged for all radii of the study at once.

        Other radii, and studies that are not staged, get a plan for the radii asked for.
        """
        if not self.staged or not set(radii_m) <= set(self.radii_m):
            key = f"{name}-{'-'.join(map(str, radii_m))}"
            if key not in self._tables:
                self._tables[key] = build(radii_m)
            return self._tables[key]
        whole = self.shared(name, lambda: build(self.radii_m))
        return whole.where(F.col("radius_m").isin(*radii_m))

    @cached_property
    def stations(self) -> DataFrame:
        """``sta_norm, line_norm, sta_lat, sta_lon``, unique by name and line."""
        return self.shared("stations", lambda: unique_stations(self.station_master))

    @cached_property
    def stops(self) -> DataFrame:
        """``stop_id, stop_lat, stop_lon, stop_type``, unique by id, without ferries."""
        return self.shared("stops", lambda: unique_stops(self.stop_master, self.settings.ferry_stop_type))

    @cached_property
    def rail_facts(self) -> DataFrame:
        """Rail counts by station, line, month and hour; ``n_rows`` says how many rows are in one."""
        return _counted(self.rail) if self.kept is None else self.kept.rail

    @cached_property
    def bus_facts(self) -> DataFrame:
        """Bus counts by stop, month and hour over all routes; ``n_rows`` says how many rows are in one."""
        return _counted(self.bus) if self.kept is None else self.kept.bus

    @cached_property
    def rail_sums(self) -> DataFrame:
        return self.shared("rail-sums", lambda: sums_by_hour_and_month(self.rail_facts, "station", "line"), "by_month")

    @cached_property
    def bus_sums(self) -> DataFrame:
        return self.shared("bus-sums", lambda: sums_by_hour_and_month(self.bus_facts, "stop_id"), "by_month")

    def _facts(self, mode: str, dims: Sequence[str], hours: Sequence[int] | None) -> DataFrame:
        """The smallest table of a mode that has the dimensions asked for.

        Staged studies have two, by hour and by month, from one pass over the facts. Sums by
        month that tell hours apart go back to the facts.
        """
        if not self.staged or ("ym" in dims and ("hr" in dims or hours is not None)):
            return self.rail_facts if mode == "rail" else self.bus_facts
        sums = self.rail_sums if mode == "rail" else self.bus_sums
        return sums.where(F.col("by_month") == F.lit(int("ym" in dims))).drop("by_month", "hr" if "ym" in dims else "ym")

    @cached_property
    def stop_names(self) -> DataFrame:
        """``stop_id, stop_name``: the largest name of each stop, out of its few distinct ones."""

        def build() -> DataFrame:
            names = self.bus.select("stop_id", "stop_name").distinct() if self.kept is None else self.kept.stop_names
            return names.groupBy("stop_id").agg(F.max("stop_name").alias("stop_name"))

        return self.shared("stop-names", build)

    def normalised(self, rail: DataFrame) -> DataFrame:
        """Add the names under which the coordinate master knows a station."""
        return rail.withColumn("sta_norm", strip_alias(F.col("station"))).withColumn(
            "line_norm", renamed(F.col("line"), self.settings.line_renames)
        )

    def all_rail(self, *dims: str, hours: Sequence[int] | None = None, **sums: Column) -> DataFrame:
        """Rail aggregates per station, line and ``dims``, for located and other stations alike."""
        facts = self._facts("rail", dims, hours)
        facts = facts if hours is None else facts.where(F.col("hr").isin(*hours))
        return facts.groupBy("station", "line", *dims).agg(*[c.alias(k) for k, c in sums.items()])

    def rail_by_station(self, *dims: str, hours: Sequence[int] | None = None, **sums: Column) -> DataFrame:
        """Rail aggregates per station, line and ``dims``, with coordinates; unlocated stations drop out."""
        return (
            self.normalised(self.all_rail(*dims, hours=hours, **sums))
            .join(self.stations, ["sta_norm", "line_norm"])
            .drop("sta_norm", "line_norm")
        )

    def bus_by_stop(self, *dims: str, hours: Sequence[int] | None = None, **sums: Column) -> DataFrame:
        """Bus aggregates per stop and ``dims``, for located and other stops alike."""
        facts = self._facts("bus", dims, hours)
        facts = facts if hours is None else facts.where(F.col("hr").isin(*hours))
        return facts.groupBy("stop_id", *dims).agg(*[c.alias(k) for k, c in sums.items()])

    @cached_property
    def station_keys(self) -> DataFrame:
        """Stations with traffic: ``station, line, sta_lat, sta_lon``."""

        def build() -> DataFrame:
            keys = self.normalised(self._facts("rail", (), None).select("station", "line").distinct())
            return keys.join(self.stations, ["sta_norm", "line_norm"]).select(
                "station", "line", "sta_lat", "sta_lon"
            )

        return self.shared("station-keys", build)

    @cached_property
    def stop_keys(self) -> DataFrame:
        """Stops with traffic: ``stop_id, stop_lat, stop_lon``."""

        def build() -> DataFrame:
            keys = self._facts("bus", (), None).select("stop_id").distinct().join(self.stops, "stop_id")
            return keys.select("stop_id", "stop_lat", "stop_lon")

        return self.shared("stop-keys", build)

    def _pair_sites(self, radii_m: Sequence[int], box_only: bool = False) -> DataFrame:
        """Pairs of positions in the masters; those no place ends up at meet nothing later."""
        stops = located(without_ferry(self.stop_master, self.settings.ferry_stop_type), "YCRD", "XCRD")
        return radius_pairs(
            stops.select(F.col("YCRD").alias("stop_lat"), F.col("XCRD").alias("stop_lon")).distinct(),
            located(self.station_master, "LAT", "LOT").select(F.col("LAT").alias("sta_lat"), F.col("LOT").alias("sta_lon")).distinct(),
            radii_m,
            self.settings.km_per_degree_lat,
            self.settings.km_per_degree_lon,
            box_only,
            self.settings.exact_circle and not box_only,
        )

    def reach(self, radii_m: Sequence[int], box_only: bool = False) -> DataFrame:
        """Stop and station sites within each radius: ``radius_m``, both positions, ``dist_km``."""
        if box_only:
            return self.shared(f"box-{'-'.join(map(str, radii_m))}", lambda: self._pair_sites(radii_m, box_only))
        return self.shared_by_radius("reach", radii_m, self._pair_sites)

    @cached_property
    def sites(self) -> tuple[DataFrame, DataFrame]:
        """Positions of the stops and of the stations that ridership can be matched to, each once."""
        return (
            self.stops.select("stop_lat", "stop_lon").distinct(),
            self.stations.select("sta_lat", "sta_lon").distinct(),
        )

    @cached_property
    def few_stations(self) -> bool:
        """Whether the stations fit a broadcast, by their measured size."""
        return measured_bytes(self.stations) <= BROADCAST_LIMIT_BYTES

    def _grid(self, radii_m: Sequence[int], box_only: bool = False) -> Grid:
        s = self.settings
        return Grid(radii_m, s.km_per_degree_lat, s.km_per_degree_lon, box_only, s.exact_circle and not box_only)

    def _near(self, grid: Grid, stops: DataFrame, stations: DataFrame) -> DataFrame:
        """Pairs cell by cell. Busy cells are those of the masters' places, counted once: no pass over the ridership."""
        key = f"busy-{grid.radii_m[-1]}-{grid.exact_circle}"
        if key not in self._tables:
            self._tables[key] = grid.busy(*self.sites)
        return grid.near(stops, stations, self._tables[key])

    def key_pairs(self, radii_m: Sequence[int], box_only: bool = False) -> DataFrame:
        """Stops and stations with traffic within each radius, from one join of the two.

        Few stations are broadcast, so that the pairs stay by stop and are not shuffled.
        """
        grid = self._grid(radii_m, box_only)
        near = grid.near_broadcast if self.few_stations else partial(self._near, grid)
        return with_radius(grid, near(self.stop_keys, self.station_keys))

    def sums_in_reach(
        self, stops: DataFrame, stations: DataFrame, radii_m: Sequence[int], by: Sequence[str], sums: Sequence[str]
    ) -> DataFrame:
        """Sums over all (stop, station) within each radius; the pairs are added up where they are found."""
        grid = self._grid(radii_m)
        return radius_sums(grid, self._near(grid, stops, stations), by, sums)

    def sums_in_reach_by(self, stops: DataFrame, radii_m: Sequence[int], dim: str, sums: Sequence[str]) -> DataFrame:
        """The same around every station for each value of ``dim``; no row is made for a pair and a value."""
        grid = self._grid(radii_m)
        key = f"busy-blocks-{grid.radii_m[-1]}-{grid.exact_circle}"
        if key not in self._tables:
            self._tables[key] = busy_blocks(grid, *self.sites)
        return radius_sums_by(grid, stops, self.sites[1], dim, sums, self._tables[key])
