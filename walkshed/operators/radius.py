"""Pairs of points within a radius, and sums over them: an equi-join on grid cells, then the exact test."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.functions.geo import great_circle_km, inside_box
from walkshed.schema import EARTH_RADIUS_KM, KM_PER_DEGREE_LAT, KM_PER_DEGREE_LON

# A cell is a little wider than the box reaches, so rounding cannot push a match two cells away.
CELL_MARGIN = 1.0001
# Candidate comparisons one task should get out of one cell.
PAIRS_PER_TASK = 50_000_000


def busy_cells(stops: DataFrame, stations: DataFrame, pairs_per_task: int) -> DataFrame:
    """Cells with more than ``pairs_per_task`` comparisons, and into how many parts to split them.

    Only counts per cell are shuffled. There are at most
    (stops + 9 * stations) / sqrt(pairs_per_task) such cells.
    """
    sides = stops.select("_cx", "_cy", F.lit(1).alias("stop"), F.lit(0).alias("station")).unionAll(
        stations.select("_cx", "_cy", F.lit(0), F.lit(1))
    )
    work = F.col("n_stops").cast("double") * F.col("n_stations")
    return (
        sides.groupBy("_cx", "_cy")
        .agg(F.sum("stop").alias("n_stops"), F.sum("station").alias("n_stations"))
        .where(work > pairs_per_task)
        .select("_cx", "_cy", F.least(F.ceil(work / pairs_per_task), F.col("n_stops")).cast("int").alias("_parts"))
    )


def _split(stops: DataFrame, stations: DataFrame, busy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deal the stops of a busy cell out over its parts and copy its stations to each part."""
    parts = F.coalesce("_parts", F.lit(1))
    spread_by = [c for c in stops.columns if c not in ("_cx", "_cy")]
    stops = stops.join(busy, ["_cx", "_cy"], "left").withColumn(
        "_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    )
    stations = stations.join(busy, ["_cx", "_cy"], "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return stops.drop("_parts"), stations.drop("_parts")


class Grid:
    """Cells as wide as the degree box of the largest radius, and the test that decides on a pair."""

    def __init__(
        self,
        radii_m: Sequence[int],
        km_per_degree_lat: float = KM_PER_DEGREE_LAT,
        km_per_degree_lon: float = KM_PER_DEGREE_LON,
        box_only: bool = False,
        exact_circle: bool = False,
    ) -> None:
        if box_only and exact_circle:
            raise ValueError("box_only and exact_circle exclude each other")
        self.radii_m = sorted(set(radii_m))
        self.degrees_km = km_per_degree_lat, km_per_degree_lon
        self.box_only, self.exact_circle = box_only, exact_circle
        self.distance = great_circle_km(
            F.col("stop_lat"), F.col("stop_lon"), F.col("sta_lat"), F.col("sta_lon"), F.col("_stop_cos"), F.col("_sta_cos")
        )

    def tolerances(self, radius_m: int) -> tuple[float, float]:
        return tuple(radius_m / 1000.0 / km for km in self.degrees_km)

    def circle_degrees(self, radius_m: int) -> tuple[float, Column]:
        """How far the circle reaches in latitude, and in longitude at the station's latitude."""
        angle = radius_m / 1000.0 / EARTH_RADIUS_KM
        ratio = math.sin(angle) / F.cos(F.radians("sta_lat"))
        return math.degrees(angle), F.degrees(F.asin(F.least(F.lit(1.0), ratio)))

    def within(self, radius_m: int) -> Column:
        near = self.distance <= radius_m / 1000.0
        if self.exact_circle:
            # The distance decides; latitudes further apart than the circle reaches need none.
            reach = math.degrees(radius_m / 1000.0 / EARTH_RADIUS_KM) * CELL_MARGIN
            return (F.abs(F.col("stop_lat") - F.col("sta_lat")) <= reach) & near
        test = inside_box(
            F.col("stop_lat"), F.col("stop_lon"), F.col("sta_lat"), F.col("sta_lon"), *self.tolerances(radius_m)
        )
        return test if self.box_only else test & near

    def cells(self, lat: str, lon: str) -> tuple[Column, Column]:
        lat_tol, lon_tol = self.tolerances(self.radii_m[-1])
        return F.floor(F.col(lat) / (lat_tol * CELL_MARGIN)), F.floor(F.col(lon) / (lon_tol * CELL_MARGIN))

    def stops_in_cell(self, stops: DataFrame) -> DataFrame:
        cx, cy = self.cells("stop_lat", "stop_lon")
        return stops.withColumn("_cx", cx).withColumn("_cy", cy)

    def stations_in_reach(self, stations: DataFrame) -> DataFrame:
        """Stations, copied to all cells that their box or circle reaches."""
        reach_x = reach_y = F.lit(1).cast("bigint")
        if self.exact_circle:
            lat_tol, lon_tol = self.tolerances(self.radii_m[-1])
            widest_lat, widest_lon = self.circle_degrees(self.radii_m[-1])
            reach_x, reach_y = F.ceil(F.lit(widest_lat / lat_tol)), F.ceil(widest_lon / lon_tol)
        return _around(stations, *self.cells("sta_lat", "sta_lon"), reach_x, reach_y)

    def busy(self, stops: DataFrame, stations: DataFrame, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame | None:
        """``busy_cells`` of these positions; None if there are none. Runs a job."""
        found = busy_cells(self.stops_in_cell(stops), self.stations_in_reach(stations), pairs_per_task)
        return None if found.isEmpty() else found

    def near(self, stops: DataFrame, stations: DataFrame, busy: DataFrame | None) -> DataFrame:
        """Pairs within the largest radius, found cell by cell."""
        stops, stations = self.stops_in_cell(_with_cos(stops, "stop")), self.stations_in_reach(_with_cos(stations, "sta"))
        cell = ["_cx", "_cy"]
        if busy is not None:
            stops, stations = _split(stops, stations, busy)
            cell = [*cell, "_part"]
        return stops.join(stations, cell).where(self.within(self.radii_m[-1])).drop(*cell)

    def near_broadcast(self, stops: DataFrame, stations: DataFrame) -> DataFrame:
        """The same with all stations in every task: the stops, and so the pairs, stay in the partitions they are in."""
        stops, stations = _with_cos(stops, "stop"), _with_cos(stations, "sta")
        if self.exact_circle:
            stops, stations = self.stops_in_cell(stops), self.stations_in_reach(stations)
        else:
            # The stops are copied as they pass, so that the broadcast has every station once.
            one = F.lit(1).cast("bigint")
            stops = _around(stops, *self.cells("stop_lat", "stop_lon"), one, one)
            cx, cy = self.cells("sta_lat", "sta_lon")
            stations = stations.withColumn("_cx", cx).withColumn("_cy", cy)
        # One number a cell, as Spark's hash table of numbers is the faster one.
        at = (F.shiftleft("_cx", 32) + F.col("_cy")).alias("_at")
        stops, stations = (df.select(*[c for c in df.columns if c not in ("_cx", "_cy")], at) for df in (stops, stations))
        return stops.join(F.broadcast(stations), "_at").where(self.within(self.radii_m[-1])).drop("_at")

    def reached(self) -> Column:
        """One row for each radius that holds a pair: a smaller box and circle lie within a larger one."""
        return F.explode(self._by_smallest(lambda i: F.array(*map(F.lit, self.radii_m[i:]))))

    def smallest(self) -> Column:
        """The smallest radius that holds a pair within the largest."""
        return self._by_smallest(lambda i: F.lit(self.radii_m[i]))

    def _by_smallest(self, value) -> Column:
        found = value(len(self.radii_m) - 1)
        for i in reversed(range(len(self.radii_m) - 1)):
            found = F.when(self.within(self.radii_m[i]), value(i)).otherwise(found)
        return found


def _around(points: DataFrame, cx: Column, cy: Column, reach_x: Column, reach_y: Column) -> DataFrame:
    return points.withColumn("_cx", F.explode(F.sequence(cx - reach_x, cx + reach_x))).withColumn(
        "_cy", F.explode(F.sequence(cy - reach_y, cy + reach_y))
    )


def _with_cos(points: DataFrame, side: str) -> DataFrame:
    """Add what a position has to be worked out for once, and not once a pair."""
    return points.withColumn(f"_{side}_cos", F.cos(F.radians(f"{side}_lat")))


def radius_pairs(
    stops: DataFrame,
    stations: DataFrame,
    radii_m: Sequence[int],
    km_per_degree_lat: float = KM_PER_DEGREE_LAT,
    km_per_degree_lon: float = KM_PER_DEGREE_LON,
    box_only: bool = False,
    exact_circle: bool = False,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Every (stop, station) within each radius, with ``radius_m`` and ``dist_km``.

    ``stops`` carries ``stop_lat`` and ``stop_lon``, ``stations`` ``sta_lat`` and ``sta_lon``; other
    columns pass through. A pair has to lie in the degree box of the radius and, unless
    ``box_only``, within the great-circle distance. One join at the largest radius serves
    all radii, as a smaller box and circle lie within a larger one.

    With ``exact_circle`` the distance alone decides. A station then takes part in all cells that its
    circle reaches at its latitude; circles over a pole or the 180th meridian are not joined up.

    """
    grid = Grid(radii_m, km_per_degree_lat, km_per_degree_lon, box_only, exact_circle)
    return with_radius(grid, grid.near(stops, stations, grid.busy(stops, stations, pairs_per_task)))


def with_radius(grid: Grid, pairs: DataFrame) -> DataFrame:
    """Pairs of a grid with ``dist_km``, once for each radius that holds them."""
    radius = grid.reached() if len(grid.radii_m) > 1 else F.lit(grid.radii_m[0])
    return pairs.withColumn("dist_km", grid.distance).withColumn("radius_m", radius).drop("_stop_cos", "_sta_cos")


def radius_sums(grid: Grid, pairs: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Columns of the pairs of a grid, added up by radius and the columns ``by``.

    The task that finds the pairs of a cell adds them up, so no pair is shuffled. Each pair counts at the
    smallest radius that holds it; the sums of the radii are put together from these.
    """

    def added(df: DataFrame) -> DataFrame:
        return df.groupBy("radius_m", *by).agg(*[F.sum(c).alias(c) for c in sums])

    found = added(pairs.withColumn("radius_m", grid.smallest()))
    if len(grid.radii_m) == 1:
        return found
    holding = F.filter(F.array(*map(F.lit, grid.radii_m)), lambda r: r >= F.col("radius_m"))
    return added(found.withColumn("radius_m", F.explode(holding)))
