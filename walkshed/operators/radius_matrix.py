"""Sums over the stops within a radius for every value of a further column, as products of matrices.

A pair within the radius would become a row for each month of its stop. Here one task takes a block of
the grid with its stops and the stations in reach, works out which lie within the radius once, and
multiplies these ones and zeros by the sums of stop and month.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkshed.operators.radius import CELL_MARGIN, Grid
from walkshed.schema import EARTH_RADIUS_KM

#: Width of a block in boxes: a box reaches into four blocks at most.
WIDE = 2
#: Comparisons and stops that one group should get out of one block.
PAIRS_PER_GROUP, STOPS_PER_GROUP = 500_000_000, 100_000
#: Stops and stations compared at a time.
AT_ONCE = 1024
_EXACT = 2**53


def _blocks(grid: Grid, stops: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stops with their block, stations with every block that their box or circle reaches."""
    lat_tol, lon_tol = grid.tolerances(grid.radii_m[-1])
    lat_reach, lon_reach = F.lit(lat_tol), F.lit(lon_tol)
    if grid.exact_circle:
        lat_degrees, lon_reach = grid.circle_degrees(grid.radii_m[-1])
        lat_reach = F.lit(lat_degrees)

    def reached(at: str, reach, width: float):
        return F.explode(F.sequence(*[F.floor((F.col(at) + sign * CELL_MARGIN * reach) / (WIDE * width)) for sign in (-1, 1)]))

    stops = stops.withColumn("_cx", F.floor(F.col("stop_lat") / (WIDE * lat_tol))).withColumn(
        "_cy", F.floor(F.col("stop_lon") / (WIDE * lon_tol))
    )
    stations = stations.withColumn("_cx", reached("sta_lat", lat_reach, lat_tol)).withColumn(
        "_cy", reached("sta_lon", lon_reach, lon_tol)
    )
    return stops, stations


def busy_blocks(
    grid: Grid, stops: DataFrame, stations: DataFrame, pairs: int = PAIRS_PER_GROUP, sites: int = STOPS_PER_GROUP
) -> DataFrame | None:
    """Blocks with more comparisons or stops than one group should get, and their parts; None if there are none."""
    stops, stations = _blocks(grid, stops.select("stop_lat", "stop_lon"), stations.select("sta_lat", "sta_lon"))
    n_stops, n_stations = (df.groupBy("_cx", "_cy").agg(F.count("*").alias(n)) for df, n in ((stops, "n_stops"), (stations, "n_stations")))
    work = F.greatest(F.col("n_stops").cast("double") * F.col("n_stations") / pairs, F.col("n_stops") / sites)
    found = n_stops.join(n_stations, ["_cx", "_cy"]).where(work > 1).select(
        "_cx", "_cy", F.least(F.ceil(work), "n_stops").cast("int").alias("_parts")
    )
    return None if found.isEmpty() else found


def radius_sums_by(
    grid: Grid, stops: DataFrame, stations: DataFrame, dim: str, sums: Sequence[str], busy: DataFrame | None
) -> DataFrame:
    """``radius_m, sta_lat, sta_lon``, ``dim`` and ``sums`` over the rows of ``stops`` within each radius.

    ``stops`` has rows by position and ``dim`` with whole numbers to add up, ``stations`` every position once. A block
    that is dealt out in parts by position gives a row for each part, and so do neighbouring blocks; these are added
    up in the end. A sum without a value is NULL.
    """
    wrong = [c for c in sums if not isinstance(stops.schema[c].dataType, (T.LongType, T.IntegerType))]
    if wrong:
        raise ValueError(f"{wrong} are not whole numbers")
    stops = stops.select("stop_lat", "stop_lon", dim, *[F.col(c).cast("bigint").alias(c) for c in sums])
    stops, stations = _blocks(grid, stops, stations.select("sta_lat", "sta_lon"))
    key = ["_cx", "_cy", "_part"]
    if busy is None:
        stops, stations = stops.withColumn("_part", F.lit(0)), stations.withColumn("_part", F.lit(0))
    else:
        parts = F.coalesce("_parts", F.lit(1))
        stops = stops.join(busy, key[:2], "left").withColumn("_part", F.pmod(F.xxhash64("stop_lat", "stop_lon"), parts).cast("int"))
        stations = stations.join(busy, key[:2], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    by = T.StructType([
        T.StructField("radius_m", T.IntegerType()), T.StructField("sta_lat", T.DoubleType()),
        T.StructField("sta_lon", T.DoubleType()), T.StructField(dim, stops.schema[dim].dataType),
    ])
    schema = T.StructType([*by.fields, *[T.StructField(c, T.LongType()) for c in sums]])
    tolerances = {r: grid.tolerances(r) for r in grid.radii_m}
    exact_circle, band = grid.exact_circle, grid.radii_m[-1] / 1000.0 / EARTH_RADIUS_KM

    def added(left: pa.Table, right: pa.Table) -> pa.Table:
        return _added(left, right, dim, sums, tolerances, exact_circle, np.degrees(band))

    found = (
        stops.select(*key, *[c for c in stops.columns if c not in (*key, "_parts")]).groupBy(*key)
        .cogroup(stations.select(*key, "sta_lat", "sta_lon").groupBy(*key))
        .applyInArrow(added, schema)
    )
    return found.groupBy(*by.fieldNames()).agg(*[F.sum(c).alias(c) for c in sums])


def _within(
    stops: np.ndarray, stations: np.ndarray, tolerances: dict[int, tuple[float, float]], exact_circle: bool
) -> dict[int, np.ndarray]:
    """Radius -> ones where the station (row) has the stop (column) within it; the tests are those of ``Grid.within``."""
    lat, lon = stops[:, 0][None, :], stops[:, 1][None, :]
    sta_lat, sta_lon = stations[:, 0][:, None], stations[:, 1][:, None]
    found, widest = {}, max(tolerances)
    for radius_m in sorted(tolerances, reverse=True):
        lat_tol, lon_tol = tolerances[radius_m]
        box = True if exact_circle else (
            (lat >= sta_lat - lat_tol) & (lat <= sta_lat + lat_tol) & (lon >= sta_lon - lon_tol) & (lon <= sta_lon + lon_tol)
        )
        if radius_m == widest:
            i, j = np.nonzero(np.broadcast_to(box, (len(stations), len(stops))))
            half_lat = np.sin(np.radians(stations[i, 0] - stops[j, 0]) / 2.0)
            half_lon = np.sin(np.radians(stations[i, 1] - stops[j, 1]) / 2.0)
            cos_stop, cos_sta = np.cos(np.radians(stops[:, 0])), np.cos(np.radians(stations[:, 0]))
            chord = half_lat * half_lat + cos_stop[j] * cos_sta[i] * half_lon * half_lon
            with np.errstate(invalid="ignore"):
                km = (2.0 * EARTH_RADIUS_KM) * np.arcsin(np.sqrt(chord))
        ones = np.zeros((len(stations), len(stops)))
        near = km <= radius_m / 1000.0
        ones[i[near], j[near]] = 1.0
        found[radius_m] = ones if exact_circle else ones * box
    return found


def _added(
    left: pa.Table, right: pa.Table, dim: str, sums: Sequence[str], tolerances: dict[int, tuple[float, float]],
    exact_circle: bool, circle_lat: float,
) -> pa.Table:
    names = ["radius_m", "sta_lat", "sta_lon", dim, *sums]
    kind = left.schema.field(dim).type
    kinds = [pa.int32(), pa.float64(), pa.float64(), kind, *[pa.int64()] * len(sums)]
    empty = pa.table([pa.array([], k) for k in kinds], names=names)
    if not left.num_rows or not right.num_rows:
        return empty
    positions = np.stack([left.column("stop_lat").to_numpy(), left.column("stop_lon").to_numpy()], axis=1)
    sites, site = np.unique(positions, axis=0, return_inverse=True)  # by latitude
    stations = np.stack([right.column("sta_lat").to_numpy(), right.column("sta_lon").to_numpy()], axis=1)
    stations = stations[np.argsort(stations[:, 0], kind="stable")]
    coded = left.column(dim).combine_chunks().dictionary_encode(null_encoding="encode")
    codes, n_dims = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    # One column of rows, then for each sum its values and how many there are.
    columns = [np.ones(left.num_rows, np.int64)]
    for name in sums:
        values = left.column(name).combine_chunks()
        columns += [values.fill_null(0).to_numpy(zero_copy_only=False), values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)]
    most = max(float(np.abs(c.astype(np.float64)).sum()) for c in columns)
    if most >= 2.0**63:
        raise OverflowError("sums beyond 64 bits")
    # Below 2^53 all sums of doubles are exact; beyond, numbers of 64 bits are multiplied, which takes longer.
    number = np.float64 if most < _EXACT else np.int64
    width = len(columns) * n_dims
    totals = {r: np.zeros((len(stations), width), number) for r in tolerances}
    reach = (circle_lat if exact_circle else tolerances[max(tolerances)][0]) * CELL_MARGIN
    order = np.argsort(site, kind="stable")
    site, codes, columns = site[order], codes[order], [c[order] for c in columns]
    for start in range(0, len(sites), AT_ONCE):
        block = sites[start : start + AT_ONCE]
        rows = slice(*np.searchsorted(site, (start, start + len(block))))
        table = np.zeros((len(block), width), number)
        for k, column in enumerate(columns):
            np.add.at(table, (site[rows] - start, k * n_dims + codes[rows]), column[rows].astype(number))
        first, last = np.searchsorted(stations[:, 0], (block[0, 0] - reach, block[-1, 0] + reach), side="left")
        last = min(len(stations), last + 1)
        for at in range(first, last, AT_ONCE):
            some = slice(at, min(at + AT_ONCE, last))
            for radius_m, ones in _within(block, stations[some], tolerances, exact_circle).items():
                totals[radius_m][some] += ones.astype(number, copy=False) @ table
    found = []
    for radius_m, total in totals.items():
        total = total.reshape(len(stations), len(columns), n_dims)
        who, what = np.nonzero(total[:, 0, :])
        arrays = [
            pa.array(np.full(len(who), radius_m, np.int32)), pa.array(stations[who, 0]), pa.array(stations[who, 1]),
            coded.dictionary.take(pa.array(what)).cast(kind),
        ]
        for k in range(len(sums)):
            values, counts = total[who, 1 + 2 * k, what], total[who, 2 + 2 * k, what]
            arrays.append(pa.array(values.astype(np.int64), mask=counts == 0))
        found.append(pa.table(arrays, names=names))
    return pa.concat_tables(found) if found else empty
