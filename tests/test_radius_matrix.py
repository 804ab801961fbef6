"""Sums within a radius for every value of a column, against the join that makes a row for each."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from walkshed.operators.radius import Grid, radius_sums
from walkshed.operators.radius_matrix import busy_blocks, radius_sums_by


def tables(spark, large=1):
    """Stops at few positions by month, some sums and months without a value; stations without a stop near too."""
    rng = random.Random(5)
    places = [(37.5 + rng.uniform(-0.01, 0.01), 127.0 + rng.uniform(-0.01, 0.01)) for _ in range(80)]
    stops = [
        (*rng.choice(places), rng.choice(["199801", "199802", None]), rng.choice([None, large * rng.randrange(100)]), 1)
        for _ in range(300)
    ]
    stations = [(37.5 + rng.uniform(-0.02, 0.02), 127.0 + rng.uniform(-0.02, 0.02)) for _ in range(60)]
    return (
        spark.createDataFrame(stops, "stop_lat double, stop_lon double, ym string, trips bigint, n_stops bigint"),
        spark.createDataFrame(stations, "sta_lat double, sta_lon double"),
    )


@pytest.mark.parametrize(("exact_circle", "large", "split"), [(False, 1, False), (True, 1, False), (False, 2**50, True)])
def test_sums_by_month_are_those_of_the_pairs(spark, exact_circle, large, split):
    stops, stations = tables(spark, large)
    grid = Grid([500, 200], exact_circle=exact_circle)
    busy = busy_blocks(grid, stops, stations, 100 if split else 10**9)
    assert (busy is not None) == split
    sums = ["trips", "n_stops"]
    by_pairs = radius_sums(grid, grid.near(stops, stations, None), ["sta_lat", "sta_lon", "ym"], sums)
    found = radius_sums_by(grid, stops, stations, "ym", sums, busy)
    assert by_pairs.count() > 20
    assert rows(found.select(by_pairs.columns)) == rows(by_pairs)


def test_no_row_is_made_for_a_pair_and_month(spark):
    stops, stations = tables(spark)
    plan = plan_text(radius_sums_by(Grid([500]), stops, stations, "ym", ["trips"], None))
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan


def test_only_whole_numbers_are_added_up(spark):
    stops, stations = tables(spark)
    with pytest.raises(ValueError, match="whole numbers"):
        radius_sums_by(Grid([500]), stops.withColumn("trips", F.col("trips") / 2), stations, "ym", ["trips"], None)
