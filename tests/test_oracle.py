"""Registered queries against their SQL on DuckDB at the smallest scale.

``check_oracle.py`` runs all of them at any scale; here, for time, queries are left out whose
plan is part of another one's.
"""

import pytest

import __spark_entry__ as registered
from check_oracle import connect, differences

SF = "/root/testdata/sf0.001"
PART_OF_ANOTHER = {
    "standardize_bus", "dedup_rail", "dedup_audit_bus", "page_rows_rail", "page_completeness", "line_norm",
    "zone_stats_500", "share_hour_type_500", "direction_bus_500", "chart_type_share", "chart_hourly_200",
    "chart_top_stations",
}
NAMES = [
    n
    for n in registered.oracle_queries()
    if n not in PART_OF_ANOTHER and (n.startswith("chart") or not n.endswith("_200"))
]


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, con, name):
    assert differences(name, spark, con, SF) is None


def test_every_query_has_sql():
    assert set(registered._walkshed_queries()) == set(registered.oracle_queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_runs(spark):
    assert registered.entry(spark).count() == 10
