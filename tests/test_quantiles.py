"""Quantiles from merged sketches against quantiles of all shares."""

import math

from pyspark.sql import functions as F

from conftest import rows
from walkshed import testdata
from walkshed.plans import quantiles

SF = "/root/testdata/sf0.001"


def nth(values, rank):
    return sorted(values)[max(math.ceil(rank * len(values)), 1) - 1]


def sketches(spark, k, *months):
    shares = spark.createDataFrame([(ym, float(x)) for ym, values in months for x in values], "ym string, share double")
    return shares.groupBy("ym").agg(F.count("*").alias("n_zones"), F.kll_sketch_agg_double("share", k).alias("sketch"))


def test_any_set_of_months_is_exact_while_all_shares_are_kept(spark):
    months = [("202501", [5, 1, 3, 3]), ("202502", [2]), ("202601", [100, 0, 0])]
    found = sketches(spark, 100, *months)
    by_month = {r.ym: r for r in quantiles.merged_quantiles(found, "ym", k=100).collect()}
    for ym, values in months:
        assert tuple(by_month[ym])[1:] == (len(values), *[nth(values, q) for q in (0.25, 0.5, 0.75)])
    (whole,) = quantiles.merged_quantiles(found.where("ym < '2026'"), k=100).collect()
    assert tuple(whole) == (5, 2.0, 3.0, 3.0)
    assert quantiles.merged_quantiles(found.where("false"), "ym").collect() == []


def test_rank_error_of_many_merged_months(spark):
    shares = spark.range(300_000).select(
        F.concat(F.lit("20"), F.lpad((F.col("id") % 60).cast("string"), 4, "0")).alias("ym"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 10_000.0).alias("share"),
    )
    months = shares.groupBy("ym").agg(
        F.count("*").alias("n_zones"), F.kll_sketch_agg_double("share", quantiles.SKETCH_K).alias("sketch")
    )
    (found,) = quantiles.merged_quantiles(months, digits=None).collect()
    assert found.n_zones == 300_000
    for name, rank in quantiles.QUANTILES.items():
        at_most = shares.where(F.col("share") <= found[name]).count() / 300_000
        assert abs(at_most - rank) < 0.002


def test_sketches_of_the_study_against_its_shares(spark):
    with testdata.study(spark, SF, staged=True) as study:
        zones = quantiles.zone_stats_by_month(study, [500])
        by_year = {}
        for r in zones.where("rail_share_pct IS NOT NULL").collect():
            by_year.setdefault(int(r.ym[:4]), []).append(r.rail_share_pct)
        found = quantiles.share_quantiles_by_year(study, [500], digits=None)
        wanted = [(500, y, len(v), *[nth(v, q) for q in (0.25, 0.5, 0.75)]) for y, v in by_year.items()]
        assert rows(found) == sorted(wanted, key=lambda r: [(v is None, str(v)) for v in r])
