"""Land the months for which new pages have arrived."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from walkshed.schema import LANDED_PAGE, SERVICE_DATASETS
from walkshed.sources.pages import DAMAGED, is_page, land, page_lines, set_aside

#: Below the checkpoint, so that both are kept or lost together: pages by service, month and batch, and other lines.
PAGES_FOLDER, DAMAGED_FOLDER = "pages", "damaged"
_STATE = ", ".join(
    [*[f"{f.name} {f.dataType.simpleString()}" for f in LANDED_PAGE.fields if f.name not in ("service", "ym")],
     "fetched_at timestamp, service string, ym string, batch bigint"]
)


def known_pages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All pages that have arrived, in folders by service, month and batch."""
    return spark.read.schema(_STATE).parquet(f"{checkpoint}/{PAGES_FOLDER}")


def _write_batch(rows: DataFrame, path: str, *folders: str) -> None:
    """Write the rows of a batch; the same batch run again replaces what it wrote before."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def land_new_pages(
    spark: SparkSession,
    source: str,
    path: str,
    columns: Mapping[str, Sequence[str]],
    checkpoint: str,
    datasets: Mapping[str, str] = SERVICE_DATASETS,
) -> StreamingQuery:
    """Process the page files that are new since the last run, then stop.

    New pages are kept by service, month and batch. The months they belong to are landed again from the folders
    of these months alone, so a month that arrives in several runs is whole, and neither the page files of
    earlier runs nor other months are read. A batch run again after a failure replaces its own folders. Lines
    that are no pages are kept apart, by batch and file.
    """

    def land_touched_months(lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()  # read once for pages, other lines and months
        try:
            batch = F.lit(batch_id).cast("bigint").alias("batch")
            new = lines.where(is_page())
            touched = new.select("service", "ym").distinct().collect()  # one row per service and month at most
            bad = set_aside(lines).select("*", batch)
            if not bad.isEmpty():
                _write_batch(bad, f"{checkpoint}/{DAMAGED_FOLDER}", "batch")
            if touched:
                kept = new.drop(DAMAGED, "file", "at").select("*", batch)
                _write_batch(kept.hint("rebalance", "service", "ym"), f"{checkpoint}/{PAGES_FOLDER}", "service", "ym", "batch")
        finally:
            lines.unpersist()
        if not touched:
            return
        months: dict[str, list[str]] = {}
        for row in touched:
            months.setdefault(row.service, []).append(row.ym)
        of_months = F.lit(False)
        for service, yms in months.items():  # on folder names, so that other months are not read
            of_months = of_months | ((F.col("service") == service) & F.col("ym").isin(yms))
        land(known_pages(spark, checkpoint).where(of_months).drop("batch"), path, columns, datasets)

    return (
        page_lines(spark.readStream, source)
        .writeStream.foreachBatch(land_touched_months)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
