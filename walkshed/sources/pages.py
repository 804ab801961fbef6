"""Landed API pages: checking, flattening and landing them month by month.

A landed page is one row of ``LANDED_PAGE``: the service and month asked for, the row range,
and the response body as text. Pages of all months and services are handled in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from walkshed.schema import LANDED_PAGE, PAGE_BODY, SERVICE_DATASETS
from walkshed.session import stage_table

MB = 1024 * 1024


#: Where Spark puts a line that is no page.
DAMAGED = "_damaged"
_LINES = T.StructType([*LANDED_PAGE.fields, T.StructField(DAMAGED, T.StringType())])


def page_lines(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """Every line under ``path``: the columns of a page, ``_damaged`` with the text of a line that is none, file and time."""
    lines = reader.schema(_LINES).option("columnNameOfCorruptRecord", DAMAGED).json(path)
    return lines.withColumns(
        {"fetched_at": F.col("_metadata.file_modification_time"), "file": F.col("_metadata.file_path"), "at": F.col("_metadata.file_block_start")}
    )


def is_page() -> Column:
    """A line with a service and a month; one without belongs to no month and is set aside too."""
    return F.col(DAMAGED).isNull() & F.col("service").isNotNull() & F.col("ym").isNotNull()


def scan_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed pages stored as JSON lines, with the time their file was written as ``fetched_at``.

    Lines that are no pages are left out; see ``damaged_lines``.
    """
    return page_lines(spark.read, path).where(is_page()).drop(DAMAGED, "file", "at")


def damaged_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, at, line): lines that are no pages, with the start of the split of the file they are in."""
    return set_aside(page_lines(spark.read, path))


def set_aside(lines: DataFrame) -> DataFrame:
    fields = F.to_json(F.struct(*LANDED_PAGE.fieldNames()))
    return lines.where(~is_page()).select("file", "at", F.coalesce(DAMAGED, fields).alias("line"))


def _with_body(pages: DataFrame) -> DataFrame:
    """Parse the envelope: ``body`` of the asked service, or ``top_result`` if there is none."""
    envelope = F.from_json("payload", "map<string,string>")
    result = F.coalesce(F.element_at("_envelope", F.lit("RESULT")), F.element_at("_envelope", F.lit("result")))
    return (
        pages.withColumn("_envelope", envelope)
        .withColumn("body", F.from_json(F.element_at("_envelope", F.col("service")), PAGE_BODY))
        .withColumn("top_result", F.from_json(result, "CODE string, MESSAGE string"))
        .drop("_envelope", "payload")
    )


def _status(rows: Column) -> Column:
    code = F.coalesce(F.col("body.RESULT.CODE"), F.lit(""))
    return (
        F.when(F.col("body").isNull(), "no_body")
        .when((code != "") & ~code.startswith("INFO-"), "error")
        .when(rows == 0, "empty")
        .otherwise("ok")
    )


def page_status(pages: DataFrame) -> DataFrame:
    """One row per page: whether it holds rows, is empty, reports an error or has no body."""
    rows = F.coalesce(F.size("body.row"), F.lit(0))
    return (
        _with_body(pages)
        .withColumn("n_rows", F.when(rows > 0, rows).otherwise(0).cast("bigint"))
        .select(
            "service",
            "ym",
            "page_start",
            _status(F.col("n_rows")).alias("status"),
            F.coalesce("body.RESULT.CODE", "top_result.CODE").alias("code"),
            "n_rows",
            F.col("body.list_total_count").alias("list_total_count"),
        )
    )


def latest_pages(pages: DataFrame) -> DataFrame:
    """Parsed pages, one per service, month and ``page_start``: of several deliveries the latest good one.

    Pages without ``fetched_at`` count as equally old; then the one with more rows is taken.
    """
    rows = F.coalesce(F.size("body.row"), F.lit(0))
    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    parsed = _with_body(pages.withColumn("_hash", F.xxhash64("payload")))
    rank = F.struct(_status(rows).isin("ok", "empty").alias("good"), "fetched_at", rows.alias("n"), "_hash")
    return (
        parsed.groupBy("service", "ym", "page_start")
        .agg(F.max_by(F.struct("body", "top_result"), rank).alias("_page"))
        .select("service", "ym", "page_start", "_page.*")
    )


def page_rows(pages: DataFrame, columns: Sequence[str], service: str | None = None) -> DataFrame:
    """The records of all good pages as text columns, under a declared column list."""
    if service is not None:
        pages = pages.where(F.col("service") == service)
    return _rows(latest_pages(pages), columns)


def _rows(latest: DataFrame, columns: Sequence[str]) -> DataFrame:
    records = (
        latest.where(_status(F.coalesce(F.size("body.row"), F.lit(0))) == "ok")
        .select("service", F.col("ym").alias("page_ym"), F.explode("body.row").alias("r"))
    )
    names = list(columns)
    schema = T.StructType([*records.schema.fields[:2], *[T.StructField(c, T.StringType()) for c in names]])
    return records.mapInArrow(lambda batches: map(lambda batch: _declared(batch, names), batches), schema)


def _declared(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """The declared keys of a batch of records as columns; of a key that comes twice in a record the first.

    Looking up every name in every record, as an expression, makes code too long for the JVM to compile.
    """
    maps = batch.column(2)
    starts = maps.offsets.to_numpy()
    keys = maps.keys.slice(starts[0], starts[-1] - starts[0])
    record = np.repeat(np.arange(len(maps)), np.diff(starts))
    column = pc.fill_null(pc.index_in(keys, value_set=pa.array(names, keys.type)), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero((column >= 0) & maps.is_valid().to_numpy(zero_copy_only=False)[record])[::-1]
    found = np.full((len(names), len(maps)), -1)
    found[column[at], record[at]] = at + starts[0]
    cells = [maps.items.take(pa.array(row, mask=row < 0)) for row in found]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells], names=[*batch.schema.names[:2], *names])


def month_status(pages: DataFrame, columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per service and month, from the latest good page of each range.

    ``failed``: a page reports an error or has no body, so the month is not landed.
    ``undeclared``: the service has no list in ``columns``; not landed.
    ``changed``: records have keys that are not among the service's ``columns``; not landed, as
    these values would be lost. ``empty``: no rows, nothing to land. ``incomplete``: fewer
    rows than announced, ``excess``: more; both are landed, but flagged. ``complete`` otherwise.
    """
    return _month_status(latest_pages(pages), columns)


def _month_status(latest: DataFrame, columns: Mapping[str, Sequence[str]] | None) -> DataFrame:
    bad = F.col("status").isin("error", "no_body")
    rows = F.coalesce(F.size("body.row"), F.lit(0))
    n_rows = F.when(rows > 0, rows).otherwise(0).cast("bigint")
    undeclared = F.lit(0)
    declared = F.lit(True) if columns is None else F.coalesce(F.col("service").isin(list(columns)), F.lit(False))
    for service, names in (columns or {}).items():
        keys = F.flatten(F.transform("body.row", lambda r: F.map_keys(r)))
        others = F.size(F.array_except(keys, F.array(*map(F.lit, names))))
        undeclared = F.when(F.col("service") == service, F.greatest(others, F.lit(0))).otherwise(undeclared)
    return (
        latest.select(
            "service", "ym", _status(n_rows).alias("status"), n_rows.alias("n_rows"),
            F.col("body.list_total_count").alias("list_total_count"), undeclared.alias("undeclared"),
        )
        .groupBy("service", "ym")
        .agg(
            F.count("*").alias("n_pages"),
            F.count_if(bad).alias("n_failed_pages"),
            F.sum("n_rows").alias("n_rows"),
            F.max("list_total_count").alias("list_total_count"),
            F.coalesce(F.max("undeclared"), F.lit(0)).cast("bigint").alias("n_undeclared_keys"),
        )
        .withColumn(
            "status",
            F.when(F.col("n_failed_pages") > 0, "failed")
            .when(~declared, "undeclared")
            .when(F.col("n_undeclared_keys") > 0, "changed")
            .when(F.col("n_rows") == 0, "empty")
            .when(F.col("n_rows") > F.col("list_total_count"), "excess")
            .when(F.col("n_rows") < F.col("list_total_count"), "incomplete")
            .otherwise("complete"),
        )
    )


#: What has been landed, one row per month and attempt.
LOG_FOLDER = "_landing_log"
LANDING_LOG = (
    "service string, dataset string, ym string, attempt bigint, status string, n_pages bigint, n_rows bigint,"
    " checksum decimal(38,0), n_files bigint, n_bytes bigint, landed_at timestamp"
)


def _checksum(columns: Sequence[str]) -> Column:
    """A sum over records that does not depend on their order; null and empty cells are one to a CSV file."""
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]
    return F.sum(F.xxhash64(*cells).cast("decimal(38,0)"))


def landing_log(spark: SparkSession, path: str) -> DataFrame:
    """All attempts to land a month under ``path``; none if nothing was landed yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LOG_FOLDER}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LANDING_LOG)
    return spark.read.schema(LANDING_LOG).parquet(f"{path}/{LOG_FOLDER}")


def landed_months(spark: SparkSession, path: str) -> DataFrame:
    """The last attempt that landed each service's month: what the files of the month should hold."""
    landed = landing_log(spark, path).where(F.col("n_files").isNotNull())
    row = F.struct("attempt", *[c for c in landed.columns if c not in ("service", "ym", "attempt")])
    return landed.groupBy("service", "ym").agg(F.max(row).alias("r")).select("service", "ym", "r.*")


def land(
    pages: DataFrame,
    path: str,
    columns: Mapping[str, Sequence[str]],
    datasets: Mapping[str, str] = SERVICE_DATASETS,
) -> DataFrame:
    """Write the records of every landable month as CSV under ``path/<dataset>/ym=<month>``.

    ``columns`` gives each service's column list. A failed, changed or undeclared month is left out and
    does not stop the others; months already landed are replaced only if they are in ``pages``. Pages are
    parsed once and staged. After the files, every month of ``pages`` gets a row in the log, with what it should hold;
    a run that ends before leaves the log as it was. Returns the month status table.
    """
    missing = sorted(set(columns) - set(datasets))
    if missing:
        raise ValueError(f"no dataset named for {', '.join(missing)}")
    spark = pages.sparkSession
    latest = stage_table(latest_pages(pages), "pages")
    status = stage_table(_month_status(latest, columns), "month-status")
    landable = status.where(F.col("status").isin("complete", "incomplete", "excess")).select("service", "ym")
    # One row per service and month at most, so the broadcast stays in the kilobytes.
    good = latest.join(F.broadcast(landable), ["service", "ym"], "left_semi")
    sums = None
    for service, names in columns.items():
        records = _rows(good.where(F.col("service") == service), names)
        (
            records.drop("service")
            .withColumnRenamed("page_ym", "ym")
            .hint("rebalance", "ym")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("header", "true")
            .option("encoding", "UTF-8")
            .partitionBy("ym")
            .csv(f"{path}/{datasets[service]}")
        )
        held = records.groupBy("service", F.col("page_ym").alias("ym")).agg(F.count("*").alias("n_held"), _checksum(names).alias("checksum"))
        sums = held if sums is None else sums.unionByName(held)
    _append_log(spark, path, status, sums, {s: datasets[s] for s in columns})
    return status


def _append_log(spark: SparkSession, path: str, status: DataFrame, sums: DataFrame | None, datasets: Mapping[str, str]) -> None:
    """One more attempt of each month of ``status``. All tables have a row per service and month."""
    before = landing_log(spark, path).groupBy("service", "ym").agg(F.max("attempt").alias("last"))
    of = F.lit(None).cast("string")
    for service, dataset in datasets.items():
        of = F.when(F.col("service") == service, dataset).otherwise(of)
    log = status.withColumn("dataset", of).join(before, ["service", "ym"], "left")
    if sums is None:
        log = log.withColumns({"checksum": F.lit(None), "n_files": F.lit(None), "n_bytes": F.lit(None)})
    else:
        log = log.join(sums, ["service", "ym"], "left").join(_landed_files(spark, path), ["dataset", "ym"], "left")
        log = log.withColumns({c: F.when(F.col("n_held").isNotNull(), F.col(c)) for c in ("checksum", "n_files", "n_bytes")})
    log = log.withColumns({"attempt": F.coalesce("last", F.lit(0)) + 1, "landed_at": F.current_timestamp()})
    typed = [part.strip().split(" ") for part in LANDING_LOG.replace("(38,0)", "(38;0)").split(",")]
    out = log.select(*[F.col(name).cast(kind.replace(";", ",")).alias(name) for name, kind in typed])
    # Staged first, as the log that is read is also written.
    stage_table(out, "landing-log").coalesce(1).write.mode("append").parquet(f"{path}/{LOG_FOLDER}")


def _landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, ym, n_files, n_bytes) from the names and sizes of the landed files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select(
            F.regexp_extract("path", r"/([^/]+)/ym=[^/]+/[^/]+$", 1).alias("dataset"),
            F.regexp_extract("path", r"/ym=([^/]+)/[^/]+$", 1).alias("ym"),
            "length",
        )
    )
    return files.groupBy("dataset", "ym").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def reconciled(spark: SparkSession, path: str) -> DataFrame:
    """Landed months against the log: (dataset, ym, n_rows, n_files, mb, state), with a total.

    ``state``: ``as logged`` if the folder has the files and bytes of the log, ``altered`` if not, ``gone`` if
    it has none, ``not logged`` for a folder that no attempt has landed. Reads file sizes only.
    """
    log = landed_months(spark, path).select(
        F.col("dataset").alias("d"), F.col("ym").alias("m"), "n_rows", F.col("n_files").alias("f"), F.col("n_bytes").alias("b")
    )
    files = _landed_files(spark, path)
    both = files.join(log, (F.col("dataset") == F.col("d")) & (F.col("ym") == F.col("m")), "full")
    state = (
        F.when(F.col("d").isNull(), "not logged").when(F.col("dataset").isNull(), "gone")
        .when((F.col("n_files") == F.col("f")) & (F.col("n_bytes") == F.col("b")), "as logged").otherwise("altered")
    )
    months = both.select(
        F.coalesce("dataset", "d").alias("dataset"), F.coalesce("ym", "m").alias("ym"), "n_rows", "n_files", "n_bytes", state.alias("state")
    )
    worst = F.when(F.count_if(F.col("state") != "as logged") > 0, "altered").otherwise("as logged")
    total = months.agg(
        F.lit("total").alias("dataset"), F.lit(None).cast("string").alias("ym"), F.sum("n_rows").alias("n_rows"), F.sum("n_files").alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"), worst.alias("state"),
    )
    return months.unionByName(total).select("dataset", "ym", "n_rows", "n_files", (F.col("n_bytes") / F.lit(float(MB))).alias("mb"), "state")


def damaged_months(spark: SparkSession, path: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Landed months whose files, read again, hold other records than the log says: rows and checksum of both."""
    found = None
    for service, names in columns.items():
        log = landed_months(spark, path).where(F.col("service") == service).select(
            "service", "dataset", "ym", "n_rows", F.col("checksum").alias("logged")
        )
        first = log.select("dataset").first()
        if first is None:
            continue
        schema = ", ".join([*[f"`{c}` string" for c in names], "ym string"])
        records = spark.read.schema(schema).option("header", "true").option("encoding", "UTF-8").csv(f"{path}/{first.dataset}")
        held = records.groupBy("ym").agg(F.count("*").alias("n_found"), _checksum(names).alias("checksum"))
        wrong = log.join(held, "ym", "left").where(
            ~(F.col("n_found").eqNullSafe(F.col("n_rows")) & F.col("checksum").eqNullSafe(F.col("logged")))
        ).select("service", "ym", "n_rows", F.coalesce("n_found", F.lit(0)).alias("n_found"))
        found = wrong if found is None else found.unionByName(wrong)
    return found if found is not None else spark.createDataFrame([], "service string, ym string, n_rows bigint, n_found bigint")


def landed_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Landed files and megabytes per dataset and month, with a total. Reads file sizes only."""
    sizes = _landed_files(spark, path).rollup("dataset", "ym").agg(
        F.sum("n_files").alias("n_files"), (F.sum("n_bytes") / F.lit(float(MB))).alias("mb"), F.grouping_id().alias("_level")
    )
    return (
        sizes.where(F.col("_level").isin(0, 3))
        .select(F.coalesce("dataset", F.lit("total")).alias("dataset"), "ym", "n_files", "mb")
        .orderBy(F.col("dataset") == "total", "dataset", "ym")
    )
