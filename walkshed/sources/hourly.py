"""The hourly table on Parquet, one folder per year and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkshed.operators.reshape import explode_hours
from walkshed.schema import ModeSpec

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MONTHS_AT_ONCE = 16


def table_schema(spec: ModeSpec) -> T.StructType:
    """Columns of the hourly table: the raw text columns, hour and counts, year and month."""
    numbers = {"hr": T.IntegerType(), "on_cnt": T.LongType(), "off_cnt": T.LongType(), "year": T.IntegerType(), "month": T.IntegerType()}
    texts = {name: T.StringType() for name in spec.raw_columns.values()}
    return T.StructType([T.StructField(name, kind) for name, kind in (texts | numbers).items()])


def write_hourly(
    packed: DataFrame, path: str, spec: ModeSpec, only_given_months: bool = False, official_names: bool = False
) -> None:
    """Write packed records as the hourly table, partitioned by year and month.

    The rebalance hint lets Spark split a big month over many tasks and pack small ones
    together, by measured size; it and the sort by place come before the hours are spread out, so 24
    times fewer rows are shuffled and sorted. As a task can hold several small months, it keeps a
    file open for each; beyond ``MONTHS_AT_ONCE`` Spark sorts the rest. The place column's
    statistics prune row groups. ``only_given_months`` replaces just the months present in
    ``packed``; otherwise the whole table is replaced.
    """
    spark = packed.sparkSession
    sorted_records = packed.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", spec.place)
    out = explode_hours(sorted_records)
    out = out.select(
        *[F.col(f.name).cast(f.dataType) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in table_schema(spec)]
    )
    partition = ["year", "month"]
    if official_names:
        out = to_official_names(out, spec)
        partition = [spec.official_names[c] for c in partition]
    before = spark.conf.get(OPEN_FILES, "0")
    spark.conf.set(OPEN_FILES, str(MONTHS_AT_ONCE))
    try:
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if only_given_months else "static")
            .partitionBy(*partition)
            .parquet(path)
        )
    finally:
        spark.conf.set(OPEN_FILES, before)


def months(columns: list[str], spec: ModeSpec) -> list[str]:
    """The names of year and month in a table that has our or the official column names."""
    return [spec.official_names[c] if spec.official_names[c] in columns else c for c in ("year", "month")]


def read_hourly(
    spark: SparkSession,
    path: str,
    spec: ModeSpec,
    first_ym: int | None = None,
    last_ym: int | None = None,
) -> DataFrame:
    """Read an hourly table, in our column names; a period skips the other months' folders.

    The schema is the declared one, whatever months were written with: a column that a month
    lacks is NULL there.
    """
    schema = table_schema(spec)
    if spec.official_names["year"] in spark.read.parquet(path).columns:
        schema = T.StructType([T.StructField(spec.official_names[f.name], f.dataType) for f in schema])
    df = from_official_names(spark.read.schema(schema).parquet(path), spec)
    ym = F.col("year") * 100 + F.col("month")
    if first_ym is not None:
        df = df.where(ym >= first_ym)
    if last_ym is not None:
        df = df.where(ym <= last_ym)
    return df


def to_official_names(df: DataFrame, spec: ModeSpec) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in spec.official_names.items() if k in df.columns})


def from_official_names(df: DataFrame, spec: ModeSpec) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in spec.official_names.items() if v in df.columns})
