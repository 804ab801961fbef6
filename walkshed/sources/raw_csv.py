"""Scans of the raw CSV tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkshed.schema import STATION_MASTER, STOP_MASTER

_FOLDER = r"^(.*)/[^/]*$"
#: Bytes of a file read at a time until its first line ends.
HEADER_BYTES = 16 * 1024
#: Files whose first lines one task reads.
FILES_PER_TASK = 256


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", "true").option("encoding", "UTF-8")


def first_line(path: str) -> tuple[str | None, int]:
    """The first line of a file, None if it is empty, and the bytes read for it.

    Opens what pyarrow can open, compressed files too; raises for other stores.
    """
    # URLs of local files come with one slash; pyarrow wants none or three.
    filesystem, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
    with filesystem.open_input_stream(inner, compression="detect", buffer_size=None) as stream:
        held, n_bytes = b"", 0
        while b"\n" not in held:
            more = stream.read(HEADER_BYTES)
            if not more:
                break
            held += more
            n_bytes += len(more)
    return (held.split(b"\n", 1)[0].removesuffix(b"\r").decode("utf-8", "replace") if held else None), n_bytes


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, length) of all files under ``path``. Lists names, reads no content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("file"), "length")


def header_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(folder, file, header, n_bytes) of every file that is not empty.

    A task opens its files one by one and reads each to the end of its first line, so the bytes read
    grow with the number of files, not with their size. A file in a store that only Spark's readers
    can open has no header here and ``n_bytes`` null.
    """
    files = _listing(spark, path).where("length > 0")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, FILES_PER_TASK):
                part, found = batch.slice(start, FILES_PER_TASK), []
                for file in part.column(0).to_pylist():
                    try:
                        found.append(first_line(file))
                    except (OSError, ValueError, NotImplementedError):
                        found.append((None, None))
                headers, sizes = zip(*found)
                arrays = [part.column(0), pa.array(headers, pa.string()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "header", "n_bytes"])

    lines = files.select("file").mapInArrow(read, "file string, header string, n_bytes bigint")
    return lines.where("header is not null or n_bytes is null").select(
        F.regexp_extract("file", _FOLDER, 1).alias("folder"), "file", "header", "n_bytes"
    )


def _one_of_each_folder(spark: SparkSession, path: str | list[str]) -> list[str]:
    """One file of each folder. Lists names, reads no content."""
    per_folder = _listing(spark, path).where("length > 0").groupBy(F.regexp_extract("file", _FOLDER, 1)).agg(F.min("file").alias("file"))
    return [row.file for row in per_folder.collect()]


def scan_wide(
    spark: SparkSession, path: str | list[str], one_header_per: str = "file"
) -> DataFrame:
    """All files under ``path`` as text columns, matched by header name.

    A single CSV scan would map every file by the position of one file's columns.
    Files are grouped by their header instead, one scan per distinct header, and the
    scans are united by name; a column some files lack is NULL there. Headers are
    checked again while reading, so a differing file fails rather than being misread.

    One distributed job reads the first line of every file and no more, and the driver gets the distinct
    headers of each folder. Where all agree, the scan is of ``path`` itself; else of folders, and
    of single files only in folders whose files differ and for patterns with wildcards.

    ``one_header_per="folder"`` reads one header per folder, for folders written by one
    job; it keeps the number of tasks of that job at the number of months.
    """
    if one_header_per not in ("file", "folder"):
        raise ValueError("one_header_per is 'file' or 'folder'")
    by_folder = one_header_per == "folder"
    sample = _one_of_each_folder(spark, path) if by_folder else path
    lines = header_lines(spark, sample) if sample else None
    # Files without a header here are told apart by their name.
    known = lines and lines.withColumn("header", F.coalesce("header", F.concat(F.lit("\n"), "file")))
    found = known and known.groupBy("folder", "header").agg(F.min("file").alias("file")).collect()
    if not found:
        raise FileNotFoundError(f"no raw files under {path}")
    example = {row.header: row.file for row in found}
    columns = {header: tuple(_reader(spark).csv(file).columns) for header, file in example.items()}
    by_columns: dict[tuple[str, ...], list[str]] = defaultdict(list)

    if len(set(columns.values())) == 1:
        scanned = [path] if isinstance(path, str) else list(path)
        by_columns[next(iter(columns.values()))] = scanned
    else:
        folders = Counter(row.folder for row in found)
        wildcards = not by_folder and re.search(r"[*?\[{]", path if isinstance(path, str) else " ".join(path))
        single = [
            folder for folder, n_headers in folders.items()
            if wildcards or n_headers > 1 or any(other.startswith(f"{folder}/") for other in folders)
        ]
        for row in found:
            if row.folder not in single:
                by_columns[columns[row.header]].append(row.folder)
        if single:
            for row in known.where(F.col("folder").isin(single)).collect():
                by_columns[columns[row.header]].append(row.file)
    scans = [
        _reader(spark)
        .schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .csv(sorted(set(paths)))
        for header, paths in sorted(by_columns.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan_master(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    return _reader(spark).schema(schema).option("enforceSchema", "false").csv(path)


def scan_stop_master(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Bus stop coordinates, ids as text."""
    return _scan_master(spark, path, STOP_MASTER)


def scan_station_master(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Station coordinates, ids as text."""
    return _scan_master(spark, path, STATION_MASTER)
