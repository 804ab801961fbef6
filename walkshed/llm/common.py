"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walkshed.session import delete_folder, new_folder, stage_table

#: The characters that separate words and are stripped from lines: space and U+0009 to U+000D.
WHITE = " \t\n\u000b\f\r"

#: Rows turned into Python objects at a time.
ROWS_AT_ONCE = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where ``stage`` writes inside ``scratch``, innermost last.
_FOLDERS: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end, so nothing lazy may be left of them."""
    folder = new_folder(spark, "scratch")
    _FOLDERS.append(folder)
    try:
        yield
    finally:
        _FOLDERS.remove(folder)
        delete_folder(spark, folder)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs start from files, which cuts the lineage and tells Spark the size of the
    table, so that a join broadcasts it only below Spark's own threshold.
    """
    folder = _FOLDERS[-1] if _FOLDERS else None
    return stage_table(df, f"{name}-{uuid4().hex}" if folder else name, folder, partition_by)


def row_salt() -> Column:
    """A hash of a row's place in its table, which tells apart rows that are alike in all else."""
    return F.xxhash64(F.monotonically_increasing_id())


def crc32_text(column: str | Column) -> Column:
    """crc32 of a value's text form; null counts as empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")))


def map_texts(
    df: DataFrame, keep: list[str], text: str, schema: str, work: Callable[[], Callable[[list], list[pa.Array]]]
) -> DataFrame:
    """One output row per input row: the columns ``keep``, then what ``work`` makes of the text.

    ``work`` is called once per task and returns a function from a list of texts (None for
    null) to the new columns. Only a slice of a batch exists as Python objects at a time.
    """
    source = df.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("text__"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = work()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                made = function(part.column(len(keep)).to_pylist())
                kept = [part.column(i) for i in range(len(keep))]
                names = [*part.schema.names[: len(keep)], *[f"made{i}" for i in range(len(made))]]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return source.mapInArrow(run, ", ".join([*fields, schema]))


def pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut before white space.

    Bounds the memory that the words of one very long text take. No word is cut, so a piece
    can be longer if a word is.
    """
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(c, start + 1, start + size) for c in WHITE)
        if cut < 0:
            cut = min((at for c in WHITE if (at := text.find(c, start + size)) >= 0), default=len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]
