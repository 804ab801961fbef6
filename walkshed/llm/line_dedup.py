"""Repeated lines across documents, kept as levelled sorted runs of line hashes.

A run is a Parquet table sorted by line hash: in how many documents a line occurs, and the
largest id of these. Every batch of documents is merge-anti-joined with the runs: the lines no run has
become a run at level 0, counts of the others an update. When a level holds
``fanout`` runs, they are merged into one run of the next level, so each hash is rewritten
once per level and the number of runs grows with the logarithm of the number of batches.

Lines are known by two 64-bit hashes of their key, never by text.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walkshed.llm.common import WHITE, stage
from walkshed.session import delete_folder, new_folder

HASH = ["h1", "h2"]
MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 4, 4
DOCS_PER_BATCH = 1 << 28
RUN = "h1 bigint, h2 bigint, n_docs bigint, last_id bigint"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)  # there lower() touches A-Z alone
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text_hash, pos, h1, h2) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"),
    ).where(F.char_length("line") >= min_chars)  # a key is never longer than its line
    keyed = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


@dataclass
class LineRuns:
    """Runs of line hashes, by level. Every document has to come in one batch only.

    ``levels`` holds the lines of each batch that no run had before, so a hash is in one run only;
    ``updates`` holds, levelled alike, what later batches have of lines that a run had. Runs that were
    merged into one are deleted, so a plan over ``table`` is good until the next ``add``.
    """

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)
    updates: list[list[str]] = field(default_factory=list)

    def _write(self, run: DataFrame) -> str:
        path = new_folder(self.spark, "line-run")
        run.sortWithinPartitions(*HASH).write.parquet(path)
        return path

    def _read(self, *levels: list[list[str]]) -> DataFrame:
        paths = [path for kind in levels for level in kind for path in level]
        if not paths:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*paths)

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))

    def _push(self, levels: list[list[str]], run: DataFrame) -> None:
        """Write a run of level 0, then compact full levels."""
        path, level = self._write(run), 0
        while True:
            if level == len(levels):
                levels.append([])
            levels[level].append(path)
            if len(levels[level]) < self.fanout:
                return
            path = self._write(self._merged(self._read([levels[level]])))
            for merged in levels[level]:
                delete_folder(self.spark, merged)
            levels[level] = []
            level += 1

    def add(self, lines: DataFrame) -> None:
        """Merge-anti-join the lines (id, h1, h2) of a batch with the runs: new ones become a run, others an update."""
        of_documents = lines.select("id", *HASH).distinct()  # then combined again, so that no line is hot
        summed = of_documents.groupBy(*HASH).agg(F.count("id").alias("n_docs"), F.max("id").alias("last_id"))
        if not self.levels:
            self._push(self.levels, summed)
            return
        path = self._write(summed)
        batch = self._read([[path]])
        known = batch.join(self._read(self.levels).select(*HASH).hint("merge"), HASH, "left_semi")
        new = self.unseen(batch)
        self._push(self.updates, known)
        self._push(self.levels, new)
        delete_folder(self.spark, path)

    def table(self) -> DataFrame:
        """(h1, h2, n_docs, last_id) over all runs and updates."""
        return self._merged(self._read(self.levels, self.updates))

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines of a batch that no run has: a sorted merge anti-join by hash."""
        return lines.join(self._read(self.levels).select(*HASH).hint("merge"), HASH, "left_anti")


def batch_of(batches: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")


def add_batches(lines: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, batch: Column | None = None) -> LineRuns:
    """Runs over lines, dealt to batches by document id, or by a column that says so."""
    runs = LineRuns(lines.sparkSession, fanout)
    for number in range(batches):
        runs.add(lines.where((batch_of(batches) if batch is None else batch) == number))
    return runs


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int | None = None,
) -> DataFrame:
    """(id, n_lines, n_dropped, kept): every row's text without lines that many documents repeat.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents (ids) stays only in the document with the largest id. Other lines stay, joined
    by line feeds. Null and empty texts have one empty line, kept as empty text. Rows without an
    id count for no line and lose every line found often enough. Repeated rows with one id
    count as one document and each return a row. An empty table gives none. Documents come in batches of up to about
    ``DOCS_PER_BATCH``, at least ``BATCHES``; the number of batches changes no result.
    """
    batches = batches or max(BATCHES, -(-docs.count() // DOCS_PER_BATCH))
    hashed = hashed_lines(docs, id_col, text_col, min_chars).withColumn("batch", batch_of(batches))
    lines = stage(hashed, "lines", ["batch"])
    often = add_batches(lines, batches, batch=F.col("batch")).table().where(F.col("n_docs") >= min_docs)
    found = lines.join(often.select(*HASH, "last_id"), HASH).where(~F.col("id").eqNullSafe(F.col("last_id")))
    dropped = found.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("dropped"))
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash"))
    every = rows.join(dropped, same, "left").select("row_id", split_lines(F.col("text")).alias("lines"), "dropped")
    positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(positions, lambda i: F.get("lines", i)), "\n")
    )
    return every.select(
        F.col("row_id").alias("id"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        kept.alias("kept"),
    )
