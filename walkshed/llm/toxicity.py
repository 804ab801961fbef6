"""Toxicity scores by FTRL-proximal logistic regression over hashed words and word pairs.

A text's features are its distinct words, pairs of neighbours, and pairs with one word between
them, hashed to ``2**bits`` places. Each place has a learning rate of its own, and the L1 term
keeps weights at zero until enough evidence comes, so that the weights that are not
zero make a small table to broadcast.

Training runs on a bounded sample of the labelled rows. The sample is dealt to shards; in
every round each shard goes on from the same state over its rows, and the states are averaged.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import crc32_text, map_texts, pieces, stage

BITS = 20
#: The most labelled rows of each class to train on.
MAX_PER_CLASS = 12_000
SHARD_ROWS, MAX_SHARDS, ROUNDS = 8_000, 3, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.3
#: Missing a row of class 1 counts as this many wrong marks, in learning and at the cut of one half.
CLASS_1_COST = 2.0

_LETTERS = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
_WORD, _PAIR, _SKIP, _SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def features(text: str | None, bits: int = BITS) -> Iterator[np.ndarray]:
    """Hashed places of the words, pairs and skip pairs of a text, piece by piece, with repeats."""
    shift, carried = np.uint64(64 - bits), np.zeros(0, np.uint64)
    for piece in pieces(text or ""):
        found = piece.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
        new = np.fromiter(map(zlib.crc32, found), np.uint64, len(found))
        h = np.concatenate((carried, new))
        start = len(carried)
        yield np.concatenate((
            new * _WORD >> shift,
            (h[:-1] * _PAIR + h[1:] * _SECOND)[max(0, start - 1):] * _WORD >> shift,
            (h[:-2] * _SKIP + h[2:] * _SECOND)[max(0, start - 2):] * _PAIR >> shift,
        )).astype(np.int64)
        carried = h[-2:]


def distinct_features(text: str | None, bits: int = BITS) -> np.ndarray:
    return np.unique(np.concatenate([*features(text, bits)])).astype(np.int32)


@dataclass
class State:
    """FTRL sums of gradients (z) and of squared gradients (n); the last place is the bias."""

    z: np.ndarray
    n: np.ndarray

    @staticmethod
    def new(bits: int) -> State:
        return State(np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) > L1, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step for a row with the distinct places ``at``."""
        w, n = self.weights(at), self.n[at]
        g = (_sigmoid(float(w.sum())) - label) * (CLASS_1_COST if label else 1.0)
        rate = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


@dataclass(frozen=True)
class Model:
    """Places with a weight, their weights, and the bias."""

    bits: int
    places: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.places] = self.weights
        return table

    def score(self, text: str | None, table: np.ndarray) -> float:
        weighted = [f[table[f] != 0] for f in features(text, self.bits)]
        return _sigmoid(self.bias + float(table[np.unique(np.concatenate(weighted))].sum(dtype=np.float64)))


def _sample(labels: DataFrame, id_col: str, label_col: str, max_per_class: int) -> DataFrame:
    """At most ``max_per_class`` (id, label) of each class, the first ones by hash of the id."""
    once = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    once = stage(once.groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("int").alias("label")), "labels")
    counts = {r["label"]: r["count"] for r in once.groupBy("label").count().collect()}
    unit = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("label") == 1, min(1.0, 1.2 * max_per_class / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, 1.2 * max_per_class / max(1, counts.get(0, 0)))
    )
    first = Window.partitionBy("label").orderBy("unit", "label_id")  # over about 1.2 times the bound
    drawn = once.withColumn("unit", unit).where(F.col("unit") <= share)
    kept = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max_per_class)
    return stage(kept.select("label_id", "label", "unit"), "label-sample")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    bits: int = BITS,
    max_per_class: int = MAX_PER_CLASS,
) -> Model:
    """A model of ``label_col`` (1 or else) from labelled rows of ``docs``.

    Labels given twice count once, as 1 if any is. Without rows of both classes the score is the
    share of class 1 for every text, a half without any rows.
    """
    labels = labels.select(id_col, (F.col(label_col) == 1).cast("int").alias("label"))
    sample = _sample(labels, id_col, "label", max_per_class)
    # The sample is bounded by a parameter: some 200 kB of ids for the default.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id")
    )
    # Dealt once, before the features are made: every round reads the shards' files as they are.
    shards = max(1, min(MAX_SHARDS, sample.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards))
    dealt = rows.repartition(shards, shard).sortWithinPartitions("unit", "id")

    def work():
        return lambda texts: [pa.array([distinct_features(t, bits) for t in texts], pa.list_(pa.int32()))]

    rows = stage(map_texts(dealt, ["label"], "text", "places array<int>", work), "toxic-sample")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, others = counts.get(1, 0), counts.get(0, 0)
    if not ones or not others:
        rate = (ones + 0.5) / (ones + others + 1)
        return Model(bits, np.zeros(0, np.int64), np.zeros(0, np.float32), math.log(rate / (1 - rate)))
    state = State.new(bits)
    for _ in range(ROUNDS):
        state = _round(rows, state, bits)
    weights = state.weights(slice(None)).astype(np.float32)
    places = np.flatnonzero(weights[:-1])
    # Classes are sampled at different rates; the bias goes back to the rates of the labels.
    given = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    shift = math.log(CLASS_1_COST * max(given.get(1, 0), 1) / max(given.get(0, 0), 1)) - math.log(ones / others)
    return Model(bits, places, weights[places], float(weights[-1]) + shift)


def _round(rows: DataFrame, state: State, bits: int) -> State:
    """Every shard learns from its rows, starting at ``state``; the mean of what they reach."""
    held = rows.sparkSession.sparkContext.broadcast((state.z.astype(np.float32), state.n.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bias, seen = State(*(x.astype(np.float64) for x in held.value)), np.array([1 << bits]), 0
        for batch in batches:
            for places, label in zip(batch.column("places"), batch.column("label").to_pylist()):
                own.learn(np.concatenate((places.values.to_numpy(zero_copy_only=False), bias)), label)
                seen += 1
        if seen:
            data = [[x.astype(np.float32).tobytes()] for x in (own.z, own.n)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in data], names=["z", "n"])

    found = rows.select("places", "label").mapInArrow(run, "z binary, n binary").collect()  # one row a shard
    held.unpersist()
    return State(*(np.mean([np.frombuffer(r[c], np.float32) for r in found], axis=0, dtype=np.float64) for c in ("z", "n")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): from 0 to 1 for every row's whole text, higher for class 1.

    Null and empty texts have the score of a text without features. Repeated rows each return a row.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def work():
        own = Model(**held.value)
        table = own.table()
        return lambda texts: [pa.array([own.score(t, table) for t in texts], pa.float64())]

    return map_texts(docs, [id_col], text_col, "score double", work).toDF("id", "score")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text is divisible by 5."""
    return crc32_text(id_col) % 5 == 0


def train_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score) of every row, learned from labels of rows that are not held out."""
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col)
    return score(docs, model, id_col, text_col).select("id", held_out("id").alias("held_out"), "score")
