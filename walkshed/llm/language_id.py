"""Language of texts by string kernels: Nyström landmarks and one-versus-rest kernel ridge.

The kernel of two texts is the number of n-grams of one to three characters, of all these
lengths together, that are present in both, over the geometric mean of the numbers in each.
N-grams are of lower-cased letters with one space between words, and are known by a
hash to ``2**bits`` places. Presence over the landmarks spans the space in which a ridge
regression is fitted for each language against the rest; texts are scored in blocks, by the product
of their presence matrix with the landmarks' and that of the kernel with the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import crc32_text, map_texts, pieces, stage

BITS = 14
#: The most rows to train on: of one language, and of all.
MAX_PER_LANGUAGE, MAX_ROWS = 400, 8_000
LANDMARKS = 32
RIDGE = 1e-2
UNKNOWN = "und"

_FACTORS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_ASCII_LETTER = np.array([97 <= c <= 122 for c in range(128)])


def presence(text: str | None, out: np.ndarray, bits: int = BITS) -> None:
    """Set the places of ``out`` whose n-grams are in the text."""
    shift = np.uint32(32 - bits)
    for piece in pieces(text or ""):
        codes = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.where(codes < 128, _ASCII_LETTER[np.minimum(codes, 127)], codes >= 170)
        codes = np.concatenate(([32], np.where(letter, codes, 32), [32])).astype(np.uint32)
        codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]
        if len(codes) < 3:
            continue
        one, two, three = (codes[i : len(codes) - 2 + i] for i in range(3))
        h = one * _FACTORS[0]
        out[h >> shift] = 1
        h = (h ^ two) * _FACTORS[1]
        out[h >> shift] = 1
        h = (h ^ three) * _FACTORS[2]
        out[h >> shift] = 1


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Model:
    """Landmarks as packed presence, and per language the weights over the kernel and a constant."""

    bits: int
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        rows = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return np.ascontiguousarray(rows.T), np.sqrt(rows.sum(axis=1))

    def margins(self, present: np.ndarray, matrix: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        kernel = _kernel(present, *matrix)
        return np.hstack((kernel, np.ones((len(kernel), 1), np.float32))) @ self.weights


def _kernel(present: np.ndarray, columns: np.ndarray, roots: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(present.sum(axis=1), 1))
    return (present @ columns) / np.maximum(np.outer(own, roots), 1)


def fit(languages: list[str], of_row: np.ndarray, packed: np.ndarray, bits: int = BITS, landmarks: int = LANDMARKS) -> Model:
    """A model from packed presence rows, ``of_row`` being each row's place in ``languages``."""
    chosen = np.concatenate([np.flatnonzero(of_row == k)[:landmarks] for k in range(len(languages))])
    rows = np.unpackbits(packed, axis=1).astype(np.float32)
    marks = np.ascontiguousarray(rows[chosen].T), np.sqrt(rows[chosen].sum(axis=1))
    among, kernel = _kernel(rows[chosen], *marks).astype(np.float64), _kernel(rows, *marks).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    keep = values > 1e-6 * max(values.max(), 1e-6)
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.hstack((kernel @ root, np.ones((len(rows), 1))))
    wanted = np.where(of_row[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = 1 / np.bincount(of_row, minlength=len(languages))[of_row]  # languages weigh alike
    scaled = mapped * share[:, None]
    ridge = RIDGE / len(languages) * np.eye(mapped.shape[1])
    weights = np.linalg.solve(scaled.T @ mapped + ridge, scaled.T @ wanted)
    folded = np.vstack((root @ weights[:-1], weights[-1:]))
    return Model(bits, languages, packed[chosen], folded.astype(np.float32))


def _sample(rows: DataFrame, max_per_language: int, max_rows: int, bits: int) -> list:
    """(lang, packed presence) of a bounded sample: of each language the first ones by hash."""
    counts = stage(rows.groupBy("lang").count(), "languages")
    n = counts.count()
    limit = max(1, min(max_per_language, max_rows // max(n, 1)))
    unit = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Staged, Spark knows the size: a small table is broadcast and the texts stay where they are.
    share = stage(counts.select(F.col("lang").alias("of"), (F.lit(1.5 * limit + 20) / F.col("count")).alias("share")), "shares")
    drawn = rows.join(share, rows["lang"] == share["of"]).withColumn("unit", unit).where("unit <= share")

    def work():
        def pack(texts):
            out = []
            for text in texts:
                row = np.zeros(1 << bits, np.uint8)
                presence(text, row, bits)
                out.append(np.packbits(row).tobytes() if has_letter(text) else None)
            return [pa.array(out, pa.binary())]

        return pack

    packed = map_texts(drawn, ["lang", "unit", "id"], "text", "packed binary", work).where("packed is not null")
    first = Window.partitionBy("lang").orderBy("unit", "id", "packed")  # over about 1.5 times the bound
    kept = packed.withColumn("place", F.row_number().over(first)).where(F.col("place") <= limit)
    return kept.orderBy("lang", "place").select("lang", "packed").limit(max_rows).collect()


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = BITS,
    max_per_language: int = MAX_PER_LANGUAGE,
    max_rows: int = MAX_ROWS,
) -> Model | None:
    """A model from the rows of ``docs`` with a language and letters; None without any.

    Trains on at most ``max_per_language`` rows of each language and ``max_rows`` in all; only their
    packed presence (2 kB a row) comes to the driver.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    sample = _sample(rows, max_per_language, max_rows, bits)
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    of_row = np.array([languages.index(r["lang"]) for r in sample])
    packed = np.stack([np.frombuffer(r["packed"], np.uint8) for r in sample])
    return fit(languages, of_row, packed, bits)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the language of every row's whole text, and from 0 to 1 how sure.

    ``und`` with score 0 for null texts and texts without a letter, and if there is no model. The
    score maps the best margin from -1, 1 to 0, 1. Repeated rows each return a row.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def work():
        own = Model(**held.value) if held.value else None
        matrix = own.matrix() if own else None

        def judge(texts):
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if own and has_letter(t)]
            if known:
                present = np.zeros((len(known), 1 << own.bits), np.float32)
                for row, i in zip(present, known):
                    presence(texts[i], row, own.bits)
                margins = own.margins(present, matrix)
                for i, best, margin in zip(known, margins.argmax(axis=1), margins.max(axis=1)):
                    names[i], scores[i] = own.languages[best], float(min(1.0, max(0.0, (1 + margin) / 2)))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return judge

    return map_texts(docs, [id_col], text_col, "lang_pred string, score double", work).toDF("id", "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text is 1 modulo 3."""
    return crc32_text(id_col) % 3 == 1


def train_and_predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row, learned from rows that are not held out."""
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    found = predict(docs, model, id_col, text_col)
    return found.select("id", held_out("id").alias("held_out"), "lang_pred", "score")


def of_known_language(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows that have no language or a score under ``min_score``."""
    marked = docs.withColumn("row__", F.struct(F.col(id_col), F.xxhash64(text_col)))
    gone = predict(marked, model, "row__", text_col).where(
        (F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score)
    )
    gone = stage(gone.select("id").distinct(), "rejected")
    return marked.join(gone, marked["row__"].eqNullSafe(gone["id"]), "left_anti").drop("row__")
