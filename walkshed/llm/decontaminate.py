"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are normalised to words of digits, a-z and characters beyond ASCII, A-Z being
lower-cased, joined by single spaces. Every window of n consecutive words of an item is a
pattern, with a space at both ends so that it starts and ends at words. One pass over a
normalised document finds all windows; their places are mapped to words, and for spans
to offsets in the original text.

The benchmark is a stated list, not part of the corpus. Its words are counted first;
beyond ``ITEM_CHARS`` the items are dealt to several automata, so that each task
holds one of bounded size at a time, and each block of items is one more pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.llm.common import ROWS_AT_ONCE, stage

WINDOW = 10
#: Characters of benchmark texts in one automaton.
ITEM_CHARS = 4_000_000

#: Byte by byte: A-Z to a-z, other ASCII that is no word character to a space, the rest as it is.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: The same words in an original text, A-Z included.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, in order; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(item: str | None, window: int = WINDOW) -> set[bytes]:
    """All runs of ``window`` words; an item of fewer words, but not none, is one run."""
    found = words(item)
    return {b" ".join(found[i : i + window]) for i in range(max(1, len(found) - window + 1))} if found else set()


class Automaton:
    """Finds the windows of items in texts."""

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        owners: dict[bytes, list] = {}
        for item_id, text in items:
            for run in windows(text, window):
                owners.setdefault(run, []).append(item_id)
        self.owners = list(owners.values())
        self.automaton = ahocorasick.Automaton()
        for at, run in enumerate(owners):
            # Bytes as characters: offsets are bytes, and a word boundary is a space.
            self.automaton.add_word(f" {run.decode('latin-1')} ", (at, run.count(b" ") + 1, len(run) + 2))
        if owners:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, which of them are hit, and the items found."""
        found = words(text)
        hit, items = np.zeros(len(found), bool), set()
        if found and self.owners:
            joined = f" {b' '.join(found).decode('latin-1')} "
            starts = None
            for last, (at, n_words, length) in self.automaton.iter(joined):
                if starts is None:  # only texts with a hit need the places of their words
                    starts = np.cumsum([1, *[len(w) + 1 for w in found]])
                first = int(np.searchsorted(starts, last - length + 2))
                hit[first : first + n_words] = True
                items.update(self.owners[at])
        return len(found), hit, items


def spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as offsets (code points) in the original text."""
    if not hit.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    firsts, lasts = set(edges[::2].tolist()), set((edges[1::2] - 1).tolist())
    out = []
    for at, word in enumerate(_WORD.finditer(text)):
        if at in firsts:
            out.append({"start": word.start(), "end": word.end()})
        if at in lasts:
            out[-1]["end"] = word.end()
    return out


def _blocks(benchmark: DataFrame, item_id: str, text_col: str, item_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``item_chars`` characters, one block at a time on the driver."""
    chars = benchmark.agg(F.sum(F.char_length(text_col))).first()[0] or 0
    n = max(1, -(-chars // item_chars))
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_id), F.col(text_col)).distinct()
    dealt = F.pmod(F.xxhash64(item_id), F.lit(n))
    for block in range(n):
        yield [tuple(r) for r in rows.where(dealt == block).collect()]


def _pass(rows: DataFrame, block: list[tuple], kind: str, window: int, last: bool) -> DataFrame:
    """One scan of rows (id, text, hit, items): with the block's finds added, or as the result."""
    held = rows.sparkSession.sparkContext.broadcast(block)
    ids = pa.list_(pa.int64() if kind == "bigint" else pa.string())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(held.value, window)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                n_words, hits, found, places = [], [], [], []
                for text, before, items in zip(*(part.column(c).to_pylist() for c in ("text", "hit", "items"))):
                    n, hit, owners = automaton.search(text)
                    if before:
                        hit |= np.unpackbits(np.frombuffer(before, np.uint8), count=n).view(bool)
                    n_words.append(n)
                    found.append(sorted(owners.union(items)))
                    if last:
                        hits.append(int(hit.sum()))
                        places.append(spans(text, hit) if hits[-1] else [])
                    else:
                        hits.append(np.packbits(hit).tobytes())
                made = [pa.array(found, ids)]
                if last:
                    made += [pa.array(n_words, pa.int64()), pa.array(hits, pa.int64()), pa.array(places, span)]
                    names = ["id", "items", "n_words", "n_hit", "spans"]
                else:
                    made += [part.column("text"), pa.array(hits, pa.binary())]
                    names = ["id", "items", "text", "hit"]
                yield pa.RecordBatch.from_arrays([part.column("id"), *made], names=names)

    made = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>" if last else "text string, hit binary"
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, items array<{kind}>, {made}")


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """(id, items, n_words, n_hit, spans): the benchmark passages in every row's whole text.

    ``items`` are the sorted ids of items with a window in the text, ``spans`` the original offsets
    (code points) of hit words, neighbours joined. Null texts have no words; null and
    empty items no windows; items without an id are left out. Items repeated or equal are each
    reported by id. An empty benchmark finds nothing. Repeated rows each return a row. If the
    benchmark needs several automata, all but the last write the rows to the shared folder.
    """
    kind = dict(benchmark.dtypes)[item_id]
    if kind not in ("bigint", "int", "string"):
        raise TypeError(f"{item_id} has to be an integer or a string, not {kind}")
    kind = "string" if kind == "string" else "bigint"
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.lit(None).cast("binary").alias("hit"), F.array().cast(f"array<{kind}>").alias("items"),
    )
    before = None
    for block in _blocks(benchmark.where(F.col(item_id).isNotNull()), item_id, item_text, item_chars):
        if before is not None:
            rows = stage(_pass(rows, before, kind, window, last=False), "scanned")
        before = block
    return _pass(rows, before, kind, window, last=True)


def without_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """``docs`` without rows in which a benchmark passage is found; rows without an id are judged like others."""
    marked = docs.withColumns({"row__": F.struct(id_col, F.xxhash64(text_col))})
    hit = find_passages(marked, benchmark, "row__", text_col, **kwargs).where("n_hit > 0")
    hit = stage(hit.select("id").distinct(), "contaminated")
    same = marked["row__"].eqNullSafe(hit["id"])
    return marked.join(hit, same, "left_anti").drop("row__")
