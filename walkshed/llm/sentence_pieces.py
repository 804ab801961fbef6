"""SentencePiece encoding and decoding for vocabularies of the merge type (BPE).

The characters of a text are its first symbols. An agenda holds the adjacent pairs of symbols
whose union is in the vocabulary, ordered by score and then from left to right; the best pair is
merged, and the pairs that the new symbol forms enter the agenda, until it is empty. Characters
the vocabulary lacks become byte pieces.

No merge crosses two neighbouring characters that no piece holds side by side, such as the last of
a word and a space mark. A text is cut there, and the words between have an agenda each. Those of
short words that are not remembered are the rows of one array: a step takes the best pair of every
row. Longer words have a heap. Every Arrow batch is checked against the sentencepiece library.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: What an id without text decodes to.
UNKNOWN_TEXT = " ⁇ "
#: Words remembered by a worker, and the characters of the longest.
REMEMBERED, SHORT = 1 << 19, 32
#: Short words whose agendas are worked on together.
TOGETHER = 1 << 12
#: Places of the tables of neighbours and of pairs of symbols, powers of two.
JOINS, PLACES = 1 << 22, 1 << 20
#: Rows, and bytes of text, encoded together.
ROWS, BYTES = 256, 1 << 22

# Fixed values of the public model file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield number, data[at : at + size]
        at += size


class Vocabulary:
    """Pieces, scores and normalisation of a serialised model.

    Raises ValueError for models of another type, and for ones with a normalisation table,
    user-defined or unused pieces, as these would be encoded in another way.
    """

    def __init__(self, model: bytes) -> None:
        self.texts: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer, normalizer = {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        # Numbers of the format: 3 model type, 24 space marks at word ends; 2 table, 3 dummy prefix, 4 and 5 spaces.
        if trainer.get(3) != BPE or trainer.get(24):
            raise ValueError("not a vocabulary of merge type with space marks before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("texts would be normalised before encoding")
        if {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("user-defined or unused pieces")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.ids = {t: i for i, (t, kind) in enumerate(zip(self.texts, self.kinds)) if kind == NORMAL}
        self.order = {t: -self.scores[i] for t, i in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(t[3:5], 16): i for i, (t, kind) in enumerate(zip(self.texts, self.kinds)) if kind == BYTE}
        self._pairs()
        #: What an id decodes to on its own; None for bytes that are only part of a character.
        self.surfaces = [
            (chr(int(t[3:5], 16)) if int(t[3:5], 16) < 0x80 else None) if kind == BYTE
            else {CONTROL: "", UNKNOWN: UNKNOWN_TEXT}.get(kind, t.replace(SPACE, " "))
            for t, kind in zip(self.texts, self.kinds)
        ]
        self.surface_column = pa.array([t or "" for t in self.surfaces], pa.large_string())
        self.partial = np.array([t is None for t in self.surfaces])
        #: Pieces of text, and those whose first character goes at the beginning of a text.
        self.plain = np.array([kind == NORMAL for kind in self.kinds])
        self.marked = np.array([bool(self.prefix) and t.startswith(SPACE) for t in self.texts])
        self.joins = np.zeros(JOINS, np.bool_)
        for text in self.ids:
            codes = np.array([ord(c) for c in text], np.uint32)
            self.joins[self._joined(codes)] = True

    @staticmethod
    def _joined(codes: np.ndarray) -> np.ndarray:
        """Where ``joins`` holds each two neighbours. Some share a place, which only leaves words longer."""
        return (codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - JOINS.bit_length() + 1)

    def words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts in UTF-32, and how many there are up to the end of each text.

        A text is cut between neighbours that no piece holds side by side.
        """
        marked = [self.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        data = "".join(marked).encode("utf-32-le")
        codes = np.frombuffer(data, np.uint32)
        ends = np.cumsum([len(m) for m in marked], dtype=np.int64)
        last = np.zeros(len(codes), np.bool_)  # characters that end a word
        last[:-1] = ~self.joins[self._joined(codes)]
        last[ends[ends > 0] - 1] = True
        stops = np.flatnonzero(last) + 1
        offsets = pa.py_buffer(4 * np.append(0, stops))
        words = pa.Array.from_buffers(pa.large_binary(), len(stops), [None, offsets, pa.py_buffer(data)])
        return words, np.searchsorted(stops, ends, "right")

    def _pairs(self) -> None:
        """Number the symbols, and list the pairs of symbols whose union is a piece.

        Symbols are numbered as pieces; a character that is no piece gets a number above them.
        """
        n = len(self.texts)
        self.symbols = np.arange(n, n + 0x110000)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.symbols[ord(text)] = i
        self.base = n + 0x110000

        def symbol(text: str) -> int | None:
            return int(self.symbols[ord(text)]) if len(text) == 1 else self.ids.get(text)

        found = []
        for text, i in self.ids.items():
            for cut in range(1, len(text)):
                left, right = symbol(text[:cut]), symbol(text[cut:])
                if left is not None and right is not None:
                    found.append((left * self.base + right, -self.scores[i], i))
        found = found or [(-1, np.inf, 0)]
        self.keys, self.ranks, self.made = (np.array(c) for c in zip(*found))
        # Where each key is: in the first table by its hash, or in the next if its place is taken.
        self.places, left = [], np.arange(len(found))
        while len(left):
            places = np.full(PLACES, -1, np.int32)
            hashed = self._place(self.keys[left], len(self.places))
            places[hashed] = left
            self.places.append(places)
            left = left[places[hashed] != left]

    @staticmethod
    def _place(keys: np.ndarray, table: int) -> np.ndarray:
        mixed = keys * np.int64(0x9E3779B97F4A7C15 - (1 << 64) + 2 * table)
        return (mixed ^ mixed >> 32) & (PLACES - 1)

    def paired(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, union) of pairs of symbols; rank infinity if the union is no piece. The best rank is the least."""
        wanted = left * self.base + right
        ranks, made = np.full(wanted.shape, np.inf), np.zeros(wanted.shape, np.int64)
        for table, places in enumerate(self.places):
            at = places[self._place(wanted, table)]
            found = self.keys[at] == wanted  # -1, for an empty place, is the last key, which then differs or is right
            ranks[found], made[found] = self.ranks[at[found]], self.made[at[found]]
        return ranks, made


class Encoder:
    """Encodes and decodes texts with a vocabulary, remembering frequent words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._known: dict[bytes, bytes] = {}

    def merged(self, word: str) -> list[str]:
        """The symbols of a word when no adjacent pair is in the vocabulary any more."""
        order, n, push = self.vocabulary.order, len(word), heapq.heappush
        stop = list(range(1, n + 1))  # the symbol that starts at i ends at stop[i]; 0 if it was merged away
        before = list(range(-1, n))
        agenda = [(order[pair], i, i + 1, i + 2) for i in range(n - 1) if (pair := word[i : i + 2]) in order]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, end = heapq.heappop(agenda)
            if stop[left] != right or stop[right] != end:
                continue  # one of the two was merged with another in the meantime
            stop[left], stop[right], before[end] = end, 0, left
            if end < n and (pair := word[left : stop[end]]) in order:
                push(agenda, (order[pair], left, end, stop[end]))
            first = before[left]
            if first >= 0 and (pair := word[first:end]) in order:
                push(agenda, (order[pair], first, left, end))
        out, i = [], 0
        while i < n:
            out.append(word[i : stop[i]])
            i = stop[i]
        return out

    def _ids(self, symbols: list[str]) -> bytes:
        ids, made = self.vocabulary.ids, []
        for symbol in symbols:
            known = ids.get(symbol)
            if known is not None:
                made.append(known)
            elif self.vocabulary.bytes:
                made.extend(self.vocabulary.bytes[b] for b in symbol.encode("utf-8"))
            else:
                made.append(self.vocabulary.unknown)
        return np.array(made, np.int32).tobytes()

    def merged_rows(self, words: list[str]) -> list[bytes]:
        """The ids of words of similar length, all agendas being the rows of one array."""
        v, n, width = self.vocabulary, len(words), max(map(len, words))
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32)
        symbols = np.full((n, width + 1), -v.base)  # in no pair; the last column stands for none
        inside = np.arange(width) < np.array([len(w) for w in words])[:, None]
        symbols[:, :-1][inside] = v.symbols[codes.reshape(n, width)[inside]]
        ranks, unions = np.full((n, width + 1), np.inf), np.zeros((n, width + 1), np.int64)
        ranks[:, :-1], unions[:, :-1] = v.paired(symbols[:, :-1], symbols[:, 1:])
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.append(width, np.arange(width)), (n, 1))
        rows, out = np.arange(n), symbols.copy()
        while True:
            best = ranks.argmin(1)
            more = ranks[np.arange(len(rows)), best] < np.inf
            each = np.flatnonzero(more)
            if 2 * len(each) <= len(rows):  # half of the words are done
                out[rows[~more]] = symbols[~more]
                rows, best = rows[more], best[more]
                symbols, ranks, unions, after, before = (m[more] for m in (symbols, ranks, unions, after, before))
                each = np.arange(len(rows))
                if not len(rows):
                    break
            at = best[each]
            merged = after[each, at]
            right, left = after[each, merged], before[each, at]
            symbols[each, at], symbols[each, merged] = unions[each, at], -v.base
            ranks[each, merged] = np.inf
            after[each, at], before[each, right] = right, at
            # The pairs that the new symbol forms.
            here = symbols[each, at]
            found, made = v.paired(np.append(here, symbols[each, left]), np.append(symbols[each, right], here))
            ranks[each, at], unions[each, at] = found[: len(each)], made[: len(each)]
            ranks[each, left], unions[each, left] = found[len(each) :], made[len(each) :]
        alive = out >= 0
        ends = np.cumsum(alive.sum(1))
        flat, pieces = out[alive], len(v.texts)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(flat >= pieces), "right")).tolist()
        held, ends = flat.astype(np.int32).tobytes(), [0, *ends.tolist()]
        made = [held[4 * i : 4 * j] for i, j in zip(ends, ends[1:])]
        for at in odd:  # with characters that are no pieces
            symbols_ = flat[ends[at] : ends[at + 1]].tolist()
            made[at] = self._ids([v.texts[c] if c < pieces else chr(c - pieces) for c in symbols_])
        return made

    def _remember(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of short words (in UTF-32), from memory or made."""
        if len(self._known) + len(words) > REMEMBERED:
            self._known.clear()
        new = sorted((w for w in words if w not in self._known), key=len)
        for i in range(0, len(new), TOGETHER):
            part = new[i : i + TOGETHER]
            self._known.update(zip(part, self.merged_rows([w.decode("utf-32-le") for w in part])))
        return self._known

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        words, counts = self.vocabulary.words(texts)
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        known = self._remember([w for w in different if len(w) <= 4 * SHORT])
        long = {w: self._ids(self.merged(w.decode("utf-32-le"))) for w in different if len(w) > 4 * SHORT}
        ids = [long[w] if w in long else known[w] for w in different] if long else list(map(known.__getitem__, different))
        flat, sizes = np.frombuffer(b"".join(ids), np.int32), np.array([len(i) // 4 for i in ids], np.int64)
        # The ids of each word of the texts, copied from those of the different words.
        at = coded.indices.to_numpy()
        sizes, starts = sizes[at], (np.cumsum(sizes) - sizes)[at]
        ends = np.append(0, np.cumsum(sizes))
        made = flat[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        ends = ends[np.append(0, counts)].tolist()
        return [made[i:j] for i, j in zip(ends, ends[1:])]

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids; those without parts of characters are slices of one column of surfaces."""
        v, flat = self.vocabulary, np.concatenate([np.zeros(0, np.int32), *ids])
        column = v.surface_column.take(pa.array(flat))
        _, offsets, data = column.buffers()
        ends = np.cumsum([0, *map(len, ids)])
        stops = np.frombuffer(offsets, np.int64)[column.offset + ends].tolist()
        data, partial = memoryview(data or b""), np.append(0, np.cumsum(v.partial[flat]))[ends].tolist()
        out = []
        for i, part in enumerate(ids):
            if len(part) and v.plain[part[0]] and partial[i] == partial[i + 1]:
                out.append(str(data[stops[i] + bool(v.marked[part[0]]) : stops[i + 1]], "utf-8"))
            else:
                out.append(self.decode(part.tolist()))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids. A byte that is part of no character becomes U+FFFD."""
        v, out, held = self.vocabulary, [], bytearray()
        first = bool(v.prefix)

        def flush() -> None:
            at = 0
            while at < len(held):
                lead = held[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                try:
                    out.append(held[at : at + size].decode("utf-8"))
                    at += size
                except UnicodeDecodeError:
                    out.append("�")
                    at += 1
            held.clear()

        for i in ids:
            kind, text = v.kinds[i], v.texts[i]
            if kind == BYTE:
                held.append(int(text[3:5], 16))
                first = False
                continue
            flush()
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(UNKNOWN_TEXT)
            else:
                out.append((text[1:] if first and text.startswith(SPACE) else text).replace(SPACE, " "))
            first = False
        flush()
        return "".join(out)


def _as_arrow(ids: list[np.ndarray], texts: list[str], agrees: list[bool | None]) -> list[pa.Array]:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *ids])
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(texts, pa.string()), pa.array(agrees, pa.bool_())]


#: The encoder of the last model a worker has seen, so that its words stay remembered from task to task.
_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(Vocabulary(model))
    return _ENCODERS[model]


def encoder_of(model: bytes, check: bool) -> Callable[[list[str | None]], tuple[list, list, list]]:
    """A function from texts (None as empty) to their ids, decoded texts and whether the library agrees."""
    own = _encoder(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None

    def made(texts: list[str | None]) -> tuple[list, list, list]:
        texts = [t or "" for t in texts]
        ids = own.encode_all(texts)
        decoded = own.decode_all(ids)
        agrees: list[bool | None] = [None] * len(texts)
        if library is not None:
            wanted = library.encode(texts, num_threads=1)
            back = library.decode(wanted, num_threads=1) if wanted else []
            agrees = [a.tolist() == b and c == d for a, b, c, d in zip(ids, wanted, decoded, back)]
        return ids, decoded, agrees

    return made


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True
) -> DataFrame:
    """(id, ids, decoded, agrees) of every row: its ids, the text they stand for, and the check.

    ``model_path`` is read on the driver and sent along (half a megabyte for 32,000 pieces).
    No begin or end ids are added. A null text counts as empty and has no ids. With ``check`` the
    library encodes and decodes every text too and ``agrees`` says if both results are its own; else
    ``agrees`` is null. A text is one value of a row, so the longest text bounds a task's memory.
    Repeated rows stay; other columns are not read. An empty table gives none.
    """
    model = Path(model_path).read_bytes()
    Vocabulary(model)  # fails here rather than in a task
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text__"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = encoder_of(model, check)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            parts, start = np.cumsum(sizes, dtype=np.int64) // BYTES, 0
            while start < batch.num_rows:
                stop = start + 1
                while stop < min(start + ROWS, batch.num_rows) and parts[stop] == parts[start]:
                    stop += 1
                part, start = batch.slice(start, stop - start), stop
                made = _as_arrow(*function(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["id", "ids", "decoded", "agrees"])

    return source.mapInArrow(run, f"id {kind}, ids array<int>, decoded string, agrees boolean")
