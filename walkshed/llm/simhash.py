"""Near duplicates by SimHash fingerprints, linked through a hierarchical index in Gray order.

Two fingerprints that differ in at most r bits agree on at least one of r + 1 segments of
bits, so each fingerprint goes once to the bucket of each of its segments. A bucket that
holds too many is divided again by the bits it does not fix, in the same exact way.

Inside a task the fingerprints of a bucket are sorted by Gray rank, which puts those with
common bits side by side. Runs of neighbours form nodes; a node keeps the mask of bits on
which all below agree, less the bits its parents have already, and their values. A search
walks down from the top with the differences summed so far and drops a node, and all below
it, once the sum is above r.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.llm.common import map_texts, pieces, stage
from walkshed.llm.components import components

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16
#: Members of a leaf, and children of an upper node.
LEAF, FAN = 16, 8
#: Rows that a bucket may hold before it is divided, and how often that may happen.
BUCKET_ROWS, MAX_DEPTH = 2048, 3
#: (query, node) pairs looked at together.
FRONTIER = 1 << 20

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_BYTE_AT = np.arange(8, dtype=np.intp) * 256


class _BitCounts:
    """For each bit, in how many of the hashes it is set."""

    def __init__(self) -> None:
        self.total, self.ones = 0, np.zeros((8, 8), np.int64)

    def add(self, digests: list[bytes]) -> None:
        values = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
        counts = np.bincount((values + _BYTE_AT).ravel(), minlength=2048).reshape(8, 256)
        self.ones += counts @ _BYTE_BITS
        self.total += len(digests)

    def fingerprint(self) -> int:
        """The bits set in over half of the hashes."""
        return int.from_bytes(np.packbits(2 * self.ones.ravel() > self.total).tobytes(), "big") if self.total else 0


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes (uint64), each of which counts once."""
    counts = _BitCounts()
    for i in range(0, len(hashes), BLOCK):
        counts.add([hashes[i : i + BLOCK].astype(">u8").tobytes()])
        counts.total += len(hashes[i : i + BLOCK]) - 1
    return counts.fingerprint()


def simhash(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash over shingles of lower-cased (A-Z) words; 0 without words.

    A text with fewer words than a shingle is one shingle. Long texts are read in pieces, the
    last words of a piece being carried over to the next.
    """
    counts, carried, hashed = _BitCounts(), [], xxhash.xxh64_digest
    for piece in pieces(text or ""):
        words = carried + piece.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
            ends = ends[shingle - 1 :].tolist()
            for i in range(0, len(starts), BLOCK):
                counts.add([hashed(joined[a:b], SEED) for a, b in zip(starts[i : i + BLOCK], ends[i : i + BLOCK])])
            carried = words[len(words) - shingle + 1 :]
        else:
            carried = words
    if not counts.total and carried:
        counts.add([hashed(b" ".join(carried), SEED)])
    return counts.fingerprint()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long. A null text has no words."""

    def work():
        return lambda texts: [pa.array(np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64))]

    return map_texts(docs, [id_col], text_col, "fp bigint", work).toDF("id", "fp")


def hex16(fp: str | Column) -> Column:
    """A signed long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- buckets -----------------------------------------------------------------------------


def _split(free: int, parts: int) -> list[int]:
    """Masks that share out the set bits of ``free`` in runs as equal as can be."""
    bits = [b for b in range(BITS) if free >> b & 1]
    return [sum(1 << int(b) for b in run) for run in np.array_split(bits, parts)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _bucketed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Each row once per mask, with the mask and the fingerprint's bits under it."""
    each = F.array(*[F.lit(_signed(m)) for m in masks])
    out = rows.select("fp", "rep", F.explode(each).alias("mask"))
    return out.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))


def _buckets(nodes: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """(mask, pattern, fp, rep): every pair within the radius shares a bucket."""
    everything = (1 << BITS) - 1
    masks = _split(everything, radius + 1)
    level, ready = _bucketed(nodes, masks), None
    for depth in range(MAX_DEPTH + 1):
        last = depth == MAX_DEPTH or any((everything & ~m).bit_count() <= radius for m in masks)
        over = None
        if not last:
            counts = level.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
            over = stage(counts.where(F.col("n") > bucket_rows).select("mask", "pattern"), "overfull")
            last = over.isEmpty()
        found = level if last else level.join(over, ["mask", "pattern"], "left_anti")
        ready = found if ready is None else ready.unionByName(found)
        if last:
            return ready
        again = stage(level.join(over, ["mask", "pattern"], "left_semi"), "divided")
        parts = [
            _bucketed(again.where(F.col("mask") == _signed(m)), [m | s for s in _split(everything & ~m, radius + 1)])
            for m in masks
        ]
        masks = [m | s for m in masks for s in _split(everything & ~m, radius + 1)]
        level = parts[0]
        for part in parts[1:]:
            level = level.unionByName(part)
    raise AssertionError("unreachable")


# --- the index ---------------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence, where neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over distinct fingerprints (uint64), sorted by Gray rank.

    ``levels`` goes from the leaves' nodes up. Each level has, per node, the first and
    last + 1 of its children, the mask of bits its members agree on that no parent
    holds, and the pattern of these bits.
    """

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, zeros, size = self.codes, ~self.codes, LEAF
        masks, patterns, self.spans = [], [], []
        while True:
            starts = np.arange(0, len(ones), size)
            self.spans.append((starts, np.minimum(starts + size, len(ones))))
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            masks.append(ones | zeros)
            patterns.append(ones)
            if len(starts) <= FAN:
                break
            size = FAN
        self.agreed, self.patterns = masks[0], patterns
        self.masks = list(masks)
        for level in range(len(masks) - 1):  # what a parent holds is factored out below it
            parent = np.repeat(masks[level + 1], np.diff(np.append(self.spans[level + 1][0], len(masks[level]))))
            self.masks[level] = masks[level] & ~parent

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (i, j), i < j, of all codes within the radius, in blocks."""
        step = max(1, FRONTIER // (4 * LEAF * len(self.spans[-1][0])))
        for start in range(0, len(self.codes), step):
            stop = min(start + step, len(self.codes))
            tops = len(self.spans[-1][0])
            queries = np.repeat(np.arange(start, stop), tops)
            nodes = np.tile(np.arange(tops), stop - start)
            yield from self._down(len(self.spans) - 1, queries, nodes, np.zeros(len(nodes), np.int64), radius)

    def _down(self, level, queries, nodes, sums, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        differ = (self.codes[queries] ^ self.patterns[level][nodes]) & self.masks[level][nodes]
        sums = sums + np.bitwise_count(differ)
        firsts, lasts = self.spans[level]
        keep = sums <= radius
        queries, nodes, sums = queries[keep], nodes[keep], sums[keep]
        for at in range(0, len(queries), FRONTIER // LEAF):
            part = slice(at, at + FRONTIER // LEAF)
            q, n, s = queries[part], nodes[part], sums[part]
            sizes = lasts[n] - firsts[n]
            children = np.repeat(firsts[n] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            q, n, s = np.repeat(q, sizes), np.repeat(n, sizes), np.repeat(s, sizes)
            if level:
                yield from self._down(level - 1, q, children, s, radius)
                continue
            later = children > q
            q, n, s, children = q[later], n[later], s[later], children[later]
            rest = (self.codes[q] ^ self.codes[children]) & ~self.agreed[n]
            near = s + np.bitwise_count(rest) <= radius
            if near.any():
                yield q[near], children[near]


def _forest(n: int, found: Iterator[tuple[np.ndarray, np.ndarray]], reps: np.ndarray) -> np.ndarray:
    """For each member the least ``rep`` it is linked to, over any number of links."""
    least = reps.copy()
    links = list(found)
    if not links:
        return least
    a, b = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
    while True:
        low = np.minimum(least[a], least[b])
        after = least.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        if (after == least).all():
            return least
        least = after


def _linked(mask_pattern_rows: dict[str, np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of complete buckets: each rep with the least rep reachable inside its bucket."""
    mask, pattern = mask_pattern_rows["mask"], mask_pattern_rows["pattern"]
    fp, rep = mask_pattern_rows["fp"].view(np.uint64), mask_pattern_rows["rep"]
    new = np.flatnonzero(np.append(True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])))
    sizes = np.diff(np.append(new, len(mask)))
    out_a, out_b = [], []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]):  # one leaf: all such buckets at once
        at = new[sizes == size][:, None] + np.arange(size)
        for i in range(size - 1):
            for j in range(i + 1, size):
                near = np.bitwise_count(fp[at[:, i]] ^ fp[at[:, j]]) <= radius
                out_a.append(rep[at[near, i]])
                out_b.append(rep[at[near, j]])
    for start, size in zip(new[sizes > LEAF], sizes[sizes > LEAF]):
        codes, ids = fp[start : start + size], rep[start : start + size]
        ids = ids[np.argsort(gray_rank(codes), kind="stable")]
        least = _forest(size, GrayIndex(codes).pairs(radius), ids)
        moved = least != ids
        out_a.append(ids[moved])
        out_b.append(least[moved])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def links(nodes: DataFrame, radius: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits of each other.

    ``nodes`` has distinct ``fp`` and a ``rep`` for each. Inside a bucket, links are reduced to
    those that connect the same members; nothing is left out between buckets.
    """
    buckets = _buckets(nodes, radius, bucket_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = ("mask", "pattern", "fp", "rep"), None

        def out(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
            a, b = _linked(rows, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if not batch.num_rows:
                continue
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
            same = (rows["mask"] == rows["mask"][-1]) & (rows["pattern"] == rows["pattern"][-1])
            cut = len(same) - int(same.sum())  # the last bucket may go on in the next batch
            if cut:
                yield out({c: v[:cut] for c, v in rows.items()})
            held = {c: v[cut:] for c, v in rows.items()}
        if held is not None:
            yield out(held)

    dealt = buckets.select("mask", "pattern", "fp", "rep").repartition("mask", "pattern")
    return dealt.sortWithinPartitions("mask", "pattern").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fp, component): every row's fingerprint and the least id it is linked to.

    Rows link if their fingerprints differ in at most ``radius`` bits; links are followed
    over any number of rows. Null and empty texts, and texts of white space, have
    fingerprint zero and link like any other. Repeated rows stay. Rows without an id
    link nothing and have no component. Other columns are not read. An empty table gives none.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stage(rows.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "codes")
    groups = components(links(nodes, radius), "a", "b")
    merged = nodes.join(groups, nodes["rep"] == groups["node"], "left").select(
        F.col("fp").alias("code"), F.coalesce("component", "rep").alias("component")
    )
    found = rows.join(merged, rows["fp"] == merged["code"], "left")
    return found.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))
