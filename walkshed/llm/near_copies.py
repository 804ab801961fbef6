"""Near copies by the Jaccard similarity of word shingles, at or above a threshold.

Texts with the same set of shingles are one node, so copies are no work. Candidates come from two
sides: the Gray-order index of ``simhash`` over fingerprints of the nodes, and bands of minhashes for
the near copies that differ in more bits. Two nodes of similarity s miss each other in all bands with
probability ``(1 - s ** ROWS) ** BANDS``: 0.1 % at 0.8, less above; at 0.5 91 % never meet.

A bucket of a band links its members to one of them, which costs as many rows as it has members. Nodes
linked so form a group of candidates. A small group goes to one task with its shingle sets, each set
once, and is compared there by an index of shingles; what the task returns is a forest of links of
exact similarity. A group too large for a task is first compared with the least node of each of its
buckets, in parts. Nodes that are not connected by then can be similar only if the first of their
shingles, in an order of the group, have one in common; what meets so is compared whole, or dealt to
blocks of which each pair is one more unit of work. So all pairs of a group are decided, whatever its
size and whichever side proposed them, and pairs are never rows of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm import simhash
from walkshed.llm.common import map_texts, pieces, scratch, stage
from walkshed.llm.components import components
from walkshed.session import stage_table

SEED = 42
#: Minhashes of a band, and bands.
ROWS, BANDS = 9, 48
#: Differing bits up to which the fingerprint index proposes candidates.
RADIUS = 3
#: Shingles hashed at a time.
BLOCK = 1 << 14
#: Shingles that a task compares at a time.
UNIT_SHINGLES = 1 << 20

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 32, ROWS * BANDS, np.uint32) | np.uint32(1)
_MASKS = _RANDOM.integers(0, 1 << 32, ROWS * BANDS, np.uint32)


def shingles(text: str | None, shingle: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the shingles of lower-cased (A-Z) words; none without words.

    A text with fewer words than a shingle is one shingle. Long texts are read in pieces.
    """
    found, carried, hashed = [], [], xxhash.xxh64_intdigest
    for piece in pieces(text or ""):
        words = carried + piece.encode("utf-8", "surrogatepass").lower().split()
        n = len(words) - shingle + 1
        for i in range(0, n, BLOCK):
            block = [hashed(b" ".join(words[j : j + shingle]), SEED) for j in range(i, min(i + BLOCK, n))]
            found.append(np.unique(np.array(block, np.uint64)))
        carried = words[n:] if n > 0 else words
    if not found and carried:
        found.append(np.array([hashed(b" ".join(carried), SEED)], np.uint64))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band; none without shingles."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 256):
        part = (short[None, i : i + 256] ^ _MASKS[:, None]) * _FACTORS[:, None]
        np.minimum(least, part.min(1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), at) for at, b in enumerate(bands)], np.uint64).view(np.int64)


def _signatures(docs: DataFrame, keep: list[str], text_col: str, shingle: int) -> DataFrame:
    """The columns ``keep``, then node, size, fingerprint and bands of every row."""

    def work():
        def made(texts):
            sets = [shingles(t, shingle) for t in texts]
            return [
                pa.array([xxhash.xxh3_128_hexdigest(s.tobytes(), SEED) for s in sets]),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([simhash.of_hashes(s) for s in sets], np.uint64).view(np.int64)),
                pa.array([_bands(s) for s in sets], pa.list_(pa.int64())),
            ]

        return made

    return map_texts(docs, keep, text_col, "node string, size bigint, fp bigint, bands array<bigint>", work)


# --- candidates --------------------------------------------------------------------------


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, key, lead): members of buckets of several nodes, with the least of them; staged."""
    rows = nodes.select("key", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("most")).where("lead < most")
    return stage(rows.join(stage(shared.select("bucket", "lead"), "shared"), "bucket").select("bucket", "key", "lead"), "buckets")


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes of one fingerprint, and links of the Gray-order index."""
    firsts = stage(nodes.groupBy("fp").agg(F.min("key").alias("rep")), "codes")
    equal = nodes.select("key", "fp").join(firsts, "fp").where("key != rep").select(F.col("rep").alias("a"), F.col("key").alias("b"))
    return equal.unionByName(simhash.links(firsts, RADIUS))


# --- exact comparison ----------------------------------------------------------------------


def compared(sets: list[np.ndarray], labels: list, led: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the links of at least this similarity, between members of different label.

    With members marked ``led`` only these are compared with the others.
    """
    n = len(sets)
    root: dict = {label: label for label in labels}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    elements, owners = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    starts = np.flatnonzero(np.append(True, elements[1:] != elements[:-1]))
    counts = np.diff(np.append(starts, len(elements)))
    place = np.empty(len(order), np.int64)  # of each element of each set: where its owners begin
    place[order] = np.repeat(np.arange(len(starts)), counts)
    ends, links, left = np.cumsum(sizes), [], len(root)
    for x in np.flatnonzero(led) if led.any() else range(n):
        if left == 1:
            break
        mine = place[ends[x] - sizes[x] : ends[x]]
        mine = mine[counts[mine] > 1]
        many = counts[mine]
        at = np.repeat(starts[mine] - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(owners[at], minlength=n)
        for y in np.flatnonzero(100 * both >= percent * (sizes[x] + sizes - both)):
            a, b = find(labels[x]), find(labels[y])
            if x != y and a != b:
                root[a] = b
                left -= 1
                links.append((int(x), int(y)))
    return links


def _forests(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found in each unit. ``units`` has unit, key, label and led; ``sets`` key, node and hashes."""
    rows = units.join(sets, "key").select(
        "unit", "node", F.coalesce("label", "node").alias("label"), "led", "hashes"
    ).repartition("unit").sortWithinPartitions("unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, nodes, labels, led, held = None, [], [], [], []

        def out() -> list[tuple[str, str]]:
            if len(set(labels)) < 2:
                return []
            return [(nodes[i], nodes[j]) for i, j in compared(held, labels, np.array(led), percent)]

        for batch in batches:
            found = []
            hashes = batch.column("hashes")
            for at, (u, node, label, lead) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("unit", "node", "label", "led")])):
                if u != unit:
                    found += out()
                    unit, nodes, labels, led, held = u, [], [], [], []
                nodes.append(node)
                labels.append(label)
                led.append(lead)
                held.append(hashes[at].values.to_numpy(zero_copy_only=False))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["a", "b"])
        if found := out():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a string, b string")


def _in_blocks(rows: DataFrame, unit: str, shingles_: str) -> DataFrame:
    """Rows (unit, key, size) of overfull units in pairs of blocks: every two rows share a unit."""
    total = rows.groupBy(unit).agg(F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(2 * F.col("total") / F.lit(UNIT_SHINGLES)), F.lit(1)).cast("int")
    dealt = rows.join(stage(total.select(unit, blocks.alias("n_blocks")), shingles_), unit)
    mine = F.pmod(F.xxhash64(F.lit(SEED), "key"), F.col("n_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    dealt = dealt.withColumn("mine", mine).select("*", other)
    pair = F.concat_ws("-", F.col(unit).cast("string"), F.least("mine", "other").cast("string"), F.greatest("mine", "other").cast("string"))
    return dealt.select(pair.alias("unit"), "key", "label")


def _apart(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(unit, key, size, label): nodes of a group that may link to one of another label; any two such share a unit.

    Two sets with this share have one of their first ``size - ceil(size * share) + 1`` elements in common, in
    any order of all elements. Here elements found under one label only come first, then rare ones. ``rows``
    has group, key, size and label.
    """
    labels = [F.min("label").alias("x"), F.max("label").alias("y")]
    several = stage(rows.groupBy("group").agg(*labels).where("x != y").select("group"), "several")
    rows = rows.join(several, "group", "left_semi")
    elements = stage(rows.join(sets.select("key", F.explode("hashes").alias("element")), "key"), "elements")
    shared = elements.groupBy("group", "element").agg(F.count("*").alias("n"), *labels).where("x != y")
    ranked = elements.join(shared.select("group", "element", "n"), ["group", "element"], "left")
    order = Window.partitionBy("key").orderBy(F.col("n").asc_nulls_first(), "element")
    least = F.ceil(F.col("size") * percent / 100)
    first = ranked.withColumn("at", F.row_number().over(order)).where(F.col("n").isNotNull() & (F.col("at") <= F.col("size") - least + 1))
    first = stage(first.select("group", "element", "key", "label"), "first")
    meet = first.groupBy("group", "element").agg(F.min("key").alias("lead"), *labels).where("x != y")
    edges = first.join(meet.select("group", "element", "lead"), ["group", "element"]).select("lead", "key")
    units = stage(components(edges, "lead", "key").withColumnsRenamed({"node": "key", "component": "unit"}), "units")
    return stage(rows.join(units, "key").select("unit", "key", "size", "label"), "apart")


def links(docs: DataFrame, nodes: DataFrame, text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(a, b): exact links that connect all nodes of a group of candidates that have at least this similarity.

    ``nodes``: key (64 bits of the node), node, size, fp, bands and the text hash of one of its texts.
    """
    buckets = _buckets(nodes)
    edges = buckets.where("key != lead").select(F.col("lead").alias("a"), F.col("key").alias("b"))
    groups = components(edges.unionByName(_by_fingerprint(nodes)), "a", "b").withColumnsRenamed({"node": "key", "component": "group"})
    groups = stage(groups.join(nodes.select("key", "node", "size", "text_hash__"), "key"), "candidates")
    sets = stage(_sets(docs, groups, text_col, shingle), "sets")
    large = stage(
        groups.groupBy("group").agg(F.sum("size").alias("total")).where(F.col("total") > UNIT_SHINGLES).select("group"), "large"
    )
    none = F.lit(None).cast("string")
    whole = groups.join(large, "group", "left_anti").select(
        F.col("group").cast("string").alias("unit"), "key", none.alias("label"), F.lit(False).alias("led")
    )
    found = stage(_forests(whole, sets, percent), "links")
    if large.isEmpty():
        return found
    inside = stage(groups.join(large, "group", "left_semi").select("group", "key", "node", "size"), "inside")
    # Each lead with its other members, in parts.
    stars = buckets.where("key != lead").select("lead", "key").distinct().join(inside.select("key", "size"), "key")
    total = stars.groupBy("lead").agg(F.sum("size").alias("total"))
    parts = F.ceil(F.col("total") / F.lit(UNIT_SHINGLES)).cast("int")
    total = stage(total.select("lead", parts.alias("n_parts")), "stars")
    name = F.concat_ws("-", F.col("lead").cast("string"), F.col("part").cast("string"))
    part = F.pmod(F.xxhash64(F.lit(SEED), "key"), F.col("n_parts")).cast("int")
    each = stars.join(total, "lead").withColumn("part", part).select(name.alias("unit"), "key", none.alias("label"), F.lit(False).alias("led"))
    leads = total.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
    leads = leads.select(name.alias("unit"), F.col("lead").alias("key"), none.alias("label"), F.lit(True).alias("led"))
    found = found.unionByName(stage(_forests(each.unionByName(leads), sets, percent), "links"))
    now = stage(components(found, "a", "b"), "groups").withColumnRenamed("node", "n")
    labelled = inside.join(now, F.col("node") == F.col("n"), "left")
    labelled = stage(labelled.select("group", "key", "size", F.coalesce("component", "node").alias("label")), "labelled")
    rest = _in_blocks(_apart(labelled, sets, percent), "unit", "blocks").withColumn("led", F.lit(False))
    return found.unionByName(stage(_forests(rest, sets, percent), "links"))


def _sets(docs: DataFrame, wanted: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(key, node, hashes) of the wanted nodes, from one text of each."""

    def work():
        return lambda texts: [pa.array([shingles(t, shingle).view(np.int64) for t in texts], pa.list_(pa.int64()))]

    found = docs.join(wanted.select("key", "node", "text_hash__"), "text_hash__").select("key", "node", text_col)
    return map_texts(found, ["key", "node"], text_col, "hashes array<bigint>", work).dropDuplicates(["node"])


# --- the operator --------------------------------------------------------------------------


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` without near copies: of each group the row with the least id stays.

    Rows link if the Jaccard similarity of their shingle sets is at least ``percent``; links are
    followed over any number of rows. Texts without words are copies of each other. Rows without
    an id come last; of rows equal in id and text one stays. All columns of ``docs`` are returned as
    they are. What is written on the way is deleted before the result is returned, but for the ids
    of the rows that go.
    """
    with scratch(docs.sparkSession):
        hashed = docs.withColumn("text_hash__", F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
        sigs = _signatures(hashed, [id_col, "text_hash__"], text_col, shingle).withColumnRenamed(id_col, "id__")
        sigs = stage(sigs.withColumn("key", F.conv(F.substring("node", 1, 15), 16, 10).cast("bigint")), "signatures")
        firsts = [F.first(c).alias(c) for c in ("key", "size", "fp", "bands")]
        nodes = sigs.where("size > 0").groupBy("node").agg(*firsts, F.min("text_hash__").alias("text_hash__"))
        nodes = stage(nodes, "nodes")
        groups = stage(components(links(hashed, nodes, text_col, shingle, percent), "a", "b"), "components")
        groups = groups.select(F.col("node").alias("n"), "component")
        rows = sigs.select("id__", "text_hash__", "node").join(groups, F.col("node") == F.col("n"), "left")
        rows = rows.groupBy("id__", "text_hash__", F.coalesce("component", "node").alias("component")).agg(F.count("*").alias("n_rows"))
        rows = stage(rows, "rows")
        first = F.min(F.struct(F.col("id__").isNull().alias("none"), "id__", "text_hash__")).alias("f")
        kept = stage(rows.groupBy("component").agg(first), "kept")
        others = rows.join(kept.withColumnRenamed("component", "c"), F.col("component") == F.col("c"))
        others = others.withColumn("stays", F.col("id__").eqNullSafe(F.col("f.id__")) & (F.col("text_hash__") == F.col("f.text_hash__")))
        others = others.where("not stays or n_rows > 1").select(F.col("id__"), F.col("text_hash__").alias("hash__"), "stays")
        gone = stage_table(others, "near-copies")
    same = hashed[id_col].eqNullSafe(gone["id__"]) & (hashed["text_hash__"] == gone["hash__"])
    single = hashed.join(gone, same, "left_anti")
    repeated = gone.where("stays")
    if not repeated.isEmpty():
        single = single.unionByName(hashed.join(repeated, same, "left_semi").dropDuplicates([id_col, "text_hash__"]))
    return single.select(docs.columns)
