"""A Merkle tree over a dataset: a root that fixes every row, and for each row the proof that it is in.

The leaves of a group are ranked, and the rank is cut into digits. A block holds the leaves that
agree on all but the last ``DIGITS`` digits. Within a block the digit columns are grouped away one
after the other: the children of a node are collected into an array of structs in the order of their
digit, hashed in pairs level by level, and nested into the struct of their parent with the hashes
of all levels. The hashes of the blocks are the leaves of the next tier, until a group is one block.

Proofs go the other way. A block meets the proof of its own hash by grouping, and is unnested by
transform and explode, each step putting the siblings of a child before the proof of its parent.
No join is made, and no row holds more than one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkshed.llm.common import stage
from walkshed.llm.ranks import numbered_parts, part_offsets

#: Children of a node that are grouped at a time, levels of pairs in them, and digits of a block.
BASE, BASE_LEVELS, DIGITS = 16, 4, 3
BLOCK = BASE**DIGITS
#: Columns that name a group: whether it has a name, and the name.
GROUP = ("named", "name")
#: A proof: per level whether the sibling is on the left, and its hash; no hash where a node has no sibling.
PROOF = "array<struct<left:boolean,hash:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as input of a leaf: ``-`` if null, else its UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def levels_above(n: Column) -> Column:
    """Levels of pairs over ``n`` leaves until one node is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


# --- up ------------------------------------------------------------------------------------


def _paired(line: Column) -> Column:
    """The next level: hashes of each two consecutive nodes, the last alone if it has no neighbour."""
    parents = F.sequence(F.lit(0), F.shiftright(F.size(line) + 1, 1) - 1)
    return F.transform(parents, lambda i: digest(F.get(line, 2 * i), F.coalesce(F.get(line, 2 * i + 1), F.lit(""))))


def _grouped_away(nodes: DataFrame, keys: Sequence[str], digit: str) -> DataFrame:
    """One row per ``keys``: the children in the order of ``digit``, nested in ``node``, and their ``hash``.

    ``levels`` counts the levels still to go; a group of which one node is left has none.
    """
    child = F.struct(digit, "hash", "node")
    rows = nodes.groupBy(*keys).agg(F.array_sort(F.collect_list(child)).alias("kids"), F.first("levels").alias("levels"))
    rows = rows.withColumn("line0", F.transform("kids", lambda k: k["hash"]))
    for at in range(BASE_LEVELS):  # a column for each level, so that no level is computed twice
        above = F.when(F.col("levels") > at, _paired(F.col(f"line{at}"))).otherwise(F.col(f"line{at}"))
        rows = rows.withColumn(f"line{at + 1}", above)
    nested = F.struct(
        F.transform("kids", lambda k: k["node"]).alias("kids"),
        F.array(*[F.col(f"line{at}") for at in range(BASE_LEVELS)]).alias("lines"),
        F.least("levels", F.lit(BASE_LEVELS)).alias("levels"),
    )
    return rows.select(
        *keys, F.greatest(F.col("levels") - BASE_LEVELS, F.lit(0)).alias("levels"),
        F.get(F.col(f"line{BASE_LEVELS}"), F.lit(0)).alias("hash"), nested.alias("node"),
    )


def blocks_of(leaves: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """(group, block, levels, hash, node) from leaves (group, rank, levels, hash, node)."""
    digits = [f"digit{d}" for d in range(DIGITS)]  # from the last digit to the first
    rows = leaves.withColumns(
        {d: F.pmod(F.floor(F.col("rank") / BASE**at), F.lit(BASE)).cast("int") for at, d in enumerate(digits)}
    )
    rows = rows.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("bigint")).repartition(*group, "block")
    for at, digit in enumerate(digits):
        rows = _grouped_away(rows, [*group, "block", *digits[at + 1 :][::-1]], digit)
    return rows


# --- down ----------------------------------------------------------------------------------


def _siblings(at: Column, node: Column) -> Column:
    """The siblings that lead from child ``at`` to its parent, one per level."""
    steps = [
        F.when(
            node["levels"] > level,
            F.struct(
                (F.shiftright(at, level).bitwiseAND(F.lit(1)) == 1).alias("left"),
                F.get(node["lines"][level], F.shiftright(at, level).bitwiseXOR(F.lit(1))).alias("hash"),
            ),
        )
        for level in range(BASE_LEVELS)
    ]
    return F.filter(F.array(*steps), lambda step: step.isNotNull())


def unnested(blocks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, item, proof): every leaf of the blocks (keep, node, proof) with its whole proof."""
    rows = blocks
    for _ in range(DIGITS):
        rows = rows.select(*keep, "node", "proof", F.posexplode(F.col("node.kids")).alias("at", "kid"))
        rows = rows.select(*keep, F.col("kid").alias("node"), F.concat(_siblings(F.col("at"), F.col("node")), "proof").alias("proof"))
    return rows.withColumnRenamed("node", "item")


def _met(blocks: DataFrame, proofs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, node, proof, subroot): each block with the proof of its hash; they meet by grouping."""
    node = blocks.schema["node"].dataType
    none = F.lit(None)
    both = blocks.select(*keys, "node", none.cast(PROOF).alias("proof"), none.cast("string").alias("subroot")).unionByName(
        proofs.select(*keys, none.cast(node).alias("node"), "proof", "subroot")
    )
    return both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "proof", "subroot")])


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """Staged blocks of each tier; the last has one block per group."""
    most_levels = leaves.agg(F.max("levels")).first()[0] or 0
    tiers = [stage(blocks_of(leaves), "tier")]
    while most_levels > len(tiers) * DIGITS * BASE_LEVELS:
        above = tiers[-1].select(*GROUP, F.col("block").alias("rank"), "levels", "hash", F.struct("block").alias("node"))
        tiers.append(stage(blocks_of(above), "tier"))
    return tiers


def _proved(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(group, subroot, item, proof) of the leaves below ``tiers``, from the proof of each group's hash."""
    proofs = tops.withColumn("block", F.lit(0).cast("bigint"))
    for tier in tiers[::-1]:
        found = unnested(_met(tier, proofs, [*GROUP, "block"]), [*GROUP, "subroot"])
        proofs = found if tier is tiers[0] else found.withColumn("block", F.col("item.block")).drop("item")
    return proofs


# --- the manifest --------------------------------------------------------------------------


def ranked_leaves(rows: DataFrame) -> DataFrame:
    """(group, rank, levels, hash, node) from rows (group, id, hash, item), by id and hash within a group."""
    numbered = numbered_parts(rows, GROUP, [F.col("id").asc_nulls_first(), F.col("hash")])
    offsets = stage(part_offsets(numbered, GROUP), "offsets").withColumnsRenamed({c: f"{c}_o" for c in ("part__", *GROUP)})
    same = numbered["part__"] == offsets["part___o"]
    for name in GROUP:
        same = same & (numbered[name] == offsets[f"{name}_o"])
    joined = numbered.join(offsets, same)  # as many rows as there are parts and groups
    rank = (F.col("before__") + F.col("place__") - 1).cast("bigint")
    return joined.select(*GROUP, rank.alias("rank"), levels_above(F.col("total__")).alias("levels"), "hash", F.col("item").alias("node"))


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf's hash leads to under a proof."""

    def step(hash_: Column, sibling: Column) -> Column:
        other = F.coalesce(sibling["hash"], F.lit(""))
        return F.when(sibling["left"], digest(other, hash_)).otherwise(digest(hash_, other))

    return F.aggregate(proof, start, step)


def manifest(
    docs: DataFrame,
    values: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    altered: Column | None = None,
) -> DataFrame:
    """(id, group, leaf, altered, subroot, root, proof) of every row.

    A leaf is the hash of the row's ``values``. The leaves of a group go by id, rows without an id first,
    rows with one id by their leaf; so the result depends on the rows alone, not on their order. A
    null group is a group of its own and the first. Repeated rows are leaves each, with proofs of their
    own. ``altered`` is another hash of the row to be carried along, null by default. Null values
    differ from empty ones. Columns not in ``values`` are not read. An empty table gives none.
    """
    rows = docs.select(
        F.col(group_col).isNotNull().alias("named"), F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("name"),
        F.col(id_col).alias("id"), leaf(*[F.col(v) for v in values]).alias("hash"),
        (F.lit(None) if altered is None else altered).cast("string").alias("altered"),
    )
    rows = stage(rows, "leaves").withColumn("item", F.struct("id", F.col("hash").alias("leaf"), "altered"))
    tiers = _tiers(stage(ranked_leaves(rows), "ranked"))
    # The subroots are the leaves of one more tree, in a group of its own.
    subroots = tiers[-1].select(
        F.lit(True).alias("named"), F.lit("").alias("name"), F.struct(*GROUP).alias("id"), "hash",
        F.struct(*GROUP, F.col("hash").alias("subroot")).alias("item"),
    )
    top_tiers = _tiers(stage(ranked_leaves(subroots), "subroots"))
    root = (top_tiers[-1].agg(F.max("hash")).first() or [None])[0]
    no_siblings = F.filter(F.array(F.lit(None).cast("struct<left:boolean,hash:string>")), lambda step: step.isNotNull())
    start = top_tiers[-1].select(*GROUP, no_siblings.alias("proof"), F.lit(None).cast("string").alias("subroot"))
    tops = _proved(top_tiers, start).select("item.named", "item.name", "item.subroot", "proof")
    found = _proved(tiers, stage(tops, "groups"))
    return found.select(
        F.col("item.id").alias("id"), F.when(F.col("named"), F.col("name")).alias("group"), F.col("item.leaf").alias("leaf"),
        F.col("item.altered").alias("altered"), "subroot", F.lit(root).cast("string").alias("root"), "proof",
    )
