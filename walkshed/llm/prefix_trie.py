"""The prefix tree of conversations, aggregated from whole sequences.

A turn is known by a 128-bit hash, and a prefix by the exclusive or of the hashes of its turns, each
bound to its position: a running aggregate, so that a conversation is never gathered in one place.
Identical conversations collapse to one weighted sequence with the list of conversations that end
there. Sequences that are proper prefixes of others are dropped by an anti-join; what is left are the
leaves. Every prefix of every sequence is then aggregated once with its weight.

Sums over a subtree need no walk over the tree. A node's text counts once in the subtree of each node
above it; the node is charged to the sequence of its smallest member, which passes through all of these.
The nodes charged to a sequence are the end of its path, so their sum below a depth is known from where
that end begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import stage
from walkshed.llm.ranks import numbered_parts, part_offsets

#: Turns of a conversation that are kept together, and the most first turns that a prefix is rebuilt from.
BLOCK = 4096
#: Ids joined to one text before a digest is made of many of them.
IDS_AT_ONCE = 1 << 14
#: A parent with more than this part of all sequences below it is joined apart; there are fewer of them than this.
HOT_PARENTS = 1000


def slim_turns(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(c, turn, code, n): conversation, position, 128-bit hash of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    code = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where(F.col(id_col).isNotNull())
    return rows.select(
        F.col(id_col).cast("bigint").alias("c"), F.col(turn_col).alias("turn"), code.alias("code"),
        F.char_length(text).cast("bigint").alias("n"),
    )


def positioned(slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, pos, code, n) with positions from 1, by turn (null first) and hash; and (c, n_own) per conversation."""
    numbered = numbered_parts(slim, ["c"], [F.col("turn").asc_nulls_first(), F.col("code")])
    offsets = stage(part_offsets(numbered, ["c"]), "offsets")
    # A conversation goes on into a further part only as the first of that part: at most one row per part.
    later = offsets.where("before__ > 0").select(F.col("part__").alias("p"), F.col("c").alias("c2"), "before__")
    same = (F.col("part__") == F.col("p")) & (F.col("c") == F.col("c2"))
    pos = F.coalesce("before__", F.lit(0)) + F.col("place__")
    placed = numbered.join(F.broadcast(later), same, "left").select("c", pos.cast("bigint").alias("pos"), "code", "n")
    return placed, offsets.groupBy("c").agg(F.max("total__").alias("n_own"))


def _lanes(pos: Column, code: Column) -> list[Column]:
    return [F.xxhash64(F.lit(lane), pos, code) for lane in (1, 2)]


def rebuilt(placed: DataFrame, own: DataFrame, h: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations as paths and ends, both staged.

    Conversation ``c`` is rebuilt from the first ``h`` turns of conversation ``base`` and its own after
    its first ``h``; ``h`` and ``base`` are columns over ``c``, and ``h`` is at most ``most``.

    Paths (c, block, depth, k1, k2, p1, p2, n, upto): one row per turn, keyed by its prefix and its parent's,
    with the code points up to it. Ends (c, depth, k1, k2, total): one row per conversation.
    """
    firsts = placed.where(F.col("pos") <= most).groupBy("c").agg(
        F.array_sort(F.collect_list(F.struct("pos", "code", "n"))).alias("firsts")  # at most ``most`` turns
    )
    taken = firsts.withColumnRenamed("c", "base")
    convs = own.withColumns({"h": h.cast("int"), "base": base}).join(taken, "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("firsts", F.expr("array()").cast(taken.schema["firsts"].dataType)), F.lit(1), F.col("h")))
    convs = convs.withColumn("shift", F.size("head") - F.col("h"))
    zero = F.struct(F.lit(0).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2"), F.lit(0).cast("bigint").alias("upto"))

    def add(a: Column, t: Column) -> Column:
        x1, x2 = _lanes(t["pos"], t["code"])
        return F.struct(
            a["k1"].bitwiseXOR(x1).alias("k1"), a["k2"].bitwiseXOR(x2).alias("k2"), (a["upto"] + t["n"]).alias("upto")
        )

    convs = convs.withColumn("at_head", F.aggregate("head", zero, add)).drop("firsts")
    convs = stage(convs, "conversations")

    heads = convs.select("c", F.explode("head").alias("t"), F.slice("head", F.lit(1), F.col("t.pos").cast("int")).alias("part"))
    heads = heads.withColumn("at", F.aggregate("part", zero, add))
    x1, x2 = _lanes(F.col("t.pos"), F.col("t.code"))
    heads = heads.select(
        "c", F.col("t.pos").alias("depth"), "at.k1", "at.k2", x1.alias("x1"), x2.alias("x2"), F.col("t.n").alias("n"), "at.upto"
    )

    # Own turns: blocks of a conversation meet its row, then run within the block.
    block = F.floor(F.col("pos") / BLOCK).cast("bigint")
    blocks = convs.where("n_own > h").select(
        F.col("c").alias("c2"), "h", "shift", "at_head", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("n_own") / BLOCK).cast("bigint"))).alias("block2")
    )
    rest = placed.withColumn("block", block).join(blocks, (F.col("c") == F.col("c2")) & (F.col("block") == F.col("block2")))
    rest = rest.where("pos > h").withColumn("depth", F.col("pos") + F.col("shift"))
    x1, x2 = _lanes(F.col("depth"), F.col("code"))
    rest = rest.select("c", "block", "at_head", "depth", x1.alias("x1"), x2.alias("x2"), "n")
    run = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = rest.withColumns({"k1": F.bit_xor("x1").over(run), "k2": F.bit_xor("x2").over(run), "upto": F.sum("n").over(run)})
    rest = stage(rest, "own-turns")
    # What the earlier blocks of a conversation add; none for conversations of one block.
    sums = rest.groupBy("c", "block").agg(*[F.bit_xor(x).alias(x) for x in ("x1", "x2")], F.sum("n").alias("n"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("c", "block", *[F.bit_xor(x).over(earlier).alias(f"{x}_b") for x in ("x1", "x2")], F.sum("n").over(earlier).alias("n_b"))
    before = stage(before.where("n_b is not null"), "block-sums").withColumnsRenamed({"c": "c2", "block": "block2"})
    joined = rest.join(before, (F.col("c") == F.col("c2")) & (F.col("block") == F.col("block2")), "left")

    def whole(run_: str, sum_: str, head: str) -> Column:
        return F.col(run_).bitwiseXOR(F.coalesce(sum_, F.lit(0))).bitwiseXOR(F.col(f"at_head.{head}")).alias(run_)

    upto = F.col("upto") + F.coalesce("n_b", F.lit(0)) + F.col("at_head.upto")
    own_turns = joined.select("c", "depth", whole("k1", "x1_b", "k1"), whole("k2", "x2_b", "k2"), "x1", "x2", "n", upto.alias("upto"))
    both = heads.unionByName(own_turns)
    paths = stage(
        both.select("c", F.floor(F.col("depth") / BLOCK).cast("bigint").alias("block"), "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "n", "upto"),
        "paths",
    )
    # The last turn: of the own turns if any are left, else of the head.
    totals = sums.groupBy("c").agg(*[F.bit_xor(x).alias(x) for x in ("x1", "x2")], F.sum("n").alias("n")).withColumnRenamed("c", "c2")
    ends = convs.join(totals, F.col("c") == F.col("c2"), "left").select(
        "c", (F.size("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).cast("bigint").alias("depth"),
        *[F.col(f"at_head.k{lane}").bitwiseXOR(F.coalesce(f"x{lane}", F.lit(0))).alias(f"k{lane}") for lane in (1, 2)],
        (F.col("at_head.upto") + F.coalesce("n", F.lit(0))).alias("total"),
    )
    return paths, stage(ends, "ends")


def id_digests(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys, ends_sha256): SHA-256 of the ids of each group, ascending, in decimal, comma-joined.

    Ids are put in order and joined to texts of many ids in parallel, also within a group. The digest
    of a group runs over these texts in one task, one text at a time, as SHA-256 takes its input in order.
    """
    kinds = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring rows of one group as one row: the least id, and the ids as text."""
        out, group, ids = [], None, []

        def close() -> None:
            if ids:
                out.append((*group, ids[0], ",".join(map(str, ids))))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "first", "ids"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                if row[:-1] != group or len(ids) >= IDS_AT_ONCE:
                    close()
                    group, ids = row[:-1], []
                ids.append(row[-1])
            if len(out) >= IDS_AT_ONCE:
                yield flush()
                out = []
        close()
        if out:
            yield flush()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, running, out = None, None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *key, _, ids in zip(*columns):
                if key != group:
                    if group is not None:
                        out.append((*group, running.hexdigest()))
                    group, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if len(out) >= IDS_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*keys, "ends_sha256"])
                out = []
        if group is not None:
            out.append((*group, running.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*keys, "ends_sha256"])

    ordered = rows.select(*keys, F.col(id_col).cast("bigint").alias("id")).repartitionByRange(*keys, "id").sortWithinPartitions(*keys, "id")
    texts = ordered.mapInArrow(joined, ", ".join([*kinds, "first bigint", "ids string"]))
    return texts.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digested, ", ".join([*kinds, "ends_sha256 string"]))


NODE = ["depth", "k1", "k2"]


def _parents(nodes: DataFrame) -> DataFrame:
    """(depth, k1, k2, n_children, parent_conv_id) of every node; the root's parent is null.

    Nodes that have the conversation of their parent know it. The others meet their parent in a join, those
    of parents with a great part of all nodes below them by a broadcast of these few.
    """
    up = nodes.where("depth > 0")
    children = up.groupBy((F.col("depth") - 1).alias("d"), F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("n_children"))
    children = stage(
        nodes.select(*NODE, "conv_id").join(children, (F.col("depth") == F.col("d")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
        .select(*NODE, "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children")),
        "children",
    )
    n_nodes = children.count()
    parents = children.where("n_children > 0").select((F.col("depth") + 1).alias("d"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = parents.where(F.col("n_children") * HOT_PARENTS >= n_nodes).drop("n_children")  # at most HOT_PARENTS rows
    hot = stage(hot, "hot-parents")
    on = (F.col("depth") == F.col("d")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2"))
    slim = up.select(*NODE, "p1", "p2")
    near_hot = slim.join(F.broadcast(hot), on, "left").drop("d", "q1", "q2")
    by_hot = near_hot.where(F.col("parent_conv_id").isNotNull()).select(*NODE, "parent_conv_id")
    rest = near_hot.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id")
    by_rest = rest.join(parents.where(F.col("n_children") * HOT_PARENTS < n_nodes), on).select(*NODE, "parent_conv_id")
    known = by_hot.unionByName(by_rest).withColumnsRenamed({"depth": "d", "k1": "q1", "k2": "q2"})
    mine = (F.col("depth") == F.col("d")) & (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2"))
    return children.join(known, mine, "left").select(*NODE, "n_children", "parent_conv_id")


def trie(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per distinct prefix, from what ``rebuilt`` returns.

    Columns: depth, k1, k2 (the prefix's key), conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.
    """
    sequences = stage(
        ends.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.count("*").alias("weight"), F.first("total").alias("total")), "sequences"
    )
    # The rows of a sequence are those of its first conversation; one row per block of its path, and the root.
    last_block = F.floor(F.col("depth") / BLOCK).cast("bigint")
    blocks = sequences.select(
        F.col("conv_id").alias("c2"), F.col("depth").alias("length"), "weight", "total",
        F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block2"),
    )
    here = (F.col("c") == F.col("c2")) & (F.col("block") == F.col("block2"))
    zero = F.lit(0).cast("bigint")
    steps = paths.join(blocks, here).select("c", "block", *NODE, "p1", "p2", "n", "upto", "length", "weight", "total")
    roots = sequences.select(
        F.col("conv_id").alias("c"), zero.alias("block"), zero.alias("depth"), *[zero.alias(k) for k in ("k1", "k2", "p1", "p2", "n", "upto")],
        F.col("depth").alias("length"), "weight", "total",
    )
    steps = stage(steps.unionByName(roots).withColumn("below", F.col("total") - F.col("upto") + F.col("n")), "steps")
    nodes = stage(
        steps.groupBy(*NODE).agg(
            F.min("c").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max(F.col("length") > F.col("depth")).alias("inner"),
            F.first("n").alias("n"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        ),
        "nodes",
    )
    leaves = sequences.select(*NODE, F.col("conv_id").alias("leaf")).join(nodes.where("inner").select(*NODE), NODE, "left_anti").select("leaf")
    # A sequence that ends on the path of one with a smaller conversation is charged with nothing.
    charged = nodes.groupBy("conv_id").agg(F.min("depth").alias("since"), F.sum("n").alias("charge"))
    told = sequences.select("conv_id", last_block.alias("last")).join(charged, "conv_id", "left")
    told = told.join(leaves, F.col("conv_id") == F.col("leaf"), "left").select(
        F.col("conv_id").alias("c2"), F.coalesce("since", (F.col("last") + 1) * BLOCK).alias("since"), F.coalesce("charge", zero).alias("charge"),
        F.col("leaf").isNotNull().cast("bigint").alias("is_leaf"), F.explode(F.sequence(zero, F.col("last"))).alias("block2"),
    )
    told = stage(told, "charges")
    counted = steps.join(told, here).groupBy(*NODE).agg(
        F.sum("is_leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("below") - F.when(F.col("depth") >= F.col("since"), F.col("below")).otherwise(F.col("charge"))).alias("saved_tokens"),
    )
    ended = id_digests(ends, NODE, "c")
    found = nodes.select(*NODE, "conv_id", "n_convs").join(counted, NODE).join(_parents(nodes), NODE).join(ended, NODE, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return found.select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256")
    )


def conversation_trie(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    h: Column | None = None, base: Column | None = None, most: int = 5,
) -> DataFrame:
    """The prefix tree of rebuilt conversations, one row per node; see ``rebuilt`` and ``trie`` for parameters and columns.

    Turns go by turn number, null first; of turns with one number the order of the MD5 of role
    length, role and text decides. Repeated turns count each. A null role or text is empty. Turns without
    a conversation id are left out. Conversations without turns are members of the root. An
    empty table gives none, not even a root. Without ``h`` conversations are taken as they are.
    """
    placed, own = positioned(slim_turns(turns, id_col, turn_col, role_col, text_col))
    no_h = F.lit(0) if h is None else h
    paths, ends = rebuilt(placed, own, no_h, F.col("c") if base is None else base, most)
    return trie(paths, ends)
