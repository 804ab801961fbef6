"""Shards of near equal bytes by sampled splitters.

Records are ordered by a hash of their text, then by id, so that equal texts are neighbours; rows
that share both are ordered by a hash of their place in the table, so that they can be divided too.
A sample drawn with probability in proportion to size gives quantile boundaries (splitters);
records are partitioned into the ranges between them. A range that turns out overfull is
divided again by a sample of its own.

Sums over the ranges say in which range each shard border falls; only there are single
records looked at. A border moves to the next edge between different texts if sizes stay
within ``tolerance``; a group of equal texts too large for that is divided by id, and rows of one id, or of none, by their place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import row_salt, stage

SEED = 23
#: Sampled keys per range, records aimed at per range, and the least and most ranges.
PER_RANGE, RANGE_ROWS, MIN_RANGES, MAX_RANGES = 32, 100_000, 64, 16_384
#: A range is overfull above so many times the mean bytes or rows; rounds of subdividing.
OVERFULL, ROUNDS = 3, 4
#: How far a border may move to an edge between texts, as a part of a shard's bytes.
TOLERANCE = 0.01

Key = tuple[int, int, int]
KEYS, KEY = ("h", "k", "t"), "struct<h:bigint,k:bigint,t:bigint>"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def slim_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, k, t, size, text_crc32), staged. ``h``, ``k``, ``t`` is the key; a null id has the least ``k``."""
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return stage(
        docs.select(
            F.col(id_col).alias("id"), *key_columns(docs, id_col, text_col), size.alias("size"), crc.alias("text_crc32")
        ),
        "slim",
    )


def key_columns(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The key that puts equal texts side by side: a hash of the text, then the id, then one of the row's place.

    The last one tells apart only rows alike in text and id. Even where a second reading numbers the
    rows anew, a border in such a group parts it in the same proportion.
    """
    return [
        F.xxhash64(docs[text_col]).alias("h"),
        F.coalesce(docs[id_col].cast("bigint"), F.lit(LEAST)).alias("k"),
        row_salt().alias("t"),
    ]


def _named(key: Key) -> dict[str, int]:
    return dict(zip(KEYS, key))


def _literal(keys: list, kind: str) -> Column:
    """Keys as one constant: thousands of single literals would make a slow plan."""
    return F.from_json(F.lit(json.dumps(keys)), kind)


def _at_most(keys: list[Key], key: Column) -> Column:
    """How many of the sorted keys are at most ``key``: a search over blocks, then in one block."""
    if not keys:
        return F.lit(0)
    width = max(1, round(len(keys) ** 0.5))
    blocks = [keys[i : i + width] for i in range(0, len(keys), width)]
    firsts = _literal([_named(b[0]) for b in blocks], f"array<{KEY}>")
    block = F.size(F.filter(firsts, lambda first: first <= key))
    every = _literal([[_named(k) for k in b] for b in blocks], f"array<array<{KEY}>>")
    inside = F.element_at(every, F.greatest(block, F.lit(1)))
    return F.when(block == 0, 0).otherwise(
        (block - 1) * width + F.size(F.filter(inside, lambda at: at <= key))
    )


def range_of(splitters: list[Key]) -> Column:
    """The number of the range of a row with the key columns."""
    return _at_most(splitters, F.struct(*KEYS)).cast("int")


def _drawn(rows: DataFrame, wanted: Column, weight: Column) -> DataFrame:
    """Keys drawn by a seeded hash with probability wanted x weight: the same ones in every run."""
    unit = F.pmod(F.xxhash64(F.lit(SEED), *KEYS), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(unit < wanted * weight)


def sample_splitters(rows: DataFrame, total_bytes: int, ranges: int) -> list[Key]:
    """Quantile boundaries of a size-weighted sample of ``PER_RANGE`` keys per range."""
    drawn = _drawn(rows, F.lit(float(PER_RANGE * ranges)), F.col("size") / F.lit(float(max(total_bytes, 1))))
    placed = drawn.withColumn("place", F.row_number().over(Window.orderBy(*KEYS)))
    found = placed.where(F.pmod(F.col("place"), F.lit(PER_RANGE)) == 0).select(*KEYS).distinct()
    return sorted(map(tuple, found.collect()))


def _range_sums(rows: DataFrame, splitters: list[Key]) -> DataFrame:
    """Bytes, rows and key bounds of each range that holds records."""
    key = F.struct(*KEYS)
    return rows.groupBy(range_of(splitters).alias("range")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )


def find_splitters(rows: DataFrame, total_bytes: int, n_rows: int) -> list[Key]:
    """Splitters for ranges of which none is overfull."""
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-n_rows // RANGE_ROWS)))
    splitters = sample_splitters(rows, total_bytes, ranges)
    most_bytes, most_rows = OVERFULL * total_bytes / ranges, OVERFULL * max(n_rows / ranges, 1)
    for _ in range(ROUNDS):
        sums = _range_sums(rows, splitters)
        over = (F.col("low") != F.col("high")) & ((F.col("bytes") > most_bytes) | (F.col("n") > most_rows))
        full = sums.where(over).withColumn("n_ranges", F.count("*").over(Window.partitionBy(F.lit(0))))
        full = full.select("range", "bytes", "n").collect()  # at most as many as there are ranges
        if not full:
            break
        numbered = rows.withColumn("range", range_of(splitters))
        parts = numbered.where(F.col("range").isin([r["range"] for r in full]))
        limits = F.create_map(*[x for r in full for x in (F.lit(r["range"]), F.lit(float(r["n"])))])
        # Within an overfull range every record counts alike, so that many small ones are divided too.
        drawn = _drawn(parts, F.lit(float(8 * PER_RANGE)), 1 / F.element_at(limits, F.col("range")))
        by_key = Window.partitionBy("range").orderBy(*KEYS)
        placed = drawn.withColumn("place", F.row_number().over(by_key))
        more = placed.where(F.pmod(F.col("place"), F.lit(PER_RANGE)) == 0).select(*KEYS).distinct().collect()
        before = len(splitters)
        splitters = sorted({*splitters, *map(tuple, more)})
        if len(splitters) == before:
            break
    return splitters


@dataclass(frozen=True)
class ShardPlan:
    """Splitters of the ranges, and the first key of every shard but shard 0."""

    shards: int
    splitters: list[Key]
    borders: list[Key]

    def shard(self) -> Column:
        """The shard of a row with the key columns."""
        return _at_most(self.borders, F.struct(*KEYS)).cast("int")


def plan_shards(rows: DataFrame, shards: int = 16, tolerance: float = TOLERANCE) -> ShardPlan:
    """Borders that give each shard near equal bytes, from staged rows (h, k, t, size).

    A shard's bytes differ from the mean by at most twice ``tolerance`` and one record.
    """
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    if not n_rows:
        return ShardPlan(shards, [], [])
    splitters = find_splitters(rows, total, n_rows)
    by_range = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = _range_sums(rows, splitters).withColumn("start", F.coalesce(F.sum("bytes").over(by_range), F.lit(0)))
    aims = [total * i / shards for i in range(1, shards)]
    aimed = F.array(*[F.lit(a) for a in aims]) if aims else F.expr("cast(array() as array<double>)")
    inside = F.filter(aimed, lambda a: (a >= F.col("start")) & (a < F.col("start") + F.col("bytes")))
    hit = starts.where(F.size(inside) > 0).select("range", "start").collect()  # at most one per border
    if not hit:
        return ShardPlan(shards, splitters, [])
    # Only ranges with a border in them, or next to it, are looked at record by record.
    start_of = F.create_map(*[x for r in hit for x in (F.lit(r["range"]), F.lit(r["start"]))])
    numbered = rows.withColumn("range", range_of(splitters))
    near = numbered.where(F.col("range").isin([r["range"] for r in hit]))
    upto = Window.partitionBy("range").orderBy(*KEYS).rowsBetween(Window.unboundedPreceding, -1)
    placed = near.withColumn(
        "at", F.element_at(start_of, F.col("range")) + F.coalesce(F.sum("size").over(upto), F.lit(0))
    )
    # The record over which the bytes reach the aim: it starts the next shard or ends this one.
    aim = F.explode(F.filter(aimed, lambda a: (a >= F.col("at")) & (a < F.col("at") + F.col("size"))))
    crossing = placed.select(*KEYS, "at", "size", aim.alias("aim")).collect()
    groups = sorted({r.h for r in crossing})
    bounds = [
        F.coalesce(F.sum(F.when(under, F.col("size"))), F.lit(0))
        for h in groups
        for under in (F.col("h") < h, F.col("h") <= h)
    ]
    found = rows.agg(*bounds).first() if groups else ()
    extent = {h: (found[2 * i], found[2 * i + 1]) for i, h in enumerate(groups)}
    allowed = tolerance * total / shards
    borders = []
    for r in sorted(crossing, key=lambda r: r.aim):
        first, last = extent[r.h]
        edges = [e for e in (first, last) if abs(e - r.aim) <= allowed]
        if edges:
            edge = min(edges, key=lambda e: abs(e - r.aim))
            borders.append((r.h, LEAST, LEAST) if edge == first else (r.h, MOST, MOST))
        else:
            after = r.aim - r.at > r.size / 2 and r.t < MOST
            borders.append((r.h, r.k, r.t + after))
    return ShardPlan(shards, splitters, sorted(borders))


def assign_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, tolerance: float = TOLERANCE
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): every row's shard and its place there.

    Size is the text's UTF-8 bytes plus 1; a null text counts as none. Slots count from 0
    without gaps. Equal texts are in one shard unless that would make shards uneven. Rows without an
    id come first among equal texts; they and repeated rows are divided like others. An empty table gives none.
    """
    rows = slim_rows(docs, id_col, text_col)
    plan = plan_shards(rows, shards, tolerance)
    placed = rows.withColumns({"shard": plan.shard(), "range": range_of(plan.splitters)})
    parts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        parts.select(
            F.col("shard").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
        ),
        "slots",
    )
    in_part = Window.partitionBy("shard", "range").orderBy(*KEYS)
    numbered = placed.withColumn("place", F.row_number().over(in_part) - 1)
    joined = numbered.join(F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("range") == F.col("r")))
    return joined.select(
        "id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("bigint").alias("slot")
    )


def with_shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, name: str = "shard"
) -> DataFrame:
    """``docs`` with the shard of each row as another column, decided row by row from the borders."""
    rows = slim_rows(docs, id_col, text_col)
    plan = plan_shards(rows, shards)
    own = [f"{key}__" for key in KEYS]
    keyed = docs.withColumns(dict(zip(own, key_columns(docs, id_col, text_col))))
    shard = _at_most(plan.borders, F.struct(*[F.col(c).alias(key) for c, key in zip(own, KEYS)])).cast("int")
    return keyed.withColumn(name, shard).drop(*own)
