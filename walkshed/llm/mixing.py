"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source gets its share of the total by weight. A source whose share is above the most
epochs it may run is clamped there, and the excess goes to the others by weight, until
none is above: with the sources in order of size per weight, the first clamped ones are a
prefix of that order, found with running sums.

A target is met with whole repetitions of all documents and one more of some: those that
come first in a seeded order, up to the words that are missing. The order is by a hash of the id, among
rows of one id, or of none, by a hash of the text, and among rows alike in both by one of their place in
the table. At each of these levels the cut is found by summing hash buckets and then ordering the
distinct hashes of the one bucket per source it falls in, so no level orders a hot group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import WHITE, row_salt, stage

WEIGHTS = (5.0, 2.0, 1.0)
SEED = 17
#: Hex digits of the seeded hash that name a bucket: 4096 buckets for each source.
BUCKET_DIGITS = 3


def word_count(text: str | Column) -> Column:
    """Words of characters other than space and U+0009 to U+000D; null has none."""
    bare = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[ \\t-\\r]+"))).cast("bigint")


def seeded_order(id_col: Column, seed: int) -> Column:
    """Hex digits that put ids in a random order fixed by the seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def _digits(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def levels(id_col: Column, text_hash: Column, salt: Column, seed: int) -> list[Column]:
    """The keys of the order, each deciding among rows that the ones before leave equal."""
    return [seeded_order(id_col, seed), _digits(text_hash), _digits(salt)]


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total_share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """(source, source_size, target) for sizes (source, size), one row per source.

    Weights repeat over the sources by code point, null last. Works on one row per source.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights have to be above 0")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    ranked = sources.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(max_epochs))})
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    clamped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    clamped_weight = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = F.sum("source_size").over(everything) * F.lit(float(total_share))
    level = (total - clamped) / (F.sum("weight").over(everything) - clamped_weight)
    # The level that holds if all before are clamped. It is right at the first source that it does not
    # clamp; clamping more sources than needed lowers it.
    levelled = ranked.withColumn("level", level)
    fits = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    filled = levelled.withColumn("fill", fits)
    target = F.when(F.col("fill").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("fill") * F.col("weight"))
    )
    return filled.select("source", F.coalesce("source_size", F.lit(0)).alias("source_size"), target.alias("target"))


def _crossing(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, at, missing, size) per source: the key at which the words of ``rows`` (source, key, size), added up by
    key, pass ``missing`` of ``wanted`` (source, missing); what is then missing before it, and its words.

    Sources that never pass have no row. Only one bucket of keys per source is ordered.
    """
    keyed = rows.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))

    def passing(sums: DataFrame, by: str) -> DataFrame:
        running = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = sums.withColumn("upto", F.sum("size").over(running))
        return upto.where((F.col("upto") > F.col("missing")) & (F.col("upto") - F.col("size") <= F.col("missing")))

    def with_missing(sums: DataFrame, other: DataFrame, *more: str) -> DataFrame:
        named = other.select(F.col("source").alias("source__"), "missing", *[F.col(c).alias(f"{c}__") for c in more])
        same = F.col("source").eqNullSafe(F.col("source__"))
        for c in more:
            same = same & (F.col(c) == F.col(f"{c}__"))
        return sums.join(named, same).drop("source__", *[f"{c}__" for c in more])

    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    buckets = passing(with_missing(sums, wanted), "bucket").withColumn("missing", F.col("missing") - (F.col("upto") - F.col("size")))
    buckets = stage(buckets.select("source", "bucket", "missing"), "cuts")
    inside = with_missing(keyed, buckets, "bucket").groupBy("source", "key", "missing").agg(F.sum("size").alias("size"))
    left = F.col("missing") - (F.col("upto") - F.col("size"))
    return stage(passing(inside, "key").select("source", F.col("key").alias("at"), left.alias("missing"), "size"), "cuts")


def plan_mix(rows: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per source: its size and target, whole repetitions, and the cut for one more.

    ``rows`` (id, source, size, text_hash, salt) should be staged. Rows whose place in the seeded order is below
    ``cut`` are taken once more. The words taken miss a target by at most half the size of the row at the cut.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = targets.withColumn("whole", whole.cast("bigint"))
    planned = stage(
        planned.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")), "mix"
    )
    keys = levels(F.col("id"), F.col("text_hash"), F.col("salt"), seed)
    tied = rows.select("source", "size", *[k.alias(f"key{n}") for n, k in enumerate(keys)])
    # The rows at the cut of one level are those in which the next one cuts.
    cuts = _crossing(tied.select("source", F.col("key0").alias("key"), "size"), planned)
    cuts = cuts.select("source", F.col("at").alias("cut"), "missing", "size")
    for level in range(1, len(keys)):
        named = cuts.select(F.col("source").alias("source__"), F.col("cut").alias("cut__"))
        before = F.concat(*[F.col(f"key{n}") for n in range(level)])
        at_cut = tied.join(named, F.col("source").eqNullSafe(F.col("source__")) & (before == F.col("cut__")))
        found = _crossing(at_cut.select("source", F.col(f"key{level}").alias("key"), "size"), cuts)
        cuts = found.join(named, F.col("source").eqNullSafe(F.col("source__"))).select(
            "source", F.concat("cut__", "at").alias("cut"), "missing", "size"
        )
    # "~" sorts after all digits: with it the row at the cut is below it.
    below = F.when(F.col("size") / 2 <= F.col("missing"), F.concat("cut", F.lit("~"))).otherwise(F.col("cut"))
    cuts = cuts.select(F.col("source").alias("cut_source"), below.alias("cut"))
    found = planned.join(cuts, planned["source"].eqNullSafe(F.col("cut_source")), "left")
    cut = F.when(F.col("missing") <= 0, F.lit("")).otherwise(F.coalesce("cut", F.lit("~")))
    return stage(found.select("source", "source_size", "target", "whole", cut.alias("cut")), "mix")


def copies(order: list[Column], whole: Column, cut: Column) -> Column:
    """How often the mix takes a row with these keys in the seeded order."""
    return whole + F.when(F.concat(*order) < cut, 1).otherwise(0)


def sized_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, source, size, text_hash, salt), staged: later steps do not read the texts again."""
    return stage(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
            F.xxhash64(text_col).alias("text_hash"), row_salt().alias("salt"),
        ),
        "sizes",
    )


def mix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = WEIGHTS,
    total_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, taken): what a mix takes of every row.

    ``taken`` counts words, repetitions included: never more than ``max_epochs`` (a whole
    number) times the size. Rows without text have size 0 and take nothing; null is a source of
    its own. Repeated rows with one id, or without, count each; the cut may fall among them, of rows alike in
    id and text in any. Runs over the same rows agree. An empty table gives none.
    """
    rows = sized_rows(docs, id_col, source_col, text_col)
    plan = plan_mix(rows, source_targets(rows, weights, total_share, max_epochs), seed)
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["source"]))
    order = levels(F.col("id"), F.col("text_hash"), F.col("salt"), seed)
    taken = F.col("size") * copies(order, F.col("whole"), F.col("cut"))
    return joined.select("id", rows["source"], "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = WEIGHTS,
    total_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its source's target asks for.

    Columns stay as they are. Rows without words are taken like others of their source. Where a second reading
    numbers the rows anew, the cut among rows alike in id and text parts them in near the same proportion.
    """
    rows = sized_rows(docs, id_col, source_col, text_col)
    plan = plan_mix(rows, source_targets(rows, weights, total_share, max_epochs), seed)
    renamed = plan.select(
        F.col("source").alias("source__"), F.col("whole").alias("whole__"), F.col("cut").alias("cut__")
    )
    salted = docs.withColumn("salt__", row_salt())
    joined = salted.join(renamed, F.col(source_col).eqNullSafe(F.col("source__")))
    order = levels(F.col(id_col), F.xxhash64(text_col), F.col("salt__"), seed)
    times = copies(order, F.col("whole__"), F.col("cut__")).cast("int")
    repeated = joined.withColumn("copy__", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
