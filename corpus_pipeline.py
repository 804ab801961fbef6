"""From raw documents to shards of training data, in five stages.

Each stage is a function of (spark, docs, sf_dir) to a DataFrame. All but the last return the
columns of ``docs``; the last adds the shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from walkshed.llm import decontaminate, language_id, mixing, near_copies, sharding
from walkshed.llm.common import read_table, stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, learned from those of ``docs`` that are not held out.

    Null texts and texts without letters go. A text of another language stays, as the one it is most like.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.of_known_language(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 80 % of their five-word shingles, the one with the least doc_id.

    Candidates come from the fingerprint index of SimHash, and from minhash bands beyond its radius.
    """
    return near_copies.first_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard, 0 to 15, of near equal bytes."""
    return sharding.with_shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("SimHash near-dedup on word shingles", near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: Language models and minhashes have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stage(docs, f"stage-{at}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
