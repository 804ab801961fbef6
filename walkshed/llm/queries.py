"""The operators of this package over the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkshed.llm import (
    ann, decontaminate, html_extract, language_id, line_dedup, merkle, mixing, pii, prefix_trie, sentence_pieces, sharding, simhash,
    toxicity,
)
from walkshed.llm.common import read_table

#: The public vocabulary of op12.
PIECES = "piece_bpe_32k.model"

#: Words of a text in the normal form of the decontamination, as a list.
_NORMAL_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The common table expression crc(id, value) over a query of ids; DuckDB has no crc32. To follow WITH RECURSIVE.
_CRC32 = """
        bits AS (
            SELECT range AS byte, range AS c, 0 AS k FROM range(256)
            UNION ALL
            SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
        ), steps AS (
            SELECT id, CAST(id AS VARCHAR) AS s, 0 AS pos, 4294967295 AS c FROM ({ids})
            UNION ALL
            SELECT id, s, pos + 1, xor(steps.c >> 8, bits.c)
            FROM steps JOIN bits ON k = 8 AND byte = xor(steps.c, ascii(s[pos + 1])) & 255 WHERE pos < length(s)
        ), crc AS (SELECT id, xor(c, 4294967295) AS value FROM steps WHERE pos = length(s))"""

#: A value as input of a leaf of op13.
_LEAF_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"

ORACLE_SQL = {
    "op3_mixing": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
            FROM d GROUP BY source
        ), fill AS (  -- raise the level until the sources under it take the total
            SELECT 0 AS step, (SELECT 1.5 * sum(source_size) FROM s) / (SELECT sum(weight) FROM s) AS level
            UNION ALL
            SELECT step + 1, (SELECT 1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (2.0 * source_size < level * weight), 0) FROM s)
                             / (SELECT sum(weight) FILTER (2.0 * source_size >= level * weight) FROM s)
            FROM fill
            WHERE step < 100 AND (SELECT count(*) FILTER (2.0 * source_size >= level * weight) FROM s) > 0
        ), t AS (
            SELECT s.*, least(2.0 * source_size, weight * (SELECT max(level) FROM fill)) AS target FROM s
        ), r AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, t.source, floor(t.target / nullif(t.source_size, 0)) AS whole,
                   md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), c AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM r
        )
        SELECT doc_id, size, source_size, target,
               CAST(size * (whole + CASE WHEN before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM c
    """,
    "op7_decontamination": f"""
        WITH w AS (SELECT doc_id, {_NORMAL_WORDS.format("coalesce(text, '')")} AS words FROM documents),
        i AS (SELECT item_id, {_NORMAL_WORDS.format("text")} AS words FROM benchmark WHERE text IS NOT NULL),
        runs AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[p : p + 9], ' ') AS run
            FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS p FROM i WHERE len(words) > 0)
        ),
        lengths AS (SELECT DISTINCT n FROM runs),
        places AS (
            SELECT doc_id, n, p, array_to_string(words[p : p + n - 1], ' ') AS run
            FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS p FROM w, lengths WHERE len(words) >= n)
        ),
        found AS (SELECT doc_id, p, places.n, item_id FROM places JOIN runs USING (run, n)),
        hit AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS word FROM found) GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_prefix_trie": f"""
        WITH RECURSIVE {_CRC32.format(ids="SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL")},
        t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos FROM t
        ), c AS (SELECT id, value % 6 AS h, id - id % 100 AS base FROM crc),
        parts AS (
            SELECT c.id, 0 AS own, o.pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
            UNION ALL
            SELECT c.id, 1, o.pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.id AND o.pos > c.h
        ), turns AS (
            SELECT id, text, md5(length(role) || ':' || role || text) AS code, row_number() OVER (PARTITION BY id ORDER BY own, pos) AS depth FROM parts
        ), paths AS (
            SELECT id, depth, length(text) AS n,
                   md5(string_agg(code, ',') OVER (PARTITION BY id ORDER BY depth)) AS key
            FROM turns
            UNION ALL
            SELECT id, 0, 0, '' FROM c
        ), up AS (
            SELECT *, lag(key) OVER (PARTITION BY id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY id) AS last FROM paths
        ), nodes AS (
            SELECT depth, key, any_value(parent) AS parent, any_value(n) AS n, min(id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (last), '')) AS ends_sha256
            FROM up GROUP BY depth, key
        ), kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        below AS (  -- each node under all nodes over it, by the path of its smallest member
            SELECT u.depth, u.key, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.n) AS saved
            FROM nodes x JOIN up u ON u.id = x.conv_id AND u.depth <= x.depth LEFT JOIN kids k ON k.depth = x.depth AND k.key = x.key
            GROUP BY u.depth, u.key
        )
        SELECT CAST(x.conv_id AS BIGINT) AS conv_id, CAST(x.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n_convs,
               coalesce(k.n_children, 0) AS n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, x.ends_sha256
        FROM nodes x JOIN below b ON b.depth = x.depth AND b.key = x.key
        LEFT JOIN kids k ON k.depth = x.depth AND k.key = x.key
        LEFT JOIN nodes p ON p.depth = x.depth - 1 AND p.key = x.parent
    """,
    "op13_merkle": f"""
        WITH RECURSIVE {_CRC32.format(ids="SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL")},
        f AS (
            SELECT doc_id, lang, coalesce(crc.value % 7 = 0, false) AS hit,
                   {_LEAF_FIELD.format("doc_id")} || {_LEAF_FIELD.format("source")} || {_LEAF_FIELD.format("lang")} AS head,
                   {_LEAF_FIELD.format("n_chars")} AS n, {_LEAF_FIELD.format("n_chars + 1")} AS n_altered, {_LEAF_FIELD.format("text")} AS tail
            FROM documents LEFT JOIN crc ON crc.id = doc_id
        ), l AS (
            SELECT *, sha256(head || n || tail) AS leaf, sha256(head || CASE WHEN hit THEN n_altered ELSE n END || tail) AS start FROM f
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM l
        ), tree AS (  -- all levels of all groups; nodes by rank
            SELECT lang, 0 AS level, rank, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM r
            UNION ALL
            SELECT lang, level + 1, rank // 2, sha256(string_agg(hash, '' ORDER BY rank)), (any_value(n) + 1) // 2
            FROM tree WHERE n > 1 GROUP BY lang, level, rank // 2
        ), s AS (
            SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM tree WHERE n = 1
        ), top AS (
            SELECT 0 AS level, rank, subroot AS hash, count(*) OVER () AS n FROM s
            UNION ALL
            SELECT level + 1, rank // 2, sha256(string_agg(hash, '' ORDER BY rank)), (any_value(n) + 1) // 2
            FROM top WHERE n > 1 GROUP BY level, rank // 2
        ), way AS (  -- up from the leaf; the proof so far, and the hash so far
            SELECT r.doc_id, r.lang, r.leaf, 0 AS level, r.rank, r.start AS done, '' AS proof, r.rank AS leaf_rank FROM r
            UNION ALL
            SELECT w.doc_id, w.lang, w.leaf, w.level + 1, w.rank // 2,
                   CASE WHEN o.rank < w.rank THEN sha256(o.hash || w.done) ELSE sha256(w.done || coalesce(o.hash, '')) END,
                   w.proof || coalesce(o.hash, ''), w.leaf_rank
            FROM way w
            JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND t.rank = w.rank AND t.n > 1
            LEFT JOIN tree o ON o.lang IS NOT DISTINCT FROM w.lang AND o.level = w.level AND o.rank = xor(w.rank, 1::BIGINT)
        ), whole AS (
            SELECT w.*, s.subroot, s.rank AS top_rank
            FROM way w JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND t.n = 1
            JOIN s ON s.lang IS NOT DISTINCT FROM w.lang
        ), up AS (
            SELECT doc_id, leaf, subroot, 0 AS level, top_rank AS rank, done, proof, lang, leaf_rank FROM whole
            UNION ALL
            SELECT u.doc_id, u.leaf, u.subroot, u.level + 1, u.rank // 2,
                   CASE WHEN o.rank < u.rank THEN sha256(o.hash || u.done) ELSE sha256(u.done || coalesce(o.hash, '')) END,
                   u.proof || coalesce(o.hash, ''), u.lang, u.leaf_rank
            FROM up u
            JOIN top t ON t.level = u.level AND t.rank = u.rank AND t.n > 1
            LEFT JOIN top o ON o.level = u.level AND o.rank = xor(u.rank, 1::BIGINT)
        )
        SELECT u.doc_id, u.leaf, u.subroot, t.hash AS root, sha256(u.proof) AS proof_sha256, u.done AS folded_root, u.done = t.hash AS verified
        FROM up u JOIN top t ON t.level = u.level AND t.n = 1
    """,
    "op9_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), often AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
            SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.keeper AS dropped FROM k LEFT JOIN often o ON k.key = o.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        found["id"].alias("doc_id"), simhash.hex16("fp").alias("fingerprint"), found["component"].alias("component_id")
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(read_table(spark, sf_dir, "pages")).withColumnRenamed("main__", "text")
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    found = mixing.mix_counts(read_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").drop("source")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    found = toxicity.train_and_score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


#: For the test tables only; a real key is a secret of whoever runs the job.
PII_KEY = "key of the test tables"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by pseudonyms."""
    found = pii.pseudonymise(read_table(spark, sf_dir, "documents"), PII_KEY)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("pseudo_text").alias("text"),
        F.size("found").cast("bigint").alias("n_replaced"),
        F.col("found").alias("replaced"),
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every 50th one."""
    found = ann.nearest_of_some(read_table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    item_ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(item_ids.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    found = sharding.assign_shards(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that many documents repeat."""
    found = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", digest)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language_id.train_and_predict(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tree of the rebuilt conversations."""
    c = F.col("c")
    shared = F.pmod(F.crc32(c.cast("string")), F.lit(6))
    found = prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), h=shared, base=c - c % 100)
    counts = [F.col(n).cast("bigint").alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    return found.select("conv_id", "depth", "parent_conv_id", *counts, "ends_sha256")


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under a public vocabulary, and the text they decode to."""
    found = sentence_pieces.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "agrees",
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a Merkle tree, and what becomes of the proofs of altered ones."""
    docs = read_table(spark, sf_dir, "documents")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    others = [F.col(c) for c in ("doc_id", "source", "lang")]
    altered = F.when(hit, merkle.leaf(*others, F.col("n_chars") + 1, F.col("text")))
    found = merkle.manifest(docs, altered=altered)
    siblings = F.array_join(F.filter(F.col("proof.hash"), lambda h: h.isNotNull()), "")
    root = merkle.folded(F.coalesce("altered", "leaf"), F.col("proof"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.digest(siblings).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


REGISTERED = (
    op1_simhash,
    op2_html_extraction,
    op3_mixing,
    op4_toxicity,
    op5_pii,
    op6_nearest,
    op7_decontamination,
    op8_sharding,
    op9_line_dedup,
    op10_language_id,
    op11_prefix_trie,
    op12_sentence_pieces,
    op13_merkle,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in REGISTERED}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
