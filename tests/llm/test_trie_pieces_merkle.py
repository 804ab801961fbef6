"""The prefix trie, SentencePiece and Merkle operators against brute force, and on odd rows."""

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from walkshed.llm import merkle, prefix_trie, queries, ranks, sentence_pieces

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- conversations -------------------------------------------------------------------------

TURN = "conv_id bigint, turn bigint, role string, text string, c bigint, depth int, n string, key string, h int"


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y", 3) for r in rows], TURN)


def brute_trie(rows):
    """One dict per node, from (conv_id, turn, role, text)."""

    def code(t):
        return hashlib.md5(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest()

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: (x[0], code(x[1])))] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    nodes = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes[ts[:d]].append(c)
    out = {}
    for key, members in nodes.items():
        under = [k for k in nodes if k[: len(key)] == key]
        kids = [k for k in under if len(k) == len(key) + 1]
        out[min(members), len(key)] = (
            min(nodes[key[:-1]]) if key else None, len(members), len(kids),
            sum(not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in under) for k in under),
            sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in under if k),
            sha(",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(key)))),
        )
    return out


def found_trie(df):
    h = F.pmod(F.crc32(F.col("c").cast("string")), F.lit(6))
    rows = prefix_trie.conversation_trie(df, h=h, base=F.col("c") - F.col("c") % 100).collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


class TestTrie:
    def made(self, seed, n=60, base=0):
        draw, rows = random.Random(seed), []
        for c in range(base, base + n):
            for t in range(draw.choice([1, 2, 3, 4, 7, 9])):
                rows.append((c, t, draw.choice(["user", "bot", None]), draw.choice(["a", "bb", "", None, "\u00e9\U0001d4b3"])))
        return rows

    @pytest.mark.parametrize("seed", [1, 2])
    def test_as_brute_force(self, spark, seed, monkeypatch):
        monkeypatch.setattr(prefix_trie, "BLOCK", 3)  # conversations of several blocks
        monkeypatch.setattr(prefix_trie, "HOT_PARENTS", 3)
        monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 4)
        rows = self.made(seed, base=100) + self.made(seed + 10, 30, base=1230)
        assert found_trie(turns_table(spark, rows).repartition(5)) == brute_trie(rows)

    def test_identical_conversations_and_one_long_one(self, spark):
        long = [(7, t, "user", f"turn {t}") for t in range(3000)]
        same = [(1000 + c, t, "user", "hello") for c in range(150) for t in range(3)]
        rows = long[:40] + same
        assert found_trie(turns_table(spark, rows)) == brute_trie(rows)
        found = found_trie(turns_table(spark, long))
        assert len(found) == 3001 - max(0, zlib.crc32(b"7") % 6) and max(d for _, d in found) == len(found) - 1

    def test_odd_rows(self, spark):
        rows = [
            (None, 0, "user", "no conversation"), (5, None, "user", "null first"), (5, 1, None, None), (5, 1, None, None),
            (5, 1, "user", "tie a"), (5, 1, "user", "tie b"), (5, 2, "user", "x" * 200_000), (-3, 0, "user", "negative"), (108, 0, "user", "base is absent"),
        ]
        df = turns_table(spark, rows)
        assert found_trie(df) == brute_trie(rows)
        assert prefix_trie.conversation_trie(df.where("1 = 0")).count() == 0
        plain = {(r.conv_id, r.depth): r.n_convs for r in prefix_trie.conversation_trie(df).collect()}
        assert plain[-3, 0] == 3 and plain[5, 6] == 1  # taken as they are

    def test_ranks_of_a_group_in_many_parts(self, spark):
        df = spark.range(500).select(F.lit(1).alias("g"), F.lit(7).alias("v"))
        numbered = ranks.numbered_parts(df, ["g"], [F.col("v")])
        offsets = ranks.part_offsets(numbered, ["g"]).withColumnRenamed("part__", "p")
        joined = numbered.join(offsets, F.col("part__") == F.col("p"))
        found = sorted(r[0] for r in joined.select(F.col("before__") + F.col("place__")).collect())
        assert found == list(range(1, 501)) and {r.total__ for r in offsets.collect()} == {500}


# --- pieces --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    with open(MODEL, "rb") as file:
        return sentence_pieces.Encoder(sentence_pieces.Vocabulary(file.read()))


class TestPieces:
    def test_texts_of_all_kinds_as_the_library(self, own, library):
        draw = random.Random(1)
        alphabet = "ab cde  \u2581 \n\t\u00e9\u6f22\u5b57\U0001d4b3\u00df<s>0xA\u3000\x00'.,the of "
        texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(3000)]
        texts += ["", " ", "word " * 50_000, "x" * 30_000, "\u6f22" * 30_000, "\u2581" * 99]
        ids = [i.tolist() for i in own.encode_all(texts)]
        assert ids == library.encode(texts) and [own.decode(i) for i in ids] == library.decode(ids)

    def test_heap_and_array_agree(self, own):
        draw = random.Random(2)
        words = ["".join(draw.choice("tionerasthd\u2581\u00e9.") for _ in range(draw.randrange(1, 30))) for _ in range(500)]
        assert own.merged_rows(words) == [own._ids(own.merged(w)) for w in words]

    def test_any_ids_decode_as_the_library_says(self, own, library):
        draw = random.Random(3)
        for _ in range(3000):
            kinds = (draw.randrange(3), 28705, draw.randrange(3, 259), draw.randrange(130, 259), draw.randrange(259, 32000))
            ids = [draw.choice(kinds) for _ in range(draw.randrange(12))]
            assert own.decode(ids) == library.decode(ids)

    def test_lists_of_ids_decode_together(self, own, library):
        draw = random.Random(4)
        kinds = [[], [28705], [0], [1, 2], [240, 150], [draw.randrange(259, 32000)], [259, 300, 28705], [200], [68, 69]]
        ids = [sum((draw.choice(kinds) for _ in range(draw.randrange(6))), []) for _ in range(2000)]
        ids += [[draw.randrange(259, 32000) for _ in range(draw.randrange(30))] for _ in range(2000)]
        assert own.decode_all([np.array(i, np.int32) for i in ids]) == library.decode(ids)
        assert own.decode_all([]) == [] and own.encode_all([]) == []

    def test_known_words_cost_less_than_the_library(self, library):
        """CPU time of encoding and decoding texts whose words are remembered, as a share of the library's."""
        documents = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"]
        texts = [t or "" for t in documents.to_pylist()]
        parts = [texts[i : i + sentence_pieces.ROWS] for i in range(0, len(texts), sentence_pieces.ROWS)]

        def seconds(work):
            found = []
            for _ in range(3):
                start = time.process_time()
                for part in parts:
                    work(part)
                found.append(time.process_time() - start)
            return min(found)

        with open(MODEL, "rb") as file:
            encoded = sentence_pieces.encoder_of(file.read(), False)
        assert seconds(encoded) < 0.55 * seconds(lambda part: library.decode(library.encode(part, num_threads=1), num_threads=1))

    def test_forgetting_changes_nothing(self, own, monkeypatch):
        texts = [f"some words number {i} and {i * 7919}" for i in range(300)]
        wanted = [i.tolist() for i in own.encode_all(texts)]
        monkeypatch.setattr(sentence_pieces, "REMEMBERED", 50)
        assert [i.tolist() for t in texts for i in own.encode_all([t])] == wanted

    def test_whole_table(self, spark, library):
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        found = queries.op12_sentence_pieces(spark, SF).collect()
        assert len(found) == len(texts)
        for r in found:
            ids = library.encode(texts[r.doc_id])
            wanted = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True)
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) == wanted

    def test_odd_rows(self, spark):
        rows = [(1, None, 5, "x"), (1, None, 5, "x"), (None, "", 6, "y"), (3, "two words", 7, None)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, decoded string")
        found = sorted(((r.id, list(r.ids), r.decoded, r.agrees) for r in sentence_pieces.encode(df, MODEL).collect()), key=str)
        assert found[:2] == [(1, [], "", True)] * 2 and found[2][2] == "two words" and found[3] == (None, [], "", True)
        assert sentence_pieces.encode(df.where("1 = 0"), MODEL).count() == 0
        assert {r.agrees for r in sentence_pieces.encode(df, MODEL, check=False).collect()} == {None}
        with pytest.raises(ValueError):
            sentence_pieces.Vocabulary(b"\x12\x02\x18\x01")


# --- the manifest ----------------------------------------------------------------------------

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, node int, hash int, level int, block int"


def brute_manifest(rows):
    """Sorted (leaf, subroot, root, proof hashes) of (doc_id, source, lang, n_chars, text)."""

    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(leaves):
        """Root and the proof of each leaf."""
        proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
        while len(level) > 1:
            for p, i in zip(proofs, at):
                if i ^ 1 < len(level):
                    p.append(level[i ^ 1])
            level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
            at = [i // 2 for i in at]
        return level[0], proofs

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(((r[0] is not None, r[0] or 0), sha("".join(map(part, r)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf in sorted(groups[g])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    return sorted(
        (leaf, trees[g][0], root, sha("".join(proof + top)))
        for g, top in zip(names, tops) for (_, leaf), proof in zip(sorted(groups[g]), trees[g][1])
    )


def found_manifest(df):
    found = merkle.manifest(df)
    siblings = F.array_join(F.filter(F.col("proof.hash"), lambda h: h.isNotNull()), "")
    found = found.withColumn("whole", merkle.folded(F.col("leaf"), F.col("proof"))).withColumn("p", F.sha2(siblings.cast("binary"), 256)).collect()
    assert all(r.whole == r.root for r in found)
    return sorted((r.leaf, r.subroot, r.root, r.p) for r in found)


class TestManifest:
    def table(self, spark, rows):
        return spark.createDataFrame([(d, t, l, s, n, "x", 1, 2, 3, 4) for d, s, l, n, t in rows], DOC)

    @pytest.mark.parametrize(("base", "levels"), [(4, 2), (2, 1), (16, 4)])
    def test_as_brute_force_in_many_tiers(self, spark, monkeypatch, base, levels):
        monkeypatch.setattr(merkle, "BASE", base)
        monkeypatch.setattr(merkle, "BASE_LEVELS", levels)
        monkeypatch.setattr(merkle, "DIGITS", 2)
        monkeypatch.setattr(merkle, "BLOCK", base**2)
        draw, rows = random.Random(base), []
        for lang, n in (("en", 150), ("de", 1), ("fr", 17), (None, 5), ("", 2), ("\u00e9", 3), ("z", 64)):
            rows += [(draw.randrange(10**6), "s", lang, 3, f"text {draw.random()}") for _ in range(n)]
        assert found_manifest(self.table(spark, rows).repartition(4)) == brute_manifest(rows)

    def test_odd_rows(self, spark):
        rows = [
            (1, None, "en", None, None), (1, "", "en", 0, ""), (1, "", "en", 0, ""), (None, "s", "en", 1, "no id"), (None, "s", None, 1, "no id"),
            (2, "s", "en", 1, "x" * 300_000), (-5, "s", "en", 1, "\u00fc"), (3, "s", None, 9, "y"),
        ]
        df = self.table(spark, rows)
        assert found_manifest(df) == brute_manifest(rows)
        assert merkle.manifest(df.where("1 = 0")).count() == 0
        one = [(1, "s", "en", 1, "alone")]
        assert found_manifest(self.table(spark, one)) == brute_manifest(one)

    def test_altered_rows_do_not_fold_to_the_root(self, spark):
        for r in queries.op13_merkle(spark, SF).collect():
            hit = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            assert r.verified == (not hit) and (r.folded_root == r.root) == r.verified
