"""Nearest vectors by cosine, through a vantage-point tree per shard.

Vectors are scaled to length one, where the Euclidean distance is a metric that orders like the
cosine. A tree node has a vantage point, a radius, and the vectors nearer and farther than it; the
triangle inequality says when one side cannot hold a nearer neighbour than those
known. The known distance is divided by ``factor`` in this test: a factor of one keeps the
search exact, a larger one skips more.

Vectors are dealt to shards by a hash, so that copies of one vector spread evenly; inside a
shard copies share one place in the tree. Queries go to all shards in blocks, each (shard,
block) being one group of bounded size. The best of each shard are joined by query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import stage

SHARD_ROWS, BLOCK_QUERIES, LEAF = 4_096, 1_024, 64
FACTOR = 1.1
#: Scores this near are ordered again by the exact sum.
CLOSE = 1e-9


class VPTree:
    """Vantage-point tree over unit vectors. Nodes are rows of ``nodes``, the root first:
    vantage point or -1 for a leaf, radius, inner and outer child, first and last + 1 in ``order``."""

    def __init__(self, units: np.ndarray, order: np.ndarray, nodes: np.ndarray) -> None:
        self.units, self.order, self.nodes = units, order, nodes

    @staticmethod
    def build(units: np.ndarray, leaf: int = LEAF) -> VPTree:
        order, nodes = np.arange(len(units)), []

        def split(first: int, last: int) -> int:
            at = len(nodes)
            nodes.append(None)
            if last - first <= leaf:
                nodes[at] = (-1, 0.0, -1, -1, first, last)
                return at
            vantage = order[first]  # the rows come in the order of a hash: the first is a random one
            away = _distance(units[order[first + 1 : last]], units[vantage])
            middle = (last - first - 1) // 2
            parted = np.argpartition(away, middle)
            order[first + 1 : last] = order[first + 1 : last][parted]
            cut = first + 1 + middle
            nodes[at] = (vantage, float(away[parted[middle]]), split(first + 1, cut), split(cut, last), first, first + 1)
            return at

        split(0, len(units))
        return VPTree(units, order, np.array(nodes, np.float64))

    def search(self, queries: np.ndarray, k: int, factor: float = FACTOR) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places of at least the k nearest, and their distances.

        All places within ``CLOSE`` of the k-th are returned, so that ties can be settled later.
        """
        n = len(queries)
        best = np.full((n, k), np.inf)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]

        def offer(who: np.ndarray, places: np.ndarray, away: np.ndarray) -> None:
            keep = away <= best[who, -1][:, None] + CLOSE
            merged = np.concatenate((best[who], away), axis=1)
            best[who] = np.sort(np.partition(merged, k - 1, axis=1)[:, :k], axis=1)
            for row in np.flatnonzero(keep.any(axis=1)):
                found[who[row]].append((places[keep[row]], away[row, keep[row]]))

        def visit(at: int, who: np.ndarray) -> None:
            if not len(who):
                return
            vantage, radius, inner, outer, first, last = self.nodes[at]
            places = self.order[int(first) : int(last)]
            away = _distances(queries[who], self.units[places])
            offer(who, places, away)
            if vantage < 0:
                return
            away = away[:, 0]
            inside = away < radius
            visit(int(inner), who[inside])
            visit(int(outer), who[~inside])
            reach = best[who, -1] / factor + CLOSE  # the far sides, once the near ones are known
            visit(int(outer), who[inside & (away + reach >= radius)])
            visit(int(inner), who[~inside & (away - reach <= radius)])

        if len(self.units):
            visit(0, np.arange(n))
        out = []
        for row, parts in enumerate(found):
            places = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)
            away = np.concatenate([a for _, a in parts]) if parts else np.zeros(0)
            near = away <= best[row, -1] + CLOSE
            out.append((places[near], away[near]))
        return out


def _distance(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (points @ to), 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec): rows with an id and a vector of finite components that are not all zero."""
    vec = F.col(vector_col).cast("array<double>")
    limit = F.lit(float("inf"))
    usable = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists(vec, lambda x: x != 0)
    return df.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")
    )


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index over (id, vec): a staged row per shard with its tree and vectors.

    Every vector is in it. Vectors of other lengths have shards of their own. Of copies
    in a shard all ids are kept, in order. Rows repeated with id and vector count once.
    """
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    # Salted by the vector: one id with many vectors spreads as well as one vector with many ids.
    dealt = vectors.withColumns({
        "dim": F.size("vec"), "shard": F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int"),
    })

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        vecs, ids = np.stack(rows["vec"].to_numpy()).astype(np.float64), rows["id"].to_numpy(np.int64)
        order = np.lexsort((ids, *vecs.T[::-1]))
        vecs, ids = vecs[order], ids[order]
        new = np.append(True, (vecs[1:] != vecs[:-1]).any(axis=1))
        again = np.append(False, (ids[1:] == ids[:-1]) & ~new[1:])
        group = np.cumsum(new) - 1
        distinct, group, ids = vecs[new], group[~again], ids[~again]
        mixed = np.random.default_rng(len(distinct)).permutation(len(distinct))
        place = np.argsort(mixed)  # a random order, the same in every run
        distinct, group = distinct[mixed], place[group]
        order = np.lexsort((ids, group))
        starts = np.searchsorted(group[order], np.arange(len(distinct) + 1))
        tree = VPTree.build(_units(distinct))
        blobs = (distinct, ids[order], starts.astype(np.int64), tree.order.astype(np.int64), tree.nodes)
        return pd.DataFrame([[rows["dim"].iloc[0], rows["shard"].iloc[0], *(b.tobytes() for b in blobs)]])

    schema = "dim int, shard int, vecs binary, ids binary, starts binary, place binary, nodes binary"
    return stage(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "vp-trees")


def _units(vecs: np.ndarray) -> np.ndarray:
    scaled = vecs / np.abs(vecs).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def search(index: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, id, score): the k nearest ids of each query (id, vec), itself left out.

    Nearest first by cosine, ties by the smaller id; all candidates if there are fewer than k. An id
    found with several vectors counts with its best. A query repeated with several vectors
    takes its best neighbours over all of them.
    """
    n = queries.count()
    blocks = max(1, -(-n // block_queries))
    shards = index.select("dim", "shard")
    sent = queries.withColumns({
        "q_dim": F.size("vec"), "block": F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int"),
    })
    # A query goes to each shard of its length: the list of shards is small, one row a tree.
    to = shards.groupBy(F.col("dim").alias("to_dim")).agg(F.collect_set("shard").alias("shards"))
    sent = sent.join(to, F.col("q_dim") == F.col("to_dim")).select(
        F.col("q_dim").alias("dim"), F.explode("shards").alias("shard"), "block", "id", "vec"
    )
    trees = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "score": []}
        if len(left) and len(right):
            row = left.iloc[0]
            vecs = np.frombuffer(row["vecs"], np.float64).reshape(-1, int(row["dim"]))
            ids, starts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)
            nodes = np.frombuffer(row["nodes"], np.float64).reshape(-1, 6)
            tree = VPTree(_units(vecs), np.frombuffer(row["place"], np.int64), nodes)
            asked, asking = np.stack(right["vec"].to_numpy()).astype(np.float64), right["id"].to_numpy(np.int64)
            # One more than k, as the query itself may be among them.
            for vec, query, (places, _) in zip(asked, asking, tree.search(_units(asked), k + 1, factor)):
                found = [(p, i) for p in places for i in ids[starts[p] : starts[p + 1]][: k + 1] if i != query]
                if found:
                    scores = _cosines(vec, vecs[[p for p, _ in found]])
                    first = np.lexsort(([i for _, i in found], -scores))[: 2 * k]
                    out["query_id"] += [query] * len(first)
                    out["id"] += [found[f][1] for f in first]
                    out["score"] += scores[first].tolist()
        return pd.DataFrame({"query_id": np.array(out["query_id"], np.int64), "id": np.array(out["id"], np.int64), "score": np.array(out["score"], np.float64)})

    keys = ("dim", "shard", "block")
    found = trees.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(find, "query_id bigint, id bigint, score double")
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _cosines(vec: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of original vectors, each pair summed in the same order."""
    a, b = vec / np.abs(vec).max(), others / np.abs(others).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def nearest_of_some(
    df: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", factor: float = FACTOR
) -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``, among all rows.

    Rows with a null id, or a vector that is null, empty, zero or has null or non-finite components, take no
    part. Other columns are not read. An empty table gives none.
    """
    vectors = valid_vectors(df, id_col, vector_col)
    index = build_index(vectors)
    return search(index, vectors.where(F.col("id") % every == 0), k, factor)
