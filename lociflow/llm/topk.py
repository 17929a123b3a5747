"""Exact top-k search by inner product with KD-trees per shard (operator 13).

1. Equal rows (id and vector) become one with a count, so that a hot row is one row; the rows are dealt to
   shards by hash, and the stated queries to blocks by hash.  A task holds one shard and one block.
2. A shard is a KD-tree: nodes are split at the median of their widest side until they hold ``LEAF``
   rows; every node has the tight box of its rows and its smallest id.
3. A query goes through the tree best first: the box bounds every inner product below a node by the sum of
   max(q lo, q hi).  A node is left out when its bound is below the kth score so far, or equal
   to it with only larger ids.  A leaf is one matrix product.
4. The kth score is propagated: first every query searches one shard of its own; then
   the other shards start from that kth score and only return what beats it.  So what leaves the tasks
   does not grow with the number of shards.
5. The k best of all shards are the answer.

Scores are exact: products are made in float64 while every sum is below 2^53, else in whole numbers of any
size, which saturate at 64 bits in the result.

Edge cases: rows without id, null vectors and vectors with null or non-finite components take no part; only vectors of
equal length are compared; a repeated row is as many candidates as it has rows; of
several vectors under one query id the least is the query, and all rows with its id are its own; a query without
candidates has no rows; empty tables give none; extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import materialize

#: Rows of a leaf; rows of a shard and queries of a block at most, about; rows that are worth a shard of their own.
LEAF, SHARD_ROWS, BLOCK_QUERIES, LEAST_ROWS = 128, 65_536, 16_384, 2_048
SCALE = 1024


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(odd, F.lit(True)), F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


class KDTree:
    """Rows of one shard by median splits; node k has ``low[k]``, ``high[k]``, ``least[k]`` and children or a slice of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        low, high, least, self.parts = [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            lo, hi, above = waiting.pop()
            rows = order[lo:hi]
            inside = vectors[rows]
            low.append(inside.min(axis=0))
            high.append(inside.max(axis=0))
            least.append(int(ids[rows].min()))
            node = len(self.parts)
            if above >= 0:
                self.parts[above][2].append(node)
            self.parts.append((lo, hi, []))
            width = high[-1] - low[-1]
            if hi - lo > leaf and width.size and width.max() > 0:
                middle = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(inside[:, int(width.argmax())], middle)]
                waiting += [(lo, lo + middle, node), (lo + middle, hi, node)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high, self.least = np.array(low), np.array(high), least

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, nodes): no inner product below a node is larger."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def best_first(tree: KDTree, query: np.ndarray, bound: np.ndarray, own: int, times: np.ndarray, k: int, floor: tuple[int, int] | None) -> tuple[list[tuple[int, int]], int]:
    """The ``k`` best (score, -id) of the tree for one query, and the number of leaves read.

    ``floor``: the kth (score, -id) known from elsewhere; what is not above it is left out.
    """
    held: list[tuple[int, int]] = []
    worst = floor
    open_nodes, leaves = [(-bound[0], 0)], 0
    while open_nodes:
        above, node = heapq.heappop(open_nodes)
        if worst is not None and (-above, -tree.least[node]) <= worst:
            if -above < worst[0]:
                break
            continue
        lo, hi, below = tree.parts[node]
        if below:
            for child in below:
                heapq.heappush(open_nodes, (-bound[child], child))
            continue
        leaves += 1
        scores = tree.vectors[lo:hi] @ query
        keep = np.flatnonzero(scores >= worst[0]) if worst is not None else np.arange(hi - lo)
        if len(keep) > 4 * k:  # ties at the kth score are settled by id
            keep = keep[np.lexsort((tree.ids[lo:hi][keep], -scores[keep]))[: k + int((tree.ids[lo:hi][keep] == own).sum())]]
        for at in keep:
            row = (int(scores[at]), -int(tree.ids[lo + at]))
            if -row[1] == own:
                continue
            for _ in range(min(k, int(times[lo + at]))):
                if len(held) < k:
                    heapq.heappush(held, row)
                elif row > held[0]:
                    heapq.heapreplace(held, row)
        if len(held) == k and (worst is None or held[0] > worst):
            worst = held[0]
    return sorted((x for x in held if floor is None or x > floor), reverse=True), leaves


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


_MAX = 2**63 - 1


def search_piece(ids: np.ndarray, times: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: list[tuple[int, int] | None], k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best of a shard for each query."""
    out: list[tuple[int, int, int]] = []
    if not len(ids) or not len(query_ids):
        return out
    largest = float(np.abs(vectors.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0)) * max(1, vectors.shape[1])
    kind = np.float64 if largest < 2**53 else object
    where = {}
    order = np.argsort(ids, kind="stable")
    tree = KDTree(ids[order], vectors[order].astype(kind))
    if times.max() > 1:
        where = dict(zip(map(tuple, np.column_stack([ids, vectors]).tolist()), times.tolist(), strict=True))
        counts = np.array([where[tuple(r)] for r in np.column_stack([tree.ids, tree.vectors.astype(np.int64)]).tolist()])
    else:
        counts = np.ones(len(ids), np.int64)
    queries = queries.astype(kind)
    step = max(1, (1 << 22) // len(tree.parts))
    for at in range(0, len(queries), step):
        bounds = tree.bounds(queries[at : at + step])
        for j in range(len(bounds)):
            q = at + j
            found, _ = best_first(tree, queries[q], bounds[j].tolist(), int(query_ids[q]), counts, k, floors[q])
            out += [(int(query_ids[q]), -i, max(-_MAX - 1, min(_MAX, s))) for s, i in found]
    return out


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates (vec_id, vector) of every query (vec_id, vector).

    Vectors are arrays of whole numbers.  Candidates with the query's id are its own and left out.
    """
    spark = candidates.sparkSession
    read = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<long>").alias("vector")).where("vec_id is not null and vector is not null")
    rows = materialize(read(candidates).groupBy("vec_id", "vector").agg(F.count("*").alias("times")), "candidates")
    asked = materialize(read(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    n, m = rows.count(), asked.count()
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), min(cores, n // LEAST_ROWS))
    blocks = max(1, -(-m // block_queries))
    place = lambda name, pieces: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(pieces)).cast("int").alias(name)
    dealt = rows.select("vec_id", "vector", "times", F.size("vector").alias("dim"), place("shard", shards), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).repartition("dim", "shard", "block")
    mine = asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.size("vector").alias("dim"), place("block", blocks), place("home", shards))

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size = key[0].as_py()
        floors = [None if s is None else (s, -i) for s, i in zip(right.column("kth_score").to_pylist(), right.column("kth_id").to_pylist(), strict=True)]
        found = search_piece(
            left.column("vec_id").to_numpy(), left.column("times").to_numpy(), _matrix(left.column("vector"), size) if size else np.zeros((left.num_rows, 0), np.int64),
            right.column("query_id").to_numpy(), _matrix(right.column("query"), size) if size else np.zeros((right.num_rows, 0), np.int64), floors, k,
        )
        return pa.table({name: pa.array([x[j] for x in found], pa.int64()) for j, name in enumerate(("query_id", "vec_id", "score"))})

    def searched(ask: DataFrame) -> DataFrame:
        ask = ask.select("query_id", "query", "dim", "block", "shard", "kth_score", "kth_id").repartition("dim", "shard", "block")
        keys = ["dim", "shard", "block"]
        return dealt.groupBy(keys).cogroup(ask.groupBy(keys)).applyInArrow(search, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    none = F.lit(None).cast("long")
    first = materialize(searched(mine.select("*", F.col("home").alias("shard"), none.alias("kth_score"), none.alias("kth_id"))), "first")
    # the kth of the first shard bounds what the others need to return
    kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    rest = mine.join(kth, "query_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    found = first.unionByName(searched(rest)) if shards > 1 else first
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embedding_top_k(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The query: every ``every``-th id asks, all rows are candidates, vectors quantized."""
    vectors = embeddings.select("vec_id", quantized(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)


def top_k_sql(k: int = 10, every: int = 100, scale: int = SCALE) -> str:
    """The same for DuckDB over ``embeddings``."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {scale}) AS DOUBLE)) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.z, c.z) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.z) = len(c.z))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= {k}"""
