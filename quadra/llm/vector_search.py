"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Candidates are dealt over shards of about ``SHARD_ROWS`` rows, queries over blocks of ``BLOCK_ROWS``;
each (shard, block) is one bounded task that builds the shard's ball tree (nodes with centre and
radius, leaves of ``LEAF`` rows) and searches it best-first: nodes are ordered by the bound
``q . centre + |q| * radius``, and a node is left out for the queries whose k-th score exceeds its
bound (equal bounds are opened, as ties go to the smaller id).

Current k-th scores are shared: a first wave sends each query to one shard only, and its k-th score
there is the floor with which the second wave enters all shards.

Components are the integers ``floor(scale * x)``; products are computed in float64 while all sums
are below 2**53, else in int64 (scores beyond 64 bits wrap).  Vectors that are null, empty, or hold null or
non-finite components take no part; vectors of different lengths never meet.  A query never meets rows of
its own id; equal query rows count once.  An empty table gives an empty result.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.llm.shared import stored

SHARD_ROWS = 4096
BLOCK_ROWS = 2048
LEAF = 64


class BallTree:
    """Nodes over rows of integer vectors; ``order`` lists the rows so that every node is a slice."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.nodes: list[tuple[np.ndarray, float, int, int, int, int]] = []  # centre, radius, first, last, left, right
        self._split(x, 0, len(x))

    def _split(self, x: np.ndarray, first: int, last: int) -> int:
        rows = x[self.order[first:last]].astype(np.float64)
        centre = rows.mean(0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(1).max()))
        at = len(self.nodes)
        self.nodes.append((centre, radius, first, last, -1, -1))
        if last - first > LEAF and radius > 0:
            # the two ends of the ball pull the rows apart; halves keep the depth logarithmic
            a = rows[((rows - centre) ** 2).sum(1).argmax()]
            b = rows[((rows - a) ** 2).sum(1).argmax()]
            side = np.argsort(rows @ (b - a), kind="stable")
            self.order[first:last] = self.order[first:last][side]
            middle = (first + last) // 2
            left, right = self._split(x, first, middle), self._split(x, middle, last)
            self.nodes[at] = (centre, radius, first, last, left, right)
        return at


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k best (score, id) of the rows, best first; missing ones have id -1 and the least score.

    ``floor``: a score that k rows are known to reach (the least number if unknown).
    """
    least = np.iinfo(np.int64).min
    small = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2.0**52
    xs, qs = (x.astype(np.float64), q.astype(np.float64)) if small else (x, q)
    tree = BallTree(x)
    best = np.full((len(q), k), least, np.int64)
    who = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    length = np.sqrt((q.astype(np.float64) ** 2).sum(1))

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        centre, radius = tree.nodes[node][:2]
        b = q[rows].astype(np.float64) @ centre + length[rows] * radius
        return b + 1e-9 * np.abs(b) + 1e-6

    every = np.arange(len(q))
    first = bound(0, every)
    heap, number = [(-first.max(initial=-np.inf), 0, 0, every, first)], 0
    while heap:
        _, _, node, rows, upper = heapq.heappop(heap)
        kth = np.maximum(best[rows, k - 1], floor[rows])
        rows = rows[upper >= kth.astype(np.float64)]
        if not len(rows):
            continue
        _, _, lo, hi, left, right = tree.nodes[node]
        if left < 0:
            at = tree.order[lo:hi]
            score = (qs[rows] @ xs[at].T)
            score = np.rint(score).astype(np.int64) if small else score
            name = np.broadcast_to(ids[at], score.shape)
            score = np.where(name == own[rows][:, None], least, score)
            name = np.where(name == own[rows][:, None], np.iinfo(np.int64).max, name)
            s, n = np.concatenate([best[rows], score], 1), np.concatenate([who[rows], name], 1)
            order = np.lexsort((n, -s.astype(np.float64) if small else ~s), axis=1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(n, order, 1)
        else:
            for child in (left, right):
                b = bound(child, rows)
                number += 1
                heapq.heappush(heap, (-b.max(), number, child, rows, b))
    return best, np.where(who == np.iinfo(np.int64).max, -1, who)


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(len(column), -1)


def _wave(candidates: DataFrame, queries: DataFrame, k: int, scale: float) -> DataFrame:
    """(qid, query_id, vec_id, score): the k best of each (shard, block) for each of its queries."""

    def run(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"qid": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            x, ids = _matrix(left.column("v").combine_chunks(), scale), left.column("id").to_numpy()
            q, own = _matrix(right.column("q_v").combine_chunks(), scale), right.column("q_id").to_numpy()
            best, who = search(x, ids, q, own, k, right.column("q_floor").to_numpy())
            keep = (who >= 0) | (best > np.iinfo(np.int64).min)
            out = {"qid": np.repeat(right.column("q_qid").to_numpy(), k)[keep.ravel()], "query_id": np.repeat(own, k)[keep.ravel()], "vec_id": who[keep], "score": best[keep]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    on = ["dim", "shard", "block"]
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])  # both sides come from one table: new columns
    return candidates.groupBy(*on).cogroup(asked.groupBy(*[f"q_{c}" for c in on])).applyInArrow(run, "qid bigint, query_id bigint, vec_id bigint, score bigint")


def usable(vector: Column) -> Column:
    """No null, non-finite or missing component."""
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query row."""
    doubles = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = table.select(F.col(f"`{key}`").cast("bigint").alias("id"), doubles.alias("v"), is_query.alias("asks")).where(usable(F.col("v")) & F.col("id").isNotNull())
    rows = stored(rows.select("id", "v", "asks", F.size("v").alias("dim"), F.xxhash64("id", "v").alias("qid")), "vectors")
    asked = rows.where("asks").dropDuplicates(["id", "qid"])
    shards, blocks = max(1, rows.count() // SHARD_ROWS), max(1, asked.count() // BLOCK_ROWS)
    shard = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int")
    candidates = rows.select("dim", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "v")
    asked = asked.select("dim", block.alias("block"), "qid", "id", "v")

    # first wave: one shard per query gives it a floor
    home = F.pmod(F.xxhash64("qid", F.lit(7)), F.lit(shards)).cast("int")
    start = asked.select("dim", home.alias("shard"), "block", "qid", "id", "v", F.lit(-(2**63)).cast("bigint").alias("floor"))
    floors = _wave(candidates, start, k, scale).groupBy("qid", F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("qid", "id", "least")
    asked = stored(asked.join(floors, ["qid", "id"], "left"), "floors")

    again = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "qid", "id", "v", F.coalesce("least", F.lit(-(2**63)).cast("bigint")).alias("floor"))
    found = _wave(candidates, again, k, scale)
    order = Window.partitionBy("qid", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
