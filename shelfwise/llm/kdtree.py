"""Exact top-k search by inner product with one KD-tree per shard of the vectors.

Vectors are dealt into shards by a hash of their id.  A shard's tree splits at
the median of the widest dimension and keeps tight bounding boxes.  A query
visits boxes best first by the largest inner product that a box allows, and
stops when that falls below its kth score.  That score starts from a bounded
sample of the vectors and is passed on to every shard, so most shards give
back only what can still be among the k best.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
#: Vectors whose scores give every query its first bound.
SEED_ROWS = 2048
QUERY_BLOCK = 8192
LEAF = 64
#: The bound of a query that has none yet.
NO_BOUND = np.iinfo(np.int64).min


class Tree:
    """Median splits of integer vectors, ordered by place in the tree; node boxes are tight."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.lo, self.hi, self.low_id, self.span, self.kids = [], [], [], [], []
        order = np.lexsort((ids,))
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            part = x[order[a:b]]
            lo, hi = part.min(0), part.max(0)
            me = len(self.span)
            self.lo.append(lo)
            self.hi.append(hi)
            self.low_id.append(int(ids[order[a:b]].min()))
            self.span.append((a, b))
            self.kids.append(None)
            if parent >= 0:
                self.kids[parent] = (*(self.kids[parent] or ()), me)
            if b - a > leaf:
                d = int((hi - lo).argmax())
                # equal vectors stay in the order of their ids, so the smaller ids share a box
                order[a:b] = order[a:b][np.argsort(part[:, d], kind="stable")]
                mid = (a + b) // 2
                stack += [(mid, b, me, 1), (a, mid, me, 0)]
        self.x, self.ids = x[order], ids[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The largest inner product of each query (row) with any point of each node's box."""
        return np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T

    def search(self, q: np.ndarray, own: int, bound: np.ndarray, k: int, least) -> list[tuple]:
        """Up to k of (score, -id), among those scoring ``least`` or more; vectors of the query's own id are left out."""
        best: list[tuple] = []
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            floor = best[0][0] if len(best) == k and best[0][0] > least else least
            if -top < floor:
                break
            if len(best) == k and -top == best[0][0] and self.low_id[node] > -best[0][1]:
                continue
            if self.kids[node] is not None:
                for c in self.kids[node]:
                    if bound[c] >= floor:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            a, b = self.span[node]
            score = self.x[a:b] @ q
            for i in np.flatnonzero(score >= floor).tolist():
                item = (score[i], -int(self.ids[a + i]))
                if item[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return best


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integers, as doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _exact(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum is exact in them, else as 64-bit or, beyond, as Python integers."""
    most = (float(np.abs(x).max(initial=0)) + 1) * (float(np.abs(y).max(initial=0)) + 1) * max(1, x.shape[1])
    if most < 2**53:
        return x, y
    if most < 2**62:
        return x.astype(np.int64), y.astype(np.int64)
    return tuple(np.array([int(v) for v in z.ravel().tolist()], object).reshape(z.shape) for z in (x, y))


def _distinct(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rows to keep: one per id, with its smallest vector."""
    order = np.lexsort((*x.T[::-1], ids))
    return order[np.append(True, ids[order][1:] != ids[order][:-1])]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id long, rank int, vec_id long, score long`` for each row where ``is_query`` holds.

    A component x becomes floor(scale * x); the score is the integer inner product over all other ids, ties going
    to the smaller id; fewer than k rows come only where there are fewer candidates.  Null ids, and vectors that are
    null, empty, or hold a null or non-finite component take no part; vectors meet only vectors of the same length.
    Components of any size count exactly; a score among the best that no long can hold raises.  An id that repeats
    counts once, with its smallest vector.  An empty table gives no rows.
    """
    def whole(c: Column) -> Column:  # a double of 2^53 or more is an integer already
        y = F.lit(scale) * c.cast("double")
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    scaled = F.transform(vectors[f"`{vector_col}`"], whole)
    sound = F.forall(vectors[f"`{vector_col}`"], lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    points = vectors.where(vectors[f"`{id_col}`"].isNotNull() & sound & (F.size(vectors[f"`{vector_col}`"]) > 0)).select(
        vectors[f"`{id_col}`"].cast("long").alias("id"), scaled.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    points = points.withColumn("dim", F.size("x"))
    total, asked = points.agg(F.count(F.lit(1)), F.sum(F.col("asks").cast("int"))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-int(asked or 0) // QUERY_BLOCK))
    # about SEED_ROWS vectors reach the driver: ids are thinned by a hash before anything is sorted or sent
    share = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SEED_ROWS / max(total, 1)))
    seed = points.where(share).select("id", "x").limit(4 * SEED_ROWS).collect()
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r["x"]) for r in seed}:
        mine = [r for r in seed if len(r["x"]) == d]
        ids, x = np.array([r["id"] for r in mine]), np.array([r["x"] for r in mine])
        one = _distinct(ids, x)
        seeds[d] = ids[one], x[one]

    def first_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, NO_BOUND)
            dims, ids = batch.column("dim").to_numpy(), batch.column("id").to_numpy()
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                if d not in seeds or len(seeds[d][0]) <= k:
                    continue
                for at in range(0, len(rows), 512):
                    some = rows[at: at + 512]
                    q, s = _exact(_matrix(batch.column("x").take(pa.array(some))), seeds[d][1])
                    score = q @ s.T
                    score[ids[some][:, None] == seeds[d][0][None, :]] = score.min()  # the own id: a lower bound stays one
                    kth = np.partition(score, -k, axis=1)[:, -k]
                    out[some] = [min(int(v), 2**63 - 1) if v > NO_BOUND else NO_BOUND for v in kth.tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "least"])

    queries = points.where("asks").select("id", "x", "dim").mapInArrow(first_bound, "id long, x array<double>, dim int, least long")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    stored = points.select("id", "x", "dim", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(shards)).cast("int").alias("shard")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        got: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, x = left.column("id").to_numpy(), _matrix(left.column("x"))
            one = _distinct(ids, x)
            qid, q, least = right.column("id").to_numpy(), _matrix(right.column("x")), right.column("least").to_numpy()
            asked = _distinct(qid, q)
            q, x = _exact(q, x)
            tree = Tree(x[one], ids[one])
            for at in range(0, len(asked), 256):
                some = asked[at: at + 256]
                for i, bound in zip(some.tolist(), tree.bounds(q[some])):
                    got += [(int(qid[i]), -v, int(s)) for s, v in tree.search(q[i], int(qid[i]), bound, k, least[i] if least[i] > NO_BOUND else -math.inf)]
        cols = zip(*got) if got else ([], [], [])
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in cols))))

    keys = ("dim", "shard", "block")
    near = stored.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
