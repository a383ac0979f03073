"""Approximate nearest neighbours by largest inner product: a forest of hash-prefix trees per block of rows.

Rows are hashed into blocks of about ``block_rows``; a block's forest is ``trees`` sorted arrays of 60-bit hash strings (signs of
random orthogonal projections; vectors get one more coordinate so that the largest inner product is the smallest angle).
A query descends in every tree to its longest matching prefix and ascends in all trees at the same depth until the subtrees
together hold ``candidates`` entries of the block; candidates are then ranked by the exact inner product in double precision.
Queries meet the rows in (block of rows) x (block of queries) groups of bounded size, so no task holds all rows or all queries, and
a block returns only its best ``k`` for a query.

The number of candidates of a block does not depend on the number of blocks.  On vectors without structure (the given
ones: 64 independent directions) about half of a block has to be ranked for a recall over 0.95, so
the work grows as queries x rows; on clustered vectors fewer entries lie above the same recall.  README has measured recall.

Edge cases: vectors that are null, zero, hold a null or non-finite component, or differ in length from the most common length (ties: the
longer) take no part, nor do null ids; of rows that share an id the one with the smallest vector takes part; equal scores rank
by smaller id; a query never returns its own id; an empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import staged

BITS = 60
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)[::-1]


class Forest:
    """Trees over the rows of one block."""

    def __init__(self, x: np.ndarray, trees: int, seed: int):
        self.x, self.norm = x, np.linalg.norm(x, axis=1)
        self.top = self.norm.max()
        unit = np.column_stack([x / self.top, np.sqrt(np.maximum(0, 1 - (self.norm / self.top) ** 2))])
        self.planes = [self._planes(unit.shape[1], np.random.default_rng([seed, t])) for t in range(trees)]
        self.order, self.codes = [], []
        for p in self.planes:
            code = self.strings(unit, p)
            o = np.argsort(code, kind="stable")
            self.order.append(o)
            self.codes.append(code[o])

    @staticmethod
    def _planes(d: int, rng) -> np.ndarray:
        blocks = [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(-(-BITS // d))]
        return np.hstack(blocks)[:, :BITS]

    @staticmethod
    def strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return ((x @ planes) > 0) @ _WEIGHTS

    def _subtrees(self, own: list[np.ndarray], depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges (tree, query) of the rows that share the first ``depth`` bits with each query."""
        lo, hi = np.empty((len(own), len(depth)), np.int64), np.empty((len(own), len(depth)), np.int64)
        s = (BITS - depth).astype(np.uint64)
        for t, (code, q) in enumerate(zip(self.codes, own, strict=True)):
            p = q >> s
            lo[t], hi[t] = np.searchsorted(code, p << s), np.searchsorted(code, (p + np.uint64(1)) << s)
        return lo, hi

    def candidates(self, q: np.ndarray, least: int):
        """For each query the rows of all subtrees at the greatest common depth where they hold ``least`` entries (depth 0: all rows)."""
        unit = np.column_stack([q / np.linalg.norm(q, axis=1)[:, None], np.zeros(len(q))])
        own = [self.strings(unit, p) for p in self.planes]
        low, high = np.zeros(len(q), np.int64), np.full(len(q), BITS)  # the number of entries falls with the depth
        while (low < high).any():
            mid = (low + high + 1) // 2
            lo, hi = self._subtrees(own, mid)
            enough = (hi - lo).sum(axis=0) >= least
            low, high = np.where(enough, mid, low), np.where(enough, high, mid - 1)
        lo, hi = self._subtrees(own, low)
        for i in range(len(q)):
            seen = np.zeros(len(self.x), bool)
            for t, o in enumerate(self.order):
                seen[o[lo[t, i] : hi[t, i]]] = True
            yield np.flatnonzero(seen)


def matrix(col: pa.ChunkedArray) -> np.ndarray:
    c = col.combine_chunks()
    return np.asarray(c.flatten(), np.float64).reshape(len(c), -1)


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vec.isNotNull() & ok & F.exists(vec, lambda x: x != 0)


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec: str = "embedding", k: int = 20, trees: int = 64,
           candidates: int = 3300, block_rows: int = 8192, query_rows: int = 1024, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row with ``is_query``."""
    good = rows.filter(F.col(id_col).isNotNull() & usable(F.col(vec))).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"), is_query.alias("q"))
    size = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = size.d if size else 0
    good = staged(good.filter(F.size("v") == d).groupBy("id").agg(F.min(F.struct("v", "q")).alias("r")).select("id", "r.v", "r.q"))
    n, nq = good.count(), good.filter("q").count()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-nq // query_rows))
    h = F.xxhash64("id")
    left = good.select("id", "v", F.pmod(h, F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("c"))
    right = good.filter("q").select("id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b"), F.pmod(F.hash("id"), F.lit(parts)).alias("c"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(a) and len(b):
            ids, x, qids, q = np.asarray(a["id"]), matrix(a["v"]), np.asarray(b["id"]), matrix(b["v"])
            forest = Forest(x, trees, seed)
            for i, cand in enumerate(forest.candidates(q, candidates)):
                cand = cand[ids[cand] != qids[i]]
                score = x[cand] @ q[i]
                if len(cand) > k:
                    best = score >= np.partition(score, len(score) - k)[len(score) - k]
                    cand, score = cand[best], score[best]
                o = np.lexsort((ids[cand], -score))[:k]
                for column, value in zip(out, (np.full(len(o), qids[i]), ids[cand[o]], score[o]), strict=True):
                    column.append(value)
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    near = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
