"""k-nearest-neighbour scoring in blocks (M11, J5), exact and by random projections.

Both sides are written as blocks of some thousand vectors.  A task holds a block of queries and goes through blocks of reference
points: all distances of a pair of blocks come from one matrix product, with a proven bound of its rounding error.  Pairs that may be among the
k nearest found so far get their exact distance, summed dimension by dimension, and only k rows per query (and left-out fold) leave the task.
So neither pairs nor vectors are shuffled, and memory is that of two blocks and k rows per query, however many rows there are.  The
work is that of all pairs (exact neighbours of vectors in many dimensions have no shorter way), at some nanoseconds a pair.

The answer equals the brute-force one (ties: distance rounded to 1e-9, then reference id).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import cut_lineage, discard, stage

QUERIES, POINTS = 2048, 8192  # rows of a block
HELD = 64 << 20  # bytes of reference blocks that a task goes through


def _round9(c: Column) -> Column:
    return F.floor(c * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9)


def pivot_distances(X: np.ndarray, pivots: np.ndarray, cells: int = 1 << 20):
    """(first row, distances [rows, pivots]) block by block: a block has ``cells`` numbers however many pivots there are."""
    step = max(1, cells // len(pivots))
    for a in range(0, len(X), step):
        d2 = np.zeros((len(X[a : a + step]), len(pivots)))
        for j in range(pivots.shape[1]):
            d2 += (X[a : a + step, j, None] - pivots[None, :, j]) ** 2
        yield a, np.sqrt(d2)


def _stack(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _vectors(column) -> np.ndarray:
    """An array column without nulls as a matrix."""
    if column.null_count or not len(column):
        if len(column):
            raise ValueError("a row has no vector")
        return np.zeros((0, 0))
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a vector has a component that is null")
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _blocks(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """(block, rows): blocks of up to ``size`` rows as Arrow messages, written once, ``parts`` files."""
    def pack(batches):
        held, n, made = [], 0, 0
        first = TaskContext.get().partitionId() << 32

        def done():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([first + made]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

        for b in batches:
            while len(b):
                part = b.slice(0, size - n)
                b = b.slice(len(part))
                held.append(part)
                n += len(part)
                if n == size:
                    yield done()
                    held, n, made = [], 0, made + 1
        if n:
            yield done()

    return stage(rows.repartition(parts).mapInArrow(pack, "block long, rows binary"))


def _opened(message) -> pa.RecordBatch:
    return pa.ipc.open_stream(message.as_buffer()).read_all().combine_chunks().to_batches()[0]


def _rank_in(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by the keys, the last one first, and each ordered row's rank among those of equal keys but the first two (rounded distance, id)."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([np.diff(key[order]) != 0 for key in keys[2:]], axis=0)
    starts = np.flatnonzero(new)
    return order, np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))


class _Nearest:
    """The k nearest found so far of a block of queries, for each of their groups of reference points."""

    def __init__(self, queries: pa.RecordBatch, k: int, distinct: bool):
        self.q, self.k, self.distinct = queries, k, distinct
        self.x = _vectors(queries.column("x"))
        self.norm = (self.x**2).sum(axis=1)
        self.reach = np.full(len(self.x), np.inf)  # no pair beyond it is among the k nearest
        none = np.zeros(0, np.int64)
        self.i, self.group, self.near, self.tid, self.d, self.at = none, none, none, none, np.zeros(0), none

    def meet(self, r: "_Points", usable, groups, reach) -> None:
        """Compares with a block of points.  ``usable(i, j)``: pairs that count; ``groups(i, j)``: the group of a pair; ``reach(self)``: the distance, in
        steps of 1e-9, up to which a point may still be among a query's nearest."""
        product = self.x @ r.x.T
        about = self.norm[:, None] + r.norm[None, :] - 2 * product
        slack = 8 * (self.x.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(self.norm) + math.sqrt(r.norm.max(initial=0))) ** 2
        far = ((self.reach + 2) * 1e-9) ** 2 * (1 + 1e-9) + slack
        if np.isinf(far).any():
            far = np.minimum(far, self._first(about, r, usable) + 2 * slack)
        i, j = np.nonzero(~(about > far[:, None]))
        for part in range(0, len(i), 1 << 20):  # equal vectors may all be near
            self._add(r, i[part : part + (1 << 20)], j[part : part + (1 << 20)], usable, groups)
        self.reach = reach(self)

    def _first(self, about: np.ndarray, r: "_Points", usable) -> np.ndarray:
        """A bound of the squared distance that holds the k nearest of every group, from one block."""
        out = np.full(len(about), np.inf)
        for rows in range(0, len(about), 256):
            some = about[rows : rows + 256]
            i, j = np.indices(some.shape)
            ok = usable(i.ravel() + rows, j.ravel()).reshape(some.shape)
            if self.distinct:  # k different ids: one row of each will do
                ok &= r.lone[None, :]
            ends = [np.where(ok, some, np.inf)] if r.fold is None or not self.several else [np.where(ok & (r.fold != f)[None, :], some, np.inf) for f in np.unique(r.fold)]
            ends = [np.sqrt(np.maximum(np.partition(e, self.k - 1, axis=1)[:, self.k - 1], 0)) if e.shape[1] >= self.k else np.full(len(e), np.inf) for e in ends]
            out[rows : rows + 256] = (np.max(ends, axis=0) + 2e-9) ** 2 * (1 + 1e-9)
        return out

    several = False

    def _add(self, r: "_Points", i, j, usable, groups) -> None:
        ok = usable(i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            return
        total = np.zeros(len(i))
        for c in range(self.x.shape[1]):  # dimension by dimension, as a sum over the arrays adds up
            total += (self.x[i, c] - r.x[j, c]) ** 2
        known = ~np.isnan(total)
        i, j, d = i[known], j[known], np.sqrt(total[known])
        at = r.first + j
        i, group, near, tid, d, at = (np.concatenate(x) for x in ((self.i, i), (self.group, groups(i, j)), (self.near, np.floor(d * 1e9 + 0.5)), (self.tid, r.tid[j]), (self.d, d), (self.at, at)))
        if self.distinct:  # equal pairs count once, with their least distance
            order = np.lexsort((d, tid, i))
            same = np.zeros(len(order), bool)
            same[1:] = (np.diff(i[order]) == 0) & (np.diff(tid[order]) == 0)
            keep = order[~same]
            i, group, near, tid, d, at = (x[keep] for x in (i, group, near, tid, d, at))
        order, rank = _rank_in(tid, near, group, i)
        keep = order[rank < self.k]
        self.i, self.group, self.near, self.tid, self.d, self.at = (x[keep] for x in (i, group, near, tid, d, at))


class _Points:
    """A block of reference points; ``first`` is the number of points that the task has seen before."""

    def __init__(self, rows: pa.RecordBatch, first: int):
        self.rows, self.first = rows, first
        self.x = _vectors(rows.column("x"))
        self.norm = (self.x**2).sum(axis=1)
        self.tid = np.asarray(rows.column("tid").cast(pa.int64()).fill_null(np.iinfo(np.int64).min))  # nulls first, as the order of Spark has it
        self.lone = np.zeros(len(self.tid), bool)
        self.lone[np.unique(self.tid, return_index=True)[1]] = True
        self.fold = np.asarray(rows.column("fold")) if "fold" in rows.schema.names else None


def _searched(ref: DataFrame, queries: DataFrame, k: int, rules, out: str, finish, distinct: bool = False) -> DataFrame:
    """The rows that ``finish(nearest, all points of the task)`` gives for each block of queries and each task's share of reference blocks.

    ``rules(nearest, points)`` -> (usable, groups, reach) of a pair of blocks."""
    cores = ref.sparkSession.sparkContext.defaultParallelism
    n = ref.count()
    d = ref.select(F.size("x").alias("d")).first()
    width = 8 * max(1, d["d"] if d else 1) + 64
    points = _blocks(ref, POINTS, max(1, min(n // POINTS, n * width // HELD)))
    asked = queries.count()
    asks = _blocks(queries, QUERIES, max(1, min(-(-asked // QUERIES), max(2 * cores, asked * width // HELD))))

    def run(batches) -> Iterator[pa.RecordBatch]:
        block, near, seen, kept = None, None, [], 0
        for b in batches:
            for q, message, r in zip(b.column("block").to_pylist(), b.column("rows"), b.column("points"), strict=True):
                if q != block:
                    if near is not None:
                        yield finish(near, seen)
                    block, near, seen, kept = q, _Nearest(_opened(message), k, distinct), [], 0
                points = _Points(_opened(r), kept)
                seen.append(points.rows.drop_columns([c for c in ("x", "h") if c in points.rows.schema.names]))
                kept += len(points.tid)
                near.meet(points, *rules(near, points))
        if near is not None:
            yield finish(near, seen)

    found = asks.crossJoin(points.select(F.col("rows").alias("points"))).mapInArrow(run, out)
    result = stage(found)
    discard(points)
    discard(asks)
    return result


def knn_neighbours(ref: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """ref: (tid, fold, label, x); queries: (part, qid, excl array<int>, x), ``excl`` the folds that are left out one at a time.  Returns
    (part, qid, excl_fold, tid, label, d) for the k nearest reference points with ``fold != excl_fold``; ``part`` tells train from
    test ids, which may be equal.  A query with several left-out folds is compared once: the k nearest of every fold answer all."""
    ref = ref.select("tid", F.col("fold").cast("int").alias("fold"), "label", "x").filter("fold IS NOT NULL")
    queries = queries.select("part", "qid", F.col("excl").cast("array<int>").alias("excl"), "x").filter("size(excl) > 0")

    def rules(near: _Nearest, points: _Points):
        if not hasattr(near, "one"):
            sizes = np.asarray(near.q.column("excl").value_lengths())
            flat = np.asarray(near.q.column("excl").flatten())
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            near.one = np.where(sizes == 1, flat[first], np.iinfo(np.int32).min)  # the fold that a query leaves out, if it is one
            near.excl = [(np.repeat(np.arange(len(sizes)), sizes)[flat == f], f) for f in np.unique(flat)]
            near.many = sizes > 1
            near.several = bool(near.many.any())

        def usable(i, j):
            return near.many[i] | (points.fold[j] != near.one[i])

        def groups(i, j):
            return np.where(near.many[i], points.fold[j].astype(np.int64), np.iinfo(np.int64).min)

        def reach(near):
            out = np.full(len(near.x), -1.0)
            for who, f in near.excl:  # a query reaches as far as one of its left-out folds asks for
                at = np.flatnonzero(near.group != f)
                order, rank = _rank_in(near.tid[at], near.near[at], near.i[at])
                last = at[order[rank == k - 1]]
                kth = np.full(len(near.x), np.inf)
                kth[near.i[last]] = near.near[last]
                out[who] = np.maximum(out[who], kth[who])
            return out

        return usable, groups, reach

    label = ref.schema["label"].dataType.simpleString()
    names = ["part", "qid", "excl", "fold", "tid", "label", "d"]

    def finish(near: _Nearest, seen: list) -> pa.RecordBatch:
        points, i, at = pa.Table.from_batches(seen).combine_chunks(), pa.array(near.i), pa.array(near.at)
        cols = [near.q.column(c).take(i) for c in names[:3]] + [points.column(c).take(at).combine_chunks() for c in names[3:6]]
        return pa.RecordBatch.from_arrays([*cols, pa.array(near.d)], names)

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    pairs = _searched(ref, queries, k, rules, f"part string, qid {kind(queries, 'qid')}, excl array<int>, fold int, tid {kind(ref, 'tid')}, label {label}, d double", finish)
    near = [_round9(F.col("d")), F.col("tid")]
    each = Window.partitionBy("part", "qid", "fold").orderBy(*near)
    best = pairs.withColumn("_rn", F.row_number().over(each)).filter((F.size("excl") == 1) | (F.col("_rn") <= k)).select("part", "qid", "fold", "tid", "label", "d", F.explode("excl").alias("excl_fold")).filter("fold <> excl_fold")
    whole = Window.partitionBy("part", "qid", "excl_fold").orderBy(*near)
    return best.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= k).select("part", "qid", "excl_fold", "tid", "label", "d")


# ---- approximate form ----------------------------------------------------------------------------

def exact_sample(ref: DataFrame, queries: DataFrame, k: int, sample: int = 64) -> DataFrame:
    """(qid, tid) of the k nearest reference points of ``sample`` queries chosen by hash: a stated query set against all rows."""
    few = queries.select("qid", "x").orderBy(F.xxhash64("qid"), "qid").limit(sample).collect()
    ids, q = [r["qid"] for r in few], np.array([r["x"] for r in few], float)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                tid = pdf["tid"].to_numpy()
                for a, d in pivot_distances(_stack(pdf["x"]), q):
                    i, j = np.indices(d.shape)
                    here = tid[a : a + len(d)]
                    ok = here[i] != np.array(ids)[j]
                    keep = ok & (np.argsort(np.argsort(np.where(ok, d, np.inf), axis=0, kind="stable"), axis=0, kind="stable") < k)
                    yield pd.DataFrame({"qid": np.array(ids)[j[keep]], "tid": here[i[keep]], "d": d[keep]})

    w = Window.partitionBy("qid").orderBy(_round9(F.col("d")), "tid")
    return ref.select("tid", "x").mapInPandas(run, "qid long, tid long, d double").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).select("qid", "tid")


def lsh_neighbours(ref: DataFrame, queries: DataFrame, k: int, tables: int = 6, bucket: float = 1.0, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Approximate J5 by random projections: a query meets the reference points of its own and both adjoining buckets of each table.

    ref: tid, x; queries: qid, x.  Returns the k nearest candidates (qid, tid, d) that aren't the query itself, compared block by block, and all
    candidates (qid, tid), which are formed only where they are read (``tune_lsh`` reads those of a few queries)."""
    fitted = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(ref.select(array_to_vector("x").alias("v")))
    hashed = lambda df, key: fitted.transform(df.select(key, "x", array_to_vector("x").alias("v"))).select(key, "x", F.transform("h", lambda v: vector_to_array(v)[0]).alias("h")).filter(F.col(key).isNotNull())
    r, q = hashed(ref, "tid"), hashed(queries, "qid")

    def rules(near: _Nearest, points: _Points):
        if not hasattr(near, "h"):
            near.h, near.qid = _vectors(near.q.column("h")), np.asarray(near.q.column("qid").cast(pa.int64()))
        h = _vectors(points.rows.column("h"))

        def usable(i, j):
            met = np.zeros(len(i), bool)
            for t in range(tables):
                met |= np.abs(near.h[i, t] - h[j, t]) <= 1
            return met & (near.qid[i] != points.tid[j])

        def reach(near):
            order, rank = _rank_in(near.tid, near.near, near.i)
            last = order[rank == k - 1]
            kth = np.full(len(near.x), np.inf)
            kth[near.i[last]] = near.near[last]
            return kth

        return usable, lambda i, j: np.zeros(len(i), np.int64), reach

    def finish(near: _Nearest, seen: list) -> pa.RecordBatch:
        points = pa.Table.from_batches(seen).combine_chunks()
        return pa.RecordBatch.from_arrays([near.q.column("qid").take(pa.array(near.i)), points.column("tid").take(pa.array(near.at)).combine_chunks(), pa.array(near.d)], ["qid", "tid", "d"])

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    found = _searched(r, q, k, rules, f"qid {kind(q, 'qid')}, tid {kind(r, 'tid')}, d double", finish, distinct=True)
    found = found.groupBy("qid", "tid").agg(F.min("d").alias("d"))  # rows of equal ids
    w = Window.partitionBy("qid").orderBy(_round9(F.col("d")), "tid")
    close = F.exists(F.zip_with("h", "g", lambda a, b: F.abs(a - b) <= 1), lambda x: x)
    met = r.select("tid", "h").crossJoin(q.select("qid", F.col("h").alias("g"))).filter((F.col("qid") != F.col("tid")) & close).select("qid", "tid").distinct()
    return found.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).select("qid", "tid", "d"), met


def tune_lsh(ref: DataFrame, queries: DataFrame, k: int, target: float = 0.9, tables: int = 6, sample: int = 64, start: float = 0.25, most: int = 8) -> tuple[float, float, float]:
    """(bucket length, recall, share of all pairs met): the bucket grows by half until the recall of the k nearest, measured against
    brute force on a sample of the queries, reaches ``target``.  ``start`` is in standard deviations of a vector's components."""
    truth = stage(exact_sample(ref, queries, k, sample))
    few = stage(queries.join(F.broadcast(truth.select("qid").distinct()), "qid", "left_semi"))  # at most ``sample`` rows
    size = math.sqrt(ref.select(F.explode("x").alias("v")).agg(F.avg(F.col("v") * F.col("v"))).first()[0] or 1.0)
    n_ref, wanted, asked = ref.count(), truth.count(), few.count()
    bucket, recall, share = start * size, 0.0, 0.0
    for _ in range(most):
        found, met = lsh_neighbours(ref, few, k, tables, bucket)
        recall = found.join(truth, ["qid", "tid"]).count() / max(wanted, 1)
        share = met.count() / max(n_ref * asked, 1)
        if recall >= target:
            break
        bucket *= 1.5
    return bucket, recall, share


def knn_vote(nb: DataFrame, n_classes: int, weights: str = "uniform") -> DataFrame:
    """(part, qid, excl_fold, label, d) -> (part, qid, excl_fold, class, p); 'distance' weights 1/d, and when a
    neighbour sits at distance 0 only the zero-distance neighbours vote."""
    if weights == "uniform":
        wcol = F.lit(1.0)
    else:
        zero = F.max((F.col("d") == 0).cast("int")).over(Window.partitionBy("part", "qid", "excl_fold"))
        wcol = F.when(zero == 1, (F.col("d") == 0).cast("double")).otherwise(1.0 / F.col("d"))
    v = nb.withColumn("_w", wcol).groupBy("part", "qid", "excl_fold").agg(
        *[F.sum(F.when(F.col("label") == c, F.col("_w")).otherwise(0.0)).alias(f"_c{c}") for c in range(n_classes)],
        F.sum("_w").alias("_t"))
    return v.select("part", "qid", "excl_fold", F.posexplode(F.array(*[F.col(f"_c{c}") / F.col("_t") for c in range(n_classes)]))
                    .alias("class", "p")).withColumn("class", F.col("class").cast("int"))


def knn_oof(train: DataFrame, test: DataFrame | None, k: int, n_classes: int, weights: str = "uniform",
            model: str = "knn", id_col: str = "id", y: str = "label", x: str = "x"):
    """K1 with M11: OOF probabilities (id, model, fold, class, p) and fold-averaged test (id, model, class, p)."""
    ref = train.select(F.col(id_col).alias("tid"), "fold", F.col(y).cast("long").alias("label"), F.col(x).alias("x"))
    q = train.select(F.lit("train").alias("part"), F.col(id_col).alias("qid"), F.array("fold").alias("excl"), F.col(x).alias("x"))
    folds = sorted(r[0] for r in train.select("fold").distinct().collect())
    if test is not None:
        q = q.unionByName(test.select(F.lit("test").alias("part"), F.col(id_col).alias("qid"),
                                      F.array(*[F.lit(f) for f in folds]).alias("excl"), F.col(x).alias("x")))
    votes = cut_lineage(knn_vote(knn_neighbours(ref, q, k), n_classes, weights))
    oof = votes.filter(F.col("part") == "train").select(F.col("qid").alias("id"), F.lit(model).alias("model"),
                                                  F.col("excl_fold").alias("fold"), "class", "p")
    tst = None
    if test is not None:
        tst = (votes.filter(F.col("part") == "test").groupBy("qid", "class").agg(F.avg("p").alias("p"))
               .select(F.col("qid").alias("id"), F.lit(model).alias("model"), "class", "p"))
    return oof, tst
