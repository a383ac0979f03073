"""Seed sweeps and seed averages (K12, K13, S6) of the encoded naive Bayes flow: all seeds in one plan.

A row carries its folds as an array, one entry per seed.  Folds of all seeds come from one ranking, encoder counts from one aggregation
by (seed, value, fold, class), moments from one pass by (seed, fold, class), and one pass scores all seeds: the number of passes
over the rows does not depend on the number of seeds.  Counts and moments are numbers per seed, fold, class and value, checked to be
few before they are broadcast; rows are never multiplied but for their narrow (id, label) in the ranking and (value, fold, class) in the counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.bayes import NaiveBayesFit
from foldwise.operators.extra_trees import matrix
from foldwise.operators.linear_svm import packed_sums
from foldwise.session import BROADCAST_MAX_BYTES, stage, table_bytes


def seeded_folds(df: DataFrame, id_col: str, label: str, k: int, seeds: list[int], prefix: int = 4) -> DataFrame:
    """(id, folds): the stratified folds of ``stratified_kfold`` for every seed, in the order of ``seeds``; ids are distinct.

    As there, ranks are taken within (seed, class, hash bucket) and offset by bucket counts, so no task holds a class."""
    each = df.select(F.col(id_col).alias("id"), F.isnull(label).alias("_stn"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("_stv"),
                     F.posexplode(F.array(*[F.lit(str(s)) for s in seeds])).alias("s", "seed"))
    each = each.withColumn("_h", F.md5(F.concat_ws(":", "seed", F.col("id").cast("string")))).withColumn("_b", F.substring("_h", 1, prefix))
    keys = ["s", "_stn", "_stv", "_b"]
    ranked = each.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_h", "id"))).select("id", *keys, "_rn")
    counts = each.groupBy(*keys).agg(F.count("*").alias("n"))
    before = counts.select(*keys, (F.sum("n").over(Window.partitionBy("s", "_stn", "_stv").orderBy("_b")) - F.col("n")).alias("_off"))
    fold = ((F.col("_off") + F.col("_rn") - 1) % k).cast("int")
    return ranked.join(before, keys).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("s", fold.alias("f")))).alias("l")).select("id", F.col("l.f").alias("folds"))


@dataclass
class Sweep:
    """All seeds' fits of one model: numeric features, encoded columns of ``encoded`` values (or none), naive Bayes parameters by seed."""

    seeds: list[int]
    classes: int
    features: list[str]
    encoded: str | None
    tables: list[dict]  # by seed: (fold, value) -> class shares outside the fold; (None, value) -> their mean over folds
    fits: list[NaiveBayesFit]

    def inputs(self, x: np.ndarray, values: pa.DictionaryArray, s: int, folds: np.ndarray | None) -> np.ndarray:
        """Features of rows for a seed: class shares of the value (by each row's fold, or the mean over folds: None) before the numbers."""
        if self.encoded is None:
            return x
        even = np.full(self.classes, 1.0 / self.classes)
        t, known = self.tables[s], [*values.dictionary.to_pylist(), None]
        code = values.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)
        every, fold = (np.array([None]), np.zeros(len(x), int)) if folds is None else np.unique(folds, return_inverse=True)
        shares = np.array([[t.get((f, v), even) for v in known] for f in every.tolist()]).reshape(len(every), len(known), self.classes)
        return np.concatenate([shares[fold, code], x], axis=1)


def _arrow(df: DataFrame, features: list[str], encoded: str | None, *more: str) -> DataFrame:
    value = F.col(encoded).cast("string") if encoded else F.lit(None).cast("string")
    return df.select("id", F.array(*[F.col(c).cast("double") for c in features]).alias("x"), value.alias("v"), *more)


def fit(train: DataFrame, features: list[str], encoded: str | None, classes: int, seeds: list[int], k: int = 5, var_smoothing: float = 1e-9, folds: DataFrame | None = None) -> tuple[Sweep, DataFrame]:
    """train: id, y (0 .. classes - 1), features without nulls, the encoded column.  Returns the fits and the staged rows with their folds;
    several fits of the same rows and seeds may share the ``folds`` of ``seeded_folds``.

    The encoder's counts by (seed, value, fold) must fit the broadcast bound; a column with more values raises (fit it seed by seed)."""
    rows = _arrow(train, features, encoded, F.col("y").cast("int").alias("y"))
    rows = stage(rows.join(seeded_folds(train.select("id", "y"), "id", "y", k, seeds) if folds is None else folds, "id"))
    tables: list[dict] = [{} for _ in seeds]
    if encoded:
        counts = rows.filter("v IS NOT NULL").select("v", "y", F.posexplode("folds").alias("s", "f")).groupBy("s", "v", "f") \
            .agg(*[F.count(F.when(F.col("y") == c, 1)).alias(f"c{c}") for c in range(classes)])
        counts = stage(counts)
        if table_bytes(counts) > BROADCAST_MAX_BYTES:
            raise ValueError(f"{encoded} has too many values for a table of all seeds")
        got = counts.toArrow().to_pydict()
        own: dict = {}
        for i, key in enumerate(zip(got["s"], got["v"], got["f"], strict=True)):
            own[key] = np.array([got[f"c{c}"][i] for c in range(classes)], float)
        for s in range(len(seeds)):
            for v in {v for t, v, _ in own if t == s}:
                cells = np.array([own.get((s, v, f), np.zeros(classes)) for f in range(k)])
                left = cells.sum(axis=0) - cells
                n = left.sum(axis=1, keepdims=True)
                share = np.where(n > 0, left / np.maximum(n, 1), 1.0 / classes)
                tables[s] |= {(f, v): share[f] for f in range(k)} | {(None, v): share.mean(axis=0)}
    sweep = Sweep(list(seeds), classes, features, encoded, tables, [])
    middle = rows.agg(*[F.avg(F.col("x")[i]).alias(str(i)) for i in range(len(features))]).first()
    shift = np.concatenate([np.zeros(classes if encoded else 0), [float(middle[str(i)] or 0) for i in range(len(features))]])
    d = len(shift)
    shared = rows.sparkSession.sparkContext.broadcast(sweep)

    def sums(b):
        m, x, y, v = shared.value, matrix(b), np.asarray(b.column("y")), b.column("v").dictionary_encode()
        folds = b.column("folds").flatten().to_numpy().reshape(len(x), -1)
        for s in range(len(seeds)):
            z = m.inputs(x, v, s, folds[:, s]) - shift
            cell = folds[:, s] * classes + y
            out = [np.bincount(cell, minlength=k * classes)]
            for part in (z, z * z):
                out += [np.bincount(cell, part[:, j], k * classes) for j in range(d)]
            yield s, np.array(out, float).ravel()

    got = packed_sums(rows, sums)
    for s in range(len(seeds)):
        a = got[s].reshape(1 + 2 * d, k, classes)
        cells = []
        for f in range(k):
            for c in range(classes):
                n = a[0, f, c]
                if n:
                    mean = a[1 : d + 1, f, c] / n
                    var = np.maximum(a[d + 1 :, f, c] / n - mean**2, 0)
                    cells.append({"fold": f, "cls": c, "n": int(n)} | {f"k{j}": int(n) for j in range(d)} | {f"m{j}": mean[j] + shift[j] for j in range(d)} | {f"v{j}": var[j] for j in range(d)})
        sweep.fits.append(NaiveBayesFit(cells, d, var_smoothing))
    shared.unpersist()
    return sweep, rows


def oof_accuracy(sweep: Sweep, rows: DataFrame) -> DataFrame:
    """(seed, n, accuracy) of the out-of-fold decisions (largest probability, the first class on ties), all seeds in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(sweep)

    def hits(b):
        m, x, y, v = shared.value, matrix(b), np.asarray(b.column("y")), b.column("v").dictionary_encode()
        folds = b.column("folds").flatten().to_numpy().reshape(len(x), -1)
        out = np.zeros((len(m.seeds), 2))
        for s, nb in enumerate(m.fits):
            z = m.inputs(x, v, s, folds[:, s])
            for f in np.unique(folds[:, s]):
                at = folds[:, s] == f
                pick = np.array(nb.classes)[nb._probs(z[at], int(f)).argmax(axis=1)]
                out[s] += [at.sum(), (pick == y[at]).sum()]
        yield 0, out.ravel()

    a = packed_sums(rows, hits).get(0, np.zeros(2 * len(sweep.seeds))).reshape(-1, 2)
    return rows.sparkSession.createDataFrame([(int(s), int(n), float(h / n) if n else None) for s, (n, h) in zip(sweep.seeds, a, strict=True)], "seed int, n long, accuracy double")


def test_probabilities(sweep: Sweep, test: DataFrame, model: str) -> DataFrame:
    """(seed, id, model, class, p) of test rows, mean over each seed's fold models, all seeds in one pass."""
    shared = test.sparkSession.sparkContext.broadcast(sweep)

    def run(batches):
        for b in batches:
            m, x, v, ids = shared.value, matrix(b), b.column("v").dictionary_encode(), np.asarray(b.column("id"))
            for s, nb in enumerate(m.fits):
                if not len(x):
                    continue
                z = m.inputs(x, v, s, None)
                p = sum(nb._probs(z, f) for f in nb.folds) / len(nb.folds)
                n, c = p.shape
                cols = [np.full(n * c, m.seeds[s], np.int32), np.repeat(ids, c), np.full(n * c, model), np.tile(np.array(nb.classes, np.int32), n), p.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.string()), pa.array(cols[3]), pa.array(cols[4])], ["seed", "id", "model", "class", "p"])

    return _arrow(test, sweep.features, sweep.encoded).mapInArrow(run, "seed int, id long, model string, class int, p double")
