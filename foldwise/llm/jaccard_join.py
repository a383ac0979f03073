"""N-gram Jaccard join of documents by the chosen-path method.

A document is the set of its word shingles.  Equal sets are one class from the start, so copies never meet each other.

1. Every class gets ``positions`` minima of its set under random orders: sampled tokens that two sets share with probability J.
2. Chosen path: a run starts with all classes in one bucket.  A bucket picks each position with probability
   1 / (threshold x positions), and its classes go on to one bucket per value there; so two sets with J >= threshold go on together
   to one bucket in the mean.  Buckets of one class end; buckets of up to ``small`` are compared by brute force, larger ones
   split again, up to ``max_depth`` (then they are compared in tiles).  The choices follow from a hash of the path, so all levels are joins and
   counts on (path, class).  The mean chance that the runs miss a pair at the threshold itself follows exactly from the positions
   they pick (``missed``); runs are added until it is at most 1 - ``recall`` for the level at which buckets end: 16 runs for two
   levels (64 positions, threshold 0.8), and for the classes met in buckets that went deeper as many more as the level
   reached needs (25 in all for three, 36 for four).  A run that picks no position is passed over.  Closer pairs are missed less, single
   pairs at the threshold whose minima happen to differ more often are missed more.
   Near copies in thousands share most of their minima, so no split parts them.  Each class of a large bucket of the first level is
   therefore compared with the leader (least class) of its buckets first; those that may reach the threshold make one star with it.  From then on
   a bucket whose classes all belong to one star ends: each of its pairs lies in one component of the exact step anyway.
3. Brute force compares 64 one-byte minima; pairs that may reach the threshold (five standard deviations below it) join their
   classes loosely.  Only a spanning star per bucket leaves the task, never its pairs.
4. Exact step: in each loose component the sets themselves are compared, in tiles of ``tile`` classes, by counting
   common shingles; every pair lies in exactly one tile, so links are counted once and only sums per class leave the task.
   Components of the exact links are the result.

A link is missed only if no chain of loosely joined pairs connects its two classes, which is rarer still.

Words: A-Z lower-cased, then ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
Edge cases: a text of fewer words than a shingle is one shingle of them all; a null text, or one without words, has no set, no links and
a class of its own; a null id counts as a document, a class without any id has a null class_id; repeated rows are
documents that link each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.blobs import groups, pack, unpack
from foldwise.llm.common import broadcast_if, fresh, staged, text_key
from foldwise.llm.components import components
from foldwise.llm.decontaminate import bit_set
from foldwise.llm.textkit import ALNUM, SpanHasher, find_words, mix, slices

WORD, SHINGLE = SpanHasher(101), SpanHasher(102)


def shingle_sets(s, size: int):
    """(text, sorted distinct shingle hashes) for each text of a slice that has words."""
    w, buf = find_words(s, ALNUM, lower=True)
    h = WORD.words(buf, w.start, w.end)
    n = np.diff(w.first)
    per = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    start = np.repeat(w.first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())
    g = SHINGLE.windows(h, start, np.repeat(np.minimum(n, size), per))
    ends = np.cumsum(per)
    for i in np.flatnonzero(per):
        x = np.sort(g[ends[i] - per[i] : ends[i]])
        yield i, x[groups(x)[:-1]]


def set_key(x: np.ndarray) -> int:
    """64-bit key of a set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(x))], np.uint64)).view(np.int64)[0])


def _orders(positions: int) -> np.ndarray:
    return np.random.default_rng(11).integers(1, 2**63, positions, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def sampled(docs: DataFrame, id_col: str, text: str, shingle: int, positions: int) -> DataFrame:
    """id, key, r (class of equal sets; null without words), minima (little-endian 32-bit values)."""
    orders = _orders(positions)

    def run(batches):
        for b in batches:
            for s in slices(b.column("text")):
                r, minima = [None] * len(s), [None] * len(s)
                for i, x in shingle_sets(s, shingle):
                    r[i] = set_key(x)
                    minima[i] = ((x[None, :] * orders[:, None]).min(axis=1) >> np.uint64(32)).astype(np.uint32).tobytes() if len(x) < 4096 else \
                        np.array([(x * o).min() >> np.uint64(32) for o in orders], np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([b.column("id").slice(s.first, len(s)), b.column("key").slice(s.first, len(s)), pa.array(r, pa.int64()), pa.array(minima, pa.binary())], ["id", "key", "r", "minima"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, key long, r long, minima binary")


def chosen(path: np.ndarray, positions: int, threshold: float) -> list[np.ndarray]:
    """For each position the rows whose bucket picks it."""
    bound = np.uint64(int(2**64 / (threshold * positions)) - 1)
    return [np.flatnonzero(mix(path + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64)) <= bound) for i in range(positions)]


def missed(picks: np.ndarray, depth: int, threshold: float) -> float:
    """Mean chance that no bucket of level ``depth`` holds both classes of a pair at the threshold; picks[i] runs pick position i at the top."""
    positions = len(picks)
    same = np.arange(positions + 1)  # positions at which the pair's minima are equal
    on = np.ones(positions + 1)  # chance to stay together from one common bucket to the last level
    for _ in range(depth - 1):
        on = 1 - (1 - on * min(1, 1 / (threshold * positions))) ** same
    chance = np.zeros((positions + 1, positions + 1))  # [same, equal positions so far]: chance of them and of having missed
    chance[:, 0] = 1
    for n in picks:
        new = chance * (1 - threshold)
        new[:, 1:] += chance[:, :-1] * threshold * ((1 - on) ** n)[:, None]
        chance = new
    return float(np.trace(chance))


def runs_for(depth: int, positions: int, threshold: float, recall: float) -> list[int]:
    """Numbers of the runs, each of which picks a position, that reach ``recall`` where buckets end at level ``depth``; more depth adds runs at the end."""
    bound = max(1 - recall, 2 * (1 - threshold) ** positions)  # a pair without an equal minimum is missed by any number of runs
    out, picks, k = [], np.zeros(positions, np.int64), 0
    while missed(picks, depth, threshold) > bound:
        k += 1
        got = np.array([len(at) for at in chosen(mix(np.array([k], np.uint64)), positions, threshold)])
        if got.any():
            out.append(k)
            picks += got
    return out


def _descend(rows: DataFrame, positions: int, threshold: float, runs: list[int] | None) -> DataFrame:
    """(path, r): the next buckets of each class.  ``rows`` has r, minima, and path below the first level."""
    def run(batches):
        for b in batches:
            r = np.asarray(b.column("r"))
            m = np.frombuffer(b"".join(b.column("minima").to_pylist()), np.uint32).reshape(len(r), positions).astype(np.uint64)
            tops = [np.full(len(r), mix(np.array([k], np.uint64))[0]) for k in runs] if runs else [np.asarray(b.column("path")).view(np.uint64)]
            for path in tops:
                for i, at in enumerate(chosen(path[:1], positions, threshold) if runs else chosen(path, positions, threshold)):
                    at = np.arange(len(r)) if runs and len(at) else at
                    if len(at):
                        child = mix(path[at] ^ mix(m[at, i] + np.uint64((i + 1) << 32)))
                        yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(r[at])], ["path", "r"])

    return rows.mapInArrow(run, "path long, r long")


def _whole_groups(batches, key: str):
    """Tables that hold all rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        k = np.asarray(b.column(key))
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        if last or (held and np.asarray(held[-1].column(key))[-1] != k[0]):
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index connected to each of n nodes by the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _loose(buckets: DataFrame, least: int) -> DataFrame:
    """(u, v): a star in each bucket for classes joined by pairs with ``least`` equal sketch bytes; rows: path, r, sketch."""
    def run(batches):
        for t in _whole_groups(batches, "path"):
            path, r = np.asarray(t["path"]), np.asarray(t["r"])
            s = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(r), -1)
            a, b, i, held = [], [], np.arange(len(r)), 0
            for d in range(1, len(r)):
                i = i[i + d < len(r)]
                i = i[path[i] == path[i + d]]
                if not len(i):
                    break
                hit = i[(s[i] == s[i + d]).sum(axis=1) >= least]
                a.append(hit)
                b.append(hit + d)
                held += len(hit)
                if held > 1 << 19:  # the pairs so far as stars: near copies link all their pairs
                    root = local_roots(len(r), np.concatenate(a), np.concatenate(b))
                    far = np.flatnonzero(root != np.arange(len(r)))
                    a, b, held = [far], [root[far]], len(far)
            if a:
                root = local_roots(len(r), np.concatenate(a), np.concatenate(b))
                far = root != np.arange(len(r))
                if far.any():
                    yield pa.RecordBatch.from_arrays([pa.array(r[far]), pa.array(r[root[far]])], ["u", "v"])

    return buckets.repartition("path").sortWithinPartitions("path").mapInArrow(run, "u long, v long")


def _stars(hot: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """(u, v): classes of large buckets that have ``least`` sketch bytes in common with the least leader of their buckets; hot: r, leader."""
    named = staged(hot.groupBy("r").agg(F.min("leader").alias("leader")).filter("r <> leader"))
    leaders = staged(named.select("leader").distinct().join(sketches.select(F.col("r").alias("leader"), F.col("sketch").alias("mark")), "leader"))

    def run(batches):
        for b in batches:
            if len(b):
                s, m = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(len(b), -1) for c in ("sketch", "mark"))
                ok = pa.array((s == m).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([b.column("r").filter(ok), b.column("leader").filter(ok)], ["u", "v"])

    # few leaders (one per large bucket at most) to many classes: broadcast if counted to be few, else a join that adaptive execution splits
    return named.join(sketches, "r").join(broadcast_if(leaders), "leader").select("r", "leader", "sketch", "mark").mapInArrow(run, "u long, v long")


def loose_links(classes: DataFrame, threshold: float, positions: int, small: int, max_depth: int, recall: float) -> DataFrame:
    """Edges (u, v) whose components hold every pair of classes that reaches the threshold."""
    least = max(1, math.floor(positions * (threshold - 5 * math.sqrt(threshold * (1 - threshold) / positions))))
    sketch = F.expr("unhex(regexp_replace(hex(minima), '(..)......', '$1'))")
    sketches = classes.select("r", sketch.alias("sketch"))
    edges, deep, reached, done = [], [], min(2, max_depth), 0
    known = None  # (r, star): classes that one star of loose links holds together already
    while len(runs := runs_for(reached, positions, threshold, recall)) > done:
        # a pair meets below level 2 only if both classes are in deep buckets: the others need no more runs
        some = staged(reduce(DataFrame.unionByName, deep).distinct().join(classes.select("r", "minima"), "r")) if done else classes.select("r", "minima")
        level = _descend(some, positions, threshold, runs[done:])
        done = len(runs)
        for depth in range(1, max_depth + 1):
            label = F.coalesce("star", "r") if known is not None else F.col("r")
            level = level.join(broadcast_if(known), "r", "left").withColumn("label", label).drop("star") if known is not None else level.withColumn("label", label)
            # a bucket of one star has no pair that isn't in one component already
            many = level.groupBy("path").agg(F.count("*").alias("n"), F.min("r").alias("leader"), F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b").drop("a", "b")
            shared = staged(level.drop("label").join(many, "path"))
            large = shared.filter(F.col("n") > small)
            any_large = bool(large.limit(1).count())
            if any_large and known is None:
                known = staged(_stars(large.select("r", "leader"), sketches, least))
                edges.append(known)
                known = staged(known.select(F.col("u").alias("r"), F.col("v").alias("star")).unionByName(known.select(F.col("v").alias("r"), F.col("v").alias("star")).distinct()).groupBy("r").agg(F.min("star").alias("star")))
                mixed = large.join(broadcast_if(known), "r", "left").groupBy("path").agg(F.min(F.coalesce("star", "r")).alias("a"), F.max(F.coalesce("star", "r")).alias("b")).filter("a < b").select("path")
                large = staged(large.join(mixed, "path", "left_semi"))
                any_large = bool(large.limit(1).count())
            last = depth == max_depth
            end = shared.filter(F.col("n") <= small).select("path", "r")
            if last and any_large:  # too large still: every two tiles of ``small`` classes meet in a bucket of their own
                tiles = F.ceil(F.col("n") / small).cast("int")
                mine = F.pmod(F.xxhash64("r", "path"), tiles)
                cut = large.withColumn("tiles", tiles).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                end = end.unionByName(cut.select(F.xxhash64("path", F.least("mine", "other"), F.greatest("mine", "other")).alias("path"), "r"))
            edges.append(staged(_loose(end.join(sketches, "r"), least).distinct()))
            if last or not any_large:
                break
            if depth >= 2:
                deep.append(large.select("r"))
                reached = max(reached, depth + 1)
            level = staged(_descend(large.select("path", "r").join(classes.select("r", "minima"), "r"), positions, threshold, None))
    return reduce(DataFrame.unionByName, edges)


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, shingle: int, max_bits: int = 1 << 27) -> DataFrame:
    """(r, shingles) of the documents (id, key) in ``wanted``; a bounded bit set leaves the other texts unread by Python."""
    name = F.xxhash64("id", "key")
    bits = bit_set(wanted.select(name.alias("h")), max_bits)

    def run(batches):
        for b in batches:
            ok = np.flatnonzero(bits.value.test(np.asarray(b.column("h")).view(np.uint64)))
            if not len(ok):
                continue
            for s in slices(b.column("text").take(pa.array(ok))):
                got = list(shingle_sets(s, shingle))
                yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for _, x in got], pa.int64()), pa.array([pack(x) for _, x in got], pa.binary())], ["r", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
    found = rows.select(name.alias("h"), "text").mapInArrow(run, "r long, shingles binary")
    return found.join(wanted.select("r"), "r", "left_semi").groupBy("r").agg(F.first("shingles").alias("shingles"))


def common(sets: list[np.ndarray], left: int | None = None) -> np.ndarray:
    """Numbers of common elements of all pairs, from the elements that two sets or more hold; with ``left``, of the first sets with the others only."""
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    o = np.argsort(every, kind="stable")
    every, row = every[o], row[o]
    g = groups(every)
    n = np.diff(g)
    shared = np.repeat(n > 1, n)
    column = np.repeat(np.cumsum(n > 1) - 1, n)[shared]
    row = row[shared]
    out = np.zeros((len(sets), len(sets)) if left is None else (left, len(sets) - left))
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        at = (column >= c) & (column < c + 4096)
        x = np.zeros((len(sets), 4096), np.float32)
        x[row[at], column[at] - c] = 1
        out += x @ x.T if left is None else x[:left] @ x[left:].T
    return out


def _exact(rows: DataFrame, threshold: float) -> DataFrame:
    """(r, links, root) per class and tile; rows: work, r, mine, i, j, copies, shingles, sorted by work."""
    def run(batches):
        for t in _whole_groups(batches, "work"):
            work, r, mine, i, j, copies = (np.asarray(t[c]) for c in ("work", "r", "mine", "i", "j", "copies"))
            cut = groups(work)
            out = [], [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                at = a + np.argsort(mine[a:b], kind="stable")
                first = int((mine[at] == mine[at[0]]).sum())
                sets = [unpack(t["shingles"][k].as_buffer(), np.uint64) for k in at.tolist()]
                size = np.array([len(x) for x in sets], float)
                if i[a] == j[a]:
                    inter = common(sets)
                    link = inter >= threshold * (size[:, None] + size[None, :] - inter) - 1e-9
                    np.fill_diagonal(link, False)
                    x, y = np.nonzero(np.triu(link))
                    links = link @ copies[at]
                else:  # pairs within a tile belong to the tile's own group
                    inter = common(sets, first)
                    link = inter >= threshold * (size[:first, None] + size[None, first:] - inter) - 1e-9
                    x, y = np.nonzero(link)
                    y = y + first
                    links = np.concatenate([link @ copies[at[first:]], link.T @ copies[at[:first]]])
                out[0].append(r[at])
                out[1].append(links)
                out[2].append(r[at][local_roots(b - a, x, y)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], ["r", "links", "root"])

    return rows.repartition("work").sortWithinPartitions("work").mapInArrow(run, "r long, links long, root long")


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = 0.8, shingle: int = 5, positions: int = 64,
         small: int = 4096, max_depth: int = 4, recall: float = 0.999999, tile: int = 2048) -> DataFrame:
    """doc_id, class_id (least doc_id that links connect it with), n_links (documents with a Jaccard similarity of ``threshold`` or more,
    equal sets included), key (of the text): one row per row of ``docs``."""
    rows = staged(sampled(docs, id_col, text, shingle, positions))
    classes = staged(rows.filter("r IS NOT NULL").groupBy("r").agg(F.count("*").alias("copies"), F.min("id").alias("least"), F.min(F.struct("id", "key")).alias("one"), F.first("minima").alias("minima")))
    loose = staged(components(loose_links(classes, threshold, positions, small, max_depth, recall)))
    members = staged(classes.select("r", "copies", "least", "one.id", "one.key").join(loose, F.col("r") == F.col("node")).select("r", "copies", "least", "id", "key", "root"))
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    sets = sets_of(docs, members, id_col, text, shingle)
    work = members.select("r", "copies", "root").join(sizes, "root").withColumn("mine", F.pmod(F.xxhash64("r"), F.col("tiles")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")) \
        .withColumn("work", F.xxhash64("root", "i", "j")).join(sets, "r")
    exact = staged(_exact(work.select("work", "r", "mine", "i", "j", "copies", "shingles"), threshold))
    links = exact.groupBy("r").agg(F.sum("links").alias("links"), F.min("root").alias("top"))
    if sizes.filter("tiles > 1").limit(1).count():  # a component that lies in one tile is done; others are put together from their tiles
        final = components(exact.select(F.col("r").alias("u"), F.col("root").alias("v")))
        links = links.drop("top").join(final.select(F.col("node").alias("r"), F.col("root").alias("top")), "r", "left")
    named = links.join(members.select("r", "least"), "r").select("r", "least", F.coalesce("top", "r").alias("top"))
    named = named.join(named.groupBy("top").agg(F.min("least").alias("class")), "top").select("r", "class")
    links = links.select("r", "links")
    per = classes.select("r", "copies", "least").join(links, "r", "left").join(named, "r", "left") \
        .select(F.col("r").alias("rr"), F.coalesce("class", "least").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    return rows.join(per, F.col("r") == F.col("rr"), "left").select(
        F.col("id").alias("doc_id"), F.when(F.col("rr").isNull(), F.col("id")).otherwise(F.col("class")).alias("class_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "key")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, that of the least id; rows equal in id and text that link each other become one.

    Documents without words, and classes in which no document has an id, all stay."""
    found = staged(join(docs, id_col, text, **options).filter("n_links > 0"))
    i, k = fresh(docs.columns, "near_id", "near_key")
    named = found.select(F.col("doc_id").alias(i), "class_id", F.col("key").alias(k))
    same = F.col(id_col).eqNullSafe(F.col(i)) & (text_key(text) == F.col(k))
    gone = staged(named.filter(F.col("class_id").isNotNull() & ~F.col(i).eqNullSafe(F.col("class_id"))).select(i, k).distinct())
    left = docs.join(broadcast_if(gone), same, "left_anti")
    twice = staged(named.filter(F.col(i) == F.col("class_id")).groupBy(i, k).agg(F.count("*").alias("n")).filter("n > 1").select(i, k))
    if not twice.limit(1).count():
        return left
    few = broadcast_if(twice)
    once = left.join(few, same, "left_semi").withColumn(k, text_key(text)).dropDuplicates([id_col, k]).drop(k)
    return left.join(few, same, "left_anti").unionByName(once)


JOIN_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, md5(array_to_string(list_slice(w, p, p + 4), ' ')) AS h FROM (SELECT rid, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.rid < b.rid GROUP BY a.rid, b.rid),
l AS (SELECT a, b FROM c JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 9 * i >= 4 * (x.n + y.n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
walk(a, b) AS (SELECT rid, rid FROM d UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a),
cls AS (SELECT a, min(doc_id) AS class_id FROM walk JOIN d ON d.rid = b GROUP BY a),
deg AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links FROM d JOIN cls ON cls.a = rid LEFT JOIN deg ON deg.a = rid
"""
