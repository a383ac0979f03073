"""Merkle manifest of a table of documents, with octopus multiproofs.

Tree: a leaf is H (lowercase hex SHA-256) of a document's fields, each ``-`` if null, else byte count, ``:`` and value.  The leaves of
a source ascend by id; every ``FAN`` consecutive nodes (the last run may have fewer) become the H of their digests as hex text,
until one is left, the subroot.  The subroots, ordered by source (null first, bytewise), become the root in the same way.

1. Leaves are hashed by Spark, dealt out by range of (source, id) and numbered: each *leaf partition* holds consecutive leaves, of one
   part of a hot source or of many small sources.  Places within a source follow from counts per (partition, source).
2. Each partition derives every node that it covers alone and hands out only the topmost ones, at most 2 x (FAN - 1) a level and
   source cut by its ends.  Nodes that straddle partitions are completed from these, a grouping of FAN rows a level; the tree
   over the subroots likewise.
3. Octopus: from its two ends alone each partition lists the coordinates (tree, level, place) that the proofs of all its leaves lack,
   minimal and without repeats; one join fetches them.  The partition derives the shared interiors again, expands the proof of each
   leaf from them, and folds the leaf (or its tampered form) to the root with the original siblings.

Shuffled are digests only, three times; texts never move.  A partition has about ``rows_per_part`` leaves at any size of the table.

Edge cases: null fields hash as ``-``; a null id comes first in its source, a null source is the first source; rows equal in (source,
id) ascend by leaf digest, fully equal rows are leaves of their own; an empty text is ``0:``; a single leaf is its subroot, a single
subroot the root, with an empty proof; an empty table has no root and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.common import fold, staged

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: number of the tree over the subroots
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(values: list[Column]) -> Column:
    """H of a document's fields."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# ---- one tree seen from a run of consecutive nodes -----------------------------------------------

def parents_of(n: int) -> int:
    return -(-n // FAN)


def cover(h: list[str], a: int, n: int) -> Iterator[tuple[int, int, int, str]]:
    """(level, place, nodes of the level, digest) of the topmost nodes that leaves a.. of n, with digests ``h``, cover alone."""
    level = 0
    while True:
        b = a + len(h)
        lo, hi = -(-a // FAN), parents_of(b) if b == n else b // FAN
        if n == 1 or lo >= hi:
            yield from ((level, q, n, h[q - a]) for q in range(a, b))
            return
        yield from ((level, q, n, h[q - a]) for q in chain(range(a, FAN * lo), range(FAN * hi, b)))
        h = ["".join(h[FAN * r - a : FAN * (r + 1) - a]) for r in range(lo, hi)]
        h, a, n, level = [digest(x) for x in h], lo, parents_of(n), level + 1


def lacking(a: int, b: int, n: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of leaves a..b-1 of n need and that these leaves don't give: the octopus's arms."""
    level = 0
    while n > 1:
        lo, hi = a // FAN, (b - 1) // FAN + 1
        yield from ((level, q) for q in chain(range(FAN * lo, a), range(b, min(n, FAN * hi))))
        a, b, n, level = lo, hi, parents_of(n), level + 1


def derive(h: list[str], a: int, n: int, fetched: dict[tuple[int, int], str]) -> list[tuple[int, list[str], int]]:
    """(first place, digests, nodes) of each level up to the top, from leaves a.. of n and the fetched nodes."""
    out: list[tuple[int, list[str], int]] = []
    while True:
        level, b = len(out), a + len(h)
        if n > 1:
            lo, hi = FAN * (a // FAN), min(n, FAN * ((b - 1) // FAN + 1))
            h = [fetched[level, q] for q in range(lo, a)] + h + [fetched[level, q] for q in range(b, hi)]
            a = lo
        out.append((a, h, n))
        if n == 1:
            return out
        h, a, n = [digest("".join(h[k : k + FAN])) for k in range(0, len(h), FAN)], a // FAN, parents_of(n)


def _run(levels, level: int, place: int) -> tuple[str, int]:
    """The digests of a node's run as one text, and the node's offset in it."""
    a, h, _ = levels[level]
    first = FAN * (place // FAN) - a
    return "".join(h[first : first + FAN]), 64 * (place % FAN)


def siblings(levels, place: int, start: int = 0) -> str:
    """Digests of the siblings on the path from a node of level ``start`` to the top, level by level, left to right."""
    out = []
    for level in range(start, len(levels) - 1):
        run, at = _run(levels, level, place)
        out.append(run[:at] + run[at + 64 :])
        place //= FAN
    return "".join(out)


def folded(levels, place: int, h: str) -> str:
    """The top digest that follows from ``h`` at a leaf's place and the siblings of its path."""
    for level in range(len(levels) - 1):
        run, at = _run(levels, level, place)
        h, place = digest(run[:at] + h + run[at + 64 :]), place // FAN
    return h


# ---- the manifest --------------------------------------------------------------------------------

@dataclass
class Manifest:
    """leaves: part, i, id, leaf, forged (binary digests; forged only for tampered rows); runs: the part of each source that a leaf
    partition holds (part, tree, a, n, i0, cnt); nodes: tree, level, place, n, digest of all nodes that more than one partition may
    need; root: hex, None for an empty table."""

    leaves: DataFrame
    runs: DataFrame
    nodes: DataFrame
    sources: int
    root: str | None


def _level_up(now: DataFrame) -> DataFrame:
    """The parents of all nodes of a level that has more than one."""
    runs = now.filter("n > 1").groupBy("tree", "level", "n", F.floor(F.col("place") / FAN).alias("up")).agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("run"))
    return runs.select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("place"), F.ceil(F.col("n") / FAN).alias("n"),
                       F.sha2(F.array_join(F.col("run.digest"), "").cast("binary"), 256).alias("digest"))


def _levels(n: int) -> int:
    return max(0, math.ceil(math.log(n, FAN) - 1e-12)) if n > 1 else 0


def build(docs: DataFrame, tampered: Column | None = None, forged: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
          source: str = "source", rows_per_part: int = 50_000) -> Manifest:
    """The manifest of a table.  Rows with ``tampered`` also get the leaf digest that follows if the columns in ``forged`` replace their own."""
    values = [F.col(c) for c in fields]
    other = [(forged or {}).get(c, F.col(c)) for c in fields]
    rows = docs.select(F.col(source).alias("source"), F.col(id_col).alias("id"), F.unhex(leaf_hash(values)).alias("leaf"),
                       (F.when(tampered, F.unhex(leaf_hash(other))) if tampered is not None else F.lit(None).cast("binary")).alias("forged"),
                       F.monotonically_increasing_id().alias("row"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // rows_per_part))
    order = ["source", "id", "leaf", "row"]  # the row only spreads equal documents over partitions
    leaves = staged(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("i"), "source", "id", "leaf", "forged"))
    held = staged(leaves.groupBy("part", "source").agg(F.count("*").alias("cnt"), F.min("i").alias("i0")))
    mine = Window.partitionBy("source").orderBy("part")  # as many rows as partitions at most
    held = held.withColumn("a", F.sum("cnt").over(mine) - F.col("cnt")).withColumn("n", F.sum("cnt").over(Window.partitionBy("source"))) \
        .withColumn("opens", (F.row_number().over(mine) == 1).cast("long"))
    before = held.groupBy("part").agg(F.sum("opens").alias("k"))  # a row a partition
    before = before.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    within = Window.partitionBy("part").orderBy("i0")
    runs = staged(held.join(before, "part").withColumn("tree", F.col("before") + F.sum("opens").over(within) - 1).select("part", "tree", "a", "n", "i0", "cnt", "opens"))
    size = runs.agg(F.sum("opens").alias("sources"), F.max("n").alias("most")).first()
    if not size["sources"]:
        return Manifest(leaves, runs, runs.sparkSession.createDataFrame([], "tree long, level int, place long, n long, digest string"), 0, None)

    def covered(left: pa.Table, right: pa.Table) -> pa.Table:
        at, hexes = _in_order(left)
        out = []
        for run in right.to_pylist():
            h = hexes[at(run["i0"]) : at(run["i0"]) + run["cnt"]]
            out += [(run["tree"], *x) for x in cover(h, run["a"], run["n"])]
        return pa.table(dict(zip(("tree", "level", "place", "n", "digest"), zip(*out, strict=True), strict=True)), schema=NODE)

    node = "tree long, level int, place long, n long, digest string"
    own = staged(leaves.select("part", "i", "leaf").groupBy("part").cogroup(runs.groupBy("part")).applyInArrow(covered, node))
    nodes, root = _complete(own, _levels(size["most"]))
    subroots = nodes.filter((F.col("n") == 1)).select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), F.lit(size["sources"]).cast("long").alias("n"), "digest")
    top, root = _complete(staged(subroots), _levels(size["sources"]))
    return Manifest(leaves, runs, nodes.unionByName(top), size["sources"], root.filter("n = 1").first()["digest"])


#: Arrow schema of nodes
NODE = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])


def _complete(own: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """All nodes that follow from ``own`` (staged), and those of the last level."""
    nodes, now = own, own.filter("level = 0")
    for level in range(levels):
        new = staged(_level_up(now))
        nodes, now = nodes.unionByName(new), own.filter(F.col("level") == level + 1).unionByName(new)
    return nodes, now


def _in_order(left: pa.Table):
    """Index of a row by its number ``i``, and the leaves' digests as hex, of one partition's rows."""
    i = np.asarray(left["i"])
    order = np.argsort(i)
    first = int(i[order[0]])
    hexes = [x.hex() for x in left["leaf"].take(pa.array(order)).to_pylist()]
    return lambda k: k - first, hexes


def prove(m: Manifest, digest_only: bool = False) -> DataFrame:
    """id, leaf, subroot, root, proof, folded_root, verified: one row per document (hex digests).

    ``proof`` is the concatenated hex of the siblings level by level to the root, or its SHA-256 if ``digest_only``.  ``folded_root`` is
    recomputed from the leaf (its forged form where it has one) and the original siblings; verified: it equals the root."""
    trees = m.runs.select("part", "tree", "a", (F.col("a") + F.col("cnt")).alias("b"), "n")
    ends = m.runs.groupBy("part").agg(F.lit(TOP).cast("long").alias("tree"), F.min("tree").alias("a"), (F.max("tree") + 1).alias("b")).withColumn("n", F.lit(m.sources).cast("long"))

    def arms(batches):
        for batch in batches:
            out = [(r["part"], r["tree"], *x) for r in batch.to_pylist() for x in lacking(r["a"], r["b"], r["n"])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["part", "tree", "level", "place"])

    wanted = trees.unionByName(ends).mapInArrow(arms, "part int, tree long, level int, place long")
    fetched = wanted.join(m.nodes.select("tree", "level", "place", "digest"), ["tree", "level", "place"])
    none = F.lit(None)
    beside = fetched.select("part", "tree", "level", "place", none.cast("long").alias("n"), none.cast("long").alias("i0"), none.cast("long").alias("cnt"), "digest") \
        .unionByName(m.runs.select("part", "tree", F.lit(-1).alias("level"), F.col("a").alias("place"), "n", "i0", "cnt", none.cast("string").alias("digest")))
    root, sources = m.root, m.sources
    kind = m.leaves.schema["id"].dataType.simpleString()

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        at, hexes = _in_order(left)
        left = left.take(pa.array(np.argsort(np.asarray(left["i"]))))
        forged = left["forged"].to_pylist()
        fetched: dict[int, dict] = {}
        runs = []
        for r in right.to_pylist():
            if r["level"] < 0:
                runs.append(r)
            else:
                fetched.setdefault(r["tree"], {})[r["level"], r["place"]] = r["digest"]
        runs.sort(key=lambda r: r["tree"])
        seen = [derive(hexes[at(r["i0"]) : at(r["i0"]) + r["cnt"]], r["place"], r["n"], fetched.get(r["tree"], {})) for r in runs]
        top = derive([x[-1][1][0] for x in seen], runs[0]["tree"], sources, fetched.get(TOP, {}))
        out: tuple[list, ...] = ([], [], [])
        for r, levels in zip(runs, seen, strict=True):
            subroot, above = levels[-1][1][0], siblings(top, r["tree"])
            shared: tuple[int, str, str] = (-1, "", "")  # run of leaves: its digests, the siblings above
            for k in range(r["cnt"]):
                place = r["place"] + k
                if r["n"] == 1:
                    proof = above
                else:
                    if shared[0] != place // FAN:
                        shared = (place // FAN, _run(levels, 0, place)[0], siblings(levels, place // FAN, 1) + above)
                    cut = 64 * (place % FAN)
                    proof = shared[1][:cut] + shared[1][cut + 64 :] + shared[2]
                bad = forged[at(r["i0"]) + k]
                out[0].append(subroot)
                out[1].append(digest(proof) if digest_only else proof)
                out[2].append(top[-1][1][0] if bad is None else folded(top, r["tree"], folded(levels, place, bad.hex())))
        return pa.table({"id": left["id"], "leaf": pa.array(hexes, pa.string()), "subroot": pa.array(out[0], pa.string()), "root": pa.array([root] * len(hexes), pa.string()),
                         "proof": pa.array(out[1], pa.string()), "folded_root": pa.array(out[2], pa.string()), "verified": pa.array([x == root for x in out[2]], pa.bool_())})

    return m.leaves.select("part", "i", "id", "leaf", "forged").groupBy("part").cogroup(beside.groupBy("part")).applyInArrow(
        expand, f"id {kind}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean")


def report(docs: DataFrame) -> DataFrame:
    """Proof of every document; where 5 divides crc32 of the id, the text was lower-cased (A-Z) after the manifest was made."""
    m = build(docs, fold("doc_id", 5) == 0, {"text": F.translate(F.col("text"), UPPER, LOWER)})
    return prove(m, digest_only=True).withColumnsRenamed({"id": "doc_id", "proof": "proof_sha256"})


REPORT_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
  || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM documents),
e AS (SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0
  THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS forged FROM d, crc),
s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM e GROUP BY source),
l AS (SELECT rid, doc_id, leaf, forged, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source),
t(tree, level, place, h, n) AS (SELECT tree, 0, place, leaf, n FROM l
  UNION ALL SELECT tree, level + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16 FROM t WHERE n > 1 GROUP BY tree, level, place // 16, n),
sub AS (SELECT tree, h FROM t WHERE n = 1),
u(level, place, h, n) AS (SELECT 0, tree, h, (SELECT count(*) FROM sub) FROM sub
  UNION ALL SELECT level + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16 FROM u WHERE n > 1 GROUP BY level, place // 16, n),
both_ AS (SELECT tree, level, place, h, n FROM t UNION ALL SELECT -1, level, place, h, n FROM u),
top AS (SELECT h FROM u WHERE n = 1),
steps(rid, tree, level, place, n, own) AS (SELECT rid, tree, 0, place, n, tree FROM l
  UNION ALL SELECT rid, CASE WHEN n > 1 THEN tree ELSE -1 END, CASE WHEN n > 1 THEN level + 1 ELSE 0 END, CASE WHEN n > 1 THEN place // 16 ELSE own END, CASE WHEN n > 1 THEN (n + 15) // 16 ELSE (SELECT count(*) FROM sub) END, own
  FROM steps WHERE n > 1 OR tree >= 0),
p AS (SELECT rid, string_agg(h, '' ORDER BY steps.tree < 0, steps.level, both_.place) AS sib FROM steps JOIN both_ ON both_.tree = steps.tree AND both_.level = steps.level AND both_.place // 16 = steps.place // 16 AND both_.place <> steps.place GROUP BY rid),
f(rid, tree, level, place, n, own, h) AS (SELECT rid, tree, 0, place, n, tree, coalesce(forged, leaf) FROM l
  UNION ALL SELECT rid, f.tree, f.level + 1, f.place // 16, (f.n + 15) // 16, own, sha256(string_agg(CASE WHEN b.place = f.place THEN f.h ELSE b.h END, '' ORDER BY b.place))
  FROM f JOIN both_ b ON b.tree = f.tree AND b.level = f.level AND b.place // 16 = f.place // 16 WHERE f.n > 1 GROUP BY rid, f.tree, f.level, f.place, f.n, own),
g(rid, level, place, n, h) AS (SELECT rid, 0, own, (SELECT count(*) FROM sub), h FROM f WHERE n = 1
  UNION ALL SELECT rid, g.level + 1, g.place // 16, (g.n + 15) // 16, sha256(string_agg(CASE WHEN b.place = g.place THEN g.h ELSE b.h END, '' ORDER BY b.place))
  FROM g JOIN u b ON b.level = g.level AND b.place // 16 = g.place // 16 WHERE g.n > 1 GROUP BY rid, g.level, g.place, g.n)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(coalesce(sib, '')) AS proof_sha256, g.h AS folded_root, g.h = top.h AS verified
FROM l JOIN sub ON sub.tree = l.tree JOIN g ON g.rid = l.rid AND g.n = 1 LEFT JOIN p ON p.rid = l.rid, top
"""
