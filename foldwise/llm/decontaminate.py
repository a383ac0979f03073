"""Benchmark decontamination: prefix-filtered set join of documents with benchmark items.

An item is a set of item-sized windows (``window`` consecutive words; a shorter item is one window), a window a set of
shingles (``shingle`` consecutive words).  A document that contains at least ``containment`` of a window's n shingles misses at
most n - ceil(containment * n) of them, so it holds one of the n - ceil(containment * n) + 1 rarest: the necessary prefix.

1. Scan the documents for shingles of the benchmark and count them: their rarity.
2. Order each window's shingles by rarity; only prefix shingles go to the join.  A bit set of the prefix (its size follows the
   benchmark up to ``max_bits``) tells the second scan which shingles to emit, each with the words around it; false
   positives fall out of the join.  Both sides of the join are hashed by shingle; the benchmark side has each
   distinct window once, and adaptive execution splits a shingle that many documents hold.
3. Length bound: the document has at least as many words as the window must match; positional bound: the shingle's place in the window
   and in the document fix where the window lies, which must be inside the document.
4. Verify: the words at that place equal the window's (containment 1), or hold enough of its shingles in that item-sized window.

Words: A-Z lower-cased, then ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
Edge cases: a null or empty text has no words; an item without words has no window; a null item_id is an item of its own named
``null``; equal windows of several items count for each item; rows with equal doc_id and text are the same document and
get the same result, one row each; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import broadcast_if, fresh, staged, text_key
from foldwise.llm.textkit import ALNUM, SpanHasher, find_words, mix, slices

WORD, SHINGLE = SpanHasher(201), SpanHasher(202)


def tokens(text):
    """array<string> of the words, as a column expression (for the small benchmark side)."""
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def windows(bench: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: wid, words), (wid, item)."""
    words = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), tokens(F.coalesce("text", F.lit(""))).alias("w")).filter(F.size("w") > 0)
    w = words.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("at")) \
        .select("item", F.slice("w", F.col("at"), F.lit(window)).alias("words")).withColumn("wid", F.sha2(F.array_join("words", " "), 256))
    w = staged(w)
    return w.groupBy("wid").agg(F.first("words").alias("words")), w.select("wid", "item").distinct()


def _shingle_batches(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    """(wid, words) -> (wid, n, at, h) for every shingle of each window."""
    for b in batches:
        out: list[tuple] = []
        for wid, words in zip(b.column("wid").to_pylist(), b.column("words").to_pylist(), strict=True):
            h = _word_hashes(words)
            n = max(1, len(words) - shingle + 1)
            g = SHINGLE.windows(h, np.arange(n), min(shingle, len(words))).view(np.int64)
            out += [(wid, len(words), i, int(x)) for i, x in enumerate(g)]
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())], ["wid", "n", "at", "h"])


def _word_hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    end = np.cumsum([len(d) + 1 for d in data]) - 1
    start = end - [len(d) for d in data]
    return WORD.words(np.frombuffer(b" ".join(data), np.uint8), start, end)


class Bits:
    """Bit set of 64-bit keys (one hash); ``bits`` is a power of two, chosen from the number of keys up to a bound."""

    def __init__(self, log2: int):
        self.shift = np.uint64(64 - log2)
        self.data = np.zeros(1 << (log2 - 3), np.uint8)

    def add(self, keys: np.ndarray) -> None:
        at = mix(keys) >> self.shift
        np.bitwise_or.at(self.data, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def test(self, keys: np.ndarray) -> np.ndarray:
        at = mix(keys) >> self.shift
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_set(keys: DataFrame, max_bits: int):
    """Broadcast bit set of the column h: built per task, merged by OR per block of it in tasks, fetched once; its size is bounded by
    max_bits whatever the table's."""
    n = keys.count()
    log2 = int(np.clip(math.ceil(math.log2(max(n, 1) * 16)), 13, int(math.log2(max_bits))))

    def part(batches):
        b = Bits(log2)
        for x in batches:
            b.add(np.asarray(x.column("h")).view(np.uint64))
        block = 1 << 13
        for i in range(0, len(b.data), block):
            if (d := b.data[i : i + block]).any():
                yield pa.RecordBatch.from_arrays([pa.array([i // block], pa.int64()), pa.array([d.tobytes()], pa.binary())], ["block", "data"])

    def merge(batches):
        block, data = None, None
        for x in batches:
            out = []
            for k, d in zip(x.column("block").to_pylist(), x.column("data"), strict=True):
                d = np.frombuffer(d.as_buffer(), np.uint8)
                if k == block:
                    data |= d
                else:
                    if block is not None:
                        out.append((block, data.tobytes()))
                    block, data = k, d.copy()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], ["block", "data"])
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data.tobytes()], pa.binary())], ["block", "data"])

    bits = Bits(log2)
    n_parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = keys.select("h").mapInArrow(part, "block long, data binary").repartition(n_parts, "block").sortWithinPartitions("block").mapInArrow(merge, "block long, data binary")
    for r in blocks.collect():
        d = np.frombuffer(r.data, np.uint8)
        bits.data[r.block * 8192 : r.block * 8192 + len(d)] = d
    return keys.sparkSession.sparkContext.broadcast(bits)


def _scan(docs: DataFrame, bits, shingle: int, lengths: list[int], reach: int, emit: bool) -> DataFrame:
    """Shingles of the documents that are in the bit set.

    emit=False: (h, n), counted per slice of texts.  emit=True: (doc_id, key, h, at, before, after, words): ``words`` are those from
    ``reach`` before the shingle to ``reach`` after its end, ``before`` how many of them come before it; and one row per document
    with h null and at = its number of words."""
    sizes = sorted({min(shingle, n) for n in lengths})

    def run(batches):
        for b in batches:
            ids, keys = (b.column("doc_id"), b.column("key")) if emit else (None, None)
            for s in slices(b.column("text")):
                w, buf = find_words(s, ALNUM, lower=True)
                h = WORD.words(buf, w.start, w.end)
                doc = w.doc
                got = []
                for size in sizes:
                    st = np.arange(max(0, len(h) - size + 1))
                    st = st[doc[st] == doc[st + size - 1]]
                    g = SHINGLE.windows(h, st, size)
                    ok = bits.value.test(g)
                    got.append((g[ok], st[ok], np.full(int(ok.sum()), size)))
                g, st, size = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))
                if not emit:
                    o = np.sort(g)
                    cut = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1], [True]])) if len(o) else np.zeros(1, int)
                    yield pa.RecordBatch.from_arrays([pa.array(o[cut[:-1]].view(np.int64)), pa.array(np.diff(cut))], ["h", "n"])
                    continue
                of = doc[st]
                lo, hi = np.maximum(st - reach, w.first[of]), np.minimum(st + size + reach, w.first[of + 1])
                ctx = [bytes(buf[a:b]).decode() for a, b in zip(w.start[lo], w.end[hi - 1], strict=True)]
                own, key = ids.slice(s.first, len(s)), keys.slice(s.first, len(s))
                yield pa.RecordBatch.from_arrays([
                    own.take(pa.array(of)), key.take(pa.array(of)), pa.array(g.view(np.int64)), pa.array(st - w.first[of]), pa.array(st - lo), pa.array(ctx, pa.string())],
                    ["doc_id", "key", "h", "at", "before", "ctx"])
                n = len(s)
                yield pa.RecordBatch.from_arrays([own, key, pa.nulls(n, pa.int64()), pa.array(np.diff(w.first)), pa.array(np.zeros(n, int)), pa.nulls(n, pa.string())],
                                                 ["doc_id", "key", "h", "at", "before", "ctx"])

    if not emit:
        return docs.select("text").mapInArrow(run, "h long, n long")
    return docs.select("doc_id", text_key("text").alias("key"), "text").mapInArrow(run, "doc_id long, key long, h long, at long, before long, ctx string")


def find_windows(docs: DataFrame, bench: DataFrame, window: int = 10, shingle: int = 5, containment: float = 1.0, max_bits: int = 1 << 27) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc_id, key, n_words; occurrences: doc_id, key, start, len, wid; wid -> item).

    ``docs`` needs doc_id and text.  An occurrence holds at least ``containment`` of the window's shingles in place."""
    wins, items = windows(bench, window)
    shingles = staged(wins.mapInArrow(lambda b: _shingle_batches(b, shingle), "wid string, n int, at int, h long"))
    lengths = [r.n for r in shingles.select("n").distinct().collect()]  # at most ``window`` values
    rarity = _scan(docs, bit_set(shingles.select("h").distinct(), max_bits), shingle, lengths, 0, False).groupBy("h").agg(F.sum("n").alias("seen"))
    # necessary prefix: the rarest n - ceil(c * n) + 1 shingles; one that no document holds can be left out of the join, the others not
    m = F.greatest(F.col("n") - shingle + 1, F.lit(1))
    by_rarity = Window.partitionBy("wid").orderBy("seen", "h", "at")
    prefix = (shingles.join(rarity, "h", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
              .withColumn("rank", F.row_number().over(by_rarity)).filter(F.col("rank") <= m - F.ceil(m * containment) + 1).filter("seen > 0"))
    prefix = staged(prefix.select("wid", "n", F.col("at").alias("off"), "h").join(wins, "wid"))
    found = staged(_scan(docs, bit_set(prefix.select("h").distinct(), max_bits), shingle, lengths, window, True))
    per_doc = found.filter("h IS NULL").select("doc_id", "key", F.col("at").alias("n_words"))
    cand = found.filter("h IS NOT NULL").join(prefix, "h")
    # the window starts ``off`` words before the shingle; both bounds: it lies inside the words around the shingle
    cand = cand.withColumn("ctx", tokens(F.col("ctx"))).withColumn("lead", F.col("before") - F.col("off")).filter((F.col("lead") >= 0) & (F.size("ctx") >= F.col("lead") + F.col("n")))
    there = F.slice("ctx", (F.col("lead") + 1).cast("int"), F.col("n"))
    if containment >= 1:
        cand = cand.filter(there == F.col("words"))
    else:
        size = F.least(F.lit(shingle), F.col("n"))
        same = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.col("n") - shingle + 1, F.lit(1))), lambda i: F.slice("there", i, F.col("size")) == F.slice("words", i, F.col("size"))))
        cand = cand.withColumn("there", there).withColumn("size", size).filter(same >= m * containment)
    hits = cand.select("doc_id", "key", (F.col("at") - F.col("off")).alias("start"), F.col("n").alias("len"), "wid").distinct()
    return per_doc, hits, items


def report(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``."""
    per_doc, hits, items = find_windows(docs, bench, **options)
    hits = staged(hits)
    before = Window.partitionBy("doc_id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.select("doc_id", "key", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    covered = ends.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))))
    words = covered.groupBy("doc_id", "key").agg(F.sum("new").alias("n_hit"))
    named = hits.select("doc_id", "key", "wid").distinct().join(items, "wid").select("doc_id", "key", "item").distinct() \
        .groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    a = per_doc.alias("a")
    for x, name in ((words, "w"), (named, "i")):
        x = x.alias(name)
        a = a.join(x, F.col("a.doc_id").eqNullSafe(F.col(f"{name}.doc_id")) & (F.col("a.key") == F.col(f"{name}.key")), "left")
    ids = F.coalesce("i.items", F.array().cast("array<string>"))
    return a.select("a.doc_id", F.col("a.n_words").cast("long"), F.coalesce("w.n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"), (F.coalesce("w.n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; same columns."""
    _, hits, _ = find_windows(docs, bench, **options)
    i, k = fresh(docs.columns, "bad_id", "bad_key")
    bad = staged(hits.select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct())
    return docs.join(broadcast_if(bad), F.col("doc_id").eqNullSafe(F.col(i)) & (text_key("text") == F.col(k)), "left_anti")


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, array_to_string(list_slice(w, p, p + 9), ' ') AS win, least(len(w), 10) AS n
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
       FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, p, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
cov AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(generate_series(p, p + n - 1)) AS pos FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, coalesce(item_id::VARCHAR, 'null') AS id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN it USING (rid)
"""
