"""Substring deduplication: every window of ``size`` words that starts earlier in the corpus too is cut out.

1. Count-min prefilter.  Each map task sketches the windows of its texts in parts (two rows of counters that stop at 2, sent as the gaps
   between touched cells); parts are merged by adding, per block of cells.  A merged counter is never below the true count,
   so a window that occurs twice is estimated repeated: none is lost.  The width follows the corpus up to
   ``max_cells``; a fuller sketch only lets more windows pass to the exact step.
2. Exact grouping of the windows estimated repeated, by a 96-bit fingerprint.  A map task first groups its own chunk: of equal windows
   only the earliest goes on, the others are already known to repeat, so a passage that a third of all documents share
   sends one entry per chunk; marks known to be late are dealt over all ranges in pieces.  Entries travel as compressed arrays, one row per (chunk, fingerprint range).
3. The marks (document, start) go back to the documents by a hash of id and text, where covered words are cut; copies with
   different ids lie in different chunks, and a document given so often that its rows would fill a chunk is cut once.

Earlier: by doc_id (null first), then by a key of the text, then by start.
Words: ``[^\x20\x09-\x0D]+``, unchanged.  Edge cases: a null or empty text has no words; a text of fewer than ``size`` words
keeps all; rows equal in doc_id and text are the same document: none is earlier than the other and they get the same
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.blobs import cells, gaps, groups, pack, unpack
from foldwise.llm.common import staged, text_bytes, text_key
from foldwise.llm.textkit import NOT_SPACE, SpanHasher, find_words, slices

WORD, WINDOW, CHECK = SpanHasher(401), SpanHasher(402), SpanHasher(403)
ROWS = 2
BLOCK = 20  # log2 of the cells of a block
PART = 4_000_000  # windows of a partial sketch
CHUNK = 500_000  # windows grouped in a map task before they are sent
PIECE = 65_536  # known marks that go to one bucket together
HEAVY = 8 << 20  # bytes of the rows of one document from which they are cut as one row
NULL_ID = np.iinfo(np.int64).min


def _windows(s, size: int):
    """(word hashes, word index of each window's start, words)."""
    w, buf = find_words(s, NOT_SPACE)
    h = WORD.words(buf, w.start, w.end)
    n = np.maximum(np.diff(w.first) - size + 1, 0)
    start = np.repeat(w.first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return h, start, n, w


def _cell(h: np.ndarray, row: int, log2: int) -> np.ndarray:
    """Cell of a window in a row of the sketch: high bits, or bits of a product with an odd constant."""
    return ((h * np.uint64(0x9E3779B97F4A7C15) if row else h) >> np.uint64(64 - log2)).astype(np.uint32)


def sketch(texts: DataFrame, size: int, log2: int):
    """Broadcast list of bit arrays, one per row: which cells count two windows or more."""
    blocks = 1 << max(0, log2 - BLOCK)

    def flush(parts):
        h = np.concatenate(parts)
        for row in range(ROWS):
            c = np.sort(_cell(h, row, log2))
            first = groups(c)[:-1]
            one, two = c[first], c[first[np.diff(np.append(first, len(c))) > 1]]
            cut1, cut2 = (np.searchsorted(x, np.arange(blocks + 1) << BLOCK) for x in (one, two))
            base = np.arange(blocks, dtype=np.int64) << BLOCK
            have = np.flatnonzero(np.diff(cut1))
            yield pa.RecordBatch.from_arrays([
                pa.array((row * blocks + have).astype(np.int32)),
                pa.array([gaps(one[cut1[b] : cut1[b + 1]] - base[b]) for b in have], pa.binary()),
                pa.array([gaps(two[cut2[b] : cut2[b + 1]] - base[b]) for b in have], pa.binary())], ["block", "one", "two"])

    def part(batches):
        held, n = [], 0
        for b in batches:
            for s in slices(b.column("text")):
                h, start, _, _ = _windows(s, size)
                held.append(WINDOW.windows(h, start, size))
                n += len(start)
                if n >= PART:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    def merge(batches):
        width = 1 << min(log2, BLOCK)
        at, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

        for b in batches:
            for block, one, two in zip(b.column("block").to_pylist(), b.column("one"), b.column("two"), strict=True):
                if block != at:
                    if at is not None:
                        yield done()
                    at, once, twice = block, np.zeros(width, bool), np.zeros(width, bool)
                c = cells(one.as_buffer())
                twice[c[once[c]]] = True
                once[c] = True
                twice[cells(two.as_buffer())] = True
        if at is not None:
            yield done()

    parts = texts.select("text").mapInArrow(part, "block int, one binary, two binary")
    got = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary").toArrow()
    each = (1 << min(log2, BLOCK)) // 8
    bits = [np.zeros(max(1, (1 << log2) // 8), np.uint8) for _ in range(ROWS)]
    for block, data in zip(got["block"].to_pylist(), got["bits"], strict=True):
        bits[block // blocks][(block % blocks) * each :][:each] = np.frombuffer(data.as_buffer(), np.uint8)
    return texts.sparkSession.sparkContext.broadcast(bits)


def _repeated(bits: list[np.ndarray], h: np.ndarray, log2: int) -> np.ndarray:
    """Where the estimate (the least counter of the rows) is two or more."""
    ok = np.ones(len(h), bool)
    for row, data in enumerate(bits):
        at = np.flatnonzero(ok)
        c = _cell(h[at], row, log2)
        ok[at] = (data[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return ok


def _salts(task: int, buckets: int):
    """Buckets for a task's pieces of known marks: one after the other, from a place of its own (multiples of the golden ratio)."""
    first = (task * 0x9E3779B1 % (1 << 32)) * buckets >> 32
    return (x % buckets for x in count(first))


def _entries(docs: DataFrame, size: int, bits, log2: int, buckets: int) -> DataFrame:
    """(bucket, known, h, c, id, key, start): windows estimated repeated, by range of fingerprints, and marks known to be late."""
    shift = np.uint64(64 - int(math.log2(buckets))) if buckets > 1 else None

    def entries(batches):
        held, n, salts = [], 0, _salts(TaskContext.get().partitionId(), buckets)
        for b in batches:
            ids, keys = np.asarray(b.column("id")), np.asarray(b.column("key"))
            for s in slices(b.column("text")):
                h, start, each, w = _windows(s, size)
                g = WINDOW.windows(h, start, size)
                ok = _repeated(bits.value, g, log2)
                doc = np.repeat(np.arange(len(s)), each)[ok] + s.first
                at = start[ok]
                c = (CHECK.windows(h, at, size) >> np.uint64(32)).astype(np.uint32)
                held.append((g[ok], c, ids[doc], keys[doc], (at - w.first[doc - s.first]).astype(np.int32)))
                n += len(at)
                if n >= CHUNK:
                    yield _chunk(held, shift, salts)
                    held, n = [], 0
        if n:
            yield _chunk(held, shift, salts)

    return docs.select("id", "key", "text").mapInArrow(entries, "bucket int, known boolean, h binary, c binary, id binary, key binary, start binary")


def marks(docs: DataFrame, size: int, bits, log2: int, buckets: int, chunks: int) -> DataFrame:
    """(chunk, id, key, n, start): per chunk of documents, the starts of windows that are not the earliest of their words.

    ``docs`` has id (null as the smallest long), key and text; n[i] starts belong to document (id[i], key[i])."""
    def group(t: pa.Table) -> pa.Table:
        known = t.filter(pa.compute.equal(t["known"], True))
        own = t.filter(pa.compute.equal(t["known"], False))
        h, c, ids, keys, start = _read(own, True)
        if len(h):
            o = np.lexsort((start, keys, ids, c, h))
            h, c, ids, keys, start = (x[o] for x in (h, c, ids, keys, start))
            g = groups(h, c)
            first = np.repeat(g[:-1], np.diff(g))
            late = (ids != ids[first]) | (keys != keys[first]) | (start != start[first])
            ids, keys, start = ids[late], keys[late], start[late]
        _, _, i2, k2, s2 = _read(known, False)
        return _by_chunk(np.concatenate([ids, i2]), np.concatenate([keys, k2]), np.concatenate([start, s2]), chunks)

    return _entries(docs, size, bits, log2, buckets).groupBy("bucket").applyInArrow(group, "chunk int, id binary, key binary, n binary, start binary")


def _chunk(held: list, shift, salts) -> pa.RecordBatch:
    """One row per fingerprint range, of the chunk's earliest windows, and one row per piece of those known to be later ones."""
    h, c, ids, keys, start = (np.concatenate(x) for x in zip(*held, strict=True))
    o = np.lexsort((start, keys, ids, c, h))
    h, c, ids, keys, start = (x[o] for x in (h, c, ids, keys, start))
    g = groups(h, c)
    first = np.repeat(g[:-1], np.diff(g))
    late = (ids != ids[first]) | (keys != keys[first]) | (start != start[first])
    lead = np.zeros(len(h), bool)
    lead[g[:-1]] = True  # rows of one document given twice are one entry
    rows = {k: [] for k in ("bucket", "known", "h", "c", "id", "key", "start")}

    def put(bucket, known, pick):
        none = pick[:0] if known else pick  # a known mark needs no fingerprint
        for k, v in zip(rows, (bucket, known, pack(h[none]), pack(c[none]), pack(ids[pick]), pack(keys[pick]), pack(start[pick])), strict=True):
            rows[k].append(v)

    at = np.flatnonzero(lead)
    bucket = (h >> shift).astype(np.int32) if shift is not None else np.zeros(len(h), np.int32)
    at = at[np.lexsort((start[at], keys[at], ids[at], bucket[at]))]  # by document: its id and key are then sent almost for free
    cut = groups(bucket[at])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            put(int(bucket[at[a]]), False, at[a:b])
    if late.any():
        pick = np.flatnonzero(late)
        pick = pick[np.lexsort((start[pick], keys[pick], ids[pick]))]
        for i in range(0, len(pick), PIECE):
            put(next(salts), True, pick[i : i + PIECE])
    kinds = {"bucket": pa.int32(), "known": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()], list(rows))


def _read(t: pa.Table, hashes: bool) -> list[np.ndarray]:
    out = []
    for name, kind in (("h", np.uint64), ("c", np.uint32), ("id", np.int64), ("key", np.int64), ("start", np.int32)):
        got = [unpack(x.as_buffer(), kind) for x in t[name]] if hashes or name not in "hc" else []
        out.append(np.concatenate(got) if got else np.zeros(0, kind))
    return out


def chunk_of(ids: np.ndarray, keys: np.ndarray, chunks: int) -> np.ndarray:
    """pmod(xxhash64(id, key), chunks) as Spark computes it."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rotl = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = np.full(len(ids), 42, np.uint64)
    for x in (ids, keys):
        h = h + p5 + np.uint64(8)
        h = rotl(h ^ (rotl(x.view(np.uint64) * p2, 31) * p1), 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
    return (h.view(np.int64) % chunks).astype(np.int32)


def _by_chunk(ids, keys, start, chunks: int) -> pa.Table:
    chunk = chunk_of(ids, keys, chunks)
    o = np.lexsort((start, ids, keys, chunk))
    chunk, ids, keys, start = (x[o] for x in (chunk, ids, keys, start))
    cut, rows = groups(chunk), {k: [] for k in ("chunk", "id", "key", "n", "start")}
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            d = groups(ids[a:b], keys[a:b])
            for k, v in zip(rows, (int(chunk[a]), pack(ids[a:b][d[:-1]]), pack(keys[a:b][d[:-1]]), pack(np.diff(d).astype(np.int32)), pack(start[a:b])), strict=True):
                rows[k].append(v)
    return pa.table([pa.array(v, pa.int32() if k == "chunk" else pa.binary()) for k, v in rows.items()], names=list(rows))


def _starts(t: pa.Table) -> dict:
    """(id, key) -> list of arrays of starts."""
    out: dict = {}
    for i, k, n, s in zip(t["id"], t["key"], t["n"], t["start"], strict=True):
        s, end = unpack(s.as_buffer(), np.int32), np.cumsum(unpack(n.as_buffer(), np.int32))
        for doc, a, b in zip(zip(unpack(i.as_buffer(), np.int64).tolist(), unpack(k.as_buffer(), np.int64).tolist(), strict=True), [0, *end[:-1]], end, strict=True):
            out.setdefault(doc, []).append(s[a:b])
    return out


def _cut(size: int, digest: bool):
    def cut(docs: pa.Table, found: pa.Table) -> pa.Table:
        starts = _starts(found)
        ids, n, gone, kept = docs["id"].to_pylist(), [], [], []
        for i, k, text in zip(ids, docs["key"].to_pylist(), docs["text"], strict=True):
            words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()  # bytes.split() takes \x20 and \x09-\x0D
            n.append(len(words))
            removed = 0
            if got := starts.get((i, k)):
                edge = np.zeros(len(words) + size + 1, np.int32)
                for s in got:
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + size, -1)
                keep = (np.cumsum(edge)[: len(words)] == 0)
                removed = len(words) - int(keep.sum())
                words = compress(words, keep.tolist())
            gone.append(removed)
            out = b" ".join(words)
            kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode())
        return pa.table([docs["row"], docs["id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["row", "id", "n_words", "n_removed", "kept"]).append_column("rows", docs["rows"])

    return cut


def _once(base: DataFrame, heavy: int) -> DataFrame:
    """``base`` with the column rows: 1, or for a document whose rows hold more than ``heavy`` bytes one row for all of them."""
    name = ["row", "id", "key"]
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64)
    many = staged(base.groupBy(*name).agg(size.alias("size"), F.count("*").alias("rows")).filter((F.col("size") > heavy) & (F.col("rows") > 1)).select(*name, "rows"))
    if not many.limit(1).count():
        return base.withColumn("rows", F.lit(1).cast("long"))
    few = F.broadcast(many)  # at most one for each ``heavy`` bytes of the corpus
    first = base.join(few, name, "left_semi").groupBy(*name).agg(F.first("text").alias("text")).join(few, name)
    return base.join(few, name, "left_anti").withColumn("rows", F.lit(1).cast("long")).unionByName(first)


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 20, digest: bool = False, max_cells: int = 1 << 29, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left joined by one space, or its SHA-256): one row per row of ``docs``."""
    total = text_bytes(docs, text)
    windows = max(1, total // 6)
    log2 = int(np.clip(math.ceil(math.log2(windows * 1.5)), 16, int(math.log2(max_cells))))
    buckets = 1 << max(0, math.ceil(math.log2(windows / 1_000_000)))
    chunks = max(1, total >> 23)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NULL_ID))).alias("id"), F.col(id_col).isNull().alias("row"), text_key(text).alias("key"), F.col(text).alias("text"))
    bits = sketch(base, size, log2)
    found = marks(base, size, bits, log2, buckets, chunks)
    chunk = F.pmod(F.xxhash64("id", "key"), F.lit(chunks)).cast("int")  # as chunk_of
    out = _once(base, heavy).withColumn("chunk", chunk).groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_cut(size, digest), "row boolean, id long, n_words long, n_removed long, kept string, rows long")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return out.select(F.when(~F.col("row"), F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept")


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT rid, doc_id, p, md5(array_to_string(list_slice(w, p, p + 19), ' ')) AS win
      FROM (SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM d WHERE len(w) >= 20)),
late AS (SELECT rid, p FROM (SELECT rid, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS k FROM x) WHERE k > 1),
gone AS (SELECT DISTINCT rid, unnest(generate_series(p, p + 19)) AS p FROM late),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
