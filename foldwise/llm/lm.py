"""Language-model scoring by logistic context mixing.

Bits of a text's bytes (lower-cased, one zero byte at the end) are predicted from the contexts of the last 1, 2, 3 and 5
bytes.  How often each context and partial byte was followed by a zero or a one is counted exactly over all training texts; the counts' log odds
are mixed by weights that a gate chooses (how often the two longest contexts were seen), and an adaptive probability map
(partial byte x mixed log odds) refines the result.  Weights and map are learnt online: every chunk of documents goes through
its training grams in small steps, predicting without the gram's own counts, and the chunks' results are averaged by bits.
Then all is frozen: a text's probability does not depend on other texts of its table or on how that is cut into tasks, and equal
(context, byte) grams of a chunk are evaluated once.

All counts stay distributed and grow with the corpus.  A chunk of documents (chosen by hash) asks for its distinct words and its distinct grams of
all orders, with its own counts of them: one compressed array per range of hashes, grams by the hash of their context.  A range adds up what all
chunks sent and answers each: words by their counts, grams by how often their context was followed by the first 0 to 8 bits of their byte.
So a word of a third of all texts costs one entry per chunk.  Answers are written once, for learning and for scoring.

Words: A-Z lower-cased, then ``[^\x20\x09-\x0D]+``, by 64-bit hashes, and one end per text.
Edge cases: a null text counts as empty; a null id is a training document; repeated rows are documents of their own;
with no training text the counts are 0, N = V = 0 and the mixer is uniform; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.blobs import groups, pack, unpack
from foldwise.llm.common import fold, staged, text_bytes, text_key
from foldwise.llm.language import Table, framed, grams
from foldwise.llm.textkit import NOT_SPACE, SpanHasher, Texts, find_words, mix, slices

ORDERS = (1, 2, 3, 5)
LONGEST = ORDERS[-1]
GATES, INPUTS = 16, len(ORDERS) + 1
BUCKETS = 33  # of the adaptive map, over log odds -8..8
STEP = 16384  # grams of an online step
BIAS = 0.3
SLICE = 4 << 20
CHUNK = 16 << 20  # bytes of text that ask together
CHUNKS = 16  # at least: learning predicts a chunk without its own counts, so it has to be a small share of the texts
BLOCK = 1 << 16  # grams that are mixed at once
WORD = SpanHasher(501)
END = np.uint64(0x5E4D3C2B1A09F8E7)  # hash of the end token


def text_grams(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each byte of the texts and of their ends, and the number of them per text."""
    buf, real, n = framed(t, LONGEST, 1)
    return grams(buf, LONGEST + 1)[real], n


def distinct(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(g)
    cut = groups(x)
    return x[cut[:-1]], np.diff(cut)


def shorter(g: np.ndarray, times: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct last ``size`` bytes of grams, with their counts."""
    g = g & np.uint64((1 << (8 * size)) - 1)
    o = np.argsort(g, kind="stable")
    g = g[o]
    cut = groups(g)
    return g[cut[:-1]], np.add.reduceat(times[o], cut[:-1]) if len(g) else times


def nodes(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8, grams): the partial byte before each bit, and the bit."""
    byte, j = (g & np.uint64(255)).astype(np.int64)[None, :], np.arange(8)[:, None]
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


def keyed(g: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all orders that end distinct longest grams, sorted, the place of their order in the top byte, and their counts."""
    keys, counts = [], []
    for k in reversed(range(len(ORDERS))):
        g, times = shorter(g, times, ORDERS[k] + 1)
        keys.append(g | np.uint64(k << 56))
        counts.append(times)
    return np.concatenate(keys[::-1]), np.concatenate(counts[::-1])


def places(g: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """For each order the rows of ``keys`` that hold the ends of longest grams."""
    return [np.searchsorted(keys, (g & np.uint64((1 << (8 * (o + 1))) - 1)) | np.uint64(k << 56)) for k, o in enumerate(ORDERS)]


def node_counts(keys: np.ndarray, totals: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """(9, asked): how often the context of each asked key was followed by the first 0 to 8 bits of its byte, from sorted keys with their counts."""
    total, out = np.concatenate([[0], np.cumsum(totals, dtype=np.int64)]), np.empty((9, len(asked)), np.int64)
    for j in range(9):
        low = (asked >> np.uint64(8 - j)) << np.uint64(8 - j)
        out[j] = total[np.searchsorted(keys, low + np.uint64((1 << (8 - j)) - 1), "right")] - total[np.searchsorted(keys, low)]
    return out


def bit_counts(n: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8, grams): zeros and ones after each partial byte, from the node counts of the grams."""
    same, other = n[1:], n[:-1] - n[1:]
    return np.where(bit == 1, other, same), np.where(bit == 1, same, other)


def log_odds(zeros, ones):
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


def level(n: np.ndarray) -> np.ndarray:
    """How often a context was seen, in four steps."""
    return (n > 0).astype(np.uint8) + (n > 2) + (n > 15)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -16, 16)))


class Refiner:
    """Map from (partial byte, log odds) to a probability, linear between buckets."""

    @staticmethod
    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        f = (np.clip(x, -7.999, 7.999) + 8) * ((BUCKETS - 1) / 16)
        k = f.astype(np.int64)
        return k, f - k

    @staticmethod
    def table(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
        start = squash((np.arange(BUCKETS) * 16 / (BUCKETS - 1) - 8))[None, :]
        return ((ones + 20 * start) / (n + 20)).astype(np.float32)


class Mixer:
    """What is learnt: weights by gate and the adaptive map."""

    def __init__(self, weights: np.ndarray, refined: np.ndarray):
        self.weights, self.refined = weights, refined

    def bits(self, g: np.ndarray, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log2 probability of the last byte of each of distinct longest grams; the node counts ``n`` are those of sorted ``keys``."""
        odds = log_odds(*bit_counts(n, nodes(keys)[1]))
        out, at = np.zeros(len(g)), places(g, keys)
        for i in range(0, len(g), BLOCK):
            part = slice(i, i + BLOCK)
            out[part] = self._bits(g[part], [odds[:, a[part]] for a in at], [level(n[:-1, a[part]]) for a in at[-2:]])
        return out

    def _bits(self, g: np.ndarray, odds: list, seen: list) -> np.ndarray:
        node, bit = nodes(g)
        gate = seen[-1] * 4 + seen[-2]
        w = self.weights.T[:, gate]
        mixed = sum(w[k] * odds[k] for k in range(len(ORDERS))) + w[-1] * np.float32(BIAS)
        k, f = Refiner.place(mixed)
        p = 0.5 * squash(mixed) + 0.5 * (self.refined[node, k] * (1 - f) + self.refined[node, k + 1] * f)
        p = np.clip(p, 1e-5, 1 - 1e-5)
        return np.log2(np.where(bit == 1, p, 1 - p)).sum(axis=0)


class Model:
    """A mixer and the distributed counts that were gathered for it."""

    def __init__(self, mixer: Mixer, gathered: DataFrame):
        self.mixer, self.gathered = mixer, gathered

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Node counts of any sorted keys: the sum of what the chunks hold."""
        def ask(batches):
            n = np.zeros((9, len(keys)), np.int64)
            for b in batches:
                for key, times in zip(b.column("key"), b.column("n"), strict=True):
                    n += node_counts(unpack(key.as_buffer(), np.uint64), unpack(times.as_buffer(), np.int64), keys)
            yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary())], ["n"])

        got = self.gathered.select("key", "n").mapInArrow(ask, "n binary").collect()
        return sum((np.frombuffer(r["n"], np.int64).reshape(9, -1) for r in got), np.zeros((9, len(keys)), np.int64))

    def bits(self, g: np.ndarray) -> np.ndarray:
        """log2 probability of the last byte of each of distinct longest grams."""
        keys, _ = keyed(np.sort(g), np.zeros(len(g), np.int64))
        return self.mixer.bits(g, keys, self.counts(keys))

    def score(self, t: Texts) -> np.ndarray:
        """log2 probability of each text and its end."""
        g, n = text_grams(t)
        u, _ = distinct(g)
        return text_bits(self.bits(u)[Table(u).find(g)], n)


def text_bits(each: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.add.reduceat(each, np.concatenate([[0], np.cumsum(n)[:-1]])) if len(n) else np.zeros(0)


def fit(train: DataFrame, text: str = "text", rate: float = 0.02) -> Model:
    """The model of all rows of ``train``."""
    total = text_bytes(train, text)
    gathered = gather(chunked(train, F.lit(None).cast("string"), text, F.lit(False), total, CHUNK), total)
    return Model(learn(gathered, rate), gathered)


def learn(gathered: DataFrame, rate: float = 0.02) -> Mixer:
    """Weights and adaptive map from the training grams of every chunk and their counts in all."""
    def step(g, m, n, at, w, ones, seen):
        """One online step over distinct grams with their counts m; a long context is predicted without the gram's own counts."""
        node, bit = nodes(g)
        x, often = np.full((INPUTS, 8, len(g)), BIAS, np.float32), []
        for order in range(len(ORDERS)):
            z, e = bit_counts(n[:, at[order]], bit)
            if order >= len(ORDERS) - 2:
                z, e = np.maximum(z - m * (1 - bit), 0), np.maximum(e - m * bit, 0)
                often.append(level(z + e))
            x[order] = log_odds(z, e)
        gate = often[-1] * 4 + often[-2]
        for j in range(8):
            mixed = np.einsum("ij,ij->j", w.T[:, gate[j]], x[:, j])
            err = (bit[j] - squash(mixed)) * m
            mass = np.bincount(gate[j], m, GATES)
            grad = np.stack([np.bincount(gate[j], err * v, GATES) for v in x[:, j]], axis=1)
            w += (rate * grad / np.maximum(mass, 1)[:, None]).astype(np.float32)
            k, f = Refiner.place(mixed)
            for cell, share in ((k, 1 - f), (k + 1, f)):
                flat = node[j] * BUCKETS + cell
                seen += np.bincount(flat, m * share, 256 * BUCKETS).reshape(256, BUCKETS)
                ones += np.bincount(flat, m * share * bit[j], 256 * BUCKETS).reshape(256, BUCKETS)

    def of_chunk(t: pa.Table) -> pa.Table:
        w = np.full((GATES, INPUTS), 0.35, np.float32)
        ones, seen = np.zeros((256, BUCKETS)), np.zeros((256, BUCKETS))
        keys, times = (np.concatenate([unpack(x.as_buffer(), kind) for x in t[c]]) for c, kind in (("key", np.uint64), ("n", np.int64)))
        o = np.argsort(keys, kind="stable")
        keys, times, n = keys[o], times[o], node_answers(t)[:, o]
        own = np.flatnonzero((keys >> np.uint64(56) == len(ORDERS) - 1) & (times > 0))
        u = keys[own] & np.uint64((1 << 56) - 1)
        o = np.argsort(mix(u), kind="stable")  # steps in an order that has nothing to do with the bytes
        u, m = u[o], times[own][o].astype(np.float32)
        at = places(u, keys)
        for i in range(0, len(u), STEP):
            step(u[i : i + STEP], m[i : i + STEP], n, [a[i : i + STEP] for a in at], w, ones, seen)
        done = float(m.sum(dtype=float))
        value = np.concatenate([w.ravel() * done, ones.ravel(), seen.ravel(), [done]]) if done else np.zeros(0)
        return pa.table([pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value.astype(np.float64))], names=["k", "v"])

    got = gathered.select("chunk", "key", "n", "nodes", "width").groupBy("chunk").applyInArrow(of_chunk, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    drop_shuffles(gathered)
    value = np.zeros(GATES * INPUTS + 2 * 256 * BUCKETS + 1)
    value[np.asarray(got["k"])] = np.asarray(got["v"])
    cut = GATES * INPUTS
    done = max(value[-1], 1.0)
    ones, seen = value[cut:-1].reshape(2, 256, BUCKETS)
    return Mixer((value[:cut].reshape(GATES, INPUTS) / done).astype(np.float32), Refiner.table(ones, seen))


def node_answers(t: pa.Table) -> np.ndarray:
    """(9, grams) of the answers of a chunk, in their order."""
    less = np.concatenate([unpack(x.as_buffer(), np.dtype(f"<i{width}")).reshape(9, -1) for x, width in zip(t["nodes"], t["width"].to_pylist(), strict=True)], axis=1)
    return np.cumsum(less[::-1], axis=0, dtype=less.dtype)[::-1]


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, number per text); ends left out."""
    w, buf = find_words(t, NOT_SPACE, lower=True)
    return WORD.words(buf, w.start, w.end), np.diff(w.first)


def _asked(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """Distinct tokens of a chunk in order, their counts in training texts, and the hashes per slice."""
    held, train = docs["held_out"].combine_chunks().to_numpy(zero_copy_only=False), []
    per = []
    for s in slices(docs["text"].combine_chunks(), SLICE):
        h, n = tokens(s)
        per.append((s, h, n))
        train.append(h[np.repeat(~held[s.first : s.first + len(s)], n)])
    train = np.sort(np.concatenate([*train, np.full(int((~held).sum()), END)]))
    every = np.sort(np.concatenate([h for _, h, _ in per] + [np.array([END])]))
    every = every[groups(every)[:-1]]
    cut = groups(train)
    count = np.zeros(len(every), np.int64)
    count[np.searchsorted(every, train[cut[:-1]])] = np.diff(cut)
    return every, count, per


def chunk_grams(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct longest grams of a chunk, and their counts in its training texts."""
    held, grams_, counts = docs["held_out"].combine_chunks().to_numpy(zero_copy_only=False), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for s in slices(docs["text"].combine_chunks(), SLICE):
        g, n = text_grams(s)
        x = np.sort((g << np.uint64(1)) | np.repeat(held[s.first : s.first + len(s)], n).astype(np.uint64))
        cut = groups(x >> np.uint64(1))
        if len(x):
            grams_.append(x[cut[:-1]] >> np.uint64(1))
            counts.append(np.diff(cut) - np.add.reduceat((x & np.uint64(1)).astype(np.int64), cut[:-1]))
    return shorter(np.concatenate(grams_), np.concatenate(counts), LONGEST + 1)


def chunked(docs: DataFrame, id_col, text: str, held_out, total: int, chunk_bytes: int) -> DataFrame:
    """id, text, held_out and the chunk of each row, about ``chunk_bytes`` of text, by hash of id and text."""
    return docs.select(id_col.alias("id"), F.col(text).alias("text"), held_out.alias("held_out"),
                       F.pmod(F.xxhash64(id_col, text_key(text)), F.lit(max(CHUNKS, total // chunk_bytes))).cast("int").alias("chunk"))


def drop_shuffles(df: DataFrame) -> None:
    """Spark deletes the shuffle files of finished jobs once their plans are collected; on a large table that is to be before the next ones are written."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def ranges(total: int) -> int:
    """log2 of the number of hash ranges: one has about a million words of text or fewer."""
    return max(0, math.ceil(math.log2(max(1, total) / (6 << 20))))


def in_ranges(h: np.ndarray, log2: int) -> np.ndarray:
    """The range of each hash."""
    return (h >> np.uint64(64 - log2)).astype(np.int64) if log2 else np.zeros(len(h), np.int64)


def by_range(keys: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by the range of their contexts, and where each range begins and ends in it."""
    r = in_ranges(mix(keys >> np.uint64(8)), log2)
    o = np.argsort(r, kind="stable")
    return o, np.searchsorted(r[o], np.arange((1 << log2) + 1))


def gather(base: DataFrame, total: int) -> DataFrame:
    """The counts of all chunks' words and grams: a row per chunk and range, written once; ``base`` as from ``chunked``."""
    log2 = ranges(total)
    buckets = 1 << log2

    def ask(t: pa.Table) -> pa.Table:
        h, n, _ = _asked(t)
        keys, times = keyed(*chunk_grams(t))
        o, f = by_range(keys, log2)
        keys, times, e = keys[o], times[o], np.searchsorted(in_ranges(h, log2), np.arange(buckets + 1))
        parts = lambda a, ends: pa.array([pack(a[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
        return pa.table([pa.array(np.arange(buckets, dtype=np.int32)), pa.array(np.full(buckets, t["chunk"][0].as_py(), np.int32)),
                         parts(h, e), parts(n, e), parts(keys, f), parts(times, f)], names=["bucket", "chunk", "h", "times", "key", "n"])

    def answer(t: pa.Table) -> pa.Table:
        hs, ns = ([unpack(x.as_buffer(), kind) for x in t[name]] for name, kind in (("h", np.uint64), ("times", np.int64)))
        _, sums, at = summed(hs, ns)
        words = [pack(sums[a]) for a in at]
        ks, ns = ([unpack(x.as_buffer(), kind) for x in t[name]] for name, kind in (("key", np.uint64), ("n", np.int64)))
        keys, totals, at = summed(ks, ns)
        n = node_counts(keys, totals, keys)
        width = 4 if n.max(initial=0) < 1 << 31 else 8
        n[:-1] -= n[1:]  # mostly 0: what a further bit takes away
        n = n.astype(f"<i{width}")
        k = len(words)
        return pa.table([t["chunk"], t["bucket"], pa.array(words, pa.binary()), pa.array(np.full(k, int((sums > 0).sum()))), pa.array(np.full(k, int(sums.sum()))),
                         t["key"], t["n"], pa.array([pack(n[:, a].ravel()) for a in at], pa.binary()), pa.array(np.full(k, width, np.int32))],
                        names=["chunk", "bucket", "c", "v", "tokens", "key", "n", "nodes", "width"])

    asked = base.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, h binary, times binary, key binary, n binary")
    answers = staged(asked.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, c binary, v long, tokens long, key binary, n binary, nodes binary, width int"))
    del asked
    drop_shuffles(base)
    return answers


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of several arrays, the sums of their counts, and for each array the rows of its keys in these."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    o = np.argsort(k, kind="stable")
    cut = groups(k[o])
    at = np.empty(len(k), np.int64)
    at[o] = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    return k[o][cut[:-1]], np.add.reduceat(n[o], cut[:-1]) if len(k) else n, np.split(at, np.cumsum([len(x) for x in keys])[:-1])


def score(base: DataFrame, mixer: Mixer, gathered: DataFrame, total: int) -> DataFrame:
    """One row per row of ``base``, whose held-out rows add nothing to the counts that were gathered."""
    log2 = ranges(total)

    def final(t: pa.Table, replies: pa.Table) -> pa.Table:
        replies = replies.sort_by("bucket")
        h, _, per = _asked(t)
        c = np.concatenate([unpack(x.as_buffer(), np.int64) for x in replies["c"]])
        v, all_tokens = int(np.asarray(replies["v"]).sum()), int(np.asarray(replies["tokens"]).sum())
        logs, known = np.log10(c + 1.0), c > 0
        end = int(np.searchsorted(h, END))
        unit = math.log10(all_tokens + v + 1)
        u, times = chunk_grams(t)
        keys, _ = keyed(u, times)
        n = node_answers(replies)
        n = n[:, np.argsort(by_range(keys, log2)[0])]
        each, find = mixer.bits(u, keys, n), Table(u).find
        cols: list[list] = [[] for _ in range(5)]
        for s, words, size in per:
            at = np.searchsorted(h, words)
            doc = np.repeat(np.arange(len(s)), size)
            base_score = np.bincount(doc, logs[at], len(s)) + logs[end] - (size + 1) * unit
            g, ends = text_grams(s)
            bits = text_bits(each[find(g)], ends)
            for col, x in zip(cols, (size + 1, np.bincount(doc, known[at], len(s)).astype(np.int64) + bool(known[end]), base_score, bits * math.log10(2), -bits / (np.diff(s.offs) + 1)), strict=True):
                col.append(x)
        n_tokens, n_known, b, sc, bpb = (np.concatenate(x) for x in cols)
        return pa.table([t["id"], t["held_out"], pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(t), all_tokens)), pa.array(b), pa.array(sc), pa.array(bpb)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    kind = base.schema["id"].dataType.simpleString()
    replies = gathered.select("chunk", "bucket", "c", "v", "tokens", "nodes", "width")
    return base.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(final, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")


def report(docs: DataFrame, chunk_bytes: int = CHUNK, **options) -> DataFrame:
    """Scores of all documents, learning from those whose fold of 7 is not 2."""
    held, total = F.coalesce(fold("doc_id", 7) == 2, F.lit(False)), text_bytes(docs, "text")
    base = chunked(docs, F.col("doc_id"), "text", held, total, chunk_bytes)
    gathered = gather(base, total)
    return score(base, learn(gathered, **options), gathered, total)
