"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ``order`` bytes holds how often each byte followed.  A byte costs
-log2(c / (n + t)) bits if it was seen after its longest context (c times of n, t different bytes), else the escape
-log2(t / (n + t)) and then its cost after the next shorter context, down to 8 bits for any byte; contexts never seen in a language cost
no escape.  Statistics are frozen after fitting, so the code length of a text is exact and does not depend on other texts: all
paths through a tree are laid out as tables (gram -> bits under every language; context -> escape bits) and whole batches
are scored by table look-ups.  The language with the least code length wins.

Fitting uses a bounded sample: about ``max_rows`` texts of each language (chosen by a hash, up to 64 kB); scoring reads every whole text.
A-Z are lower-cased; a text starts after ``order`` zero bytes.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; without any learned language all texts are; a tie goes to
the first language by name; the score is the posterior of the language under equal priors; repeated rows score alike; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.blobs import groups
from foldwise.llm.common import bounded_texts, fold, hash_share
from foldwise.llm.textkit import LOWER, Texts, byte_set, slices, translate

LETTER = byte_set(range(0x41, 0x5B), range(0x61, 0x7B))
HIGH = byte_set(range(0x80, 0x100))


class Table:
    """Hash table from 64-bit keys to rows 0..n-1 with look-ups of whole arrays (linear probing)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.log2 = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.slot = np.full(1 << self.log2, len(keys), np.int32)  # the last row stands for "none"
        self.none = len(keys)
        rows, at = np.arange(len(keys), dtype=np.int32), self._hash(keys)
        while len(rows):
            free = self.slot[at] == self.none
            self.slot[at[free]] = rows[free]  # of several rows the last stays
            lost = self.slot[at] != rows
            rows, at = rows[lost], (at[lost] + 1) & (len(self.slot) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.log2)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._hash(keys)
        row = self.slot[at]
        open_ = np.flatnonzero((self.keys[row] != keys) & (row != self.none))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slot) - 1)
            row[open_] = self.slot[at[open_]]
            open_ = open_[(self.keys[row[open_]] != keys[open_]) & (row[open_] != self.none)]
        return row


def framed(t: Texts, before: int, after: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with ``before`` zeros before and ``after`` behind each text; the mask of positions to predict (all but
    those before), and their number per text."""
    n = np.diff(t.offs)
    low, out = translate(t.buf, LOWER), np.zeros(len(t.buf) + (before + after) * len(n), np.uint8)
    real, at = np.ones(len(out), bool), 0
    for a, b in zip(t.offs[:-1].tolist(), t.offs[1:].tolist(), strict=True):
        real[at : at + before] = False
        at += before
        out[at : at + b - a] = low[a:b]
        at += b - a + after
    return out, real, n + after


def grams(buf: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` (up to 8) bytes that end at each position, as one number; bytes before the buffer count as zero."""
    x, out, block = np.concatenate([np.zeros(size - 1, np.uint8), buf]), np.empty(len(buf), np.uint64), 1 << 15  # a block stays in the cache
    for i in range(0, len(buf), block):
        seg = x[i : i + block + size - 1].astype(np.uint64)
        g = out[i : i + block]
        g[:] = seg[size - 1 :]
        for k in range(1, size):
            g |= seg[size - 1 - k : len(seg) - k] << np.uint64(8 * k)
    return out


class Model:
    def __init__(self, langs: list[str], texts: list[pa.Array], order: int):
        self.langs, self.order = langs, order
        counts = []  # per language and size: (gram, count)
        for col in texts:
            sizes: list[list] = [[] for _ in range(order + 1)]
            for s in slices(col):
                buf, real, _ = framed(s, order)
                for size in range(1, order + 2):
                    sizes[size - 1].append(_count(np.sort(grams(buf, size)[real]), None))
            counts.append([_count(*_merge(x)) for x in sizes])
        self.grams, self.bits, self.contexts, self.escape = [], [], [], []
        for size in range(1, order + 2):
            keys = _union([c[size - 1][0] for c in counts])
            ctx_keys = _union([c[size - 1][0] >> np.uint64(8) for c in counts])
            bits, esc = np.zeros((len(keys), len(langs))), np.zeros((len(ctx_keys), len(langs)))
            ctx_of = np.searchsorted(ctx_keys, keys >> np.uint64(8))
            low = np.full((len(keys), len(langs)), 8.0) if size == 1 else self.bits[-1][np.searchsorted(self.grams[-1], keys & np.uint64((1 << (8 * (size - 1))) - 1))]
            for i, c in enumerate(counts):
                g, k = c[size - 1]
                seen, n = np.zeros(len(keys)), np.zeros(len(ctx_keys))
                seen[np.searchsorted(keys, g)] = k
                where = np.searchsorted(ctx_keys, g >> np.uint64(8))
                np.add.at(n, where, k)
                t = np.bincount(where, minlength=len(ctx_keys))
                with np.errstate(divide="ignore", invalid="ignore"):
                    esc[:, i] = np.where(n > 0, np.log2((n + t) / t), 0)
                    bits[:, i] = np.where(seen > 0, np.log2((n + t)[ctx_of] / seen), esc[ctx_of, i] + low[:, i])
            self.grams.append(keys)
            self.bits.append(bits)
            self.contexts.append(ctx_keys)
            self.escape.append(esc)
        none = np.zeros((1, len(langs)))
        self.bits = [np.vstack([b, none]).astype(np.float32) for b in self.bits]
        self.escape = [np.vstack([e, none]).astype(np.float32) for e in self.escape]
        self.tables = None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def code_lengths(self, t: Texts) -> np.ndarray:
        """Bits of each text under each language."""
        if self.tables is None:
            self.tables = [Table(k) for k in self.grams], [Table(k) for k in self.contexts]
        gram_table, context_table = self.tables
        buf, real, n = framed(t, self.order)
        longest = grams(buf, self.order + 1)[real]
        cost = np.zeros((len(longest), len(self.langs)), np.float32)
        open_ = np.arange(len(longest))
        for size in range(self.order + 1, 0, -1):
            key = longest[open_] & np.uint64((1 << (8 * size)) - 1)
            row = gram_table[size - 1].find(key)
            hit = row != gram_table[size - 1].none
            cost[open_[hit]] += self.bits[size - 1][row[hit]]
            open_, key = open_[~hit], key[~hit]
            if not len(open_):
                break
            cost[open_] += self.escape[size - 1][context_table[size - 1].find(key >> np.uint64(8))]
        cost[open_] += 8
        out = np.zeros((len(t), len(self.langs)))
        if len(cost):
            have = np.flatnonzero(n)
            out[have] = np.add.reduceat(cost, np.concatenate([[0], np.cumsum(n[have])[:-1]]), axis=0, dtype=np.float64)
        return out

    def predict(self, t: Texts) -> tuple[list[str], np.ndarray]:
        bits = self.code_lengths(t)
        best = bits.argmin(axis=1)
        score = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
        known = letters(t) & ~t.null
        return [self.langs[b] if k else "und" for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def letters(t: Texts) -> np.ndarray:
    """Texts that hold a letter of any script."""
    def within(table):
        total = np.concatenate([[0], np.cumsum(translate(t.buf, table), dtype=np.int64)])
        return np.diff(total[t.offs]) > 0

    out = within(LETTER)
    for i in np.flatnonzero(within(HIGH) & ~out):
        out[i] = any(c.isalpha() for c in bytes(t.buf[t.offs[i] : t.offs[i + 1]]).decode(errors="replace"))
    return out


def _count(keys: np.ndarray, counts):
    """Distinct keys of a sorted array with their counts."""
    g = groups(keys)
    return keys[g[:-1]], np.diff(g) if counts is None else np.add.reduceat(counts, g[:-1]) if len(keys) else counts


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    o = np.argsort(keys, kind="stable")
    return keys[o], counts[o]


def _union(parts: list[np.ndarray]) -> np.ndarray:
    x = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    return x[groups(x)[:-1]]


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", id_col: str = "doc_id", order: int = 4, max_rows: int = 1000) -> Model:
    """Context trees from a bounded sample of the rows of ``docs`` with a language."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, id_col, text)
    sample = bounded_texts(hash_share(known, lang, id_col, max_rows), lang, id_col, text)
    langs = sorted(set(sample["label"].to_pylist()))
    return Model(langs, [sample.filter(pa.compute.equal(sample["label"], x))["text"].combine_chunks() for x in langs], order)


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred and score: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for s in slices(b.column(text)):
                lang, score = m.predict(s) if m.langs else (["und"] * len(s), np.zeros(len(s)))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(s.first, len(s)) for c in keep), pa.array(lang, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    kinds = docs.select(*keep).schema
    return docs.select(*keep, text).mapInArrow(run, kinds.add("lang_pred", "string").add("score", "double"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows whose fold of 4 is not 2."""
    model = fit(docs.filter(fold("doc_id", 4) != 2), **options)
    held = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    return predict(held, model, ["doc_id", "held_out"])
