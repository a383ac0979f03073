"""Toxicity by compression distance: zstandard dictionaries of ordinary and of toxic text.

The ordinary dictionary is trained on windows of ordinary texts.  The toxic dictionary holds the strings (words, or
word beginnings of four letters or more) that toxic texts use and ordinary ones do not, and which follow many different
words: a string that only repeated copies of one text bring along follows one and the same word and is left out.
Every window of a text is compressed against the ordinary dictionary and against toxic + ordinary: the bytes the toxic one
saves are the window's distance.  The threshold is calibrated by a logistic regression on a text's greatest savings, their
mean and its number of windows, over labelled texts that neither dictionary was trained on.

Fitting uses a bounded sample of labelled rows (about ``max_rows`` of each label, texts up to 64 kB); scoring reads every whole text.

Edge cases: a null text counts as empty; an empty text has one empty window and gets a score as others do; with no
labelled row of one of the classes the score is the share of toxic labels (0 without any); labels other than 0 and 1 are
left out; of several labels of a document any toxic one counts; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import bounded_texts, fold, fresh, hash_share

WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
WINDOW = 60  # bytes; a window goes on to the next space
LEAST = 4  # letters of a word beginning


def windows(text: bytes) -> list[bytes]:
    """The lower-cased text in pieces of about WINDOW bytes that end before a space (or after 40 bytes without one)."""
    b, out, i = text.lower(), [], 0
    while i < len(b):
        j = i + WINDOW
        if j < len(b):
            k = b.find(b" ", j - 1, j + 40)
            j = k if k > 0 else j
        out.append(b[i:j])
        i = j
    return out or [b""]


def strings(word: bytes) -> list[bytes]:
    return [word[:k] for k in range(LEAST, min(len(word), 12))] + [word]


def toxic_strings(toxic: list[bytes], ordinary: list[bytes], share: float, ratio: float, limit: int) -> bytes:
    """Strings of toxic texts, the most frequent last: those that follow at least ``share`` x texts (and 4) different words and
    whose share of the ordinary texts is at most ``ratio`` of their share of the toxic ones."""
    usual: Counter = Counter()
    for t in ordinary:
        usual.update({s for w in set(WORDS.findall(t.lower())) for s in strings(w)})
    texts, after = Counter(), defaultdict(set)
    for t in toxic:
        words = WORDS.findall(t.lower())
        texts.update({s for w in set(words) for s in strings(w)})
        for before, w in zip([b"", *words], words, strict=False):
            for s in strings(w):
                after[s].add(before)
    least = max(4, share * len(toxic))
    found = {s: len(a) for s, a in after.items() if len(s) >= 3 and len(a) >= least and usual[s] * len(toxic) <= ratio * texts[s] * len(ordinary)}
    # a beginning that one longer string makes up nearly all of is left out; whole words stay, as longer matches save more
    one = {s[:k] for s, n in found.items() for k in range(LEAST, len(s)) if found.get(s[:k], np.inf) * 0.9 <= n}
    chosen = sorted((s for s in found if s not in one), key=lambda s: (found[s], s))
    return (b" " + b" ".join(chosen) + b" ")[-limit:] if chosen else b""


def ordinary_dictionary(texts: list[bytes], size: int, max_windows: int) -> bytes:
    """Trained on ``max_windows`` windows of the texts at most, drawn by hash from all of them."""
    pieces = [w for t in texts for w in windows(t)]
    if len(pieces) > max_windows:
        drawn = np.argsort([zlib.crc32(w + str(i).encode()) for i, w in enumerate(pieces)], kind="stable")[:max_windows]
        pieces = [pieces[i] for i in np.sort(drawn)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too few windows to train on: their own text
        return b"".join(pieces)[-size:]


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic, self.base = ordinary, toxic, None
        self.mean = self.sd = self.weights = None
        self._c = None

    def __getstate__(self):
        return self.__dict__ | {"_c": None}

    def _compressors(self):
        if self._c is None:
            par = zstandard.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=15, search_log=4, target_length=32, min_match=4, strategy=zstandard.STRATEGY_LAZY2,
                                                      write_content_size=False, write_checksum=False, write_dict_id=False)
            # the toxic part lies farther back, so that ordinary matches cost the same under both
            self._c = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=par)
                       for d in (self.ordinary, self.toxic + self.ordinary)]
        return self._c

    def savings(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves, for each window."""
        a, b = self._compressors()
        return np.array([len(a.compress(w)) - len(b.compress(w)) for w in windows(text)])

    def features(self, text: bytes) -> list[float]:
        d = np.maximum(self.savings(text), 0)
        top = np.sort(np.append(d, [0, 0, 0]))[::-1]
        return [top[0], top[1], top[2], d.sum() / len(d), np.log1p(np.maximum(d - 1, 0).sum()), np.log(len(d))]

    def calibrate(self, x: np.ndarray, labels: np.ndarray) -> None:
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([np.ones(len(x)), (x - self.mean) / self.sd])
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - labels) + 1e-2 * w)
        self.weights = w

    def score(self, text: bytes) -> float:
        if self.weights is None:
            return self.base
        x = (np.array(self.features(text)) - self.mean) / self.sd
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 4000,
        share: float = 0.025, ratio: float = 0.05, ordinary_bytes: int = 32768, toxic_bytes: int = 8192, max_windows: int = 40_000) -> Model:
    """Dictionaries and calibration from a bounded sample of the rows of ``docs`` that have a label: about ``max_rows`` of each label, of
    long texts 64 kB of pieces drawn by hash, and ``max_windows`` ordinary windows drawn by hash."""
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("_label"))
    # of bounded size: about max_rows ids of each of the two labels, so the texts stay where they are
    few = F.broadcast(hash_share(marked, "_label", "_id", max_rows))
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("_text")).join(few, F.col("_doc") == F.col("_id"))
    sample = bounded_texts(rows, "_label", "_id", "_text")
    texts = {c: [x.as_buffer().to_pybytes() for x in sample.filter(pa.compute.equal(sample["label"], c))["text"]] for c in (0, 1)}
    if len(texts[0]) < 2 or len(texts[1]) < 2:
        model = Model(b"", b"")
        model.base = len(texts[1]) / max(1, len(sample))
        return model

    cut = {0: len(texts[0]) // 2, 1: max(1, len(texts[1]) * 6 // 10)}
    model = Model(ordinary_dictionary(texts[0][: cut[0]], ordinary_bytes, max_windows), toxic_strings(texts[1][: cut[1]], texts[0][: cut[0]], share, ratio, toxic_bytes))
    rest = [(t, c) for c in (0, 1) for t in texts[c][cut[c] :]]
    model.calibrate(np.array([model.features(t) for t, _ in rest]), np.array([c for _, c in rest]))
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = fresh([*keep, name], "body")[0]

    def run(batches) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in b.column(body)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s, pa.float64())], [*keep, name])

    return docs.select(*keep, F.col(text).alias(body)).mapInArrow(run, docs.select(*keep).schema.add(name, "double"))


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted; learns labels from rows whose fold of 5 is not 0."""
    model = fit(docs.filter(fold("doc_id", 5) != 0), labels, **options)
    rows = docs.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return score(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without those scored at ``threshold`` or more; same columns, learnt as in report()."""
    model = fit(docs.filter(fold("doc_id", 5) != 0), labels, **options)
    mark = fresh(docs.columns, "score")[0]
    return score(docs, model, docs.columns, name=mark).filter(F.col(mark) < threshold).select(*docs.columns)
