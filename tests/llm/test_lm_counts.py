"""The counts of the language model are those of all training texts, and scores do not depend on how the table is cut."""

from collections import Counter

import numpy as np
import pytest

from foldwise.llm import lm

ROWS = [(i if i % 9 else None, f"{'Abba' * (i % 3)} word{i % 11} x{i * i % 17} the end {chr(224 + i % 5)}" if i % 7 else (None if i % 2 else "")) for i in range(120)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_scores_do_not_depend_on_tasks(rows):
    """weights and counts are of chunks by hash, whatever the partitions."""
    one, four = (sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 9), round(r.score, 9)) for r in lm.report(rows.repartition(n, "text"), chunk_bytes=500).collect()) for n in (1, 7))
    assert one == four


def test_counts_are_those_of_all_training_texts(rows):
    """every gram of every order, in several chunks and ranges of hashes, none sharing a place with another."""
    held = lm.fold("doc_id", 7) == 2
    base = lm.chunked(rows, rows.doc_id, "text", lm.F.coalesce(held, lm.F.lit(False)), 40 << 20, 8 << 20)
    gathered = lm.gather(base, 40 << 20)  # as for 40 MB: eight ranges
    assert gathered.select("chunk").distinct().count() == lm.CHUNKS and gathered.count() == 8 * lm.CHUNKS
    train = [(r.text or "") for r in base.filter("NOT held_out").collect()]
    low = [b"\0" * lm.LONGEST + bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()) + b"\0" for t in train]
    got = {}
    for k, o in enumerate(lm.ORDERS):
        grams = Counter(t[i - o : i + 1] for t in low for i in range(lm.LONGEST, len(t)))
        asked = np.sort(np.array([int.from_bytes(g, "big") | k << 56 for g in grams], np.uint64))
        n = lm.Model(None, gathered).counts(asked)
        for key, c in zip(asked.tolist(), n.T.tolist(), strict=True):
            got[k, (key & ((1 << 56) - 1)).to_bytes(o + 1, "big")] = c
        follow = Counter()
        for g, c in grams.items():
            for j in range(9):
                follow[g[:-1], j, g[-1] >> (8 - j)] += c
        assert all(got[k, g] == [follow[g[:-1], j, g[-1] >> (8 - j)] for j in range(9)] for g in grams)
    # and the answers of a chunk are the same numbers
    t = gathered.select("key", "nodes", "width").toArrow()
    keys = np.concatenate([lm.unpack(x.as_buffer(), np.uint64) for x in t["key"]])
    for key, c in zip(keys.tolist(), lm.node_answers(t).T.tolist(), strict=True):
        k = key >> 56
        assert c == got.get((k, (key & ((1 << 56) - 1)).to_bytes(lm.ORDERS[k] + 1, "big")), c)


def test_a_small_table_is_learnt_in_several_chunks(spark, monkeypatch):
    """learning leaves out a chunk's own counts; were the whole table one chunk, known contexts would be learnt as misleading."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 80).tolist())) for i in range(200)], "doc_id long, text string")
    bits = {}
    for n in (lm.CHUNKS, 1):
        monkeypatch.setattr(lm, "CHUNKS", n)
        bits[n] = np.mean([r.bits_per_byte for r in lm.report(docs).collect() if r.held_out])
    assert bits[16] < bits[1] - 0.1, bits
