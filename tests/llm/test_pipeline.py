"""The five stages of the corpus pipeline on a table with nulls, repeated rows and extra columns, each against brute force on its own input."""

from collections import Counter

import corpus_pipeline as P
import pytest
from test_operators import BENCH_TEXT, DOCS, SCHEMA, alnum, brute_links

from foldwise.llm import mixing


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(DOCS, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0 if i % 7 == 0 else 1, 0) for i in range(1, 61)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, BENCH_TEXT), (2, "two words"), (3, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def stage(spark, sf_dir, name, docs):
    return dict(P.STAGES)[name](spark, docs, sf_dir)


def key(r):
    return (r["doc_id"], r["text"])


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "source_mixing"]


def test_each_stage_on_its_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # no label says toxic: all documents stay, extra columns go
    clean = stage(spark, sf_dir, "toxicity", docs)
    assert clean.columns == P.COLUMNS
    assert Counter(map(key, clean.collect())) == Counter((d[0], d[1]) for d in DOCS)

    lines = stage(spark, sf_dir, "line_dedup", clean)
    count, pages = Counter(), Counter(d[3] for d in DOCS)
    for d in DOCS:
        count.update((d[3], x.strip(" ")) for x in {x.strip(" ") for x in (d[1] or "").split("\n")} if x)
    drop = {k for k, n in count.items() if n >= 2 and n > 0.1 * pages[k[0]]}
    want = Counter((d[0], None if d[1] is None else "\n".join(x for x in d[1].split("\n") if (d[3], x.strip(" ")) not in drop)) for d in DOCS)
    got = lines.collect()
    assert lines.columns == P.COLUMNS and Counter(map(key, got)) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)

    # on the documents themselves, which hold copies: one of each group stays
    near = stage(spark, sf_dir, "jaccard_join", docs).collect()
    links = [(d, c) for d, (_, c, _) in zip(DOCS, brute_links(DOCS), strict=True)]
    kept = {(d[0], d[1]) for d, c in links if c is None or d[0] == c}
    assert set(map(key, near)) == kept and len(near) == len(kept)

    leaks = stage(spark, sf_dir, "decontamination", docs).collect()
    bench = [alnum(BENCH_TEXT)[k : k + 10] for k in range(len(alnum(BENCH_TEXT)) - 9)] + [["two", "words"]]
    holds = lambda w: any(w[k : k + len(b)] == b for b in bench for k in range(len(w) - len(b) + 1))
    assert Counter(map(key, leaks)) == Counter((d[0], d[1]) for d in DOCS if not holds(alnum(d[1])))

    rates = stage(spark, sf_dir, "source_mixing", docs)
    assert rates.columns == [*P.COLUMNS, "rate", "copies"]
    n, total = {}, 0
    for r in mixing.report(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect():
        n[r["doc_id"], round(r["rate"], 9)] = r["n_tokens"]
        total += r["n_tokens"]
    kept = rates.collect()
    assert all(r["rate"] > 0 and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in kept)
    # rates keep the number of tokens, as the targets add up to one
    assert abs(sum(n[r["doc_id"], round(r["rate"], 9)] * r["rate"] for r in kept) - total) < 0.05 * total


@pytest.mark.filterwarnings("ignore:the targets")
def test_empty_table_and_whole_run(spark, sf_dir):
    empty = spark.createDataFrame([], SCHEMA)
    for name, f in P.STAGES:
        assert f(spark, empty, sf_dir).count() == 0, name
    out = P.run(spark, sf_dir)
    assert out.columns == [*P.COLUMNS, "rate", "copies"] and 0 < out.count() <= len(DOCS)
