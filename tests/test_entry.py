"""Driver contract: entry() runs, every query has a callable, and oracle keys are a subset."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r["part"] for r in rows} == {"oof", "test"}
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in rows)


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_match_oracle(spark):
    from compare import compare
    res = compare(spark, "/root/testdata/sf0.01", ["a9_distinct_counts", "e6_ordinal_unseen_minus1", "t2_mestimate_te"],
                  verbose=False)
    assert all(v[0] == "OK" for v in res.values()), res
