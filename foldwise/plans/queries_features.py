"""Registered queries for profiles, imputers, encoders, scalers and column functions (table B / C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions import arrays as A
from foldwise.functions import columns as C
from foldwise.operators import fold_scope as FS
from foldwise.operators import encode as E
from foldwise.operators import impute as I
from foldwise.operators import profile as P
from foldwise.operators import scale as S
from foldwise.plans.prepare import orders_train_test
from foldwise.plans.registry import r6, register
from foldwise.sources.tables import orders_base

UNSEEN_NATION = "NATION_3"  # left out of the fitting side to exercise unseen-value rules
CATS = ["c_mktsegment", "n_name", "r_name", "o_year", "o_orderpriority"]


def _tt(spark, sf):
    return orders_train_test(spark, sf, "y_bin")


def _both(tr: DataFrame, ts: DataFrame, cols) -> DataFrame:
    return (tr.select("id", F.lit("train").alias("part"), *cols)
            .unionByName(ts.select("id", F.lit("test").alias("part"), *cols)))


@register("a1_value_counts")
def q_a1(spark: SparkSession, sf: str) -> DataFrame:
    tr, _ = _tt(spark, sf)
    return P.value_counts(tr, "n_name")


@register("a2_relative_frequency")
def q_a2(spark, sf):
    tr, _ = _tt(spark, sf)
    return P.relative_frequency(tr, "c_mktsegment").select("value", r6("freq", "freq"))


@register("a3_counts_with_null")
def q_a3(spark, sf):
    tr, _ = _tt(spark, sf)
    return P.value_counts(tr, "c_mktsegment", dropna=False)


@register("a4_target_mean_count")
def q_a4(spark, sf):
    tr, _ = _tt(spark, sf)
    return P.target_stats(tr, "n_name", "y_bin").select("value", r6("mean", "mean"), "n")


@register("a5_class_distribution")
def q_a5(spark, sf):
    tr, _ = orders_train_test(spark, sf, "o_orderpriority")
    lab = E.fit_label_index(tr, ["o_orderpriority"], "_y")
    tr = lab.apply(tr)
    d = P.class_distribution(tr, "n_name", "o_orderpriority_y", 5)
    return d.select("value", *[r6(f"p{i}", f"p{i}") for i in range(5)])


@register("a6_a7_prior_and_mean_of_means")
def q_a6(spark, sf):
    tr, _ = _tt(spark, sf)
    return P.mean_of_group_means(tr, "n_name", "y_bin").select(r6("global_mean", "global_mean"), r6("mean_of_means", "mean_of_means"))


@register("a8_sorted_label_index")
def q_a8(spark, sf):
    tr, _ = _tt(spark, sf)
    return (P.dense_index(tr, "o_orderpriority").withColumn("col", F.lit("o_orderpriority"))
            .unionByName(P.dense_index(tr, "n_name").withColumn("col", F.lit("n_name"))))


@register("a9_distinct_counts")
def q_a9(spark, sf):
    tr, _ = _tt(spark, sf)
    return P.distinct_counts(tr, CATS)


@register("a10_null_counts")
def q_a10(spark, sf):
    base = orders_base(spark, sf)
    return P.null_counts(base, [c for c in base.columns])


@register("a11_shape")
def q_a11(spark, sf):
    return P.shape(orders_base(spark, sf))


@register("a11_head")
def q_a11h(spark, sf):
    return P.head(orders_base(spark, sf), "id", 5).select("id", "o_orderpriority", r6("o_totalprice", "o_totalprice"))


@register("a12_class_balance")
def q_a12(spark, sf):
    tr, ts = _tt(spark, sf)
    both = tr.withColumn("split", F.lit("train")).unionByName(ts.withColumn("split", F.lit("test")), allowMissingColumns=True)
    return P.class_balance(both, "y_bin", ["split"])


@register("a16_column_means")
def q_a16(spark, sf):
    tr, _ = _tt(spark, sf)
    cols = ["c_acctbal", "li_qty", "li_disc", "o_totalprice"]
    m = P.column_means(tr, cols)
    return spark.createDataFrame([(c, float(m[c])) for c in cols], "col string, mean double").select("col", r6("mean", "mean"))


@register("i2_mode")
def q_i2(spark, sf):
    tr, _ = _tt(spark, sf)
    m = I.fit_mode(tr, ["c_mktsegment", "n_name", "o_year"])
    return spark.createDataFrame(sorted(m.items()), "col string, mode string")


@register("i3_i4_constant_fill_and_flags")
def q_i3(spark, sf):
    base = orders_base(spark, sf)
    d = I.missing_flags(base, ["c_acctbal", "c_mktsegment", "li_qty"])
    d = I.fill_constant(d, ["c_mktsegment"], "Unknown")
    return d.select("id", "c_mktsegment", "c_acctbal_missing", "c_mktsegment_missing", "li_qty_missing")


@register("i5_scrub_non_finite")
def q_i5(spark, sf):
    base = orders_base(spark, sf)
    raw = (F.when(F.col("id") % 13 == 0, F.lit(float("inf"))).when(F.col("id") % 17 == 0, F.lit(float("nan")))
           .otherwise(F.col("li_disc")))
    return base.select("id", r6(I.scrub_non_finite(raw, 1.0 / 5), "x"))


@register("i6_null_as_text")
def q_i6(spark, sf):
    return orders_base(spark, sf).select("id", I.null_as_text(F.col("c_mktsegment")).alias("c_mktsegment"))


def _fit_side(tr):
    return tr.filter(F.col("n_name") != UNSEEN_NATION)


@register("e1_frequency_encoding")
def q_e1(spark, sf):
    tr, ts = _tt(spark, sf)
    enc = E.fit_frequency(_fit_side(tr), ["c_mktsegment", "n_name"])
    return _both(enc.apply(tr), enc.apply(ts), ["c_mktsegment_FE", "n_name_FE"])


@register("e2_frequency_self_with_null")
def q_e2(spark, sf):
    base = orders_base(spark, sf)
    return E.frequency_self(base, ["c_mktsegment"]).select("id", "c_mktsegment_freq")


@register("e3_relative_frequency_unseen_zero")
def q_e3(spark, sf):
    tr, ts = _tt(spark, sf)
    enc = E.fit_relative_frequency(_fit_side(tr), ["n_name", "c_mktsegment"], "_freq", 0.0)
    return _both(enc.apply(tr), enc.apply(ts), [r6("n_name_freq", "n_name_freq"), r6("c_mktsegment_freq", "c_mktsegment_freq")])


@register("e4_rarity_unseen_null")
def q_e4(spark, sf):
    tr, ts = _tt(spark, sf)
    enc = E.fit_relative_frequency(_fit_side(tr), ["n_name"], "_RAR", None)
    return _both(enc.apply(tr), enc.apply(ts), [r6("n_name_RAR", "n_name_RAR")])


@register("e5_label_encode_unseen_k")
def q_e5(spark, sf):
    tr, ts = _tt(spark, sf)
    enc = E.fit_label_index(_fit_side(tr), ["n_name", "o_year"])
    return _both(enc.apply(tr), enc.apply(ts), ["n_name_LE", "o_year_LE"])


@register("e6_ordinal_unseen_minus1")
def q_e6(spark, sf):
    tr, ts = _tt(spark, sf)
    enc = E.fit_ordinal(_fit_side(tr), ["n_name", "c_mktsegment"])
    return _both(enc.apply(tr), enc.apply(ts), ["n_name_OE", "c_mktsegment_OE"])


@register("e7_one_hot_unseen_zero")
def q_e7(spark, sf):
    tr, ts = _tt(spark, sf)
    lv = E.fit_one_hot_levels(tr.filter(F.col("r_name") != "ASIA"), ["r_name", "c_mktsegment"])
    cols = [f"{c}_oh_{i}" for c, v in lv.items() for i in range(len(v))]
    return _both(E.one_hot(tr, lv), E.one_hot(ts, lv), cols)


@register("e8_one_hot_fit_on_union")
def q_e8(spark, sf):
    tr, ts = _tt(spark, sf)
    lv = E.fit_one_hot_levels(tr.select("r_name").unionByName(ts.select("r_name")), ["r_name"])
    cols = [f"r_name_oh_{i}" for i in range(len(lv["r_name"]))]
    return _both(E.one_hot(tr, lv), E.one_hot(ts, lv), cols)


@register("e9_dummies_with_nan_column")
def q_e9(spark, sf):
    tr, ts = _tt(spark, sf)
    u = tr.select("c_mktsegment").unionByName(ts.select("c_mktsegment"))
    lv = E.fit_one_hot_levels(u, ["c_mktsegment"])
    cols = [f"c_mktsegment_oh_{i}" for i in range(len(lv["c_mktsegment"]))] + ["c_mktsegment_nan"]
    return _both(E.one_hot(tr, lv, dummy_na=True), E.one_hot(ts, lv, dummy_na=True), cols)


@register("e10_one_hot_numeric_codes")
def q_e10(spark, sf):
    tr, ts = _tt(spark, sf)
    code = F.coalesce(F.col("li_lines"), F.lit(0.0)).cast("int")
    tr, ts = tr.withColumn("n_lines", code), ts.withColumn("n_lines", code)
    (tr, ts), sizes = E.sparse_one_hot(tr, [tr, ts], ["n_lines"])
    tr, ts = (d.withColumn("n_lines_size", F.lit(sizes["n_lines"]).cast("long")) for d in (tr, ts))
    return _both(tr, ts, ["n_lines_hot", "n_lines_size"])


@register("e11_top4_cardinality_crosses")
def q_e11(spark, sf):
    tr, ts = _tt(spark, sf)
    tr2, ts2, names = E.top_cardinality_crosses(tr, ts, CATS, 4)
    return _both(tr2, ts2, names)


@register("e12_all_pair_crosses")
def q_e12(spark, sf):
    base = orders_base(spark, sf)
    d, names = E.cross_pairs(base, ["c_mktsegment", "r_name", "o_year"], "_")
    return d.select("id", *names)


@register("e13_fixed_crosses_ordinal")
def q_e13(spark, sf):
    tr, ts = _tt(spark, sf)
    tr2, ts2, names = E.fixed_crosses_ordinal(tr, ts, [("c_mktsegment", "r_name"), ("o_year", "n_name")], fit_on=_fit_side(tr))
    return _both(tr2, ts2, names)


@register("e15_cardinality_router")
def q_e15(spark, sf):
    tr, _ = _tt(spark, sf)
    plan = E.route_by_cardinality(tr, CATS)
    return spark.createDataFrame(sorted(plan.items()), "col string, route string")


NUM = ["o_totalprice", "c_acctbal", "li_qty", "li_disc"]


@register("n1_n4_n11_column_transforms")
def q_n1(spark, sf):
    b = orders_base(spark, sf)
    return b.select(
        "id",
        r6(C.log1p_clip("c_acctbal"), "acctbal_log1p"),
        r6(C.ratio_plus_one("o_totalprice", "li_qty"), "price_per_qty"),
        r6(C.product("li_qty", "li_disc"), "qty_disc"),
        r6(C.total("li_qty", "li_lines", "li_disc"), "li_sum"),
        r6(C.sigmoid((F.col("c_acctbal") / 1000.0)), "acctbal_sigmoid"),
        r6(C.sigmoid((F.col("o_totalprice") / 10000.0) - 20, clip=None), "price_sigmoid_raw"),
    )


@register("n5_standard_scaling")
def q_n5(spark, sf):
    tr, ts = _tt(spark, sf)
    med = I.fit_median(tr, ["c_acctbal", "li_qty", "li_disc"])
    tr, ts = I.apply_fill(tr, med), I.apply_fill(ts, med)
    p = S.fit_standard(tr, NUM)
    return _both(S.apply_center_scale(tr, p), S.apply_center_scale(ts, p), [r6(c, c) for c in NUM])


@register("n6_robust_scaling")
def q_n6(spark, sf):
    tr, ts = _tt(spark, sf)
    p = S.fit_robust(tr, NUM)
    return _both(S.apply_center_scale(tr, p), S.apply_center_scale(ts, p), [r6(c, c) for c in NUM])


@register("i1_n5_n6_fold_scope")
def q_fold_scope(spark, sf):
    """I1, N5, N6 fitted without the own fold: median fill, then standard scaling of two and robust scaling of two columns; test rows by the
    fits of all training rows."""
    tr, ts = _tt(spark, sf)
    med = FS.fit_median(tr, ["c_acctbal", "li_qty", "li_disc"])
    tr, ts = FS.apply_fill(tr, med), FS.apply_fill(ts, med, None)
    std, rob = FS.fit_standard(tr, NUM[:2]), FS.fit_robust(tr, NUM[2:])
    done = [FS.apply_center_scale(FS.apply_center_scale(x, std, k), rob, k) for x, k in ((tr, "fold"), (ts, None))]
    return _both(*done, [r6(c, c) for c in NUM])


@register("n7_pairwise_products")
def q_n7(spark, sf):
    b = orders_base(spark, sf)
    d, names = S.pairwise_products(b, ["o_totalprice", "li_qty", "li_disc", "li_lines"])
    return d.select("id", *[r6(n, n) for n in names])


@register("n12_n14_row_softmax_argmax_boost")
def q_n12(spark, sf):
    tr, _ = orders_train_test(spark, sf, "o_orderpriority")
    tr = E.fit_label_index(tr, ["o_orderpriority"], "_y").apply(tr)
    d = P.class_distribution(tr, "n_name", "o_orderpriority_y", 5)
    p = F.array(*[F.col(f"p{i}") for i in range(5)])
    sm = A.softmax(F.transform(p, lambda v: v * 10.0))
    bo = A.boost(p, [1.5, 1.25, 1.0, 0.75, 0.5])
    return d.select("value", *[r6(sm[i], f"softmax_{i}") for i in range(5)], A.argmax(p).alias("argmax"),
                    *[r6(bo[i], f"boost_{i}") for i in range(5)], A.argmax(bo).alias("boost_argmax"))


@register("n15_n16_label_map_and_text")
def q_n15(spark, sf):
    b = orders_base(spark, sf)
    return b.select("id", C.label_to_binary("o_orderstatus", "F").alias("y"),
                    C.binary_to_label(F.col("y_bin"), "finished", "open").alias("label"),
                    C.cross("c_mktsegment", "o_year", "___").alias("seg_year"))


@register("w6_plain_kfold")
def q_w6(spark, sf):
    from foldwise.operators.folds import kfold
    return kfold(orders_base(spark, sf), "id", 5, 42).select("id", "fold")


@register("w8_stratified_sample_split")
def q_w8(spark, sf):
    from foldwise.operators.folds import stratified_sample_split
    return stratified_sample_split(orders_base(spark, sf), "id", "y_bin", 0.2, 0.2, 7).select("id", "split")


@register("w10_union_train_test")
def q_w10(spark, sf):
    from foldwise.operators.folds import union_train_test
    tr, ts = _tt(spark, sf)
    u = union_train_test(tr.select("id", "y_bin", "fold"), ts.select("id"))
    return u.select("id", "y_bin", "fold")


@register("j6_unseen_values_report")
def q_j6(spark, sf):
    """Test values absent from the fitting rows (left anti join), with their row counts."""
    tr, ts = _tt(spark, sf)
    fit = _fit_side(tr)
    out = None
    for c in ["n_name", "c_mktsegment"]:
        seen = fit.select(F.col(c).alias("value")).filter(F.col("value").isNotNull()).distinct()
        miss = (ts.select(F.col(c).alias("value")).filter(F.col("value").isNotNull())
                .join(seen, "value", "left_anti").groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
                .withColumn("col", F.lit(c)))
        out = miss if out is None else out.unionByName(miss)
    return out.select("col", "value", "n_rows")


@register("n8_quantile_normal_transform")
def q_n8(spark, sf):
    tr, ts = _tt(spark, sf)
    cols = ["o_totalprice", "li_qty"]
    p = S.fit_quantile_normal(tr, cols, 1000)
    return _both(S.apply_quantile_normal(tr, p), S.apply_quantile_normal(ts, p), [r6(c, c) for c in cols])


@register("n9_yeo_johnson_transform")
def q_n9(spark, sf):
    tr, ts = _tt(spark, sf)
    cols = ["c_acctbal", "li_disc"]
    p = S.fit_yeo_johnson(tr, cols)
    return _both(S.apply_yeo_johnson(tr, p), S.apply_yeo_johnson(ts, p), [r6(c, c) for c in cols])
