"""Registered queries for blends, searches, metrics, seed averaging and stage tables (SQL-checkable)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators.metrics import accuracy, log_loss, macro_f1
from foldwise.operators.rank import average_rank, rank_runs, rank_normalised
from foldwise.operators.weights import class_weights
from foldwise.plans import blend as B
from foldwise.plans import search as S
from foldwise.plans import seeds as SD
from foldwise.plans.registry import r6, register, round6
from foldwise.plans.zoo import NUM, PRIORITY_LABELS, priority_filled, priority_zoo, status_zoo
from foldwise.session import cut_lineage
from foldwise.sources import files

BIN_W = {"nb_num": 0.2, "nb_te": 0.3, "nb_all": 0.5}
MC_W = {"nbc_num": 0.4, "nbc_te": 0.6}
SEEDS = [1, 2, 3]


def k6_blend(spark, sf):
    _, _, _, tst = status_zoo(spark, sf)
    b = B.fixed_blend(tst.filter(F.col("class") == 1), BIN_W, ["id"])
    return b.select("id", r6("p", "p"), F.when(F.col("p") >= 0.5, "finished").otherwise("open").alias("label"))


register("k6_fixed_weight_blend")(k6_blend)


@register("k8_rank_average_blend")
def q_k8(spark, sf):
    _, _, _, tst = status_zoo(spark, sf)
    t = tst.filter(F.col("class") == 1).withColumn("p", round6("p"))  # rank the stored 6-digit scores
    r = B.rank_average(t, list(BIN_W))
    return r.select("id", r6("score", "score"))


@register("k8_weighted_rank_blend")
def q_k8w(spark, sf):
    _, _, _, tst = status_zoo(spark, sf)
    t = tst.filter(F.col("class") == 1).withColumn("p", round6("p"))
    r = B.rank_average(t, list(BIN_W), weights=BIN_W)
    return r.select("id", r6("score", "score"))


@register("k9_k10_weight_grid")
def q_k9(spark, sf):
    tr, _, oof, _ = status_zoo(spark, sf)
    scored = S.wide_scores(oof, ["nb_te", "nb_all"]).join(tr.select("id", "y_bin"), "id")
    return S.grid_search(scored, ["nb_te", "nb_all"], "y_bin")


@register("k11_dirichlet_weight_search")
def q_k11(spark, sf):
    tr, _, oof, _ = status_zoo(spark, sf)
    models = list(BIN_W)
    scored = S.wide_scores(oof, models).join(tr.select("id", "y_bin"), "id")
    best = S.dirichlet_search(scored, models, "y_bin", 10_000, 42)
    return best.select(F.col("wid").cast("long").alias("wid"), r6("accuracy", "accuracy"), *[r6(f"w_{m}", f"w_{m}") for m in models])


@register("k17_v3_per_model_fold_accuracy")
def q_k17(spark, sf):
    tr, _, oof, _ = status_zoo(spark, sf)
    s = oof.filter(F.col("class") == 1).join(tr.select("id", "y_bin"), "id").withColumn("pred", (F.col("p") >= 0.5).cast("double"))
    per_fold = accuracy(s, "pred", "y_bin", ["model", "fold"])
    overall = accuracy(s, "pred", "y_bin", ["model"]).withColumn("fold", F.lit(-1))
    return per_fold.unionByName(overall).select("model", "fold", "n", r6("accuracy", "accuracy"))


@register("v4_log_loss")
def q_v4(spark, sf):
    tr, _, oof, _ = status_zoo(spark, sf)
    s = oof.join(tr.select("id", F.col("y_bin").cast("int").alias("class")), ["id", "class"])
    return log_loss(s, "p", ["model"]).select("model", r6("log_loss", "log_loss"))


@register("w1_average_rank")
def q_w1(spark, sf):
    _, _, _, tst = status_zoo(spark, sf)
    t = tst.filter((F.col("class") == 1) & (F.col("model") == "nb_all")).select("id", round6("p").alias("p"))
    r = rank_normalised(average_rank(t, "p", None, "rank"), "p", None, "rank_norm")
    return r.select("id", r6("rank", "rank"), r6("rank_norm", "rank_norm"))


@register("k7_fixed_weight_multiclass_blend")
def q_k7(spark, sf):
    _, _, _, tst = priority_zoo(spark, sf)
    b = B.decide(B.to_vector(B.fixed_blend(tst, MC_W), 5), PRIORITY_LABELS)
    return b.select("id", "pred", "label", *[r6(F.col("probs")[i], f"p{i}") for i in range(5)])


@register("v2_macro_f1")
def q_v2(spark, sf):
    tr, _, oof, _ = priority_zoo(spark, sf)
    v = B.decide(B.to_vector(oof, 5, ["id", "model", "fold"])).join(tr.select("id", "y"), "id")
    v = v.withColumn("y", F.col("y").cast("int"))
    per_fold = macro_f1(v, "pred", "y", ["model", "fold"])
    overall = macro_f1(v, "pred", "y", ["model"]).withColumn("fold", F.lit(-1))
    return per_fold.unionByName(overall).select("model", "fold", r6("macro_f1", "macro_f1"))


@register("m20_soft_voting")
def q_m20(spark, sf):
    _, _, _, tst = priority_zoo(spark, sf)
    v = B.decide(B.to_vector(B.mean_over(tst, "model", ["id", "class"]), 5), PRIORITY_LABELS)
    return v.select("id", "pred", "label")


@register("m22_class_weights")
def q_m22(spark, sf):
    from foldwise.plans.queries_target import multiclass_train_test
    tr, _ = multiclass_train_test(spark, sf)
    return class_weights(tr, "y").select(F.col("y").cast("long").alias("class"), "n", r6("weight", "weight"))


def _seeded(spark, sf, features, encoded, seeds):
    """Fits of all seeds on the multiclass table in one plan: (sweep, train rows, test rows)."""
    tr, ts = priority_filled(spark, sf)
    sweep, rows = SD.fit(tr, features, encoded, 5, seeds)
    return sweep, rows, ts


def _seeded_test(spark, sf, seeds=SEEDS):
    sweep, _, ts = _seeded(spark, sf, ["li_qty"], "n_name", list(seeds))
    return SD.test_probabilities(sweep, ts, "nbc_te")


@register("k13_seed_average")
def q_k13(spark, sf):
    avg = B.mean_over(_seeded_test(spark, sf), "seed", ["id", "class"])
    return avg.select("id", "class", r6("p", "p"))


def sweep_accuracy(spark, sf, seeds=tuple(range(1, 51))):
    """OOF accuracy by seed; the study sweeps 50 seeds, the registered query 4."""
    sweep, rows, _ = _seeded(spark, sf, NUM, None, list(seeds))
    return SD.oof_accuracy(sweep, rows)


@register("k12_w4_seed_sweep_ranked")
def q_k12(spark, sf):
    runs = sweep_accuracy(spark, sf, [1, 2, 3, 4])
    return rank_runs(runs, "accuracy", ["seed"]).select("seed", r6("accuracy", "accuracy"), F.col("rank").cast("long").alias("rank"))


@register("k16_s4_s5_stage_tables")
def q_k16(spark, sf):
    """S4 write per-seed probabilities partitioned by seed; S5 read them back (partition filter);
    K16 average, argmax, decode."""
    path = files.stage_path(spark, "proba_by_seed")
    files.write_stage(_seeded_test(spark, sf).select("seed", "id", "class", "p"), path, ["seed"])
    back = files.read_stage(spark, path).filter(F.col("seed").isin(SEEDS))
    v = B.decide(B.to_vector(B.mean_over(back, "seed", ["id", "class"]), 5), PRIORITY_LABELS)
    return v.select("id", "label")


@register("s1_s2_submission_roundtrip")
def q_s1(spark, sf):
    sub = k6_blend(spark, sf).select("id", "label")
    path = files.stage_path(spark, "submission")
    files.write_submission(sub, path)
    return files.read_csv(spark, path, "id long, label string")


@register("s3_submission_per_seed")
def q_s3(spark, sf):
    sub = _seeded_test(spark, sf)
    lab = B.decide(B.to_vector(sub, 5, ["seed", "id"]), PRIORITY_LABELS).select("seed", "id", "label")
    path = files.stage_path(spark, "submission_by_seed")
    files.write_submission(lab, path, partition_by=["seed"])
    return files.read_csv(spark, path, "id long, label string, seed int").select(F.col("seed").cast("long").alias("seed"), "id", "label")


@register("a15_mean_fold_score")
def q_a15(spark, sf):
    """Mean over folds of the per-fold OOF accuracy, per model."""
    tr, _, oof, _ = status_zoo(spark, sf)
    s = oof.filter(F.col("class") == 1).join(tr.select("id", "y_bin"), "id").withColumn("pred", (F.col("p") >= 0.5).cast("double"))
    per_fold = accuracy(s, "pred", "y_bin", ["model", "fold"])
    return per_fold.groupBy("model").agg(F.avg("accuracy").alias("mean_fold_accuracy")).select("model", r6("mean_fold_accuracy", "mean_fold_accuracy"))


@register("p6_meta_block_subset")
def q_p6(spark, sf):
    """Meta features from a subset of models, fixed (model x class) column order, absent cells 0."""
    _, _, oof, _ = status_zoo(spark, sf)
    keep = ["nb_all", "nb_num"]
    sub = oof.filter(F.col("model").isin(keep))
    g = sub.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "model", F.col("class").cast("string")), "p"))).alias("_m"))
    return g.select("id", *[r6(F.coalesce(F.col("_m")[f"{m}:{c}"], F.lit(0.0)), f"{m}_{c}") for m in keep for c in range(2)])


@register("k14_seed_average_of_blend")
def q_k14(spark, sf):
    """Per seed a fixed-weight blend of the two multiclass models, then the mean over seeds."""
    tr, ts = priority_filled(spark, sf)
    folds = cut_lineage(SD.seeded_folds(tr.select("id", "y"), "id", "y", 5, SEEDS))  # both models' rows and folds are the same
    num, _ = SD.fit(tr, NUM, None, 5, SEEDS, folds=folds)
    te, _ = SD.fit(tr, ["li_qty"], "n_name", 5, SEEDS, folds=folds)
    both = cut_lineage(SD.test_probabilities(te, ts, "nbc_te").unionByName(SD.test_probabilities(num, ts, "nbc_num")))
    blend = B.fixed_blend(both, MC_W, ["seed", "id", "class"])
    avg = B.mean_over(blend, "seed", ["id", "class"])
    v = B.decide(B.to_vector(avg, 5), PRIORITY_LABELS)
    return v.select("id", "pred", "label")


@register("k15_seed_average_margins_softmax")
def q_k15(spark, sf):
    """Per seed the raw class scores (log-probabilities, floored at 1e-300), mean over seeds,
    then a row soft-max and argmax."""
    from foldwise.functions.arrays import softmax
    raw = _seeded_test(spark, sf).withColumn("m", F.log(F.greatest(F.col("p"), F.lit(1e-300))))
    avg = raw.groupBy("id", "class").agg(F.avg("m").alias("p"))
    v = B.to_vector(avg, 5).withColumn("probs", softmax("probs"))
    v = B.decide(v, PRIORITY_LABELS)
    return v.select("id", "pred", *[r6(F.col("probs")[i], f"p{i}") for i in range(5)])


@register("q_quality_te_naive_bayes")
def q_quality(spark, sf):
    """Text-quality table Q (documents joined with labels): hold-out + folds, m-estimate target
    encoding of source and lang, naive Bayes on (source_te, lang_te, n_chars), accuracy per part."""
    from foldwise.operators.bayes import naive_bayes_oof
    from foldwise.operators.target import fit_target_encoder
    from foldwise.plans.prepare import split_train_test
    from foldwise.sources.tables import quality_base
    tr, ts = split_train_test(quality_base(spark, sf), "id", "y")
    te = fit_target_encoder(tr, ["source", "lang"], "y", kind="mestimate", m=1.0, test_mode="full")
    tr, ts = te.apply_oof(tr), te.apply_test(ts)
    oof, tst, _ = naive_bayes_oof(tr, ts, ["source_te", "lang_te", "n_chars"], "y", model="nb_q")
    p_oof = oof.filter(F.col("class") == 1).select("id", "p").join(tr.select("id", "y"), "id").withColumn("part", F.lit("oof"))
    p_tst = tst.filter(F.col("class") == 1).select("id", "p").join(ts.select("id", "y"), "id").withColumn("part", F.lit("test"))
    both = p_oof.unionByName(p_tst).withColumn("pred", (F.col("p") >= 0.5).cast("double"))
    return accuracy(both, "pred", "y", ["part"]).select("part", "n", r6("accuracy", "accuracy"))
