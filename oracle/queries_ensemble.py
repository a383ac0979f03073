"""Oracle SQL for the blend / search / metric / seed queries."""

from __future__ import annotations

import numpy as np

from oracle import sql as S
from oracle.queries_features import tt
from oracle.queries_target import mc_tt

NUM = ["o_totalprice", "c_acctbal", "li_qty", "li_disc"]
FILL = ["c_acctbal", "li_qty", "li_disc"]
TE3 = ["o_orderpriority_te", "c_mktsegment_te", "n_name_te"]
BIN_MODELS = {"nb_num": NUM, "nb_te": TE3, "nb_all": NUM + TE3}
BIN_W = {"nb_num": 0.2, "nb_te": 0.3, "nb_all": 0.5}
MC_MODELS = {"nbc_num": NUM, "nbc_te": [f"n_name_te_{i}" for i in range(5)] + ["li_qty"]}
MC_W = {"nbc_num": 0.4, "nbc_te": 0.6}
LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def bin_zoo() -> str:
    """CTEs: tr2/ts2 features, oof(id, model, fold, class, p), tst(id, model, class, p)."""
    parts = [tt()[len("WITH "):],
             S.median_fill("tr", "tr", FILL, "tr1"), S.median_fill("ts", "tr", FILL, "ts1")]
    for c in ["o_orderpriority", "c_mktsegment", "n_name"]:
        parts.append(S.te_mestimate("tr1", "ts1", c, "y_bin", 1, f"te_{c}"))
    parts.append("""
tr2 AS (SELECT t.*, a.enc AS o_orderpriority_te, b.enc AS c_mktsegment_te, c.enc AS n_name_te FROM tr1 t
  JOIN te_o_orderpriority_tr a ON a.id = t.id JOIN te_c_mktsegment_tr b ON b.id = t.id JOIN te_n_name_tr c ON c.id = t.id),
ts2 AS (SELECT t.*, a.enc AS o_orderpriority_te, b.enc AS c_mktsegment_te, c.enc AS n_name_te FROM ts1 t
  JOIN te_o_orderpriority_ts a ON a.id = t.id JOIN te_c_mktsegment_ts b ON b.id = t.id JOIN te_n_name_ts c ON c.id = t.id)""")
    for m, feats in BIN_MODELS.items():
        parts.append(S.naive_bayes("tr2", "ts2", feats, "y_bin", m))
    parts.append("\noof AS (" + " UNION ALL ".join(f"SELECT id, '{m}' AS model, fold, class, p FROM {m}_oof" for m in BIN_MODELS) + ")")
    parts.append("\ntst AS (" + " UNION ALL ".join(f"SELECT id, '{m}' AS model, class, p FROM {m}_test" for m in BIN_MODELS) + ")")
    return "WITH " + ",".join(parts)


def mc_zoo(seed: int | None = None, sfx: str = "") -> str:
    """CTEs (suffix sfx): trf{sfx}/tsf{sfx}, oof{sfx}, tst{sfx} for the multiclass zoo; optional fold re-draw."""
    trc = "trc"
    parts = []
    if seed is not None:
        parts.append(f"""
trc{sfx} AS (SELECT * EXCLUDE (fold), CAST((row_number() OVER (PARTITION BY y ORDER BY md5('{seed}:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INTEGER) AS fold FROM trc)""")
        trc = f"trc{sfx}"
    parts += [S.median_fill(trc, trc, FILL, f"tr1{sfx}"), S.median_fill("tsc", trc, FILL, f"ts1{sfx}")]
    K = 5
    cnt = ", ".join(f"SUM(CASE WHEN y = {i} THEN 1 ELSE 0 END) AS c{i}" for i in range(K))
    oofc = ", ".join(f"SUM(st.c{i}) AS c{i}" for i in range(K))
    pc = ", ".join(f"CASE WHEN n_oof > 0 THEN c{i} / n_oof ELSE CAST(1 AS DOUBLE) / {K} END AS p{i}" for i in range(K))
    n = f"m{sfx}"
    parts.append(f"""
{n}_st AS (SELECT CAST(n_name AS VARCHAR) AS v, fold, {cnt}, COUNT(*) AS n FROM tr1{sfx} WHERE n_name IS NOT NULL GROUP BY 1, 2),
{n}_ff AS (SELECT DISTINCT fold AS f FROM tr1{sfx}),
{n}_grid AS (SELECT d.v, ff.f, SUM(st.n) AS n_oof, {oofc}
  FROM (SELECT DISTINCT v FROM {n}_st) d CROSS JOIN {n}_ff ff LEFT JOIN {n}_st st ON st.v = d.v AND st.fold <> ff.f GROUP BY d.v, ff.f),
{n}_p AS (SELECT v, f, {pc} FROM {n}_grid),
trf{sfx} AS (SELECT t.*, """ + ", ".join(f"COALESCE(e.p{i}, CAST(1 AS DOUBLE) / {K}) AS n_name_te_{i}" for i in range(K)) + f"""
  FROM tr1{sfx} t LEFT JOIN {n}_p e ON e.v = CAST(t.n_name AS VARCHAR) AND e.f = t.fold),
{n}_tsx AS (SELECT t.id, """ + ", ".join(f"COALESCE(AVG(e.p{i}), CAST(1 AS DOUBLE) / {K}) AS n_name_te_{i}" for i in range(K)) + f"""
  FROM ts1{sfx} t LEFT JOIN {n}_p e ON e.v = CAST(t.n_name AS VARCHAR) GROUP BY t.id),
tsf{sfx} AS (SELECT t.*, x.* EXCLUDE (id) FROM ts1{sfx} t JOIN {n}_tsx x ON x.id = t.id)""")
    for m, feats in MC_MODELS.items():
        parts.append(S.naive_bayes(f"trf{sfx}", f"tsf{sfx}", feats, "y", f"{m}{sfx}"))
    parts.append(f"\noof{sfx} AS (" + " UNION ALL ".join(f"SELECT id, '{m}' AS model, fold, class, p FROM {m}{sfx}_oof" for m in MC_MODELS) + ")")
    parts.append(f"\ntst{sfx} AS (" + " UNION ALL ".join(f"SELECT id, '{m}' AS model, class, p FROM {m}{sfx}_test" for m in MC_MODELS) + ")")
    return ",".join(parts)


def _argmax_cte(src: str, keys: str, name: str) -> str:
    """(keys, class, p) -> (keys, pred): first class with the max p."""
    return f"""
{name} AS (SELECT {keys}, CAST(MIN(class) AS INTEGER) AS pred FROM (
  SELECT {keys}, class, p, MAX(p) OVER (PARTITION BY {keys}) AS mx FROM {src}) WHERE p = mx GROUP BY {keys})"""


def _decode(pred_col: str = "pred") -> str:
    return "CASE " + " ".join(f"WHEN {pred_col} = {i} THEN '{lab}'" for i, lab in enumerate(LABELS)) + " END"


def k6() -> str:
    w = " ".join(f"WHEN '{m}' THEN {v}" for m, v in BIN_W.items())
    return bin_zoo() + f""",
b AS (SELECT id, SUM(CASE model {w} END * p) AS p FROM tst WHERE class = 1 GROUP BY id)
SELECT id, ROUND(p, 6) AS p, CASE WHEN p >= 0.5 THEN 'finished' ELSE 'open' END AS label FROM b"""


def k8() -> str:
    return bin_zoo() + """,
t6 AS (SELECT id, model, ROUND(p, 6) AS p FROM tst WHERE class = 1),
r AS (SELECT id, model, (rank() OVER (PARTITION BY model ORDER BY p) + (COUNT(*) OVER (PARTITION BY model, p) - 1) / 2.0) AS rk FROM t6),
rn AS (SELECT id, model, rk / MAX(rk) OVER (PARTITION BY model) AS rn FROM r)
SELECT id, ROUND(SUM(rn) / 3, 6) AS score FROM rn GROUP BY id"""


def k8w() -> str:
    w = " ".join(f"WHEN '{m}' THEN {v}" for m, v in BIN_W.items())
    return k8().replace("SUM(rn) / 3", f"SUM(rn * CASE model {w} END) / {sum(BIN_W.values())}")


def _scored(models: list[str]) -> str:
    cols = ", ".join(f"MAX(CASE WHEN o.model = '{m}' THEN o.p END) AS p_{m}" for m in models)
    return f"""
sc AS (SELECT o.id, {cols}, ANY_VALUE(t.y_bin) AS y FROM oof o JOIN tr2 t ON t.id = o.id WHERE o.class = 1 GROUP BY o.id)"""


def k9() -> str:
    return bin_zoo() + "," + _scored(["nb_te", "nb_all"]) + """,
g1 AS (SELECT i, j FROM range(0, 21) a(i), range(0, 21) b(j) WHERE i + j <= 20),
s1 AS (SELECT i, j, AVG(CAST(CAST((i / 20) * p_nb_te + (j / 20) * p_nb_all >= 0.5 AS DOUBLE) = y AS DOUBLE)) AS acc FROM g1, sc GROUP BY i, j),
b1 AS (SELECT i, j, acc FROM s1 ORDER BY acc DESC, i, j LIMIT 1),
g2 AS (SELECT a.i, b.j FROM b1, range(0, 101) a(i), range(0, 101) b(j)
  WHERE a.i BETWEEN GREATEST(0, b1.i * 5 - 10) AND LEAST(100, b1.i * 5 + 10)
    AND b.j BETWEEN GREATEST(0, b1.j * 5 - 10) AND LEAST(100, b1.j * 5 + 10) AND a.i + b.j <= 100),
s2 AS (SELECT i, j, AVG(CAST(CAST((i / 100) * p_nb_te + (j / 100) * p_nb_all >= 0.5 AS DOUBLE) = y AS DOUBLE)) AS acc FROM g2, sc GROUP BY i, j),
b2 AS (SELECT i, j, acc FROM s2 ORDER BY acc DESC, i, j LIMIT 1)
SELECT 'coarse' AS stage, i / 20 AS w_a, j / 20 AS w_b, acc AS accuracy FROM b1
UNION ALL SELECT 'refine', i / 100, j / 100, acc FROM b2"""


def k11() -> str:
    rng = np.random.default_rng(42)
    draws = [rng.dirichlet(np.ones(3)).tolist() for _ in range(10_000)]
    vals = ", ".join(f"({k}, {w[0]!r}, {w[1]!r}, {w[2]!r})" for k, w in enumerate(draws))
    return bin_zoo() + "," + _scored(list(BIN_W)) + f""",
wt(wid, w0, w1, w2) AS (VALUES {vals}),
s AS (SELECT wid, w0, w1, w2, AVG(CAST(CAST(w0 * p_nb_num + w1 * p_nb_te + w2 * p_nb_all >= 0.5 AS DOUBLE) = y AS DOUBLE)) AS acc
  FROM wt, sc GROUP BY wid, w0, w1, w2)
SELECT CAST(wid AS BIGINT) AS wid, ROUND(acc, 6) AS accuracy, ROUND(w0, 6) AS w_nb_num, ROUND(w1, 6) AS w_nb_te, ROUND(w2, 6) AS w_nb_all
FROM s ORDER BY acc DESC, wid LIMIT 1"""


def k17() -> str:
    return bin_zoo() + """,
s AS (SELECT o.model, o.fold, CAST(CAST(o.p >= 0.5 AS DOUBLE) = t.y_bin AS DOUBLE) AS hit FROM oof o JOIN tr2 t ON t.id = o.id WHERE o.class = 1)
SELECT model, fold, COUNT(*) AS n, ROUND(AVG(hit), 6) AS accuracy FROM s GROUP BY model, fold
UNION ALL SELECT model, -1, COUNT(*), ROUND(AVG(hit), 6) FROM s GROUP BY model"""


def v4() -> str:
    return bin_zoo() + """
SELECT o.model, ROUND(AVG(-LN(LEAST(GREATEST(o.p, 1e-15), 1 - 1e-15))), 6) AS log_loss
FROM oof o JOIN tr2 t ON t.id = o.id AND o.class = CAST(t.y_bin AS INTEGER) GROUP BY o.model"""


def w1() -> str:
    return bin_zoo() + """,
t6 AS (SELECT id, ROUND(p, 6) AS p FROM tst WHERE class = 1 AND model = 'nb_all'),
r AS (SELECT id, rank() OVER (ORDER BY p) + (COUNT(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM t6)
SELECT id, ROUND(rk, 6) AS rank, ROUND(rk / MAX(rk) OVER (), 6) AS rank_norm FROM r"""


def k7() -> str:
    w = " ".join(f"WHEN '{m}' THEN {v}" for m, v in MC_W.items())
    return mc_tt() + "," + mc_zoo() + f""",
b AS (SELECT id, class, SUM(CASE model {w} END * p) AS p FROM tst GROUP BY id, class),""" + _argmax_cte("b", "id", "am") + f"""
SELECT b.id, am.pred, {_decode('am.pred')} AS label, """ + ", ".join(
        f"ROUND(MAX(CASE WHEN b.class = {i} THEN b.p END), 6) AS p{i}" for i in range(5)) + """
FROM b JOIN am ON am.id = b.id GROUP BY b.id, am.pred"""


def _f1(src: str, keys: str) -> str:
    """macro F1 per keys from (keys, y, pred)."""
    return f"""
labf AS (SELECT {keys}, y AS label FROM {src} UNION SELECT {keys}, pred FROM {src}),
per AS (SELECT l.{keys.replace(', ', ', l.')}, l.label,
  2.0 * SUM(CASE WHEN s.y = l.label AND s.pred = l.label THEN 1 ELSE 0 END)
  / (SUM(CASE WHEN s.y = l.label THEN 1 ELSE 0 END) + SUM(CASE WHEN s.pred = l.label THEN 1 ELSE 0 END)) AS f1
  FROM labf l JOIN {src} s ON """ + " AND ".join(f"s.{k} = l.{k}" for k in keys.split(", ")) + f"""
  GROUP BY l.{keys.replace(', ', ', l.')}, l.label)"""


def v2() -> str:
    return mc_tt() + "," + mc_zoo() + "," + _argmax_cte("oof", "id, model, fold", "am") + """,
ev AS (SELECT am.id, am.model, am.fold, am.pred, CAST(t.y AS INTEGER) AS y FROM am JOIN trf t ON t.id = am.id),
ev2 AS (SELECT id, model, -1 AS fold, pred, y FROM ev),""" + _f1("ev", "model, fold") + """,
lab2 AS (SELECT model, fold, y AS label FROM ev2 UNION SELECT model, fold, pred FROM ev2),
per2 AS (SELECT l.model, l.fold, l.label, 2.0 * SUM(CASE WHEN s.y = l.label AND s.pred = l.label THEN 1 ELSE 0 END)
  / (SUM(CASE WHEN s.y = l.label THEN 1 ELSE 0 END) + SUM(CASE WHEN s.pred = l.label THEN 1 ELSE 0 END)) AS f1
  FROM lab2 l JOIN ev2 s ON s.model = l.model GROUP BY l.model, l.fold, l.label)
SELECT model, fold, ROUND(AVG(f1), 6) AS macro_f1 FROM per GROUP BY model, fold
UNION ALL SELECT model, fold, ROUND(AVG(f1), 6) FROM per2 GROUP BY model, fold"""


def m20() -> str:
    return mc_tt() + "," + mc_zoo() + """,
b AS (SELECT id, class, AVG(p) AS p FROM tst GROUP BY id, class),""" + _argmax_cte("b", "id", "am") + f"""
SELECT id, pred, {_decode()} AS label FROM am"""


def m22() -> str:
    return mc_tt() + """,
c AS (SELECT y, COUNT(*) AS n FROM trc GROUP BY y)
SELECT CAST(y AS BIGINT) AS class, n, ROUND((SELECT SUM(n) FROM c) / ((SELECT COUNT(*) FROM c) * n), 6) AS weight FROM c"""


SEEDS = [1, 2, 3]


def _seeded() -> str:
    parts = [mc_zoo(s, f"_s{s}") for s in SEEDS]
    return mc_tt() + "," + ",".join(parts) + ",\nseeded AS (" + " UNION ALL ".join(
        f"SELECT {s} AS seed, id, class, p FROM tst_s{s} WHERE model = 'nbc_te'" for s in SEEDS) + ")"


def k13() -> str:
    return _seeded() + "\nSELECT id, class, ROUND(AVG(p), 6) AS p FROM seeded GROUP BY id, class"


def k16() -> str:
    return _seeded() + """,
b AS (SELECT id, class, AVG(p) AS p FROM seeded GROUP BY id, class),""" + _argmax_cte("b", "id", "am") + f"""
SELECT id, {_decode()} AS label FROM am"""


def s3() -> str:
    return _seeded() + "," + _argmax_cte("seeded", "seed, id", "am") + f"""
SELECT CAST(seed AS BIGINT) AS seed, id, {_decode()} AS label FROM am"""


def k12() -> str:
    seeds = [1, 2, 3, 4]
    parts = [mc_zoo(s, f"_s{s}") for s in seeds]
    body = mc_tt() + "," + ",".join(parts)
    for s in seeds:
        body += "," + _argmax_cte(f"(SELECT * FROM oof_s{s} WHERE model = 'nbc_num')", "id", f"am{s}")
    runs = " UNION ALL ".join(
        f"SELECT {s} AS seed, AVG(CAST(a.pred = CAST(t.y AS INTEGER) AS DOUBLE)) AS acc FROM am{s} a JOIN trf_s{s} t ON t.id = a.id"
        for s in seeds)
    return body + f""",
runs AS ({runs})
SELECT CAST(seed AS BIGINT) AS seed, ROUND(acc, 6) AS accuracy, row_number() OVER (ORDER BY acc DESC, seed) AS rank FROM runs"""


def s1() -> str:
    return k6().replace("SELECT id, ROUND(p, 6) AS p, CASE", "SELECT id, CASE")


ORACLE = {
    "k6_fixed_weight_blend": k6, "k8_rank_average_blend": k8, "k8_weighted_rank_blend": k8w, "k9_k10_weight_grid": k9,
    "k11_dirichlet_weight_search": k11, "k17_v3_per_model_fold_accuracy": k17, "v4_log_loss": v4,
    "w1_average_rank": w1, "k7_fixed_weight_multiclass_blend": k7, "v2_macro_f1": v2, "m20_soft_voting": m20,
    "m22_class_weights": m22, "k13_seed_average": k13, "k12_w4_seed_sweep_ranked": k12,
    "k16_s4_s5_stage_tables": k16, "s1_s2_submission_roundtrip": s1, "s3_submission_per_seed": s3,
}


def a15() -> str:
    return bin_zoo() + """,
s AS (SELECT o.model, o.fold, AVG(CAST(CAST(o.p >= 0.5 AS DOUBLE) = t.y_bin AS DOUBLE)) AS acc FROM oof o JOIN tr2 t ON t.id = o.id WHERE o.class = 1 GROUP BY o.model, o.fold)
SELECT model, ROUND(AVG(acc), 6) AS mean_fold_accuracy FROM s GROUP BY model"""


def p6() -> str:
    keep = ["nb_all", "nb_num"]
    cols = ", ".join(f"ROUND(COALESCE(MAX(CASE WHEN model = '{m}' AND class = {c} THEN p END), 0), 6) AS {m}_{c}"
                     for m in keep for c in range(2))
    return bin_zoo() + f"\nSELECT id, {cols} FROM oof WHERE model IN ('nb_all', 'nb_num') GROUP BY id"


def k14() -> str:
    w = " ".join(f"WHEN '{m}' THEN {v}" for m, v in MC_W.items())
    parts = [mc_zoo(s, f"_s{s}") for s in SEEDS]
    blends = " UNION ALL ".join(f"SELECT {s} AS seed, id, class, SUM(CASE model {w} END * p) AS p FROM tst_s{s} GROUP BY id, class" for s in SEEDS)
    return mc_tt() + "," + ",".join(parts) + f""",
bl AS ({blends}),
b AS (SELECT id, class, AVG(p) AS p FROM bl GROUP BY id, class),""" + _argmax_cte("b", "id", "am") + f"""
SELECT id, pred, {_decode()} AS label FROM am"""


ORACLE.update({"a15_mean_fold_score": a15, "p6_meta_block_subset": p6, "k14_seed_average_of_blend": k14})


def k15() -> str:
    return _seeded() + """,
mg AS (SELECT id, class, AVG(LN(GREATEST(p, 1e-300))) AS m FROM seeded GROUP BY id, class),
ex AS (SELECT id, class, EXP(m - MAX(m) OVER (PARTITION BY id)) AS e FROM mg),
sm AS (SELECT id, class, e / SUM(e) OVER (PARTITION BY id) AS p FROM ex),""" + _argmax_cte("sm", "id", "am") + """
SELECT sm.id, am.pred, """ + ", ".join(f"ROUND(MAX(CASE WHEN sm.class = {i} THEN sm.p END), 6) AS p{i}" for i in range(5)) + """
FROM sm JOIN am ON am.id = sm.id GROUP BY sm.id, am.pred"""


ORACLE.update({"k15_seed_average_margins_softmax": k15})


def q_quality() -> str:
    return "WITH " + """
q AS (SELECT d.doc_id AS id, CAST(l.quality AS DOUBLE) AS y, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id),""" + S.split("q", "y", "sp") + """,
tr0 AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'),
ts0 AS (SELECT * EXCLUDE (split, fold) FROM sp WHERE split = 'test'),""" + \
        S.te_mestimate("tr0", "ts0", "source", "y", 1, "tes") + "," + S.te_mestimate("tr0", "ts0", "lang", "y", 1, "tel") + """,
tr AS (SELECT t.*, a.enc AS source_te, b.enc AS lang_te FROM tr0 t JOIN tes_tr a ON a.id = t.id JOIN tel_tr b ON b.id = t.id),
ts AS (SELECT t.*, a.enc AS source_te, b.enc AS lang_te FROM ts0 t JOIN tes_ts a ON a.id = t.id JOIN tel_ts b ON b.id = t.id),""" + \
        S.naive_bayes("tr", "ts", ["source_te", "lang_te", "n_chars"], "y", "nbq") + """
SELECT part, COUNT(*) AS n, ROUND(AVG(CAST(pred = y AS DOUBLE)), 6) AS accuracy FROM (
  SELECT 'oof' AS part, CAST(o.p >= 0.5 AS DOUBLE) AS pred, t.y FROM nbq_oof o JOIN tr t ON t.id = o.id WHERE o.class = 1
  UNION ALL
  SELECT 'test', CAST(o.p >= 0.5 AS DOUBLE), t.y FROM nbq_test o JOIN ts t ON t.id = o.id WHERE o.class = 1) x
GROUP BY part"""


ORACLE.update({"q_quality_te_naive_bayes": q_quality})
