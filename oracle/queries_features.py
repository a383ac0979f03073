"""Oracle SQL for profile / imputer / encoder / scaler / column-function queries."""

from __future__ import annotations

from oracle import sql as S

CATS = ["c_mktsegment", "n_name", "r_name", "o_year", "o_orderpriority"]
BASE_COLS = ["id", "y_bin", "o_orderpriority", "o_orderstatus", "o_totalprice", "c_acctbal", "li_qty", "li_lines",
             "li_disc", "c_mktsegment", "n_name", "r_name", "o_year"]
NUM = ["o_totalprice", "c_acctbal", "li_qty", "li_disc"]


def tt(label: str = "y_bin") -> str:
    return "WITH " + ",".join([S.base_orders(), S.split("base", label, "sp"),
                               "\ntr AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'),"
                               "\nts AS (SELECT * EXCLUDE (split, fold) FROM sp WHERE split = 'test'),"
                               "\nfit AS (SELECT * FROM tr WHERE n_name <> 'NATION_3')"])


def base() -> str:
    return "WITH " + S.base_orders()


def both(sel_tr: str, sel_ts: str | None = None) -> str:
    sel_ts = sel_ts or sel_tr
    return f"SELECT id, 'train' AS part, {sel_tr} FROM tr_o UNION ALL SELECT id, 'test' AS part, {sel_ts} FROM ts_o"


def a1():
    return tt() + " SELECT n_name AS value, COUNT(*) AS n FROM tr WHERE n_name IS NOT NULL GROUP BY 1"


def a2():
    return tt() + """ SELECT c_mktsegment AS value, ROUND(COUNT(*) / (SELECT COUNT(c_mktsegment) FROM tr), 6) AS freq
FROM tr WHERE c_mktsegment IS NOT NULL GROUP BY 1"""


def a3():
    return tt() + " SELECT c_mktsegment AS value, COUNT(*) AS n FROM tr GROUP BY 1"


def a4():
    return tt() + " SELECT n_name AS value, ROUND(AVG(y_bin), 6) AS mean, COUNT(*) AS n FROM tr WHERE n_name IS NOT NULL GROUP BY 1"


def _class_dist():
    return tt("o_orderpriority") + """,
lab AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT o_orderpriority AS value FROM tr)),
trc AS (SELECT tr.*, lab.idx AS y FROM tr JOIN lab ON lab.value = tr.o_orderpriority),
dist AS (SELECT n_name AS value, """ + ", ".join(
        f"SUM(CASE WHEN y = {i} THEN 1 ELSE 0 END) / COUNT(*) AS p{i}" for i in range(5)) + """
FROM trc WHERE n_name IS NOT NULL GROUP BY 1)"""


def a5():
    return _class_dist() + " SELECT value, " + ", ".join(f"ROUND(p{i}, 6) AS p{i}" for i in range(5)) + " FROM dist"


def a6():
    return tt() + """ SELECT ROUND((SELECT AVG(y_bin) FROM tr), 6) AS global_mean,
ROUND((SELECT AVG(m) FROM (SELECT AVG(y_bin) AS m FROM tr WHERE n_name IS NOT NULL GROUP BY n_name)), 6) AS mean_of_means"""


def a8():
    return tt() + """ SELECT 'o_orderpriority' AS col, value, row_number() OVER (ORDER BY value) - 1 AS idx
FROM (SELECT DISTINCT o_orderpriority AS value FROM tr WHERE o_orderpriority IS NOT NULL)
UNION ALL SELECT 'n_name', value, row_number() OVER (ORDER BY value) - 1 FROM (SELECT DISTINCT n_name AS value FROM tr WHERE n_name IS NOT NULL)"""


def a9():
    return tt() + " " + " UNION ALL ".join(f"SELECT '{c}' AS col, COUNT(DISTINCT {c}) AS n_distinct FROM tr" for c in CATS)


def a10():
    return base() + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM base" for c in BASE_COLS)


def a11():
    return base() + f" SELECT COUNT(*) AS n_rows, CAST({len(BASE_COLS)} AS BIGINT) AS n_cols FROM base"


def a11h():
    return base() + " SELECT id, o_orderpriority, ROUND(o_totalprice, 6) AS o_totalprice FROM base ORDER BY id LIMIT 5"


def a12():
    return tt() + " SELECT split, y_bin AS label, COUNT(*) AS n FROM sp GROUP BY ALL"


def a16():
    return tt() + " " + " UNION ALL ".join(f"SELECT '{c}' AS col, ROUND(AVG({c}), 6) AS mean FROM tr" for c in ["c_acctbal", "li_qty", "li_disc", "o_totalprice"])


def i2():
    return tt() + " " + " UNION ALL ".join(f"""SELECT '{c}' AS col, (SELECT v FROM (SELECT {c} AS v, COUNT(*) AS n FROM tr
WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1)) AS mode""" for c in ["c_mktsegment", "n_name", "o_year"])


def i3():
    return base() + """ SELECT id, COALESCE(c_mktsegment, 'Unknown') AS c_mktsegment,
CAST(c_acctbal IS NULL AS INTEGER) AS c_acctbal_missing, CAST(c_mktsegment IS NULL AS INTEGER) AS c_mktsegment_missing,
CAST(li_qty IS NULL AS INTEGER) AS li_qty_missing FROM base"""


def i5():
    return base() + """, r AS (SELECT id, CASE WHEN id % 13 = 0 THEN 'inf'::DOUBLE WHEN id % 17 = 0 THEN 'nan'::DOUBLE ELSE li_disc END AS x FROM base)
SELECT id, ROUND(CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN CAST(0.2 AS DOUBLE) ELSE x END, 6) AS x FROM r"""


def i6():
    return base() + " SELECT id, COALESCE(CAST(c_mktsegment AS VARCHAR), 'nan') AS c_mktsegment FROM base"


def e1():
    return tt() + """,
f1 AS (SELECT c_mktsegment AS v, COUNT(*) AS n FROM fit WHERE c_mktsegment IS NOT NULL GROUP BY 1),
f2 AS (SELECT n_name AS v, COUNT(*) AS n FROM fit WHERE n_name IS NOT NULL GROUP BY 1),
tr_o AS (SELECT t.id, CAST(a.n AS DOUBLE) AS c_mktsegment_FE, CAST(b.n AS DOUBLE) AS n_name_FE FROM tr t LEFT JOIN f1 a ON a.v = t.c_mktsegment LEFT JOIN f2 b ON b.v = t.n_name),
ts_o AS (SELECT t.id, CAST(a.n AS DOUBLE) AS c_mktsegment_FE, CAST(b.n AS DOUBLE) AS n_name_FE FROM ts t LEFT JOIN f1 a ON a.v = t.c_mktsegment LEFT JOIN f2 b ON b.v = t.n_name)
""" + both("c_mktsegment_FE, n_name_FE")


def e2():
    return base() + """, v AS (SELECT c_mktsegment, COUNT(*) AS n FROM base GROUP BY 1)
SELECT b.id, CAST(v.n AS DOUBLE) AS c_mktsegment_freq FROM base b JOIN v ON v.c_mktsegment IS NOT DISTINCT FROM b.c_mktsegment"""


def _relfreq(c):
    return f"(SELECT {c} AS v, COUNT(*) / (SELECT COUNT({c}) FROM fit) AS f FROM fit WHERE {c} IS NOT NULL GROUP BY 1)"


def e3():
    return tt() + f""",
f1 AS {_relfreq('n_name')}, f2 AS {_relfreq('c_mktsegment')},
tr_o AS (SELECT t.id, COALESCE(a.f, 0) AS n_name_freq, COALESCE(b.f, 0) AS c_mktsegment_freq FROM tr t LEFT JOIN f1 a ON a.v = t.n_name LEFT JOIN f2 b ON b.v = t.c_mktsegment),
ts_o AS (SELECT t.id, COALESCE(a.f, 0) AS n_name_freq, COALESCE(b.f, 0) AS c_mktsegment_freq FROM ts t LEFT JOIN f1 a ON a.v = t.n_name LEFT JOIN f2 b ON b.v = t.c_mktsegment)
""" + both("ROUND(n_name_freq, 6) AS n_name_freq, ROUND(c_mktsegment_freq, 6) AS c_mktsegment_freq")


def e4():
    return tt() + f""",
f1 AS {_relfreq('n_name')},
tr_o AS (SELECT t.id, a.f AS n_name_RAR FROM tr t LEFT JOIN f1 a ON a.v = t.n_name),
ts_o AS (SELECT t.id, a.f AS n_name_RAR FROM ts t LEFT JOIN f1 a ON a.v = t.n_name)
""" + both("ROUND(n_name_RAR, 6) AS n_name_RAR")


def _idx(c, src="fit"):
    return f"(SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL))"


def e5():
    return tt() + f""",
d1 AS {_idx('n_name')}, d2 AS {_idx('o_year')},
tr_o AS (SELECT t.id, COALESCE(a.idx, (SELECT COUNT(*) FROM d1)) AS n_name_LE, COALESCE(b.idx, (SELECT COUNT(*) FROM d2)) AS o_year_LE FROM tr t LEFT JOIN d1 a ON a.value = t.n_name LEFT JOIN d2 b ON b.value = t.o_year),
ts_o AS (SELECT t.id, COALESCE(a.idx, (SELECT COUNT(*) FROM d1)) AS n_name_LE, COALESCE(b.idx, (SELECT COUNT(*) FROM d2)) AS o_year_LE FROM ts t LEFT JOIN d1 a ON a.value = t.n_name LEFT JOIN d2 b ON b.value = t.o_year)
""" + both("n_name_LE, o_year_LE")


def e6():
    return tt() + f""",
d1 AS {_idx('n_name')}, d2 AS {_idx('c_mktsegment')},
tr_o AS (SELECT t.id, COALESCE(a.idx, -1) AS n_name_OE, COALESCE(b.idx, -1) AS c_mktsegment_OE FROM tr t LEFT JOIN d1 a ON a.value = t.n_name LEFT JOIN d2 b ON b.value = t.c_mktsegment),
ts_o AS (SELECT t.id, COALESCE(a.idx, -1) AS n_name_OE, COALESCE(b.idx, -1) AS c_mktsegment_OE FROM ts t LEFT JOIN d1 a ON a.value = t.n_name LEFT JOIN d2 b ON b.value = t.c_mktsegment)
""" + both("n_name_OE, c_mktsegment_OE")


def _oh(c, lv_cte, n, fmt="{c}_oh_{i}"):
    return ", ".join(f"CASE WHEN CAST({c} AS VARCHAR) = (SELECT value FROM {lv_cte} WHERE idx = {i}) THEN 1 ELSE 0 END AS {fmt.format(c=c, i=i)}"
                     for i in range(n))


def e7():
    return tt() + f""",
fit7 AS (SELECT * FROM tr WHERE r_name <> 'ASIA'),
l1 AS {_idx('r_name', 'fit7')}, l2 AS {_idx('c_mktsegment', 'fit7')},
tr_o AS (SELECT id, {_oh('r_name', 'l1', 4)}, {_oh('c_mktsegment', 'l2', 5)} FROM tr),
ts_o AS (SELECT id, {_oh('r_name', 'l1', 4)}, {_oh('c_mktsegment', 'l2', 5)} FROM ts)
""" + both(", ".join([f"r_name_oh_{i}" for i in range(4)] + [f"c_mktsegment_oh_{i}" for i in range(5)]))


def e8():
    return tt() + f""",
u AS (SELECT r_name FROM tr UNION ALL SELECT r_name FROM ts),
l1 AS {_idx('r_name', 'u')},
tr_o AS (SELECT id, {_oh('r_name', 'l1', 5)} FROM tr),
ts_o AS (SELECT id, {_oh('r_name', 'l1', 5)} FROM ts)
""" + both(", ".join(f"r_name_oh_{i}" for i in range(5)))


def e9():
    return tt() + f""",
u AS (SELECT c_mktsegment FROM tr UNION ALL SELECT c_mktsegment FROM ts),
l1 AS {_idx('c_mktsegment', 'u')},
tr_o AS (SELECT id, {_oh('c_mktsegment', 'l1', 5)}, CAST(c_mktsegment IS NULL AS INTEGER) AS c_mktsegment_nan FROM tr),
ts_o AS (SELECT id, {_oh('c_mktsegment', 'l1', 5)}, CAST(c_mktsegment IS NULL AS INTEGER) AS c_mktsegment_nan FROM ts)
""" + both(", ".join([f"c_mktsegment_oh_{i}" for i in range(5)] + ["c_mktsegment_nan"]))


def e10():
    code = "CAST(COALESCE(li_lines, 0) AS INTEGER)"
    return tt() + f""",
tr2 AS (SELECT *, {code} AS n_lines FROM tr), ts2 AS (SELECT *, {code} AS n_lines FROM ts),
l1 AS (SELECT CAST(v AS VARCHAR) AS value, row_number() OVER (ORDER BY v) - 1 AS idx FROM (SELECT DISTINCT n_lines AS v FROM tr2)),
tr_o AS (SELECT t.id, l1.idx AS n_lines_hot, (SELECT COUNT(*) FROM l1) AS n_lines_size FROM tr2 t LEFT JOIN l1 ON l1.value = CAST(t.n_lines AS VARCHAR)),
ts_o AS (SELECT t.id, l1.idx AS n_lines_hot, (SELECT COUNT(*) FROM l1) AS n_lines_size FROM ts2 t LEFT JOIN l1 ON l1.value = CAST(t.n_lines AS VARCHAR))
""" + both("n_lines_hot, n_lines_size")


def _x(a, b, sep):
    return f"COALESCE(CAST({a} AS VARCHAR), 'nan') || '{sep}' || COALESCE(CAST({b} AS VARCHAR), 'nan')"


E11_TOP = ["n_name", "o_year", "c_mktsegment", "r_name"]  # cardinalities 25, 7, 5, 5 (ties keep list order)


def e11():
    pairs = [(E11_TOP[i], E11_TOP[j]) for i in range(4) for j in range(i + 1, 4)]
    sel = ", ".join(f"{_x(a, b, '___')} AS {a}__{b}" for a, b in pairs)
    return tt() + f""",
tr_o AS (SELECT id, {sel} FROM tr), ts_o AS (SELECT id, {sel} FROM ts)
""" + both(", ".join(f"{a}__{b}" for a, b in pairs))


def e12():
    cols = ["c_mktsegment", "r_name", "o_year"]
    pairs = [(cols[i], cols[j]) for i in range(3) for j in range(i + 1, 3)]
    return base() + " SELECT id, " + ", ".join(f"{_x(a, b, '_')} AS {a}_{b}" for a, b in pairs) + " FROM base"


def e13():
    x1, x2 = _x("c_mktsegment", "r_name", "_"), _x("o_year", "n_name", "_")
    return tt() + f""",
f2 AS (SELECT id, {x1} AS a, {x2} AS b FROM fit),
r2 AS (SELECT id, {x1} AS a, {x2} AS b FROM tr),
t2 AS (SELECT id, {x1} AS a, {x2} AS b FROM ts),
d1 AS {_idx('a', 'f2')}, d2 AS {_idx('b', 'f2')},
tr_o AS (SELECT t.id, COALESCE(d1.idx, -1) AS c_mktsegment_r_name_OE, COALESCE(d2.idx, -1) AS o_year_n_name_OE FROM r2 t LEFT JOIN d1 ON d1.value = t.a LEFT JOIN d2 ON d2.value = t.b),
ts_o AS (SELECT t.id, COALESCE(d1.idx, -1) AS c_mktsegment_r_name_OE, COALESCE(d2.idx, -1) AS o_year_n_name_OE FROM t2 t LEFT JOIN d1 ON d1.value = t.a LEFT JOIN d2 ON d2.value = t.b)
""" + both("c_mktsegment_r_name_OE, o_year_n_name_OE")


def e15():
    return tt() + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS col, CASE WHEN COUNT(DISTINCT {c}) <= 6 THEN 'onehot' WHEN COUNT(DISTINCT {c}) <= 20 THEN 'target' ELSE 'frequency' END AS route FROM tr"
        for c in CATS)


def n1():
    return base() + """ SELECT id,
ROUND(LN(1 + CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END), 6) AS acctbal_log1p,
ROUND(o_totalprice / (li_qty + 1), 6) AS price_per_qty,
ROUND(li_qty * li_disc, 6) AS qty_disc,
ROUND(li_qty + li_lines + li_disc, 6) AS li_sum,
ROUND(1 / (1 + EXP(-(CASE WHEN c_acctbal / 1000 > 20 THEN 20 WHEN c_acctbal / 1000 < -20 THEN -20 ELSE c_acctbal / 1000 END))), 6) AS acctbal_sigmoid,
ROUND(1 / (1 + EXP(-(o_totalprice / 10000 - 20))), 6) AS price_sigmoid_raw
FROM base"""


def n5():
    fill = ["c_acctbal", "li_qty", "li_disc"]
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in fill)
    rep = ", ".join(f"COALESCE(t.{c}, m.{c}) AS {c}" for c in fill)
    stats = ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS s_{c}" for c in NUM)
    sc = ", ".join(f"(t.{c} - p.m_{c}) / p.s_{c} AS {c}" for c in NUM)
    return tt() + f""",
med AS (SELECT {meds} FROM tr),
tr2 AS (SELECT t.* REPLACE ({rep}) FROM tr t CROSS JOIN med m),
ts2 AS (SELECT t.* REPLACE ({rep}) FROM ts t CROSS JOIN med m),
par AS (SELECT {stats} FROM tr2),
tr_o AS (SELECT t.id, {sc} FROM tr2 t CROSS JOIN par p),
ts_o AS (SELECT t.id, {sc} FROM ts2 t CROSS JOIN par p)
""" + both(", ".join(f"ROUND({c}, 6) AS {c}" for c in NUM))


def n6():
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in NUM)
    sc = ", ".join(f"(t.{c} - p.m_{c}) / CASE WHEN p.s_{c} = 0 THEN 1 ELSE p.s_{c} END AS {c}" for c in NUM)
    return tt() + f""",
par AS (SELECT {stats} FROM tr),
tr_o AS (SELECT t.id, {sc} FROM tr t CROSS JOIN par p),
ts_o AS (SELECT t.id, {sc} FROM ts t CROSS JOIN par p)
""" + both(", ".join(f"ROUND({c}, 6) AS {c}" for c in NUM))


def fold_scope():
    fill, std, rob = ["c_acctbal", "li_qty", "li_disc"], NUM[:2], NUM[2:]
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in fill)
    rep = ", ".join(f"COALESCE(t.{c}, m.{c}) AS {c}" for c in fill)
    stats = ", ".join([f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in std]
                      + [f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in rob])
    sc = ", ".join(f"(t.{c} - p.m_{c}) / CASE WHEN p.s_{c} = 0 THEN 1 ELSE p.s_{c} END AS {c}" for c in NUM)
    return tt() + f""",
ff AS (SELECT DISTINCT fold AS f FROM tr UNION ALL SELECT -1),
med AS (SELECT f, {meds} FROM tr JOIN ff ON f <> fold GROUP BY f),
tr2 AS (SELECT t.* REPLACE ({rep}) FROM tr t JOIN med m ON m.f = t.fold),
ts2 AS (SELECT t.* REPLACE ({rep}) FROM ts t JOIN med m ON m.f = -1),
par AS (SELECT f, {stats} FROM tr2 JOIN ff ON f <> fold GROUP BY f),
tr_o AS (SELECT t.id, {sc} FROM tr2 t JOIN par p ON p.f = t.fold),
ts_o AS (SELECT t.id, {sc} FROM ts2 t JOIN par p ON p.f = -1)
""" + both(", ".join(f"ROUND({c}, 6) AS {c}" for c in NUM))


def n7():
    cols = ["o_totalprice", "li_qty", "li_disc", "li_lines"]
    pairs = [(cols[i], cols[j]) for i in range(4) for j in range(i + 1, 4)]
    return base() + " SELECT id, " + ", ".join(f"ROUND({a} * {b}, 6) AS {a}_x_{b}" for a, b in pairs) + " FROM base"


def n12():
    p = [f"p{i}" for i in range(5)]
    mx10 = "GREATEST(" + ", ".join(f"{x} * 10" for x in p) + ")"
    boost = [1.5, 1.25, 1.0, 0.75, 0.5]
    bsum = " + ".join(f"{x} * {b}" for x, b in zip(p, boost))
    return _class_dist() + f""",
s AS (SELECT *, {mx10} AS mx, GREATEST({', '.join(p)}) AS pm FROM dist),
s2 AS (SELECT *, {' + '.join(f'EXP({x} * 10 - mx)' for x in p)} AS se, {bsum} AS bs FROM s),
s3 AS (SELECT *, """ + ", ".join(f"{x} * {b} / bs AS b{i}" for i, (x, b) in enumerate(zip(p, boost))) + """ FROM s2)
SELECT value, """ + ", ".join(f"ROUND(EXP(p{i} * 10 - mx) / se, 6) AS softmax_{i}" for i in range(5)) + """,
CAST(CASE """ + " ".join(f"WHEN p{i} = pm THEN {i}" for i in range(5)) + """ END AS INTEGER) AS argmax, """ + \
        ", ".join(f"ROUND(b{i}, 6) AS boost_{i}" for i in range(5)) + """,
CAST(CASE """ + " ".join(f"WHEN b{i} = GREATEST(b0, b1, b2, b3, b4) THEN {i}" for i in range(5)) + """ END AS INTEGER) AS boost_argmax
FROM s3"""


def n15():
    return base() + """ SELECT id, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y,
CASE WHEN y_bin >= 0.5 THEN 'finished' ELSE 'open' END AS label,
COALESCE(c_mktsegment, 'nan') || '___' || COALESCE(o_year, 'nan') AS seg_year FROM base"""


ORACLE = {
    "a1_value_counts": a1, "a2_relative_frequency": a2, "a3_counts_with_null": a3, "a4_target_mean_count": a4,
    "a5_class_distribution": a5, "a6_a7_prior_and_mean_of_means": a6, "a8_sorted_label_index": a8,
    "a9_distinct_counts": a9, "a10_null_counts": a10, "a11_shape": a11, "a11_head": a11h, "a12_class_balance": a12,
    "a16_column_means": a16, "i2_mode": i2, "i3_i4_constant_fill_and_flags": i3, "i5_scrub_non_finite": i5,
    "i6_null_as_text": i6, "e1_frequency_encoding": e1, "e2_frequency_self_with_null": e2,
    "e3_relative_frequency_unseen_zero": e3, "e4_rarity_unseen_null": e4, "e5_label_encode_unseen_k": e5,
    "e6_ordinal_unseen_minus1": e6, "e7_one_hot_unseen_zero": e7, "e8_one_hot_fit_on_union": e8,
    "e9_dummies_with_nan_column": e9, "e10_one_hot_numeric_codes": e10, "e11_top4_cardinality_crosses": e11,
    "e12_all_pair_crosses": e12, "e13_fixed_crosses_ordinal": e13, "e15_cardinality_router": e15,
    "n1_n4_n11_column_transforms": n1, "n5_standard_scaling": n5, "n6_robust_scaling": n6, "n7_pairwise_products": n7, "i1_n5_n6_fold_scope": fold_scope,
    "n12_n14_row_softmax_argmax_boost": n12, "n15_n16_label_map_and_text": n15,
}


def w6():
    return base() + """ SELECT id, CAST((row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INTEGER) AS fold FROM base"""


def w8():
    return base() + """,
r1 AS (SELECT *, row_number() OVER (PARTITION BY y_bin ORDER BY md5('7:' || CAST(id AS VARCHAR)), id) - 1 AS rk,
         round(count(*) OVER (PARTITION BY y_bin) * CAST(0.2 AS DOUBLE)) AS nt FROM base),
s AS (SELECT id, y_bin FROM r1 WHERE rk < nt),
r2 AS (SELECT *, row_number() OVER (PARTITION BY y_bin ORDER BY md5('7s:' || CAST(id AS VARCHAR)), id) - 1 AS rk,
         round(count(*) OVER (PARTITION BY y_bin) * CAST(0.2 AS DOUBLE)) AS nt FROM s)
SELECT id, CASE WHEN rk < nt THEN 'test' ELSE 'train' END AS split FROM r2"""


def w10():
    return tt() + " SELECT id, y_bin, fold FROM tr UNION ALL SELECT id, CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER) FROM ts"


def j6():
    return tt() + " " + " UNION ALL ".join(f"""SELECT '{c}' AS col, {c} AS value, COUNT(*) AS n_rows FROM ts
WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM fit WHERE {c} IS NOT NULL) GROUP BY {c}""" for c in ["n_name", "c_mktsegment"])


ORACLE.update({"w6_plain_kfold": w6, "w8_stratified_sample_split": w8, "w10_union_train_test": w10,
               "j6_unseen_values_report": j6})


# AS 241 (PPND16) coefficients, lowest degree first (same table as the library's).
_A = [3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3, 1.3731693765509461125e+4,
      4.5921953931549871457e+4, 6.7265770927008700853e+4, 3.3430575583588128105e+4, 2.5090809287301226727e+3]
_B = [1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
      2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4, 5.2264952788528545610e+3]
_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
      1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
      2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]


def _h(coefs, r):
    out = f"{coefs[-1]!r}"
    for c in reversed(coefs[:-1]):
        out = f"({out} * {r} + {c!r})"
    return out


def _ppf(p: str) -> str:
    q = f"({p} - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    r0 = f"SQRT(-LN(CASE WHEN {q} < 0 THEN {p} ELSE 1 - {p} END))"
    near = f"({_h(_C, f'({r0} - 1.6)')} / {_h(_D, f'({r0} - 1.6)')})"
    far = f"({_h(_E, f'({r0} - 5.0)')} / {_h(_F, f'({r0} - 5.0)')})"
    tail = f"(CASE WHEN {r0} <= 5.0 THEN {near} ELSE {far} END)"
    return (f"(CASE WHEN ABS({q}) <= 0.425 THEN {q} * {_h(_A, rc)} / {_h(_B, rc)} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")


def n8():
    import numpy as np
    from statistics import NormalDist
    clip = -NormalDist().inv_cdf(1e-7 - 2.220446049250313e-16)
    parts, sels = [], []
    for c in ["o_totalprice", "li_qty"]:
        parts.append(f"""
{c}_n AS (SELECT COUNT({c}) AS n FROM tr)""")
    pre = tt() + "," + ",".join(parts)
    # the number of quantiles depends on n (min(1000, n)): at these scales n >= 1000 for both columns
    refs = np.linspace(0.0, 1.0, 1000).tolist()
    rl = "[" + ", ".join(repr(r) for r in refs) + "]"
    body = []
    for c in ["o_totalprice", "li_qty"]:
        lvl = f"""CASE WHEN x - 1e-7 < umin THEN 0.0 WHEN x + 1e-7 > umax THEN 1.0
  WHEN x = u THEN (rlo + rhi) / 2 ELSE rhi + (x - u) / (u2 - u) * (rlo2 - rhi) END"""
        body.append(f"""
{c}_q AS (SELECT UNNEST(quantile_cont({c}, {rl})) AS v, UNNEST({rl}) AS r FROM tr),
{c}_d AS (SELECT v AS u, MIN(r) AS rlo, MAX(r) AS rhi FROM {c}_q GROUP BY v),
{c}_l AS (SELECT u, rlo, rhi, LEAD(u) OVER (ORDER BY u) AS u2, LEAD(rlo) OVER (ORDER BY u) AS rlo2,
          MIN(u) OVER () AS umin, MAX(u) OVER () AS umax FROM {c}_d),
{c}_rows AS (SELECT id, 'train' AS part, {c} AS x FROM tr UNION ALL SELECT id, 'test', {c} FROM ts),
{c}_j AS (SELECT r.id, r.part, r.x, l.* FROM {c}_rows r ASOF LEFT JOIN {c}_l l ON r.x >= l.u),
{c}_mm AS (SELECT MIN(u) AS umin0, MAX(u) AS umax0 FROM {c}_d),
{c}_lv AS (SELECT j.id, j.part, j.x, CASE WHEN j.x - 1e-7 < m.umin0 THEN 0.0 WHEN j.x + 1e-7 > m.umax0 THEN 1.0
  WHEN j.x = j.u THEN (j.rlo + j.rhi) / 2 ELSE j.rhi + (j.x - j.u) / (j.u2 - j.u) * (j.rlo2 - j.rhi) END AS lv
  FROM {c}_j j CROSS JOIN {c}_mm m),
{c}_z AS (SELECT id, part, CASE WHEN x IS NULL THEN NULL WHEN lv <= 0 THEN -{clip!r} WHEN lv >= 1 THEN {clip!r}
  ELSE GREATEST(LEAST({_ppf('lv')}, {clip!r}), -{clip!r}) END AS {c} FROM {c}_lv)""")
    return pre + "," + ",".join(body) + """
SELECT a.id, a.part, ROUND(a.o_totalprice, 6) AS o_totalprice, ROUND(b.li_qty, 6) AS li_qty
FROM o_totalprice_z a JOIN li_qty_z b ON a.id = b.id AND a.part = b.part"""


def _yj(x, lam):
    return (f"(CASE WHEN {x} >= 0 THEN (CASE WHEN ABS({lam}) < 1e-12 THEN LN(1 + {x}) ELSE (POW({x} + 1, {lam}) - 1) / {lam} END) "
            f"ELSE (CASE WHEN ABS({lam} - 2) < 1e-12 THEN -LN(1 - {x}) ELSE -(POW(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END) END)")


def n9():
    coarse = ", ".join(f"({i}, {round(-3.0 + 0.1 * i, 10)!r})" for i in range(61))
    body = []
    for c in ["c_acctbal", "li_disc"]:
        body.append(f"""
{c}_g1 AS (SELECT g.i, g.lam, COUNT(t.{c}) AS n, VAR_POP({_yj('t.' + c, 'g.lam')}) AS v,
   SUM(SIGN(t.{c}) * LN(1 + ABS(t.{c}))) AS sl FROM (VALUES {coarse}) g(i, lam) CROSS JOIN tr t WHERE t.{c} IS NOT NULL GROUP BY g.i, g.lam),
{c}_b1 AS (SELECT lam FROM {c}_g1 WHERE v > 0 ORDER BY -n / 2.0 * LN(v) + (lam - 1) * sl DESC, i LIMIT 1),
{c}_f AS (SELECT i, ROUND(b.lam - 0.1 + 0.005 * i, 10) AS lam FROM {c}_b1 b, range(0, 41) r(i)),
{c}_g2 AS (SELECT g.i, g.lam, COUNT(t.{c}) AS n, VAR_POP({_yj('t.' + c, 'g.lam')}) AS v,
   SUM(SIGN(t.{c}) * LN(1 + ABS(t.{c}))) AS sl FROM {c}_f g CROSS JOIN tr t WHERE t.{c} IS NOT NULL GROUP BY g.i, g.lam),
{c}_b2 AS (SELECT lam FROM {c}_g2 WHERE v > 0 ORDER BY -n / 2.0 * LN(v) + (lam - 1) * sl DESC, i LIMIT 1),
{c}_ms AS (SELECT AVG({_yj('t.' + c, 'b.lam')}) AS m, STDDEV_POP({_yj('t.' + c, 'b.lam')}) AS s FROM tr t CROSS JOIN {c}_b2 b),
{c}_o AS (SELECT r.id, r.part, ({_yj('r.x', 'b.lam')} - ms.m) / CASE WHEN ms.s = 0 THEN 1 ELSE ms.s END AS {c}
  FROM (SELECT id, 'train' AS part, {c} AS x FROM tr UNION ALL SELECT id, 'test', {c} FROM ts) r CROSS JOIN {c}_b2 b CROSS JOIN {c}_ms ms)""")
    return tt() + "," + ",".join(body) + """
SELECT a.id, a.part, ROUND(a.c_acctbal, 6) AS c_acctbal, ROUND(b.li_disc, 6) AS li_disc
FROM c_acctbal_o a JOIN li_disc_o b ON a.id = b.id AND a.part = b.part"""


ORACLE.update({"n8_quantile_normal_transform": n8, "n9_yeo_johnson_transform": n9})
