"""Oracle SQL for the target encoders: per (value, fold) the statistics of all rows of the OTHER folds."""

from __future__ import annotations

from oracle import sql as S
from oracle.queries_features import tt


def mc_tt() -> str:
    return tt("o_orderpriority") + """,
lab AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT o_orderpriority AS value FROM tr)),
trc AS (SELECT tr.*, lab.idx AS y FROM tr JOIN lab ON lab.value = tr.o_orderpriority),
tsc AS (SELECT ts.*, lab.idx AS y FROM ts LEFT JOIN lab ON lab.value = ts.o_orderpriority)"""


def te_generic(train: str, test: str, c: str, y: str, n: str, kind: str, m: float = 1.0,
               min_leaf: float = 100, smoothing: float = 10) -> str:
    """CTEs {n}_tr(id, enc), {n}_ts(id, enc)."""
    g = f"(SELECT AVG(CAST({y} AS DOUBLE)) FROM {train})"
    if kind == "sigmoid":
        w = f"(1 / (1 + EXP(-(n_oof - {min_leaf}) / {smoothing})))"
        enc = f"CASE WHEN n_oof > 0 THEN gf * (1 - {w}) + (s_oof / n_oof) * {w} END"
        fill = f"{g}"
    elif kind == "mestimate":
        enc = f"(COALESCE(s_oof, 0) + {g} * {m}) / (COALESCE(n_oof, 0) + {m})"
        fill = g
    elif kind == "mean":
        enc = "CASE WHEN n_oof > 0 THEN s_oof / n_oof END"
        fill = g
    else:  # mean_catmean
        enc = "CASE WHEN n_oof > 0 THEN s_oof / n_oof END"
        fill = None
    fill_sql = (f"SELECT f, {fill} AS fill FROM {n}_ff" if fill is not None else
                f"SELECT ff.f, COALESCE((SELECT AVG(e.enc) FROM {n}_enc e WHERE e.f = ff.f AND e.enc IS NOT NULL), {g}) AS fill FROM {n}_ff ff")
    return f"""
{n}_st AS (SELECT CAST({c} AS VARCHAR) AS v, fold, COUNT(*) AS n, SUM(CAST({y} AS DOUBLE)) AS s FROM {train} WHERE {c} IS NOT NULL GROUP BY 1, 2),
{n}_ff AS (SELECT d.fold AS f, (SELECT AVG(CAST({y} AS DOUBLE)) FROM {train} t2 WHERE t2.fold <> d.fold) AS gf FROM (SELECT DISTINCT fold FROM {train}) d),
{n}_grid AS (SELECT d.v, ff.f, ff.gf, SUM(st.n) AS n_oof, SUM(st.s) AS s_oof
  FROM (SELECT DISTINCT v FROM {n}_st) d CROSS JOIN {n}_ff ff LEFT JOIN {n}_st st ON st.v = d.v AND st.fold <> ff.f
  GROUP BY d.v, ff.f, ff.gf),
{n}_enc AS (SELECT v, f, {enc} AS enc FROM {n}_grid),
{n}_fill AS ({fill_sql}),
{n}_full AS (SELECT e.v, e.f, COALESCE(e.enc, fl.fill) AS enc FROM {n}_enc e JOIN {n}_fill fl ON fl.f = e.f),
{n}_tr AS (SELECT t.id, COALESCE(e.enc, fl.fill) AS enc FROM {train} t JOIN {n}_fill fl ON fl.f = t.fold
  LEFT JOIN {n}_full e ON e.v = CAST(t.{c} AS VARCHAR) AND e.f = t.fold),
{n}_ts AS (SELECT t.id, COALESCE(AVG(e.enc), (SELECT AVG(fill) FROM {n}_fill)) AS enc FROM {test} t
  LEFT JOIN {n}_full e ON e.v = CAST(t.{c} AS VARCHAR) GROUP BY t.id)"""


def _out(cols: list[tuple[str, str]]) -> str:
    """cols: (cte prefix, output name)."""
    tr_sel = ", ".join(f"ROUND({p}_tr.enc, 6) AS {o}" for p, o in cols)
    ts_sel = ", ".join(f"ROUND({p}_ts.enc, 6) AS {o}" for p, o in cols)
    p0 = cols[0][0]
    tr_j = " ".join(f"JOIN {p}_tr ON {p}_tr.id = {p0}_tr.id" for p, _ in cols[1:])
    ts_j = " ".join(f"JOIN {p}_ts ON {p}_ts.id = {p0}_ts.id" for p, _ in cols[1:])
    return f"""
SELECT {p0}_tr.id, 'train' AS part, {tr_sel} FROM {p0}_tr {tr_j}
UNION ALL
SELECT {p0}_ts.id, 'test' AS part, {ts_sel} FROM {p0}_ts {ts_j}"""


def t1():
    return tt() + "," + te_generic("tr", "ts", "n_name", "y_bin", "x1", "sigmoid", min_leaf=100, smoothing=20) + "," + \
        te_generic("tr", "ts", "o_year", "y_bin", "x2", "sigmoid", min_leaf=100, smoothing=20) + \
        _out([("x1", "n_name_te"), ("x2", "o_year_te")])


T7_TOP = ["n_name", "o_year", "c_mktsegment", "r_name"]


def t7():
    pairs = [(T7_TOP[i], T7_TOP[j]) for i in range(4) for j in range(i + 1, 4)]
    x = lambda a, b: f"COALESCE(CAST({a} AS VARCHAR), 'nan') || '___' || COALESCE(CAST({b} AS VARCHAR), 'nan') AS {a}__{b}"
    sel = ", ".join(x(a, b) for a, b in pairs)
    pre = tt() + f""",
trx AS (SELECT *, {sel} FROM tr), tsx AS (SELECT *, {sel} FROM ts)"""
    parts = [te_generic("trx", "tsx", f"{a}__{b}", "y_bin", f"x{i}", "sigmoid", min_leaf=200, smoothing=30)
             for i, (a, b) in enumerate(pairs)]
    return pre + "," + ",".join(parts) + _out([(f"x{i}", f"{a}__{b}_te") for i, (a, b) in enumerate(pairs)])


def t3():
    return mc_tt() + "," + te_generic("trc", "tsc", "n_name", "y", "x1", "mestimate", m=10) + "," + \
        te_generic("trc", "tsc", "c_mktsegment", "y", "x2", "mestimate", m=10) + \
        _out([("x1", "n_name_TE"), ("x2", "c_mktsegment_TE")])


def _segnat():
    sn = "CONCAT_WS('_', c_mktsegment, n_name)"
    return mc_tt() + f""",
trs AS (SELECT *, {sn} AS seg_nat FROM trc), tss AS (SELECT *, {sn} AS seg_nat FROM tsc)"""


def t4():
    return _segnat() + "," + te_generic("trs", "tss", "seg_nat", "y", "x1", "mean") + _out([("x1", "seg_nat_TE")])


def t5():
    return _segnat() + "," + te_generic("trs", "tss", "seg_nat", "y", "x1", "mean_catmean") + _out([("x1", "seg_nat_TE")])


def t6():
    K = 5
    parts = []
    for c in ["n_name", "o_year"]:
        n = f"m_{c}"
        cnt = ", ".join(f"SUM(CASE WHEN y = {i} THEN 1 ELSE 0 END) AS c{i}" for i in range(K))
        oof = ", ".join(f"SUM(st.c{i}) AS c{i}" for i in range(K))
        p = ", ".join(f"CASE WHEN n_oof > 0 THEN c{i} / n_oof ELSE CAST(1 AS DOUBLE) / {K} END AS p{i}" for i in range(K))
        parts.append(f"""
{n}_st AS (SELECT CAST({c} AS VARCHAR) AS v, fold, {cnt}, COUNT(*) AS n FROM trc WHERE {c} IS NOT NULL GROUP BY 1, 2),
{n}_ff AS (SELECT DISTINCT fold AS f FROM trc),
{n}_grid AS (SELECT d.v, ff.f, SUM(st.n) AS n_oof, {oof}
  FROM (SELECT DISTINCT v FROM {n}_st) d CROSS JOIN {n}_ff ff LEFT JOIN {n}_st st ON st.v = d.v AND st.fold <> ff.f GROUP BY d.v, ff.f),
{n}_p AS (SELECT v, f, {p} FROM {n}_grid),
{n}_tr AS (SELECT t.id, """ + ", ".join(f"COALESCE(e.p{i}, CAST(1 AS DOUBLE) / {K}) AS {c}_te_{i}" for i in range(K)) + f"""
  FROM trc t LEFT JOIN {n}_p e ON e.v = CAST(t.{c} AS VARCHAR) AND e.f = t.fold),
{n}_ts AS (SELECT t.id, """ + ", ".join(f"COALESCE(AVG(e.p{i}), CAST(1 AS DOUBLE) / {K}) AS {c}_te_{i}" for i in range(K)) + f"""
  FROM tsc t LEFT JOIN {n}_p e ON e.v = CAST(t.{c} AS VARCHAR) GROUP BY t.id)""")
    cols = [f"{c}_te_{i}" for c in ["n_name", "o_year"] for i in range(K)]
    sel = ", ".join(f"ROUND({x}, 6) AS {x}" for x in cols)
    return mc_tt() + "," + ",".join(parts) + f"""
SELECT a.id, 'train' AS part, {sel} FROM m_n_name_tr a JOIN m_o_year_tr b ON a.id = b.id
UNION ALL
SELECT a.id, 'test' AS part, {sel} FROM m_n_name_ts a JOIN m_o_year_ts b ON a.id = b.id"""


ORACLE = {
    "t1_sigmoid_te": t1, "t1_sigmoid_te_crosses": t7, "t3_mestimate_fold_mean_te": t3,
    "t4_mean_te_global_fill": t4, "t5_mean_te_catmean_fill": t5, "t6_multiclass_te": t6,
}
