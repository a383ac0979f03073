"""SQL building blocks for the DuckDB oracle.  Written from the operator definitions
(SURVEY section 2), independent of the Spark code path: plain windows, joins over all
fold pairs and textbook formulas."""

from __future__ import annotations

SEED = 42
K = 5


def base_orders() -> str:
    """CTEs li, base: table B / C (one row per order)."""
    return """
li AS (
  SELECT l_orderkey, SUM(l_quantity) AS li_qty, CAST(COUNT(*) AS DOUBLE) AS li_lines, AVG(l_discount) AS li_disc
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS id,
         CAST(o.o_orderstatus = 'F' AS DOUBLE) AS y_bin,
         o.o_orderpriority, o.o_orderstatus, o.o_totalprice,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal,
         li.li_qty, li.li_lines, li.li_disc,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
         n.n_name, r.r_name, CAST(year(o.o_orderdate) AS VARCHAR) AS o_year
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey)"""


def split(src: str, label: str, name: str = "split_tbl", frac: float = 0.2, k: int = K, seed: int = SEED) -> str:
    """CTEs: rank inside the class by md5('seed:id'), first round(frac*n_c) -> test, rest -> folds."""
    return f"""
{name}_rk AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || CAST(id AS VARCHAR)), id) - 1 AS rk_,
            round(count(*) OVER (PARTITION BY {label}) * CAST({frac} AS DOUBLE)) AS nt_
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE (rk_, nt_),
         CASE WHEN rk_ < nt_ THEN 'test' ELSE 'train' END AS split,
         CAST(CASE WHEN rk_ < nt_ THEN -1 ELSE (rk_ - nt_) % {k} END AS INTEGER) AS fold
  FROM {name}_rk)"""


def median_fill(src: str, train: str, cols: list[str], name: str) -> str:
    """CTE: src with cols filled by the interpolated median of the train rows."""
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_med" for c in cols)
    repl = ", ".join(f"COALESCE(s.{c}, m.{c}_med) AS {c}" for c in cols)
    return f"""
{name}_m AS (SELECT {meds} FROM {train}),
{name} AS (SELECT s.* REPLACE ({repl}) FROM {src} s CROSS JOIN {name}_m m)"""


def te_mestimate(train: str, test: str, c: str, y: str, m: float, name: str, test_mode: str = "full") -> str:
    """CTEs {name}_tr (id, enc) and {name}_ts (id, enc): m-estimate target encoding of column c.

    train rows: statistics of all rows in the other folds; test rows: all train rows ('full')
    or the mean over folds of the other-folds encodings ('fold_mean')."""
    g = f"(SELECT AVG({y}) FROM {train})"
    ts = (f"""
{name}_ts AS (
  SELECT t.id, COALESCE((SUM(st.s) + {g} * {m}) / (SUM(st.n) + {m}), {g}) AS enc
  FROM {test} t LEFT JOIN {name}_st st ON st.v = CAST(t.{c} AS VARCHAR)
  GROUP BY t.id)""" if test_mode == "full" else f"""
{name}_ff AS (SELECT DISTINCT fold AS f FROM {train}),
{name}_grid AS (
  SELECT d.v, ff.f, COALESCE((SUM(st.s) + {g} * {m}) / (SUM(st.n) + {m}), {g}) AS enc
  FROM (SELECT DISTINCT v FROM {name}_st) d CROSS JOIN {name}_ff ff
  LEFT JOIN {name}_st st ON st.v = d.v AND st.fold <> ff.f
  GROUP BY d.v, ff.f),
{name}_ts AS (
  SELECT t.id, COALESCE(AVG(gr.enc), {g}) AS enc
  FROM {test} t LEFT JOIN {name}_grid gr ON gr.v = CAST(t.{c} AS VARCHAR)
  GROUP BY t.id)""")
    return f"""
{name}_st AS (
  SELECT CAST({c} AS VARCHAR) AS v, fold, COUNT(*) AS n, SUM({y}) AS s
  FROM {train} WHERE {c} IS NOT NULL GROUP BY 1, 2),
{name}_tr AS (
  SELECT t.id, COALESCE((SUM(st.s) + {g} * {m}) / (SUM(st.n) + {m}), {g}) AS enc
  FROM {train} t LEFT JOIN {name}_st st ON st.v = CAST(t.{c} AS VARCHAR) AND st.fold <> t.fold
  GROUP BY t.id),{ts}"""


def naive_bayes(train: str, test: str, feats: list[str], y: str, name: str, var_smoothing: str = "1e-9") -> str:
    """CTEs {name}_oof (id, fold, class, p) and {name}_test (id, class, p): Gaussian naive Bayes,
    fitted per fold on the other folds' rows; test = mean over the fold models."""
    d = len(feats)
    stat_cols = ", ".join(f"AVG({f}) AS m{i}, VAR_POP({f}) AS v{i}" for i, f in enumerate(feats))
    eps = "GREATEST(" + ", ".join(f"VAR_POP({f})" for f in feats) + ")" if d > 1 else f"VAR_POP({feats[0]})"
    logdet = " + ".join(f"LN(2 * PI() * (s.v{i} + e.eps))" for i in range(d))
    par_cols = ", ".join(f"s.m{i}, s.v{i} + e.eps AS w{i}" for i in range(d))
    quad = " + ".join(f"(t.{f} - p.m{i}) * (t.{f} - p.m{i}) / p.w{i}" for i, f in enumerate(feats))
    return f"""
{name}_f AS (SELECT DISTINCT fold AS f FROM {train}),
{name}_s AS (
  SELECT ff.f, CAST(t.{y} AS BIGINT) AS cls, COUNT(*) AS n, {stat_cols}
  FROM {name}_f ff JOIN {train} t ON t.fold <> ff.f GROUP BY ff.f, t.{y}),
{name}_e AS (
  SELECT ff.f, {var_smoothing} * {eps} AS eps, COUNT(*) AS ntot
  FROM {name}_f ff JOIN {train} t ON t.fold <> ff.f GROUP BY ff.f),
{name}_p AS (
  SELECT s.f, s.cls, LN(CAST(s.n AS DOUBLE) / e.ntot) - 0.5 * ({logdet}) AS c0, {par_cols}
  FROM {name}_s s JOIN {name}_e e ON s.f = e.f),
{name}_jo AS (
  SELECT t.id, t.fold, p.cls, p.c0 - 0.5 * ({quad}) AS jll
  FROM {train} t JOIN {name}_p p ON p.f = t.fold),
{name}_jo2 AS (SELECT *, EXP(jll - MAX(jll) OVER (PARTITION BY id)) AS e FROM {name}_jo),
{name}_oof AS (SELECT id, fold, CAST(cls AS INTEGER) AS class, e / SUM(e) OVER (PARTITION BY id) AS p FROM {name}_jo2),
{name}_jt AS (
  SELECT t.id, p.f, p.cls, p.c0 - 0.5 * ({quad}) AS jll
  FROM {test} t CROSS JOIN {name}_p p),
{name}_jt2 AS (SELECT *, EXP(jll - MAX(jll) OVER (PARTITION BY id, f)) AS e FROM {name}_jt),
{name}_jt3 AS (SELECT id, f, cls, e / SUM(e) OVER (PARTITION BY id, f) AS p FROM {name}_jt2),
{name}_test AS (SELECT id, CAST(cls AS INTEGER) AS class, AVG(p) AS p FROM {name}_jt3 GROUP BY id, cls)"""
