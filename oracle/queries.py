"""The oracle SQL per registered query name."""

from __future__ import annotations

from oracle import sql as S

R6 = lambda e, a: f"ROUND({e}, 6) AS {a}"


def _status_prefix() -> str:
    """base -> split -> median fill -> T2 on o_orderpriority, c_mktsegment (train / test features)."""
    return "WITH " + ",".join([
        S.base_orders(),
        S.split("base", "y_bin", "sp"),
        "\ntr0 AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'),\nts0 AS (SELECT * EXCLUDE (split, fold) FROM sp WHERE split = 'test')",
        S.median_fill("tr0", "tr0", ["c_acctbal", "li_qty"], "tr1"),
        S.median_fill("ts0", "tr0", ["c_acctbal", "li_qty"], "ts1"),
        S.te_mestimate("tr1", "ts1", "o_orderpriority", "y_bin", 1, "tep"),
        S.te_mestimate("tr1", "ts1", "c_mktsegment", "y_bin", 1, "tem"),
        """
tr AS (SELECT t.*, a.enc AS o_orderpriority_te, b.enc AS c_mktsegment_te
       FROM tr1 t JOIN tep_tr a ON a.id = t.id JOIN tem_tr b ON b.id = t.id),
ts AS (SELECT t.*, a.enc AS o_orderpriority_te, b.enc AS c_mktsegment_te
       FROM ts1 t JOIN tep_ts a ON a.id = t.id JOIN tem_ts b ON b.id = t.id)""",
    ])


NB_FEATS = ["o_orderpriority_te", "c_mktsegment_te", "o_totalprice", "c_acctbal", "li_qty"]


def flagship() -> str:
    return _status_prefix() + "," + S.naive_bayes("tr", "ts", NB_FEATS, "y_bin", "nb") + """
SELECT part, CAST(COUNT(*) AS BIGINT) AS n, AVG(CAST(pred = y_bin AS DOUBLE)) AS accuracy FROM (
  SELECT 'oof' AS part, CAST(o.p >= 0.5 AS DOUBLE) AS pred, t.y_bin FROM nb_oof o JOIN tr t ON t.id = o.id WHERE o.class = 1
  UNION ALL
  SELECT 'test', CAST(o.p >= 0.5 AS DOUBLE), t.y_bin FROM nb_test o JOIN ts t ON t.id = o.id WHERE o.class = 1) x
GROUP BY part"""


def split_b() -> str:
    return "WITH " + ",".join([S.base_orders(), S.split("base", "y_bin", "sp")]) + """
SELECT id, split, fold FROM sp"""


def te_mestimate_b() -> str:
    return _status_prefix() + """
SELECT id, 'train' AS part, ROUND(o_orderpriority_te, 6) AS o_orderpriority_te, ROUND(c_mktsegment_te, 6) AS c_mktsegment_te FROM tr
UNION ALL
SELECT id, 'test', ROUND(o_orderpriority_te, 6), ROUND(c_mktsegment_te, 6) FROM ts"""


def nb_oof_b() -> str:
    return _status_prefix() + "," + S.naive_bayes("tr", "ts", NB_FEATS, "y_bin", "nb") + """
SELECT id, fold, class, ROUND(p, 6) AS p FROM nb_oof
UNION ALL
SELECT id, -1, class, ROUND(p, 6) FROM nb_test"""


def median_b() -> str:
    return "WITH " + ",".join([S.base_orders(), S.split("base", "y_bin", "sp")]) + """
SELECT c AS col, ROUND(v, 6) AS median FROM (
  SELECT 'c_acctbal' AS c, quantile_cont(c_acctbal, 0.5) AS v FROM sp WHERE split = 'train'
  UNION ALL SELECT 'li_qty', quantile_cont(li_qty, 0.5) FROM sp WHERE split = 'train'
  UNION ALL SELECT 'li_disc', quantile_cont(li_disc, 0.5) FROM sp WHERE split = 'train') x"""
