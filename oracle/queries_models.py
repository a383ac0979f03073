"""Oracle SQL for the ridge queries: Gram sums, Gauss-Jordan elimination by recursion, closed-form leave-one-out errors."""

from __future__ import annotations

from oracle.queries_ensemble import BIN_MODELS, NUM, TE3, bin_zoo


def scaled_inputs() -> str:
    """CTEs mtr(id, fold, y, z) and mts(id, z): z = [1, features ..., target], numerics standardised by the train rows."""
    stats = ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS s_{c}" for c in NUM)
    x = ", ".join([f"(t.{c} - p.m_{c}) / p.s_{c}" for c in NUM] + [f"t.{c}" for c in TE3])
    return bin_zoo() + f""",
par AS (SELECT {stats} FROM tr2),
mtr AS (SELECT t.id, t.fold, CAST(t.y_bin AS INTEGER) AS y, [CAST(1 AS DOUBLE), {x}, 2 * t.y_bin - 1] AS z FROM tr2 t CROSS JOIN par p),
mts AS (SELECT t.id, [CAST(1 AS DOUBLE), {x}, 0] AS z FROM ts2 t CROSS JOIN par p)"""


def ridge(d: int, alphas: list[float]) -> str:
    """CTEs sol(f, a, beta, mean, t0, n), inv(f, a, i, j, v): fits without fold f (f = -1: of all rows) for each alpha, features 1..d."""
    av = ", ".join(f"({i}, CAST({a!r} AS DOUBLE))" for i, a in enumerate(alphas))
    return f""",
gram AS (SELECT fold, i, j, SUM(z[i] * z[j]) AS v FROM mtr, range(1, {d + 3}) r(i), range(1, {d + 3}) s(j) GROUP BY fold, i, j),
ff AS (SELECT DISTINCT fold AS f FROM mtr UNION ALL SELECT -1),
fg AS (SELECT f, i, j, SUM(v) AS v FROM gram JOIN ff ON f <> fold GROUP BY f, i, j),
al(k, a) AS (VALUES {av}),
cen AS (SELECT g.f, g.i - 1 AS i, g.j - 1 AS j, g.v - a.v * b.v / n.v AS v FROM fg g JOIN fg a ON a.f = g.f AND a.i = 1 AND a.j = g.i
  JOIN fg b ON b.f = g.f AND b.i = 1 AND b.j = g.j JOIN fg n ON n.f = g.f AND n.i = 1 AND n.j = 1 WHERE g.i BETWEEN 2 AND {d + 1} AND g.j >= 2),
aug AS (SELECT f, k, i, j, v + CASE WHEN i = j THEN a ELSE 0 END AS v FROM cen CROSS JOIN al
  UNION ALL SELECT f, k, i, {d + 1} + j, CASE WHEN i = j THEN 1.0 ELSE 0.0 END FROM ff, al, range(1, {d + 1}) r(i), range(1, {d + 1}) s(j)),
el(p, f, k, i, j, v) AS (SELECT 1::BIGINT, f, k, i::BIGINT, j::BIGINT, v::DOUBLE FROM aug
  UNION ALL SELECT m.p + 1, m.f, m.k, m.i, m.j, CASE WHEN m.i = m.p THEN m.v / q.v ELSE m.v - r.v * c.v / q.v END
  FROM el m JOIN el q ON q.f = m.f AND q.k = m.k AND q.i = m.p AND q.j = m.p JOIN el r ON r.f = m.f AND r.k = m.k AND r.i = m.i AND r.j = m.p
  JOIN el c ON c.f = m.f AND c.k = m.k AND c.i = m.p AND c.j = m.j WHERE m.p <= {d}),
fin AS (SELECT f, k, i, j, v FROM el WHERE p = {d + 1}),
sol AS (SELECT f, k, list(v ORDER BY i) AS beta FROM fin WHERE j = {d + 1} GROUP BY f, k),
lev AS (SELECT f, MAX(v) FILTER (j = 1) AS n, list(v ORDER BY j) FILTER (j BETWEEN 2 AND {d + 1}) AS sx, MAX(v) FILTER (j = {d + 2}) AS st FROM fg WHERE i = 1 GROUP BY f),
inv AS (SELECT f, k, list(v ORDER BY i, j) AS v FROM fin WHERE j > {d + 1} GROUP BY f, k)"""


def margin(d: int) -> str:
    """Margin of row t under sol s, lev l."""
    return "(l.st / l.n + " + " + ".join(f"(t.z[{i + 1}] - l.sx[{i}] / l.n) * s.beta[{i}]" for i in range(1, d + 1)) + ")"


def loo(d: int, which: str) -> str:
    """CTE loo(f, k, mse): mean squared leave-one-out errors of the fits that ``which`` (a condition on f) names."""
    quad = " + ".join(f"(t.z[{i + 1}] - l.sx[{i}] / l.n) * (t.z[{j + 1}] - l.sx[{j}] / l.n) * v.v[{(i - 1) * d + j}]" for i in range(1, d + 1) for j in range(1, d + 1))
    return f""",
loo AS (SELECT s.f, s.k, AVG(POWER((t.z[{d + 2}] - {margin(d)}) / (1 - 1 / l.n - ({quad})), 2)) AS mse
  FROM sol s JOIN inv v ON v.f = s.f AND v.k = s.k JOIN lev l ON l.f = s.f JOIN mtr t ON t.fold <> s.f WHERE {which} GROUP BY s.f, s.k),
pick AS (SELECT f, arg_min(k, {{'m': mse, 'k': k}}) AS k FROM loo GROUP BY f)"""


def sigmoid(x: str) -> str:
    return f"(1 / (1 + EXP(-LEAST(GREATEST({x}, -20), 20))))"


def predictions(d: int, model: str, chosen: str) -> str:
    """(id, model, fold, class, p) of train rows by the fit without their fold, and of test rows by the mean over those fits (fold -1)."""
    p = sigmoid(margin(d))
    both = lambda src: f"SELECT id, '{model}' AS model, fold, 1 AS class, ROUND(p, 6) AS p FROM {src} UNION ALL SELECT id, '{model}', fold, 0, ROUND(1 - p, 6) FROM {src}"
    return f""",
po AS (SELECT t.id, t.fold, {p} AS p FROM mtr t JOIN sol s ON s.f = t.fold {chosen} JOIN lev l ON l.f = s.f),
pt AS (SELECT t.id, -1 AS fold, AVG({p}) AS p FROM mts t CROSS JOIN sol s JOIN lev l ON l.f = s.f {chosen.replace('AND s.k = 0', '')} WHERE s.f >= 0 GROUP BY t.id)
{both('po')} UNION ALL {both('pt')}"""


def m6() -> str:
    d = len(NUM + TE3)
    return scaled_inputs() + ridge(d, [1.0]) + predictions(d, "ridge", "AND s.k = 0")


def m7() -> str:
    d, alphas = len(NUM + TE3), [0.1, 1.0, 10.0, 100.0]
    return scaled_inputs() + ridge(d, alphas) + f""",
acc AS (SELECT s.k, AVG(CASE WHEN (CASE WHEN {margin(d)} >= 0 THEN 1 ELSE 0 END) = t.y THEN 1.0 ELSE 0.0 END) AS acc
  FROM mtr t JOIN sol s ON s.f = t.fold JOIN lev l ON l.f = s.f GROUP BY s.k)
SELECT a AS alpha, acc AS oof_accuracy, acc.k = (SELECT arg_min(k, {{'a': -acc, 'k': k}}) FROM acc) AS chosen FROM acc JOIN al ON al.k = acc.k"""


def m7_loo() -> str:
    d, alphas = len(NUM + TE3), [0.1, 1.0, 10.0, 100.0, 1000.0]
    return scaled_inputs() + ridge(d, alphas) + loo(d, "true") + """
SELECT loo.f AS fold, a AS alpha, ROUND(mse, 6) AS loo_mse, loo.k = pick.k AS chosen FROM loo JOIN al ON al.k = loo.k JOIN pick ON pick.f = loo.f"""


def k5_ridge() -> str:
    models = list(BIN_MODELS)
    x = ", ".join(f"MAX(p) FILTER (model = '{m}')" for m in models)
    d = len(models)
    return bin_zoo() + f""",
mtr AS (SELECT o.id, o.fold, CAST(ANY_VALUE(t.y_bin) AS INTEGER) AS y, [CAST(1 AS DOUBLE), {x}, 2 * ANY_VALUE(t.y_bin) - 1] AS z FROM oof o JOIN tr2 t ON t.id = o.id WHERE class = 1 GROUP BY o.id, o.fold),
mts AS (SELECT id, [CAST(1 AS DOUBLE), {x}, 0] AS z FROM tst WHERE class = 1 GROUP BY id)""" \
        + ridge(d, [0.1, 1.0, 3.0, 5.0]) + loo(d, "s.f >= 0") + predictions(d, "meta_ridge", "JOIN pick c ON c.f = s.f AND c.k = s.k")


def m9_sigmoid() -> str:
    """Newton steps on (a, b) by recursion over the other folds' rows."""
    return bin_zoo() + """,
pr AS (SELECT o.id, o.fold, LN(LEAST(GREATEST(p, 1e-6), 1 - 1e-6) / (1 - LEAST(GREATEST(p, 1e-6), 1 - 1e-6))) AS m, CAST(t.y_bin AS INTEGER) AS y FROM oof o JOIN tr2 t ON t.id = o.id WHERE class = 1 AND model = 'nb_num'),
ff AS (SELECT DISTINCT fold AS f FROM pr),
cn AS (SELECT f, SUM(1 - y)::DOUBLE AS n0, SUM(y)::DOUBLE AS n1 FROM pr JOIN ff ON f <> fold GROUP BY f),
ot AS (SELECT ff.f, m, CASE WHEN y = 1 THEN (n1 + 1) / (n1 + 2) ELSE 1 / (n0 + 2) END AS t FROM pr JOIN ff ON f <> fold JOIN cn ON cn.f = ff.f),
it(step, f, a, b) AS (SELECT 0, f, CAST(0 AS DOUBLE), LN((n1 + 1) / (n0 + 1)) FROM cn
  UNION ALL SELECT step + 1, f, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM (
    SELECT step, it.f AS f, a, b, SUM((p - t) * m) AS ga, SUM(p - t) AS gb, SUM(p * (1 - p) * m * m) AS haa, SUM(p * (1 - p) * m) AS hab, SUM(p * (1 - p)) AS hbb
    FROM (SELECT step, it.f AS f, a, b, m, t, 1 / (1 + EXP(-(a * m + b))) AS p FROM it JOIN ot ON ot.f = it.f WHERE step < 30) it GROUP BY step, it.f, a, b) x),
ab AS (SELECT f, a, b FROM it WHERE step = 30)
SELECT id, fold, ROUND(1 / (1 + EXP(-(a * m + b))), 6) AS p FROM pr JOIN ab ON f = fold"""


def n10() -> str:
    u = lambda c, k: f"CAST(('0x' || substr(md5('0:' || t.id || ':{c}:{k}'), 1, 13))::BIGINT AS DOUBLE)"
    cols = ", ".join(f"ROUND({c} + 0.003 * SQRT(-2 * LN(({u(c, 1)} + 1) / 4503599627370497)) * COS(2 * 3.141592653589793 * {u(c, 2)} / 4503599627370496), 6) AS {c}" for c in NUM)
    return bin_zoo() + f" SELECT t.id, {cols} FROM tr2 t"


def recursive(sql):
    return lambda: "WITH RECURSIVE" + sql().removeprefix("WITH")


ORACLE = {"n10_gaussian_jitter": n10, "m9_sigmoid_calibration": m9_sigmoid, "m6_ridge_classifier_oof": m6, "m7_ridge_alpha_selection": m7, "m7_ridge_loo_alphas": m7_loo, "k5_ridge_meta_oof": k5_ridge}
ORACLE = {k: recursive(f) for k, f in ORACLE.items()}
