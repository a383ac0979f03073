"""Oracle SQL for kNN: brute force over all (query, reference) pairs of other folds."""

from __future__ import annotations

from oracle import sql as S


def _prefix() -> str:
    return "WITH " + """
v AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),""" + \
        S.split("v", "label", "sp") + """,
tr AS (SELECT * FROM sp WHERE split = 'train'),
ts AS (SELECT * FROM sp WHERE split = 'test'),
q AS (SELECT 'train' AS part, id AS qid, fold AS ef, x FROM tr
      UNION ALL SELECT 'test', id, f.fold, t.x FROM ts t CROSS JOIN (SELECT DISTINCT fold FROM tr) f),
pr AS (SELECT q.part, q.qid, q.ef, r.id AS tid, r.label,
         sqrt(list_sum(list_transform(list_zip(q.x, r.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
       FROM q JOIN tr r ON r.fold <> q.ef)"""


def knn(k: int, weights: str) -> str:
    if weights == "uniform":
        w = "1.0"
    else:
        w = "CASE WHEN MAX(CAST(d = 0 AS INTEGER)) OVER (PARTITION BY part, qid, ef) = 1 THEN CAST(d = 0 AS DOUBLE) ELSE 1 / d END"
    cls = " UNION ALL ".join(f"SELECT {c} AS c" for c in range(10))
    return _prefix() + f""",
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part, qid, ef ORDER BY FLOOR(d * 1e9 + 0.5) / 1e9, tid) AS rn FROM pr) WHERE rn <= {k}),
nw AS (SELECT *, {w} AS w FROM nb),
cl AS ({cls}),
vote AS (SELECT g.part, g.qid, g.ef, cl.c AS class,
   SUM(CASE WHEN g.label = cl.c THEN g.w ELSE 0 END) / SUM(g.w) AS p
   FROM nw g CROSS JOIN cl GROUP BY g.part, g.qid, g.ef, cl.c)
SELECT qid AS id, ef AS fold, CAST(class AS INTEGER) AS class, ROUND(p, 6) AS p FROM vote WHERE part = 'train'
UNION ALL
SELECT qid, -1, CAST(class AS INTEGER), ROUND(AVG(p), 6) FROM vote WHERE part = 'test' GROUP BY qid, class"""


ORACLE = {
    "m11_knn_oof": lambda: knn(21, "uniform"),
    "m11_knn_distance_weighted_oof": lambda: knn(15, "distance"),
}
