"""Oracle SQL per query name (same keys as foldwise.plans.registry.QUERIES)."""

from oracle import queries as Q
from oracle import queries_features as QF
from oracle import queries_target as QT
from oracle import queries_ensemble as QE
from oracle import queries_knn as QK
from oracle import queries_models as QM


def round6_rewrite(sql: str) -> str:
    """Turn every ``ROUND(expr, 6)`` into ``(FLOOR((expr) * 1e6 + 0.5) / 1e6)`` (engine-independent rounding)."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j + 6:k]
        if inner.rstrip().endswith(", 6"):
            expr = round6_rewrite(inner.rstrip()[:-3])
            out.append(sql[i:j] + f"(FLOOR(({expr}) * 1e6 + 0.5) / 1e6)")
        else:
            out.append(sql[i:k + 1])
        i = k + 1


_RAW = {
    "flagship_retention_nb": Q.flagship,
    "w7_w5_holdout_folds": Q.split_b,
    "i1_median": Q.median_b,
    "t2_mestimate_te": Q.te_mestimate_b,
    "m10_naive_bayes_oof": Q.nb_oof_b,
}
_RAW.update(QF.ORACLE)
_RAW.update(QT.ORACLE)
_RAW.update(QE.ORACLE)
_RAW.update(QK.ORACLE)
_RAW.update(QM.ORACLE)

ORACLE = {k: (lambda f=f: round6_rewrite(f())) for k, f in _RAW.items()}
