"""Categorical encoders.

fit -> a small dimension DataFrame (value -> number) or, for one-hot, the value
list (one-hot is only used on low-cardinality columns, so the list is bounded);
apply -> a left join (broadcast when the checked row count is small) + ``coalesce``
with the unseen-value rule, or plain column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.profile import dense_index, distinct_counts, relative_frequency, value_counts
from foldwise.session import cut_lineage, join_dim


@dataclass
class LookupEncoder:
    """A fitted (value -> number) dimension per column, with a default for unseen values."""
    dims: dict            # col -> DataFrame(value string, out)
    default: object       # value for unseen / null (None keeps null)
    suffix: str
    null_matches: bool = False
    out_type: str = "double"

    def apply(self, df: DataFrame) -> DataFrame:
        out = df
        for c, dim in self.dims.items():
            d = dim.select(F.col("value").alias("_v"), F.col("out").alias("_o"))
            key = F.col(c).cast("string")
            cond = key.eqNullSafe(F.col("_v")) if self.null_matches else key == F.col("_v")
            out = join_dim(out, d, on=cond, how="left")
            dflt = self.default.get(c) if isinstance(self.default, dict) else self.default
            val = F.col("_o") if dflt is None else F.coalesce(F.col("_o"), F.lit(dflt))
            out = out.withColumn(c + self.suffix, val.cast(self.out_type)).drop("_v", "_o")
        return out


def _long(df: DataFrame, cols: list[str], dropna: bool = True) -> DataFrame:
    """All listed columns stacked as (col, value) text rows -- one scan serves every column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.inline(pairs))
    return long.filter(F.col("value").isNotNull()) if dropna else long


def long_counts(df: DataFrame, cols: list[str], dropna: bool = True) -> DataFrame:
    """(col, value, n) for all columns in ONE aggregation (partial aggregation map-side)."""
    return _long(df, cols, dropna).groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))


def _split_dims(long_dim: DataFrame, cols: list[str]) -> dict:
    """One materialised (col, value, out) table, viewed per column."""
    t = cut_lineage(long_dim.select("col", F.col("value").cast("string").alias("value"), "out"))
    return {c: t.filter(F.col("col") == c).select("value", "out") for c in cols}


def fit_frequency(train: DataFrame, cols: list[str], suffix: str = "_FE") -> LookupEncoder:
    """Counts of the training rows; unseen / null -> null."""
    return LookupEncoder(_split_dims(long_counts(train, cols).withColumnRenamed("n", "out"), cols), None, suffix)


def frequency_self(df: DataFrame, cols: list[str], suffix: str = "_freq") -> DataFrame:
    """Counts on the table itself, null counted as a value (``value_counts(dropna=False)``)."""
    dims = _split_dims(long_counts(df, cols, dropna=False).withColumnRenamed("n", "out"), cols)
    return LookupEncoder(dims, None, suffix, null_matches=True).apply(df)


def fit_relative_frequency(train: DataFrame, cols: list[str], suffix: str = "_freq", unseen=0.0) -> LookupEncoder:
    """E3 (unseen -> 0) / E4 rarity (``unseen=None``: unseen -> null).  Denominator = non-null rows of
    the column, from a per-column total table (one row per column, broadcast)."""
    lc = long_counts(train, cols)
    tot = lc.groupBy("col").agg(F.sum("n").alias("_tot"))
    rel = lc.join(F.broadcast(tot), "col").select("col", "value", (F.col("n") / F.col("_tot")).alias("out"))
    return LookupEncoder(_split_dims(rel, cols), unseen, suffix)


def _dense_indices(train: DataFrame, cols: list[str]) -> DataFrame:
    """(col, value, out = 0-based sorted index) for all columns at once: distinct (col, value) pairs,
    range-partitioned running counts per column (no window over a whole column)."""
    from functools import reduce

    from foldwise.operators.rank import cumulative_before
    types = dict(train.dtypes)
    groups = {}
    for c in cols:  # columns of one type share a pass; values sort in their own type (codes numerically)
        groups.setdefault(types[c], []).append(c)
    parts = []
    for _, group in groups.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("value")) for c in group])
        d = train.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct().withColumn("_one", F.lit(1))
        cb = cumulative_before(d, ["value"], "_one", ["col"])
        parts.append(cb.select("col", F.col("value").cast("string").alias("value"), F.col("_before").cast("long").alias("out")))
    return reduce(DataFrame.unionByName, parts)


def fit_ordinal(train: DataFrame, cols: list[str], unseen: int = -1, suffix: str = "_OE") -> LookupEncoder:
    """Sorted index, unseen -> -1.  E5 label encoding: ``unseen=K`` (use ``fit_label_index``)."""
    return LookupEncoder(_split_dims(_dense_indices(train, cols), cols), unseen, suffix, out_type="long")


def fit_label_index(train: DataFrame, cols: list[str], suffix: str = "_LE") -> LookupEncoder:
    """E5: sorted index with unseen -> K (the number of training values), like StringIndexer(keep)."""
    dims = _split_dims(_dense_indices(train, cols), cols)
    return LookupEncoder(dims, {c: d.count() for c, d in dims.items()}, suffix, out_type="long")


# ---- one-hot -------------------------------------------------------------------------------

def fit_one_hot_levels(train: DataFrame, cols: list[str], max_levels: int = 1000) -> dict:
    """Sorted level list per column (bounded: one-hot is for low-cardinality columns)."""
    out = {}
    for c in cols:
        # sorted in the column's own type (integer codes numerically), matched as text
        levels = [str(r[0]) for r in train.select(F.col(c)).filter(F.col(c).isNotNull())
                  .distinct().orderBy(F.col(c)).limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels; use sparse_one_hot, which has no limit")
        out[c] = levels
    return out


def one_hot(df: DataFrame, levels: dict, prefix_fmt: str = "{c}_oh_{i}", dummy_na: bool = False) -> DataFrame:
    """0/1 columns per fitted level (unseen -> all 0); E9 adds ``{c}_nan``."""
    cols = []
    for c, lv in levels.items():
        key = F.col(c).cast("string")
        for i, v in enumerate(lv):
            cols.append(F.when(key == F.lit(v), 1).otherwise(0).alias(prefix_fmt.format(c=c, i=i)))
        if dummy_na:
            cols.append(F.isnull(c).cast("int").alias(f"{c}_nan"))
    return df.select("*", *cols)


def sparse_one_hot(train: DataFrame, dfs: list[DataFrame], cols: list[str], suffix: str = "_hot") -> tuple[list[DataFrame], dict]:
    """E7 / E8 / E10 for any number of levels: per column the position of the 1 (null for a level not fitted) in place of 0/1
    columns, by a join with the dimension of levels; returns the frames and {column: number of levels}.

    ``position`` and the number of levels are what a sparse vector is made of."""
    dims = _split_dims(_dense_indices(train, cols), cols)
    enc = LookupEncoder(dims, None, suffix, out_type="long")
    return [enc.apply(d) for d in dfs], {c: d.count() for c, d in dims.items()}


# ---- crosses -------------------------------------------------------------------------------

def _text(c) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def cross_pairs(df: DataFrame, cols: list[str], sep: str = "_", name_fmt: str = "{a}_{b}") -> tuple[DataFrame, list[str]]:
    """Every pair of the listed columns as ``a<sep>b`` text (nulls as 'nan')."""
    names = []
    exprs = []
    for a, b in combinations(cols, 2):
        n = name_fmt.format(a=a, b=b)
        names.append(n)
        exprs.append(F.concat(_text(a), F.lit(sep), _text(b)).alias(n))
    return df.select("*", *exprs), names


def top_k_by_cardinality(train: DataFrame, cols: list[str], k: int = 4) -> list[str]:
    """The k columns with most distinct values; ties keep the listed order (stable sort)."""
    n = {r["col"]: r["n_distinct"] for r in distinct_counts(train, cols).collect()}
    order = sorted(range(len(cols)), key=lambda i: (-n.get(cols[i], 0), i))
    return [cols[i] for i in order[:k]]


def top_cardinality_crosses(train: DataFrame, test: DataFrame | None, cols: list[str], k: int = 4):
    """Pairs of the top-k columns by cardinality, separator '___', names ``a__b``."""
    top = top_k_by_cardinality(train, cols, k)
    tr, names = cross_pairs(train, top, "___", "{a}__{b}")
    ts = cross_pairs(test, top, "___", "{a}__{b}")[0] if test is not None else None
    return tr, ts, names


def fixed_crosses_ordinal(train: DataFrame, test: DataFrame, pairs: list[tuple[str, str]], sep: str = "_", fit_on: DataFrame | None = None):
    """Fixed pairs crossed, then ordinal encoded (unseen -> -1); fitted on ``fit_on`` (default: train), applied to all rows."""
    names = []
    fitted = train if fit_on is None else fit_on
    for a, b in pairs:
        n = f"{a}_{b}"
        names.append(n)
        e = F.concat(_text(a), F.lit(sep), _text(b))
        train, test, fitted = train.withColumn(n, e), test.withColumn(n, e), fitted.withColumn(n, e)
    enc = fit_ordinal(fitted, names, -1, "_OE")
    return enc.apply(train), enc.apply(test), [n + "_OE" for n in names]


# ---- cardinality router --------------------------------------------------------------------

def route_by_cardinality(train: DataFrame, cols: list[str], low_max: int = 6, mid_max: int = 20) -> dict:
    """<= low_max -> 'onehot', low_max+1..mid_max -> 'target', above -> 'frequency'."""
    n = {r["col"]: r["n_distinct"] for r in distinct_counts(train, cols).collect()}
    plan = {}
    for c in cols:
        k = n.get(c, 0)
        plan[c] = "onehot" if k <= low_max else ("target" if k <= mid_max else "frequency")
    return plan
