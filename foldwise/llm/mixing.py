"""Mixing sources to target weights with soft memberships (DataFrame operations only).

A naive Bayes classifier, fitted on a bounded sample of the labelled table, gives every document posteriors over the domains: its
features are hashed words and hashed (second letter, last letter) pairs, so the fitted table has a fixed number of
entries and enters the plan as constant arrays.  A long text would make every posterior 0 or 1, so the evidence of a
text counts as that of at most ``evidence`` words.

Rates r >= 0 (expected copies of a document) are to meet sum_i r_i n_i p_ik = b_k, with n_i tokens, p_ik posterior and b_k target tokens:
projected-gradient least squares on the residual e.  A pass over the documents adds up e and a K x K Gram matrix; the step of a document is
p_i . g with one vector g = W e of K numbers, W the inverse of the Gram matrix of the documents with a rate above 0, and the projection cuts
rates at 0.  A document's rate is a fold over those vectors from 1, so nothing per document is kept between passes and a lost executor
costs nothing.  Without a clipped rate one step is exact; with many the plain metric (all documents) takes thousands of steps, this one about
ten.  Targets that no rates meet leave a residual, which is given as a warning; ``fit_rates`` returns it.

Edge cases: a null or empty text has no tokens, prior posteriors and a rate as any other; a null id is a document; rows equal in id
and text get equal rates; documents with several labels count as toxic if any says so, else low if any says so; without labelled rows
all posteriors are equal; a target for a domain without tokens cannot be met, the others still are; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import fresh, hash_share, staged, text_key

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 13, 1 << 10
TARGETS = {"high": 0.90, "low": 0.08, "toxic": 0.02}


def words(text: str) -> Column:
    """An empty string, which stands for the document, and its words between spaces and line feeds (empty ones are not words)."""
    return F.concat(F.array(F.lit("")), F.split(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\n"), F.lit(" ")), " ", -1))


def word_bucket(w: Column) -> Column:
    return F.pmod(F.hash(w), F.lit(WORD_BUCKETS))


def shape_bucket(w: Column) -> Column:
    return F.pmod(F.hash(F.substring(w, 2, 1), F.substring(w, -1, 1)), F.lit(SHAPE_BUCKETS)) + F.lit(WORD_BUCKETS)


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the labelled table."""
    one = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return one.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "high").alias("domain")).filter("domain IS NOT NULL")


def fit(docs: DataFrame, marked: DataFrame, domains: list[str], max_rows: int = 20_000, alpha: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """(log prior, log likelihood [domain, bucket]) from about ``max_rows`` labelled documents of each domain."""
    marked = marked.filter(F.col("domain").isin(*domains))
    sizes = {r.domain: r.n for r in marked.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = hash_share(marked, "domain", "doc_id", max_rows).select(F.col("doc_id").alias("_id"), "domain")
    w = docs.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("domain", F.explode(words("text")).alias("w")).filter("w <> ''")
    # both tables have a fixed number of rows: domains x buckets
    got = [r for bucket in (word_bucket, shape_bucket) for r in w.groupBy("domain", bucket(F.col("w")).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()]
    n = np.full((len(domains), WORD_BUCKETS + SHAPE_BUCKETS), alpha)
    for r in got:
        n[domains.index(r.domain), r.b] += r.n
    logp = np.concatenate([np.log(part / part.sum(axis=1, keepdims=True)) for part in (n[:, :WORD_BUCKETS], n[:, WORD_BUCKETS:])], axis=1)
    prior = np.array([sizes.get(d, 0) + 1.0 for d in domains])
    return np.log(prior / prior.sum()), logp


def constants(values) -> Column:
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def posteriors(docs: DataFrame, prior: np.ndarray, logp: np.ndarray, evidence: float) -> DataFrame:
    """doc_id, key, rows, n, p (array): one row per distinct (doc_id, text)."""
    base = logp[1:] - logp[0]  # relative to the first domain
    once = docs.select("doc_id", text_key("text").alias("key"), words("text").alias("ws"))  # the key once per text, not per word
    w = once.select("doc_id", "key", F.posexplode("ws").alias("pos", "w"))
    w = w.select("doc_id", "key", (F.col("pos") == 0).cast("int").alias("row"), (F.col("w") != "").alias("is"), word_bucket(F.col("w")).alias("b"), shape_bucket(F.col("w")).alias("s"))
    like = [F.lit(0.0)] + [F.col("is").cast("double") * (F.get(constants(v), F.col("b")) + F.get(constants(v[WORD_BUCKETS:]), F.col("s") - WORD_BUCKETS)) for v in base]
    per = w.groupBy("doc_id", "key").agg(F.sum("row").alias("rows"), F.sum(F.col("is").cast("long")).alias("tokens"), *[F.sum(x).alias(f"l{k}") for k, x in enumerate(like)])
    n = (F.col("tokens") / F.col("rows")).cast("long")
    scale = F.least(F.lit(1.0), F.lit(float(evidence)) / F.greatest(n, F.lit(1))) / F.col("rows")
    logs = F.array(*[F.lit(float(q)) + F.col(f"l{k}") * scale for k, q in enumerate(prior)])
    e = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    return per.select("doc_id", "key", "rows", n.alias("n"), logs.alias("logs")).withColumn("e", e) \
        .select("doc_id", "key", "rows", "n", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, y: a + y)).alias("p"))


def rate_of(steps: list[np.ndarray]) -> Column:
    """The rate after all gradient steps, folded from 1."""
    if not steps:
        return F.lit(1.0)
    rows = F.transform(F.split(F.lit(";".join(",".join(repr(float(v)) for v in g) for g in steps)), ";"), lambda s: F.split(s, ",").cast("array<double>"))
    dot = lambda g: F.aggregate(F.zip_with("p", g, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(rows, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - dot(g)))


def fit_rates(members: DataFrame, targets: np.ndarray, max_passes: int = 100, tolerance: float = 1e-6) -> tuple[list[np.ndarray], float]:
    """Projected-gradient steps, and the largest residual left as a share of all tokens; ``members`` has rows, n and p.

    A pass gives the residual e and the Gram matrix of the documents with a rate above 0; its inverse is the metric of the next step
    (the documents that the projection holds at 0 do not move, so the Gram matrix of all would take too short a step).  A step
    after which e' W e, W of the first pass, has not fallen is halved."""
    k = len(targets)
    p, mass = [F.col("p")[i] for i in range(k)], F.col("rows") * F.col("n")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(steps):
        """(tokens, share of tokens by domain at the rates, Gram matrix of rates above 0 as a share of tokens)"""
        r = members.select("*", rate_of(steps).alias("r")).withColumn("on", F.when(F.col("r") > 0, mass).otherwise(F.lit(0)))
        got = r.agg(F.sum(mass).alias("n"), *[F.sum(mass * F.col("r") * q).alias(f"s{i}") for i, q in enumerate(p)], *[F.sum(F.col("on") * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
        n = float(got["n"] or 0)
        return n, np.array([got[f"s{i}"] or 0 for i in range(k)]) / max(n, 1), np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0 for j in range(k)] for i in range(k)]) / max(n, 1)

    inverse = lambda g: np.linalg.pinv(g, rcond=1e-9, hermitian=True)  # noqa: E731  a domain without tokens drops out
    steps: list[np.ndarray] = []
    n, got, gram = sums(steps)
    if not n:
        return [], 0.0
    want, metric = targets / targets.sum(), inverse(gram)
    best = np.inf
    for _ in range(max_passes):
        e = got - want
        value = float(e @ metric @ e)
        if np.abs(e).max() < tolerance / 10:
            break
        if value < best * (1 - 1e-9):
            best, kept = value, e
            steps.append(inverse(gram) @ e)
        elif np.abs(steps[-1]).max() > 1e-12:
            steps[-1] = steps[-1] / 2
        else:  # no step lowers it any more
            steps.pop()
            return steps, float(np.abs(kept).max())
        _, got, gram = sums(steps)
    return steps, float(np.abs(got - want).max())


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, evidence: float = 100, tolerance: float = 1e-6, **fit_options) -> tuple[DataFrame, list[str]]:
    """(doc_id, key, rows, n, p, rate) per distinct (doc_id, text), and the domains in the order of p; a warning if the targets are missed
    by more than ``tolerance`` of all tokens."""
    targets = targets or TARGETS
    domains = sorted(targets)
    prior, logp = fit(docs, domain_of(labels), domains, **fit_options)
    members = staged(posteriors(docs, prior, logp, evidence))
    steps, missed = fit_rates(members, np.array([targets[d] for d in domains], float), tolerance=tolerance)
    if missed > tolerance:
        warnings.warn(f"the targets of {', '.join(domains)} are not met: the largest difference is {missed:.3g} of all tokens", stacklevel=2)
    return members.withColumn("rate", rate_of(steps)), domains


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain, and the rate: one row per row of ``docs``."""
    out, domains = mix(docs, labels, **options)
    each = out.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", F.col("n").alias("n_tokens"), *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], "rate")


def mixed(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with rate (expected copies) and copies (drawn by a hash of the document), without those of rate 0; if ``docs`` has columns of
    these names, the new ones get a leading underscore."""
    out, _ = mix(docs, labels, **options)
    rate, copies = fresh(docs.columns, "rate", "copies")
    i, k, r = fresh([*docs.columns, rate, copies], "mix_id", "mix_key", "mix_rate")
    rates = out.select(F.col("doc_id").alias(i), F.col("key").alias(k), F.col("rate").alias(r))
    j = docs.join(rates, F.col("doc_id").eqNullSafe(F.col(i)) & (text_key("text") == F.col(k)))
    draw = F.pmod(F.xxhash64(k, F.lit("copies")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return j.filter(F.col(r) > 0).select(*docs.columns, F.col(r).alias(rate), F.floor(F.col(r) + draw).alias(copies))
