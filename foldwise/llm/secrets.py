"""Secret scan with corpus-wide ownership frequency (DataFrame operations only).

One map pass finds the candidates of each kind: ``regexp_extract_all`` gives the matches and
``split`` by the same pattern gives what lies between, so lengths in code points give positions without a UDF.
The narrow table of candidates (hashes of their values, never the values) is staged; positions are
running sums over one document's candidates.  Ownership: distinct (value, owner, repository), then counts
by (value, owner), then by value, each with partial sums, so a value copied to a third of all rows is
spread over its owners and repositories before its few partial counts meet.  A value with at most ``max_owners`` owners
and ``max_repos`` repositories looks live; any other is a widely copied example.

Base kinds (assign, access, hex) are always reported.  The method adds spans of the kinds ``pem``, ``prefix`` and
``mixed``, for values that look live.

Edge cases: a null text counts as empty and gives no span; null owners or repositories count as one owner or repository;
each row is a document, repeated rows of one repository count once for ownership; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import sha256_hex, staged

#: kind -> (pattern, group that holds the value, least length of the value); the order is that of equal starts
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # a maximal run that is too short has no long enough match inside, so these two may ask for the length at once
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
ADDED = {
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+", 0, 64),
    "prefix": (r"\b(?:gh[pousr]_|github_pat_|xox[abprs]-|sk-|glpat-)[A-Za-z0-9_-]+", 0, 20),
    "mixed": (r"[A-Za-z0-9+/_=-]{24,}", 0, 24),
}
KINDS = list(BASE) + list(ADDED)
#: cheap patterns without which a kind can have no match of the length asked for
NEEDS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[^A-Za-z0-9]{1,3}",
    "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}", "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "prefix": r"(?:gh[pousr]_|github_pat_|xox[abprs]-|sk-|glpat-)[A-Za-z0-9_-]", "mixed": r"[A-Za-z0-9+/_=-]{24}",
}


def _found(text: Column, kind: str) -> Column:
    """array<struct<k, at, gap, len, vlen, h>> of all matches of a kind, failing ones included (they take up room)."""
    pattern, group, _ = (BASE | ADDED)[kind]
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    hits = F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(group)) if group else hits
    one = F.transform(F.arrays_zip(hits.alias("m"), values.alias("v"), F.slice(gaps, 1, F.size(hits)).alias("g")), lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("k"), i.alias("at"), x["g"].alias("gap"), F.length(x["m"]).alias("len"),
        F.when(_mixed(x["v"]) if kind == "mixed" else F.lit(True), F.length(x["v"])).otherwise(0).alias("vlen"), F.unhex(F.sha2(F.encode(x["v"], "UTF-8"), 256)).alias("h")))
    return F.when(text.rlike(NEEDS[kind]), one)


def _mixed(v: Column) -> Column:
    return v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9].*[0-9].*[0-9]")


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """rid (one per row), id, owner, repo and one row per candidate: k, start, end, h; a document without any has one row with a null k."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*[F.coalesce(_found(t, kind), F.array().cast("array<struct<k:int,at:int,gap:int,len:int,vlen:int,h:binary>>")) for kind in KINDS])
    # the row number is fixed by writing it: later stages read it, and none computes it again
    flat = staged(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(owner).cast("string").alias("owner"),
                              F.col(repo).cast("string").alias("repo"), found.alias("found")))
    rows = flat.select("rid", "id", "owner", "repo", F.explode_outer("found").alias("f")).select("rid", "id", "owner", "repo", "f.*")
    so_far = Window.partitionBy("rid", "k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in (BASE | ADDED).values()]), F.col("k") + 1)
    return (rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
            .withColumn("keep", F.coalesce(F.col("vlen") >= least, F.lit(False)))
            .select("rid", "id", "owner", "repo", F.when(F.col("keep"), F.col("k")).alias("k"), "start", "end", "h"))


def ownership(found: DataFrame) -> DataFrame:
    """(h, owners, repos): distinct owners and repositories of each value."""
    each = found.filter("k IS NOT NULL").groupBy("h", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo")).agg(F.lit(1).alias("one"))
    return each.groupBy("h", "owner").agg(F.count("*").alias("repos")).groupBy("h").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def scan(docs: DataFrame, max_owners: int = 2, max_repos: int = 10, **columns) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example: one row per row of ``docs``.

    n_live and n_example split the reported spans by what ownership says of their values."""
    found = staged(find(docs, **columns))
    own = ownership(found)
    # documents without a candidate have no value to join by
    rows = found.filter("k IS NOT NULL").join(own, "h").unionByName(found.filter("k IS NULL").withColumns({"owners": F.lit(None).cast("long"), "repos": F.lit(None).cast("long")}))
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    rows = rows.withColumn("live", live).withColumn("k", F.when((F.col("k") < len(BASE)) | F.col("live"), F.col("k")))
    span = F.when(F.col("k").isNotNull(), F.struct("start", "k", "end"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    per = rows.groupBy("rid", "id").agg(
        *[count(F.col("k") == i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.array_sort(F.collect_list(span)).alias("all"),
        count(F.col("k").isNotNull() & F.col("live")).alias("n_live"), count(F.col("k").isNotNull() & ~F.col("live")).alias("n_example"))
    return per.select(F.col("id").alias("doc_id"), *[f"n_{kind}" for kind in BASE],
                      sha256_hex(joined(F.filter("all", lambda s: s["k"] < len(BASE)))).alias("base_sha256"), joined(F.col("all")).alias("spans"), "n_live", "n_example")


def _sql_kind(i: int, kind: str) -> str:
    p, group, least = (BASE | ADDED)[kind]
    p = p.replace("'", "''")
    more = " AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9].*[0-9].*[0-9]')" if kind == "mixed" else ""
    return f"""
  SELECT rid, {i} AS k, '{kind}' AS kind, e - length(m) AS s, e, v FROM (
    SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY pos) AS e FROM (
      SELECT rid, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[:len(ms)]) AS g, generate_subscripts(ms, 1) AS pos FROM (
        SELECT rid, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {group}) AS vs, string_split_regex(t, '{p}') AS gs FROM d)))
  WHERE length(v) >= {least}{more}"""


SCAN_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS owner, coalesce(doc_id::VARCHAR, '') AS repo, coalesce(text, '') AS t FROM documents),
c AS ({" UNION ALL ".join(_sql_kind(i, k) for i, k in enumerate(KINDS))}),
o AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM c JOIN d USING (rid) GROUP BY v),
r AS (SELECT c.*, owners <= 2 AND repos <= 10 AS live, kind || ':' || s::BIGINT || ':' || e::BIGINT AS span FROM c JOIN o USING (v)),
u AS (SELECT * FROM r WHERE k < {len(BASE)} OR live),
g AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(span, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY s, k) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM u GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (rid)
"""
