"""Site-relative line deduplication (DataFrame operations only).

A line of a page is boilerplate of its site if more than ``ratio`` of the site's pages, and at
least ``min_pages`` (two: a line of one page alone is repeated nowhere) of them, contain it.  Per page each distinct line counts once, so the number
of pages with a line is a plain count with map-side partial sums: a site or line that holds a third
of all rows reaches the reducer as one partial row per task.  A site has fewer than (its mean number of distinct
lines per page) / ratio boilerplate lines, so they go back to the pages as one short list per site; the
join is broadcast by the planner if the staged list is small, otherwise shuffled, where
adaptive execution splits a hot site.

Edge cases: a null site is a site of its own; a null or empty text has no lines and stays as it is;
lines are compared trimmed of spaces, and lines that are empty then are never counted nor dropped;
repeated rows count as pages of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import fresh, sha256_hex, staged

#: tags, comments, and script or style elements, all of which end a line of a page
MARKUP = r"<script\b[^>]*>(?s:.*?)</script>|<style\b[^>]*>(?s:.*?)</style>|<!--(?s:.*?)-->|<[^>]*>"


def _key(line: Column) -> Column:
    x = F.trim(line)
    return F.struct(F.xxhash64(x).alias("h"), F.crc32(F.encode(x, "UTF-8")).alias("c"))


def boilerplate(pages: DataFrame, site: Column, lines: Column, ratio: float, min_pages: int) -> DataFrame:
    """(site, drop: array of line fingerprints of 96 bits), sites without boilerplate left out."""
    sites = pages.select(F.coalesce(site, F.lit("")).alias("site"), site.isNull().alias("nosite"), lines.alias("lines"))
    total = sites.groupBy("site", "nosite").agg(F.count(F.lit(1)).alias("pages"))
    seen = sites.select("site", "nosite", F.explode(F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), _key))).alias("k"))
    freq = seen.groupBy("site", "nosite", "k.h", "k.c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    hot = freq.join(total, ["site", "nosite"]).filter(F.col("n") > F.lit(float(ratio)) * F.col("pages"))
    return hot.groupBy("site", "nosite").agg(F.collect_list(F.struct("h", "c")).alias("drop"))


def with_kept_lines(pages: DataFrame, site: Column, lines: Column, ratio: float = 0.1, min_pages: int = 2,
                    kept: str = "kept_lines", all_lines: str = "all_lines") -> DataFrame:
    """``pages`` with two array columns: all lines, and those that are not boilerplate of their site."""
    s, n, d, a = fresh(pages.columns, "site", "nosite", "drop", all_lines)
    hot = staged(boilerplate(pages, site, lines, ratio, min_pages)).select(F.col("site").alias(s), F.col("nosite").alias(n), F.col("drop").alias(d))
    left = pages.withColumns({a: lines, s: F.coalesce(site, F.lit("")), n: site.isNull()})
    keep = F.filter(F.col(a), lambda x: (F.trim(x) == "") | ~F.coalesce(F.array_contains(F.col(d), _key(x)), F.lit(False)))
    return left.join(hot, [s, n], "left").withColumn(kept, keep).drop(s, n, d)


def dedup_lines(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """``docs`` with boilerplate lines (ended by a line feed) cut out of ``text``; same rows and columns."""
    k, a = fresh(docs.columns, "kept", "all")
    out = with_kept_lines(docs, F.col(site), F.split(F.col(text), "\n", -1), ratio, min_pages, kept=k, all_lines=a)
    return out.withColumn(text, F.when(F.size(k) == F.size(a), F.col(text)).otherwise(F.array_join(k, "\n"))).select(*docs.columns)


def page_report(pages: DataFrame, ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """page_id, host, n_lines, n_dropped, kept_sha256 of the lines left in each web page, joined by line feeds."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    lines = F.filter(F.transform(F.split(F.col("html"), MARKUP, -1), lambda x: F.trim(x)), lambda x: x != "")
    out = with_kept_lines(pages, host, F.coalesce(lines, F.array().cast("array<string>")), ratio, min_pages)
    return out.select("page_id", host.alias("host"), F.size("all_lines").cast("long").alias("n_lines"),
                      (F.size("all_lines") - F.size("kept_lines")).cast("long").alias("n_dropped"),
                      sha256_hex(F.array_join("kept_lines", "\n")).alias("kept_sha256"))


PAGE_REPORT_SQL = rf"""
WITH p AS (
  SELECT page_id, row_number() OVER () AS rid,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
         list_filter(list_transform(string_split_regex(coalesce(html, ''), '{MARKUP}'), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
f AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY host, line),
hot AS (SELECT f.host, f.line FROM f JOIN t USING (host) WHERE n >= 2 AND n > 0.1 * pages),
u AS (SELECT rid, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM p),
k AS (SELECT u.rid, string_agg(u.line, chr(10) ORDER BY pos) AS kept, count(*) AS n FROM u ANTI JOIN hot USING (host, line) GROUP BY u.rid)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(k.n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM p LEFT JOIN k USING (rid)
"""
