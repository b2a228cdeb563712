"""Line deduplication by site-relative frequency.

For each site, the pages that contain a line (trimmed of spaces, once per page)
are divided by the site's pages; lines above ``ratio`` that stand on at least
``min_pages`` pages are boilerplate and are dropped from every page of the site,
however much of a page that is.  Pages of a site with the same content count as
one page, on both sides of the division: the lines of a page with many copies
are no boilerplate.  Lines and contents are known by two 64-bit hashes; only
hashes are shuffled: a line's pages spread by their content, and are counted
with map-side combine, so neither a hot site nor a hot line lands in one task.
A site keeps at most (mean lines per page / ratio) boilerplate lines, a short
list.

Defined cases: blank lines are never boilerplate; a null site is a site of its
own; null text stays null; repeated rows are copies of a page; an empty table
gives an empty table.  Other columns pass through, but for those named like a
column of ``counts``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, cut

RATIO, MIN_PAGES = 0.1, 3


def _site(col: str) -> Column:
    return F.when(F.col(col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(col).cast("string")))


def _lines(col: str) -> Column:
    return F.split(F.col(col), "\n", -1)


def boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, a, b, pages, site_pages): hashes of every boilerplate line of a site."""
    page = docs.select(_site(site_col).alias("site"), F.xxhash64(text_col).alias("ta"),
                       F.xxhash64(text_col, F.lit(1)).alias("tb"),
                       F.array_distinct(F.transform(_lines(text_col), F.trim)).alias("lines"))
    sites = page.select("site", "ta", "tb").distinct().groupBy("site").agg(F.count("*").alias("site_pages"))
    often = (page.select("site", "ta", "tb", F.explode("lines").alias("line")).filter("line <> ''")
             .select("site", F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit(1)).alias("b"), "ta", "tb").distinct()
             .groupBy("site", "a", "b").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages))
    return often.join(sites, "site").filter(F.col("pages") > F.col("site_pages") * F.lit(ratio))


def drop_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text_col``; with ``counts``
    also ``lines_total`` and ``lines_dropped`` (0 for null text)."""
    if counts:
        docs = docs.drop("lines_total", "lines_dropped")
    found = cut(boilerplate(docs, site_col, text_col, ratio, min_pages)
                .groupBy(F.col("site").alias("__ld_site"))
                .agg(F.collect_list(F.struct("a", "b")).alias("__ld_bad")))
    entries = found.agg(F.sum(F.size("__ld_bad"))).first()[0] or 0
    side = F.broadcast(found) if entries <= BROADCAST_ROWS else found
    rows = docs.join(side, _site(site_col) == F.col("__ld_site"), "left")

    def bad(line: Column) -> Column:
        a, b = F.xxhash64(F.trim(line)), F.xxhash64(F.trim(line), F.lit(1))
        return F.exists("__ld_bad", lambda x: (x.a == a) & (x.b == b))

    lines = _lines(text_col)
    kept = F.when(F.col("__ld_bad").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.filter(lines, lambda x: (F.trim(x) == "") | ~bad(x)), "\n"))
    rows = rows.withColumn("__ld_kept", kept)
    text = F.col("__ld_kept")
    out = [text.alias(text_col) if c == text_col else docs[c] for c in docs.columns]
    if counts:
        total = F.coalesce(F.size(lines), F.lit(0))
        left = F.size(F.split(text, "\n", -1))
        # a page with nothing left is not split into one empty line
        left = F.when(F.length(text) == 0, F.when(F.length(text_col) == 0, total).otherwise(0)).otherwise(left)
        total = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(total)
        out += [total.cast("long").alias("lines_total"),
                F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(total - left).cast("long").alias("lines_dropped")]
    return rows.select(*out)


#: DuckDB form of ``drop_boilerplate(docs, counts=True)`` over ``{docs}``
ORACLE = """
WITH pages AS (
  SELECT row_number() OVER () AS rid, *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS site
  FROM {docs}),
lines AS (
  SELECT rid, site, text, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')))) AS line
  FROM pages),
bad AS (
  SELECT l.site, l.line
  FROM lines l JOIN (SELECT site, count(DISTINCT text) + max(text IS NULL)::INTEGER AS n FROM pages GROUP BY site) s USING (site)
  WHERE l.line <> ''
  GROUP BY l.site, l.line, s.n
  HAVING count(DISTINCT l.text) >= {min_pages} AND count(DISTINCT l.text) > s.n * {ratio}::DOUBLE),
lists AS (SELECT site, list(line) AS bad FROM bad GROUP BY site),
cleaned AS (
  SELECT p.*, string_split(p.text, chr(10)) AS before,
         list_filter(string_split(p.text, chr(10)),
                     lambda x: trim(x, ' ') = '' OR NOT list_contains(coalesce(b.bad, []), trim(x, ' '))) AS kept
  FROM pages p LEFT JOIN lists b USING (site))
SELECT {columns}, array_to_string(kept, chr(10)) AS text, coalesce(len(before), 0)::BIGINT AS lines_total,
       coalesce(len(before) - len(kept), 0)::BIGINT AS lines_dropped
FROM cleaned
"""
