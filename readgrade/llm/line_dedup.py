"""Line dedup by site: a line that is on too large a share of a site's pages is boilerplate and goes.

Lines are counted once a page, by site and 128-bit hash, and combined before the exchange. The boilerplate of a site is a short list, as each
of its lines is on more than a fixed share of the site's pages; pages meet that list once and drop the lines within the row, so a
site with a third of all pages costs no more than its pages, and no text is shuffled unless the lists are too many to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from readgrade.llm.common import fresh, stored, table

#: A line goes if it is on more than this share of its site's pages, and on at least so many of them.
RATIO, PAGES = 0.1, 3
#: Boilerplate lines, all sites together, up to which the lists are broadcast.
BROADCAST_LINES = 500_000

BLOCK_TAGS = ("(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html"
              "|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)( [^>]*)?/?>")
#: Patterns, replaced in this order, then entities.
MARKUP = [("(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", ""), (BLOCK_TAGS, "\n"), ("<[^>]*>", "")]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SPACES = " \t\n\v\f\r"


def page_text(html: Column) -> Column:
    """Markup out, one line for each block."""
    text = F.coalesce(html.cast("string"), F.lit(""))
    for pattern, to in MARKUP:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(to))
    for entity, to in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(to))
    return text


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def lines(text: Column) -> Column:
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.filter(trimmed, lambda x: x != "")


def _hash(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """(site, line) hashes of the lines to drop, of (site, lines); pages of site '' belong together in nothing and keep all."""
    sited = pages.where("site != ''")
    totals = sited.groupBy("site").agg(F.count("*").alias("pages"))
    counted = (sited.select("site", F.explode(F.array_distinct(F.transform("lines", _hash))).alias("line"))
               .groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    return counted.join(totals, "site").where(F.col("n") > F.lit(ratio) * F.col("pages")).select("site", "line")


def drop_boilerplate(pages: DataFrame, site: Column, text: Column, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """The rows of ``pages`` with ``site``, ``clean_text`` (kept lines, trimmed, joined by line feeds), ``n_lines`` and ``n_dropped``.

    Blank lines are no lines. Null text is a page without lines, which counts for its site; a null or empty site keeps its lines. Repeated
    rows are pages of their own. New columns get a leading underscore where ``pages`` has their names.
    """
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                        F.coalesce(site.cast("string"), F.lit("")).alias("site"), lines(text).alias("lines"))
    found = stored(boilerplate(rows.select("site", "lines"), ratio, least), "boilerplate")
    lists = found.groupBy("site").agg(F.collect_list("line").alias("drop"))
    lists = F.broadcast(lists) if found.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else stored(lists, "boilerplate-lists")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("drop"), _hash(x))))
    out = rows.join(lists, "site", "left").select("row", "site", F.size("lines").cast("long").alias("all"), kept.alias("kept"))
    return out.select("row.*", F.col("site").alias(fresh("site", pages)), F.array_join("kept", "\n").alias(fresh("clean_text", pages)),
                      F.col("all").alias(fresh("n_lines", pages)), (F.col("all") - F.size("kept")).alias(fresh("n_dropped", pages)))


def op8_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the boilerplate of their site."""
    pages = table(spark, sf_dir, "pages")
    return drop_boilerplate(pages, host(F.col("url")), page_text(F.col("html"))).select(
        "page_id", "site", "clean_text", "n_lines", "n_dropped")


def _sql_text() -> str:
    text = "coalesce(html, '')"
    for pattern, to in MARKUP:
        text = f"regexp_replace({text}, '{pattern}', {'chr(10)' if to == chr(10) else repr(to)}, 'g')"
    for entity, to in ENTITIES:
        text = f"replace({text}, '{entity}', '{to}')"
    return text


OP8_SQL = rf"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS site,
         list_filter(list_transform(string_split({_sql_text()}, chr(10)),
                                    lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x != '') AS lines
  FROM pages
), l AS (SELECT page_id, site, unnest(list_distinct(lines)) AS line FROM p WHERE site != ''),
c AS (SELECT site, line, count(*) AS n FROM l GROUP BY ALL),
t AS (SELECT site, count(*) AS pages FROM p GROUP BY site),
d AS (
  SELECT c.site, list(c.line) AS dropped FROM c JOIN t USING (site) WHERE n >= {PAGES} AND n > CAST({RATIO} AS DOUBLE) * pages GROUP BY c.site
), k AS (
  SELECT page_id, p.site, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(dropped, []), x)) AS kept
  FROM p LEFT JOIN d ON p.site = d.site
)
SELECT page_id, site, coalesce(array_to_string(kept, chr(10)), '') AS clean_text, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped FROM k
"""
