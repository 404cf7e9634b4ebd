"""Line dedup by site-relative frequency, with SQL functions only.

A line is boilerplate of a host if more than a given part of the host's pages contain
it. Counts are combined before the shuffle, lines travel as 64-bit hashes, and
what comes back to the pages is one short list per host: a host has fewer boilerplate
lines than its pages have lines on average, divided by the ratio. The pages of a
host are salted over several parts for that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Parts that the pages of each host are dealt to.
SALT = 16
#: HTML elements without lines of text, and those that begin or end a line.
HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BREAKS = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:\s[^>]*)?/?>"
TAGS = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def html_lines(html: Column) -> Column:
    """The text lines of a page, trimmed, without empty ones."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, ""), BREAKS, "\n"), TAGS, "")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")


def line_dedup(pages: DataFrame, *, ratio: tuple[int, int] = (1, 4), least_pages: int = 2, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, n_lines, n_dropped, text) per row of pages; text is what is left, one line after another.

    A line goes if at least `least_pages` rows of the host contain it and these are more than
    ratio = (numerator, denominator) of the host's rows; what is on one page alone is not
    repeated, so that a host's only page keeps its text. Repeats within a page count once
    and go together. Null or empty html has no lines and text ''; pages without a host,
    with a null url too, are one host ''; repeated rows count as pages of their own. Other columns are
    ignored. An empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "lines")
    hashed = lambda a: F.transform(a, lambda x: F.xxhash64(x))
    lined = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col).cast("string")).alias("host"), html_lines(F.col(html_col).cast("string")).alias("lines"))
    lined = scratch.table(lined, "lines")
    counts = lined.select("host", F.explode(F.array_distinct(hashed(F.col("lines")))).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    totals = lined.groupBy("host").agg(F.count("*").alias("pages"))
    common = counts.join(totals, "host").where(ratio[1] * F.col("n") > ratio[0] * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("common"))
    common = scratch.table(common, "common").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = lined.withColumn("part", F.pmod(F.xxhash64("_id", F.size("lines")), F.lit(SALT)).cast("int"))
    joined = dealt.join(common, ["host", "part"], "left")
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("common"), F.xxhash64(x))))
    return joined.withColumn("kept", kept).select(F.col("_id").alias(id_col), "host", F.size("lines").alias("n_lines"), (F.size("lines") - F.size("kept")).alias("n_dropped"), F.concat_ws("\n", "kept").alias("text"))


OP3_SQL = rf"""
WITH l AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
  list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g'), chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13))), lambda x: x <> '') AS lines FROM pages),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM l) GROUP BY host, line HAVING count(*) >= 2),
t AS (SELECT host, count(*) AS pages FROM l GROUP BY host),
b AS (SELECT c.host, list(c.line) AS common FROM c JOIN t USING (host) WHERE 4 * c.n > t.pages GROUP BY c.host),
k AS (SELECT l.page_id, l.host, l.lines, CASE WHEN b.common IS NULL THEN l.lines ELSE list_filter(l.lines, lambda x: NOT list_contains(b.common, x)) END AS kept FROM l LEFT JOIN b ON l.host = b.host)
SELECT page_id, host, CAST(len(lines) AS INTEGER) AS n_lines, CAST(len(lines) - len(kept) AS INTEGER) AS n_dropped, array_to_string(kept, chr(10)) AS text FROM k
"""
