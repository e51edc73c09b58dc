"""Line deduplication by site-relative frequency, with DataFrame functions only.

For each host, the pages that contain a line are counted and divided by the host's pages. Lines over a ratio are the site's
boilerplate and are dropped from all its pages. A line counts once per page; lines are compared without outer white space,
and blank lines are neither counted nor dropped. Repeated pages count each.

Null text stays null and null hosts are one host. Pages keep all their columns; names used on the way avoid those that the
table has. An empty table gives an empty one. A page may end with empty text. Pages of any length are split whole; a line exactly at the
ratio stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import free_name

# Markup that never shows, and tags that end a line of text.
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</(script|style)\s*>"
BLOCKS = r"(?i)</?(address|article|aside|body|br|div|footer|h[1-6]|head|header|hr|html|li|main|nav|ol|p|section|table|td|th|title|tr|ul)\b[^>]*>"
TAGS = r"(?s)<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def text_of(html: Column) -> Column:
    """The text of a page, with a line for each block of it."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), BLOCKS, "\n"), TAGS, "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[ \t\r\f]{2,}|[\t\r\f]", " "), r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(" \t\r\f")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(text: Column) -> Column:
    """The different lines of a text that are not blank, by hash."""
    blank = F.xxhash64(F.lit(""))
    return F.array_distinct(F.filter(F.transform(_lines(text), _line_key), lambda k: k != blank))


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(`host`, `line`, `on`, `of`): lines, by hash, on more than `max_ratio` of their host's pages and on `min_pages` or more.

    Counts are summed in each task before they are shuffled, so a line on a third of all pages is a few rows.
    """
    name = F.coalesce(F.col(host), F.lit("")).alias("host")
    totals = pages.groupBy(name).agg(F.count("*").alias("of"))
    lines = pages.select(name, F.explode(_keys(F.col(text))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("on")).filter(F.col("on") >= min_pages)
    return counts.join(totals, "host").filter(F.col("on") > F.col("of") * max_ratio)


def drop_boilerplate(pages: DataFrame, page_id: str, host: str | list[str], text: str, max_ratio: float = 0.1, min_pages: int = 3, most: float = 1.0, whole: bool = False) -> DataFrame:
    """The pages with boilerplate lines taken out of `text`, and `n_lines` and `n_dropped` (lines that are not blank).

    A page that would lose more than the share `most` of its characters stays whole: it is a copy of others rather than a page
    in a template. With `whole`, so does a page that would lose all its lines.
    Of several columns of hosts, a line goes if it is boilerplate of any.
    """
    key, drops, kept = (free_name(pages, n) for n in ("page_key", "page_drops", "page_kept"))
    hosts = [F.coalesce(F.col(h), F.lit("")) for h in ([host] if isinstance(host, str) else host)]
    content = F.xxhash64(*hosts, F.col(text))
    found = []
    for h in hosts:
        named = pages.withColumn(key, h)
        bad = boilerplate(named, key, text, max_ratio, min_pages).select("host", "line")
        where = named.select(F.col(page_id).alias("id"), content.alias("content"), F.col(key).alias("host"), F.explode(_keys(F.col(text))).alias("line"))
        found.append(where.join(bad, ["host", "line"]).select("id", "content", "line"))
    lists = reduce(DataFrame.union, found).groupBy("id", "content").agg(F.collect_set("line").alias(drops))
    lists = lists.select(F.struct("id", "content").alias(key), drops)
    here = F.struct(F.col(page_id).alias("id"), content.alias("content"))
    joined = pages.join(lists, (here["id"].eqNullSafe(F.col(key)["id"])) & (here["content"] == F.col(key)["content"]), "left")
    lines, blank = _lines(F.col(text)), F.xxhash64(F.lit(""))
    left = F.array_join(F.filter(lines, lambda x: ~F.array_contains(F.col(drops), _line_key(x))), "\n")
    enough = F.length(left) >= (1.0 - most) * F.length(F.col(text))
    if whole:
        enough &= F.exists(lines, lambda x: (_line_key(x) != blank) & ~F.array_contains(F.col(drops), _line_key(x)))
    cut = joined.withColumn(kept, F.when(F.col(drops).isNotNull() & enough, left))
    filled = F.size(F.filter(lines, lambda x: _line_key(x) != blank))
    gone = F.size(F.filter(lines, lambda x: F.array_contains(F.col(drops), _line_key(x))))
    return cut.select(
        *[F.coalesce(F.col(kept), F.col(text)).alias(c) if c == text else F.col(c) for c in pages.columns if c not in ("n_lines", "n_dropped")],
        F.when(F.col(text).isNull(), 0).otherwise(filled).cast("long").alias("n_lines"),
        F.when(F.col(kept).isNull(), 0).otherwise(gone).cast("long").alias("n_dropped"),
    )
