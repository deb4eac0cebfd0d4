"""Links of HTML tables, and crawled pages as files with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import absolute_url, date_prefix, slug, strip


def table_links(pages: DataFrame, id_col: str, html_col: str, host: str) -> DataFrame:
    """``id``, ``date``, ``title`` and ``url`` of every row of a table's body whose second cell has a link; the first cell is the
    date, and a path gets the host."""
    bodies = F.regexp_extract_all(F.col(html_col), F.lit(r"(?is)<tbody[^>]*>(.*?)</tbody>"), F.lit(1))
    rows = F.flatten(F.transform(bodies, lambda b: F.regexp_extract_all(b, F.lit(r"(?is)<tr[^>]*>(.*?)(?:</tr>|$)"), F.lit(1))))
    each = pages.select(F.col(id_col).alias("id"), F.explode(rows).alias("row")).withColumn("cells", F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)))
    plain = lambda c: strip(F.regexp_replace(c, r"<[^>]+>", ""))
    second = F.try_element_at("cells", F.lit(2))
    link = each.select(
        "id",
        plain(F.try_element_at("cells", F.lit(1))).alias("date"),
        plain(F.regexp_extract(second, r"(?is)<a\b[^>]*>(.*?)</a>", 1)).alias("title"),
        absolute_url(F.regexp_extract(second, r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']*)[\"']", 1), host).alias("url"),
    )
    return link.where("url <> ''")


def page_file_name(title: Column, date: Column) -> Column:
    """The name of a crawled page's file."""
    return F.concat(date_prefix(date), F.lit("_"), slug(title), F.lit(".md"))


def page_file(source: str, title: Column, date: Column, url: Column, crawled: Column, text: Column) -> Column:
    """A crawled page with its header."""
    quoted = lambda c: F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))
    lines = [("source", F.lit(source)), ("title", quoted(title)), ("date", quoted(date)), ("url", url), ("crawled", quoted(crawled)), ("chars", F.char_length(text).cast("string"))]
    return F.concat(F.lit("---\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\n")) for k, v in lines], F.lit("---\n\n"), text)


def page_header(content: Column) -> Column:
    """The header of a crawled page as a map."""
    head = F.regexp_extract(content, r"(?s)^---\n(.*?)\n---\n", 1)
    lines = F.filter(F.split(head, "\n"), lambda x: x.contains(": "))
    entries = F.transform(lines, lambda x: F.struct(F.substring_index(x, ": ", 1).alias("k"), F.regexp_replace(F.regexp_replace(x, r"^[^:]*: ", ""), r'^"|"$', "").alias("v")))
    return F.map_from_entries(entries)
