"""Rows of HTML tables in a table of pages -> typed daily OHLC rows.

Column expressions and windows over a page's tokens; no page is parsed on the
driver. The tags that matter are read as a stack machine would: a running sum of
<table> and </table> is the depth; at one depth the tables, their rows and the cells
of a row are running counts of their start tags. So end tags of rows and cells may
be left out, and a table nested in a cell has rows of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.scalar import parse_day, parse_money

OHLC_COLS = ("open", "high", "low", "close", "value", "market_cap")
TOKENS = r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|<[^>]*>|[^<]+|<"


def table_cells(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "currency")) -> DataFrame:
    """keep..., row_no (of the <tr> in its page, from 0), depth (1: not nested), cells:
    the texts of the row's <td> without tags, trimmed, and n_headers, the number of
    its <th>. Rows without a cell are left out."""
    # a page is numbered before it is cut up: repeated pages stay apart
    rows = pages.withColumn("_page", F.monotonically_increasing_id()).select("_page", *keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(TOKENS), F.lit(0))).alias("_i", "_x"))
    name = F.lower(F.regexp_extract("_x", r"^<(/?[a-zA-Z]+)(?=[\s/>])", 1))
    rows = rows.withColumn("_tag", F.when(F.substring("_x", 1, 1) == "<", name).otherwise("text"))
    rows = rows.filter(F.col("_tag").isin("text", "table", "/table", "tr", "/tr", "td", "/td", "th", "/th"))
    is_ = lambda *tags: F.col("_tag").isin(*tags)
    so_far = lambda *by: Window.partitionBy(*by).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda tag, *by: F.sum(is_(*tag).cast("long")).over(so_far(*by))
    # an end without a start closes nothing: the depth is the sum above its lowest point so far
    step = F.when(is_("table"), 1).when(is_("/table"), -1).otherwise(0)
    rows = rows.withColumns({"_sum": F.sum(step).over(so_far("_page")), "_tr": count(("tr",), "_page")})
    low = F.least(F.lit(0), F.min("_sum").over(so_far("_page")))
    rows = rows.withColumn("depth", F.col("_sum") - low).filter("depth > 0")
    rows = rows.withColumn("_table", count(("table",), "_page", "depth"))
    at = ("_page", "depth", "_table")
    rows = rows.withColumns({
        "_row": F.max(F.when(is_("tr"), F.col("_tr"))).over(so_far(*at)),
        # the last start or end of a cell or row says whether text lies in a cell
        "_in": F.last(F.when(~is_("text", "table", "/table"), F.col("_tag")), ignorenulls=True).over(so_far(*at)),
        "_cell": count(("td", "th"), *at),
    })
    rows = rows.filter("_row is not null and _in in ('td', 'th') and _tag in ('text', 'td', 'th')")
    pieces = F.transform(F.array_sort(F.collect_list(F.when(is_("text"), F.struct("_i", "_x")))), lambda p: p["_x"])
    cells = rows.groupBy("_page", *keep, "depth", "_table", "_row", "_cell").agg(
        F.trim(F.array_join(pieces, "")).alias("t"), F.first("_in").alias("kind"))
    own = F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "td", F.struct("_cell", "t")))), lambda c: c["t"])
    return cells.groupBy("_page", *keep, "depth", "_table", "_row").agg(own.alias("cells"), F.count_if(F.col("kind") == "th").alias("n_headers")).select(
        *keep, (F.col("_row") - 1).cast("int").alias("row_no"), "depth", "cells", "n_headers")


def _typed(cells: DataFrame, ncols: int, keep: tuple[str, ...], day_format: str) -> tuple[list[Column], Column]:
    day = parse_day(F.get("cells", F.lit(0)), day_format)
    values = [parse_money(F.get("cells", F.lit(i + 1))).alias(c) for i, c in enumerate(OHLC_COLS[:ncols - 1])]
    return [*[F.col(c) for c in keep], F.col("row_no"), day.alias("day"), *values], F.size("cells") == ncols


def html_table_rows(
    pages: DataFrame,
    html: str = "html",
    ncols: int = 7,
    keep: tuple[str, ...] = ("page_id", "currency"),
    day_format: str = "MMM d, yyyy",
) -> DataFrame:
    """One output row per table row with exactly ``ncols`` <td> cells (header rows
    use <th> and are skipped): keep..., row_no, day, then ``OHLC_COLS`` as doubles
    ('$' and ',' removed)."""
    cells = table_cells(pages, html, keep)
    columns, fits = _typed(cells, ncols, keep, day_format)
    return cells.filter(fits).select(*columns)


def html_table_rejects(pages: DataFrame, html: str = "html", ncols: int = 7, keep: tuple[str, ...] = ("page_id", "currency"),
                       day_format: str = "MMM d, yyyy") -> DataFrame:
    """keep..., rows, accepted, other_width, no_day: how many table rows with <td>
    cells each page has, how many ``html_table_rows`` returns with a readable day, how
    many it leaves out for their number of cells, and how many come without a day."""
    cells = table_cells(pages, html, keep).filter(F.size("cells") > 0)
    _, fits = _typed(cells, ncols, keep, day_format)
    dated = parse_day(F.get("cells", F.lit(0)), day_format).isNotNull()
    return cells.groupBy(*keep).agg(F.count("*").alias("rows"), F.count_if(fits & dated).alias("accepted"),
                                    F.count_if(~fits).alias("other_width"), F.count_if(fits & ~dated).alias("no_day"))
