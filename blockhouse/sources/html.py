"""SRC-11 (+ FLT-4/5/6, FN-18): holder rows from raw account-list pages.

Parsing is native regular expressions over the page text: first <table>, its
<tr> rows after the header row, the <td> cells of a row. No Python runs per
row; pages are independent, so the work is spread over the scan's partitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn

_TABLE = r"(?is)<table\b.*?</table>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
_SPAN_TARGET = r"""(?is)<span\b[^>]*\bdata-highlight-target\s*=\s*["']?([^"'\s>]*)"""


def holder_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of the first table after its header row, as a cell array, with
    their position (``row_no``) on the page."""
    table = F.regexp_extract(F.col(html), _TABLE, 0)
    rows = pages.select(*[c for c in pages.columns if c != html],
                        F.posexplode(F.regexp_extract_all(table, F.lit(_ROW), 1)).alias("row_no", "tr"))
    rows = rows.where(F.col("row_no") >= 1)                       # skip the header row
    return rows.withColumn("cells", F.regexp_extract_all(F.col("tr"), F.lit(_CELL), 1)).drop("tr")


def parse_holder_cells(rows: DataFrame, filtered: bool = True) -> DataFrame:
    """Cells -> (address, eth_balance, percentage). With ``filtered``: drop
    rows with fewer than 5 cells (FLT-4), an <img> in the third cell (FLT-5),
    or a non-blank name tag (FLT-6). Address = span attribute, else 'N/A'."""
    c = F.col("cells")
    out = rows
    if filtered:
        out = out.where(F.size(c) >= 5)
        out = out.where(~F.lower(c[2]).contains("<img"))
        out = out.where(fn.strip_tags(c[2]) == "")
    addr = fn.strip_text(F.regexp_extract(c[1], _SPAN_TARGET, 1))
    keep = [x for x in rows.columns if x != "cells"]
    return out.select(
        *keep,
        F.when(addr != "", addr).otherwise(F.lit("N/A")).alias("address"),
        fn.strip_tags(c[3]).alias("eth_balance"),
        fn.strip_tags(F.try_element_at(c, F.lit(5))).alias("percentage"),
        F.lower(F.coalesce(c[2], F.lit(""))).contains("<img").alias("has_img"),
        fn.strip_tags(F.coalesce(c[2], F.lit(""))).alias("name_tag"),
        F.size(c).alias("n_cells"),
        fn.strip_tags(c[0]).try_cast("bigint").alias("rank"),
    )


def extract_holder_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """SRC-11: filtered (address, eth_balance, percentage) per page row."""
    return parse_holder_cells(holder_cells(pages, html), filtered=True).drop("has_img", "name_tag", "n_cells", "rank")
