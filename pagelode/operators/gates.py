"""Filters a page passes before it is indexed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the content types that are indexed.
CONTENT_TYPES = ("text/html",)


def has_content_type(content_type: Column, patterns=CONTENT_TYPES) -> Column:
    """True if any pattern is found in the header; a missing header is False.

    An empty pattern list accepts every page.
    """
    if not patterns:
        return F.lit(True)
    found = reduce(Column.__or__, [content_type.rlike(p) for p in patterns])
    return F.coalesce(found, F.lit(False))


def is_due(indexed_at: Column, now: Column, ttl_seconds: int) -> Column:
    """True if never indexed or at least ``ttl_seconds`` ago."""
    return indexed_at.isNull() | (
        indexed_at <= now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    )


def index_times(pages: DataFrame, link: DataFrame) -> DataFrame:
    """Adds ``indexed_at`` of the page's URL, NULL for a URL not stored."""
    return pages.join(link.select("url", "indexed_at"), "url", "left")


def mime_filter(pages: DataFrame, patterns=CONTENT_TYPES) -> DataFrame:
    return pages.where(has_content_type(F.col("content_type"), patterns))


def recrawl_due(pages: DataFrame, link: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Pages to index again. Only the recently indexed URLs are matched.

    The stored side is filtered and narrowed to one column before the join.
    """
    recent = link.where(~is_due(F.col("indexed_at"), now, ttl_seconds)).select("url")
    return pages.join(recent, "url", "left_anti").select(*pages.columns)
