"""The ranking formula as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tf_idf(weight: Column, page_length: Column, pairs: Column, hit_pages: Column) -> Column:
    """Share of the page times ln(all word-page pairs / pages hit by the query)."""
    tf = F.try_divide(weight.cast("double"), page_length)
    return tf * F.ln(F.try_divide(pairs.cast("double"), hit_pages))


def backlink_score(inlinks: Column, max_inlinks: Column) -> Column:
    """ln(inlinks) / ln(max); NULL without inlinks or if the maximum is one."""
    return F.try_divide(F.ln(inlinks.cast("double")), F.ln(max_inlinks.cast("double")))


def blend(tfidf: Column, backlinks: Column, weight: Column) -> Column:
    """Weighted sum. NULL stays NULL, even at weight 1."""
    return tfidf * weight + (F.lit(1.0) - weight) * backlinks
