"""Filters on link targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions import urls

# Domain lists up to this size become a literal set; longer ones are joined.
MAX_LITERAL_DOMAINS = 10_000


def allowed_links(
    links: DataFrame, domains: DataFrame, url: str = "url_to", literal_bound: int = MAX_LITERAL_DOMAINS
) -> DataFrame:
    """Links whose host is an allowed domain or a subdomain of one.

    An empty list allows every link.
    """
    listed = domains.select(F.lower(F.trim("domain")).alias("domain")).distinct()
    rows = listed.limit(literal_bound + 1).collect()
    if not rows:
        return links
    if len(rows) <= literal_bound:
        allowed = [row.domain for row in rows]
        return links.where(
            F.exists(urls.host_suffixes(urls.host(F.col(url))), lambda s: s.isin(allowed))
        )
    # Suffixes are taken per distinct host, so a host with a third of all
    # links sends one row per task here and stays unexploded below.
    hosted = links.withColumn("_host", urls.host(F.col(url)))
    hosts = hosted.select("_host").distinct()
    kept = (
        hosts.select("_host", F.explode(urls.host_suffixes(F.col("_host"))).alias("domain"))
        .join(listed, "domain", "left_semi")
        .select("_host")
        .distinct()
    )
    return hosted.join(kept, "_host", "left_semi").select(*links.columns)


def new_urls(targets: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct target URLs that were not seen yet."""
    return targets.select("url").distinct().join(seen.select("url"), "url", "left_anti")
