"""Pages reached by following links from start pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators.links import allowed_links
from pagelode.session import materialize, scratch_path, working
from pagelode.sources.segments import SegmentStore, Snapshot, Table


def reachable_pages(
    start: DataFrame,
    link: DataFrame,
    edges: DataFrame,
    domains: DataFrame | None = None,
    max_levels: int | None = None,
) -> DataFrame:
    """(link_id, level) of all pages reached, level 0 being the start pages.

    ``link`` holds the pages that are accepted, (link_id, url); the links of
    others are not followed. Links are resolved to pages once, into a table of
    id pairs, where the skew join splits a page that a third of all links
    point to. Each level is written to the shared folder, which is also the
    set of pages seen: plans stay short, and a lost executor costs a re-read.
    Every page's links are followed once, so a cycle ends.
    """
    spark = link.sparkSession
    path = scratch_path(spark, "reach")
    pages = link.select("link_id", F.col("url").alias("url_to"))
    if domains is not None:
        edges = allowed_links(edges, domains)
    hops = materialize(
        edges.join(pages, "url_to").select("link_id_from", "link_id"), "hops"
    )
    frontier = (
        start.select(F.col("url").alias("url_to")).distinct().join(pages, "url_to").select("link_id")
    )
    level = 0
    while True:
        frontier.write.parquet(f"{path}/level={level}")
        seen = spark.read.schema("link_id BIGINT, level INT").parquet(path)
        reached = seen.where(F.col("level") == level).select(F.col("link_id").alias("link_id_from"))
        if reached.isEmpty() or level == max_levels:
            return seen
        frontier = (
            hops.join(reached, "link_id_from")
            .select("link_id")
            .distinct()
            .join(seen.select("link_id"), "link_id", "left_anti")
        )
        level += 1


# Reachability that grows with the link table

REACH = {
    "page": Table("url STRING, link_id BIGINT", ("url",), "url"),
    "edge": Table("url_to STRING, link_id_from BIGINT", ("url_to", "link_id_from"), "url_to"),
    "hop": Table("link_id_from BIGINT, link_id BIGINT", ("link_id_from", "link_id"), "link_id_from"),
    "start": Table("url STRING", ("url",), "url", "set"),
    "reached": Table("link_id BIGINT, level INT", ("link_id",), "link_id", "last"),
}


def reach_store(spark: SparkSession, path: str, buckets: int = 64) -> SegmentStore:
    return SegmentStore(spark, path, REACH, buckets)


def extend_reach(
    store: SegmentStore,
    pages: DataFrame,
    edges: DataFrame,
    start: DataFrame,
    batch_id: int,
    domains: DataFrame | None = None,
) -> Snapshot:
    """Add accepted pages (link_id, url), links (link_id_from, url_to) and start URLs.

    The stored rows ``reached`` then are those of ``reachable_pages`` over all
    that was added so far, under the same domains. New links may end at stored
    pages, new pages at stored links; from what either reaches, or reaches in
    fewer steps than before, the search goes on, level by level, along the hops
    in the buckets of the pages it is at. A batch committed before changes nothing.
    """
    base = store.snapshot()
    if base.last_batch is not None and batch_id <= base.last_batch:
        return base
    if domains is not None:
        edges = allowed_links(edges, domains)

    def fresh(name: str, rows: DataFrame) -> DataFrame:
        table = REACH[name]
        rows = rows.select(*table.names).dropDuplicates(list(table.key))
        return rows.join(base.at(name, rows, table.placed_by).select(*table.key), list(table.key), "left_anti")

    with working(store.spark, "reach") as keep:
        pages = keep(fresh("page", pages), "pages")
        edges = keep(fresh("edge", edges), "edges")
        start = keep(start.select("url").distinct(), "start")
        targets = edges.select(F.col("url_to").alias("url")).distinct()
        every_page = base.at("page", targets, "url").select("url", "link_id").union(pages.select("url", "link_id"))
        old_edges = base.at("edge", pages, "url").select("url_to", "link_id_from")
        hops = (
            edges.join(every_page.withColumnRenamed("url", "url_to"), "url_to")
            .union(old_edges.join(pages.withColumnRenamed("url", "url_to").select("url_to", "link_id"), "url_to"))
            .select("link_id_from", "link_id")
        )
        hops = keep(hops.distinct(), "hops")

        # Where the new rows lead from what is reached already.
        known = base.at("page", start, "url").select("url", "link_id")
        begun = (
            start.join(known.union(pages.select("url", "link_id")), "url")
            .union(base.at("start", pages, "url").select("url").join(pages.select("url", "link_id"), "url"))
            .select("link_id", F.lit(0).alias("level"))
        )
        from_reached = base.at("reached", hops.select(F.col("link_id_from").alias("link_id")), "link_id").select(
            F.col("link_id").alias("link_id_from"), (F.col("level") + 1).alias("level")
        )
        offered = begun.union(hops.join(from_reached, "link_id_from").select("link_id", "level"))
        found = None
        step = 0
        while True:
            best = keep(offered.groupBy("link_id").agg(F.min("level").alias("level")), f"offered-{step}")
            before = base.at("reached", best, "link_id").select("link_id", "level")
            if found is not None:
                before = before.union(found)
            before = before.groupBy("link_id").agg(F.min("level").alias("_before"))
            better = best.join(before, "link_id", "left").where("_before is null or level < _before")
            better = keep(better.select("link_id", "level"), f"better-{step}")
            if better.isEmpty():
                break
            found = better if found is None else found.union(better)
            ahead = base.at("hop", better, "link_id").select("link_id_from", "link_id").union(hops)
            at = better.select(F.col("link_id").alias("link_id_from"), (F.col("level") + 1).alias("level"))
            offered = ahead.join(at, "link_id_from").select("link_id", "level")
            step += 1
        rows = {"page": pages, "edge": edges, "hop": hops, "start": start}
        if found is not None:
            rows["reached"] = found.groupBy("link_id").agg(F.min("level").alias("level"))
        return store.commit(base, rows, batch_id)
