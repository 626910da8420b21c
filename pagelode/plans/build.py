"""Index build: the same code for a whole page table and for a stream batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import words
from pagelode.operators import extract as ex
from pagelode.operators import gates
from pagelode.operators import index as ix
from pagelode.session import materialize
from pagelode.sources.store import IndexStore


def gated_pages(pages: DataFrame, patterns=gates.CONTENT_TYPES) -> DataFrame:
    """Pages that pass the content-type gate; skipped where no header is stored."""
    if "content_type" not in pages.columns:
        return pages
    return gates.mime_filter(pages, patterns)


def build_tables(
    pages: DataFrame,
    languages=words.LANGUAGES,
    lemma_table: DataFrame | None = None,
    unique_urls: bool = False,
) -> ix.IndexTables:
    """Index tables of a page table, for callers that keep no store.

    The HTML is read once, here; the tables are lazy over what was extracted.
    """
    extracted = materialize(
        ex.extract(gated_pages(pages), languages, lemmatise=lemma_table is None), "extract"
    )
    if not unique_urls:
        extracted = ix.first_captures(extracted)
    return ix.index_tables(extracted, lemma_table)


def index_batch(
    store: IndexStore,
    pages: DataFrame,
    batch_id: int,
    now: Column | datetime,
    ttl_seconds: int = 0,
    mode: str = "keep_first",
    languages=words.LANGUAGES,
    lemma_table: DataFrame | None = None,
) -> DataFrame:
    """Index a batch of pages into the store and return the links to follow.

    ``keep_first``: a stored page keeps its title, language and counts; words
    and links not yet stored are added. ``replace``: the batch stores whole
    pages, and ``store.tables(latest_only=True)`` reads the last version.
    Either way the index time moves to ``now``.

    The HTML is read once, into a narrow table in the shared folder that all
    later steps read. A key is looked up in stored words and links only for
    pages stored before.
    """
    if mode not in ("keep_first", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    stored = store.link(before=batch_id)
    at = F.lit(now)
    accepted = gated_pages(pages)
    if ttl_seconds > 0:
        accepted = gates.recrawl_due(accepted, stored, at, ttl_seconds)
    extracted = materialize(
        ex.extract(accepted, languages, lemmatise=lemma_table is None), "extract"
    )
    captures = extracted.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not captures.isEmpty():
        extracted = ix.first_captures(extracted)
    known = stored.groupBy("url").agg(F.min("link_id").alias("stored_id"))
    again = materialize(
        extracted.select("link_id", "url").join(known, "url").select("link_id", "stored_id"), "again"
    )
    first_time = again.isEmpty()
    if not first_time:
        extracted = (
            extracted.join(again, "link_id", "left")
            .withColumn("link_id", F.coalesce("stored_id", "link_id"))
            .drop("stored_id")
        )
    tables = ix.index_tables(extracted, lemma_table)
    links, postings, edges = tables.links, tables.postings, tables.edges
    if mode == "keep_first" and not first_time:
        ids = again.select(F.col("stored_id").alias("link_id"))
        links = links.join(ids, "link_id", "left_anti")
        postings = _unstored(
            postings, store.base("wordrelation", batch_id), ids, ["word", "link_id"]
        )
        edges = _unstored(
            edges,
            store.base("backlinks", batch_id),
            ids.withColumnRenamed("link_id", "link_id_from"),
            ["link_id_from", "url_to"],
        )
    store.write_batch("link", links, batch_id)
    store.write_batch("wordrelation", postings, batch_id)
    store.write_batch("backlinks", edges, batch_id)
    # In replace mode a page that lost its content is touched too, so that its
    # last version is the empty one.
    seen = extracted if mode == "replace" else ix.with_content(extracted)
    touched = seen.select("link_id", at.alias("indexed_at"))
    store.write_batch("touched", touched, batch_id)
    return ix.followed_links(extracted)


def _unstored(rows: DataFrame, table: DataFrame, again: DataFrame, key: list[str]) -> DataFrame:
    page = next(c for c in key if c.startswith("link_id"))
    old = table.join(again, page, "left_semi").select(*key)
    return rows.join(old, key, "left_anti")
