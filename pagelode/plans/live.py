"""An index that each batch of pages extends, searchable after every batch.

The base tables and the tables of search are kept as segments. A batch writes
its own postings, words and grams, and what it changes about pages stored
before: more words on them, more links to them. It looks up stored rows only in
the buckets of its own keys and rewrites none. A search adds the changes to the
postings it hits; merging segments folds them in.

Stored pages keep their title, language and counts; words and links not yet
stored are added, and the index time moves.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import words
from pagelode.functions.folding import folded
from pagelode.operators import extract as ex
from pagelode.operators import gates
from pagelode.operators import index as ix
from pagelode.operators import match
from pagelode.operators import search as se
from pagelode.plans.build import gated_pages
from pagelode.session import working
from pagelode.sources.segments import SegmentStore, Snapshot, Table

_SCORED = "language STRING, url STRING, page_length BIGINT, inlinks BIGINT"
TABLES = {
    # Base tables, placed by what a batch looks them up by.
    "link": Table("url STRING, link_id BIGINT", ("url",), "url"),
    "touched": Table("url STRING, indexed_at TIMESTAMP", ("url",), "url", "last"),
    "wordrelation": Table("link_id BIGINT, word STRING, weight BIGINT", ("link_id", "word"), "link_id"),
    "backlinks": Table("link_id_from BIGINT, url_to STRING", ("link_id_from", "url_to"), "link_id_from"),
    "inlinks": Table("url_to STRING, inlinks BIGINT", ("url_to",), "url_to", "sum"),
    # Tables of search. Scores are as of the segment that holds the row.
    "pages": Table(f"link_id BIGINT, title STRING, {_SCORED}", ("link_id",), "link_id"),
    "postings": Table(f"word STRING, link_id BIGINT, weight BIGINT, {_SCORED}", ("word", "link_id"), "word"),
    # What a segment adds to the scores of pages that older segments hold.
    "changes": Table("link_id BIGINT, page_length BIGINT, inlinks BIGINT", ("link_id",), "link_id", "sum"),
    "words": Table("word STRING", ("word",), "word", "set"),
    "grams": Table("gram STRING, word STRING", ("gram", "word"), "gram", "set"),
    "gram_counts": Table("gram STRING, words BIGINT", ("gram",), "gram", "sum"),
}


def live_store(spark: SparkSession, path: str, buckets: int = 64) -> SegmentStore:
    return SegmentStore(spark, path, TABLES, buckets)


def _with_changes(snapshot: Snapshot, found: DataFrame, pages: set[int] | None = None) -> DataFrame:
    """Rows of a table with scores, brought up to the last segment.

    A page has at most one change per live segment, of which there are few.
    ``pages`` are the buckets of the rows' pages, if known.
    """
    if not snapshot.count("changes"):
        return found.drop("segment")
    later = F.struct("segment", F.col("page_length").alias("length"), F.col("inlinks").alias("links"))
    changes = snapshot.scan("changes", pages).groupBy("link_id").agg(F.collect_list(later).alias("_changes"))
    # A change of the segment of a row, or of one before it, is in the row.
    new = F.filter(F.coalesce("_changes", F.array()), lambda c: c["segment"] > F.col("segment"))

    def added(field: str) -> Column:
        return F.aggregate(new, F.lit(0).cast("bigint"), lambda s, c: s + c[field])

    return (
        found.join(changes, "link_id", "left")
        .withColumn("page_length", F.col("page_length") + added("length"))
        .withColumn("inlinks", F.nullif(F.coalesce("inlinks", F.lit(0)) + added("links"), F.lit(0)))
        .select(*[c for c in found.columns if c != "segment"])
    )


def pages_of(snapshot: Snapshot, buckets: set[int] | None = None) -> DataFrame:
    """Stored pages with their present scores."""
    return _with_changes(snapshot, snapshot.scan("pages", buckets), buckets)


def search_index(snapshot: Snapshot) -> se.SearchIndex:
    """What search reads, as of a snapshot."""
    found = snapshot.scan("postings").select(*TABLES["postings"].names, "bucket", "segment")
    return se.SearchIndex(
        links=pages_of(snapshot),
        postings=_with_changes(snapshot, found),
        words=snapshot.rows("words").select("word"),
        grams=snapshot.rows("grams"),
        gram_counts=snapshot.rows("gram_counts").select("gram", "words"),
        pairs=F.lit(snapshot.count("postings")),
        max_inlinks=F.lit(max(snapshot.facts("max_inlinks"), default=None)).cast("bigint"),
        buckets=snapshot.store.buckets,
    )


def index_pages(
    store: SegmentStore,
    pages: DataFrame,
    batch_id: int,
    now: Column | datetime,
    ttl_seconds: int = 0,
    languages=words.LANGUAGES,
    lemma_table: DataFrame | None = None,
    fold: bool = False,
) -> Snapshot:
    """Index a batch of pages; the snapshot returned can be searched.

    Batches are numbered upwards. One that is not above the last committed one
    was committed before and changes nothing, so a batch may be run again.

    With ``fold``, words and URLs that differ in case and accents only are
    equal: words are stored as their keys, for queries that were folded too, and
    results show a URL as its page spelt it first. All batches of a store fold
    or none does.
    """
    base = store.snapshot()
    if base.segments and max(base.facts("fold"), default=0) != int(fold):
        raise ValueError("the batches before were folded differently")
    if base.last_batch is not None and batch_id <= base.last_batch:
        return base
    at = F.lit(now)
    key = folded if fold else (lambda text: text)
    with working(store.spark, "index-pages") as keep:
        accepted = gated_pages(pages)
        if ttl_seconds > 0:
            keyed = accepted.withColumn("_spelt", F.col("url")).withColumn("url", key(F.col("url")))
            times = base.at("touched", keyed, "url")
            accepted = gates.recrawl_due(keyed, times, at, ttl_seconds).withColumn("url", F.col("_spelt")).drop("_spelt")
        extracted = keep(ex.extract(accepted, languages, lemmatise=lemma_table is None), "extracted")
        # From here on ``url`` is the key of a page, and ``spelt`` what results show.
        extracted = extracted.withColumn("spelt", F.col("url")).withColumn("url", key(F.col("url")))
        if fold:
            extracted = extracted.withColumns(
                {"words": F.transform("words", folded), "targets": F.transform("targets", folded)}
            )
        extracted = ix.first_captures(ix.with_content(extracted))
        known = base.at("link", extracted, "url").select("url", F.col("link_id").alias("stored_id"))
        extracted = (
            extracted.join(known, "url", "left")
            .withColumn("again", F.col("stored_id").isNotNull())
            .withColumn("link_id", F.coalesce("stored_id", "link_id"))
            .drop("stored_id")
        )
        extracted = keep(extracted, "placed")
        again = extracted.where("again").select("link_id")
        tables = ix.index_tables(extracted, lemma_table)
        fresh = tables.links.join(again, "link_id", "left_anti")

        def unstored(rows: DataFrame, name: str) -> DataFrame:
            """Rows of pages stored before are looked up among the stored ones of these pages."""
            page = TABLES[name].placed_by
            ids = again.withColumnRenamed("link_id", page)
            old = base.at(name, ids, page).join(ids, page, "left_semi").select(*TABLES[name].key)
            return rows.join(old, list(TABLES[name].key), "left_anti")

        postings = keep(unstored(tables.postings, "wordrelation"), "postings")
        edges = keep(unstored(tables.edges, "backlinks"), "edges")
        targets = keep(ix.inlink_count(edges), "targets")
        lengths = ix.page_length(postings)

        # Links to the batch's targets and pages, those stored and those it adds.
        asked = targets.select("url_to").union(fresh.select(F.col("url").alias("url_to")))
        counted = base.at("inlinks", asked, "url_to").select("url_to", "inlinks").union(targets)
        totals = counted.groupBy("url_to").agg(F.sum("inlinks").alias("inlinks"))
        totals = keep(totals.join(asked.distinct(), "url_to", "left_semi"), "totals")
        most = totals.agg(F.max("inlinks")).first()[0]

        new_pages = (
            fresh.join(lengths, "link_id")
            .join(totals.select(F.col("url_to").alias("url"), "inlinks"), "url", "left")
            .join(extracted.select("link_id", "spelt"), "link_id")
            .withColumn("url", F.col("spelt"))
        )
        linked = (
            base.at("link", targets.select(F.col("url_to").alias("url")), "url")
            .join(targets.select(F.col("url_to").alias("url"), "inlinks"), "url")
            .select("link_id", F.lit(0).cast("bigint").alias("page_length"), "inlinks")
        )
        longer = lengths.join(again, "link_id", "left_semi").select(
            "link_id", "page_length", F.lit(0).cast("bigint").alias("inlinks")
        )
        changes = linked.union(longer).groupBy("link_id").agg(
            F.sum("page_length").alias("page_length"), F.sum("inlinks").alias("inlinks")
        )
        changes = keep(changes, "changes")
        # Pages stored before, with this batch's changes, for the words it adds to them.
        added = changes.select("link_id", F.col("page_length").alias("_length"), F.col("inlinks").alias("_links"))
        old_pages = (
            pages_of(base, store.buckets_of(again, "link_id"))
            .join(again, "link_id", "left_semi")
            .join(added, "link_id", "left")
            .withColumn("page_length", F.col("page_length") + F.coalesce("_length", F.lit(0)))
            .withColumn(
                "inlinks",
                F.nullif(F.coalesce("inlinks", F.lit(0)) + F.coalesce("_links", F.lit(0)), F.lit(0)),
            )
        )
        columns = TABLES["pages"].names
        new_pages = keep(new_pages.select(*columns), "pages")
        scored = new_pages.union(old_pages.select(*columns)).drop("title")
        dictionary = keep(ix.dictionary(postings), "words")
        grams = keep(match.word_grams(dictionary), "grams")
        return store.commit(
            base,
            {
                "link": fresh,
                "touched": extracted.select("url", at.cast("timestamp").alias("indexed_at")),
                "wordrelation": postings,
                "backlinks": edges,
                "inlinks": targets,
                "pages": new_pages,
                "postings": postings.join(scored, "link_id"),
                "changes": changes,
                "words": dictionary,
                "grams": grams,
                "gram_counts": match.gram_counts(grams),
            },
            batch_id,
            {"fold": int(fold)} | ({} if most is None else {"max_inlinks": most}),
        )


def _merged_changes(part: Snapshot, oldest: bool) -> DataFrame:
    """Changes of pages that are not in the merged segments themselves; those are folded in."""
    found = part.rows("changes")
    if oldest:
        return found.limit(0)
    return found.join(part.scan("pages").select("link_id"), "link_id", "left_anti")


def merge_segments(store: SegmentStore, everything: bool = False) -> Snapshot:
    """Merge the segments that are due, or all of them, and remove files no reader is left for."""
    base = store.snapshot()
    taken = base.segments if everything else store.due(base)
    if len(taken) < 2:
        return base
    own = {
        name: lambda part, _, name=name: _with_changes(
            part, part.scan(name).select(*TABLES[name].names, "segment")
        )
        for name in ("pages", "postings")
    }
    own["changes"] = _merged_changes
    own["gram_counts"] = lambda part, _: match.gram_counts(part.rows("grams"))
    merged = store.merge(base, taken, own, {"max_inlinks": max, "fold": max})
    store.vacuum()
    return merged
