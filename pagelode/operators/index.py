"""Index tables from extracted pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions.folding import folded
from pagelode.operators.extract import table_lemmas


@dataclass(frozen=True)
class IndexTables:
    """Base tables of one run: link, wordrelation (postings) and backlinks."""

    links: DataFrame  # link_id, url, language, title
    postings: DataFrame  # word, link_id, weight
    edges: DataFrame  # link_id_from, url_to


def term_frequency(extracted: DataFrame, lemma_table: DataFrame | None = None) -> DataFrame:
    """(word, link_id, weight): one shuffle, of pages by their id.

    A page travels as its array of words and is counted where it arrives, in
    partitions that Spark sizes, so that no task holds the pairs of a whole input
    split. Steps that group by or join on link_id go on without another
    shuffle. With a lemma table, surface forms are counted, mapped, and summed again.
    """
    if lemma_table is None:
        pages = extracted.select("link_id", "words").repartition("link_id")
        tokens = pages.select("link_id", F.explode("words").alias("word"))
        return tokens.groupBy("word", "link_id").agg(F.count(F.lit(1)).alias("weight"))
    pages = extracted.select("link_id", "language", "words").repartition("link_id")
    tokens = pages.select("link_id", "language", F.explode("words").alias("word"))
    surface = tokens.groupBy("word", "link_id", "language").agg(F.count(F.lit(1)).alias("weight"))
    return (
        table_lemmas(surface, lemma_table)
        .groupBy("word", "link_id")
        .agg(F.sum("weight").alias("weight"))
    )


def with_content(extracted: DataFrame) -> DataFrame:
    """Pages with at least one content word; others get no row anywhere."""
    return extracted.where(F.size("words") > 0)


def link_rows(extracted: DataFrame) -> DataFrame:
    return with_content(extracted).select("link_id", "url", "language", "title")


def edge_rows(extracted: DataFrame) -> DataFrame:
    """Distinct (page, target); each page's repeats are removed in its row."""
    return with_content(extracted).select(
        F.col("link_id").alias("link_id_from"),
        F.explode(F.array_distinct("targets")).alias("url_to"),
    )


def followed_links(extracted: DataFrame) -> DataFrame:
    """Distinct targets to visit next; pages without content words count too."""
    return extracted.select(F.explode("targets").alias("url")).distinct()


def first_captures(extracted: DataFrame) -> DataFrame:
    """One row per URL, the one with the lowest link_id.

    The choice reads two narrow columns, combined on the map side, so a URL
    that fills a third of the table sends one row per task. The wide rows
    join on link_id, which is unique and cannot be hot.
    """
    first = extracted.groupBy("url").agg(F.min("link_id").alias("link_id"))
    return extracted.join(first.select("link_id"), "link_id", "left_semi")


def index_tables(extracted: DataFrame, lemma_table: DataFrame | None = None) -> IndexTables:
    """Tables of pages whose URLs are unique (see ``first_captures``)."""
    return IndexTables(
        links=link_rows(extracted),
        postings=term_frequency(extracted, lemma_table),
        edges=edge_rows(extracted),
    )


def page_length(postings: DataFrame) -> DataFrame:
    return postings.groupBy("link_id").agg(F.sum("weight").alias("page_length"))


def inlink_count(edges: DataFrame) -> DataFrame:
    """Backlinks per target; edges are unique, so a plain count is distinct."""
    return edges.groupBy("url_to").agg(F.count(F.lit(1)).alias("inlinks"))


def max_inlinks(edges: DataFrame) -> DataFrame:
    """Highest count over all targets, indexed or not."""
    return inlink_count(edges).agg(F.max("inlinks").alias("max_inlinks"))


def dictionary(postings: DataFrame) -> DataFrame:
    return postings.select("word").distinct()


def folded_dictionary(words: DataFrame, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Words equal but for case and accents as one row: (word, variants)."""
    return (
        words.withColumn("_key", F.collate("word", collation))
        .groupBy("_key")
        .agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("variants"))
        .drop("_key")
    )


def fold_keys(words: DataFrame) -> DataFrame:
    """(key, word): every word under its folded key."""
    return words.select(folded(F.col("word")).alias("key"), "word").distinct()


def folded_edges(edges: DataFrame) -> DataFrame:
    """Distinct links under the folded key of their target."""
    return edges.select("link_id_from", folded(F.col("url_to")).alias("url_to")).distinct()


def folded_tables(tables: IndexTables) -> IndexTables:
    """Index tables in which texts that differ in case and accents only are equal.

    Of pages whose URLs have the same key the one with the lowest link_id stays,
    with its URL as it is spelt; others are not indexed. Words become their
    keys and their counts on a page add up. A link leads to the page of its
    target's key, under the spelling of that page; to one that is not indexed
    it leads under the key.
    """
    named = tables.links.withColumn("_key", folded(F.col("url")))
    first = named.groupBy("_key").agg(F.min("link_id").alias("link_id"))
    kept = first.select("link_id")
    links = named.join(kept, "link_id", "left_semi")
    postings = (
        tables.postings.join(kept, "link_id", "left_semi")
        .groupBy(folded(F.col("word")).alias("word"), "link_id")
        .agg(F.sum("weight").alias("weight"))
    )
    edges = folded_edges(tables.edges.join(kept.withColumnRenamed("link_id", "link_id_from"), "link_id_from", "left_semi"))
    spelt = links.select(F.col("_key").alias("url_to"), "url")
    return IndexTables(
        links=links.drop("_key"),
        postings=postings,
        edges=edges.join(spelt, "url_to", "left").select(
            "link_id_from", F.coalesce("url", "url_to").alias("url_to")
        ),
    )


def index_outcomes(gated: DataFrame, extracted: DataFrame) -> DataFrame:
    """Run statistics (outcome, pages).

    ``gated`` holds link_id and the gate's verdict of every page received;
    ``extracted`` the pages that passed.
    """
    content = extracted.select(
        "link_id",
        F.when(F.size("words") > 0, "indexed").otherwise("no_content").alias("_content"),
    )
    return (
        gated.join(content, "link_id", "left")
        .groupBy(F.coalesce("_content", "verdict").alias("outcome"))
        .agg(F.count(F.lit(1)).alias("pages"))
    )
