"""Tables the registered queries share, derived from the given tables.

The given pages have no headers, index times or links among themselves; these
are derived by rules that SQL can state as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import urls, words
from pagelode.operators import extract as ex
from pagelode.operators import index as ix
from pagelode.operators import search as se
from pagelode.plans.build import index_batch
from pagelode.session import scratch_path
from pagelode.sources.pages import read_pages
from pagelode.sources.store import IndexStore

# The searches of the registered queries.
SEARCHES = (
    (1, "ther", "english", 0.6),
    (2, "erth", "english", 0.8),
    (3, "the", "english", 0.6),
    (4, "lich", "german", 0.6),
    (5, "keit", "german", 0.6),
    (6, "zzzzz", "english", 0.6),
    (7, "", "english", 0.6),
    (8, "+tion -ther", "english", 0.6),
)
NOW = "2024-01-31 00:00:00"
TTL_SECONDS = 21600

_indexes: dict[tuple[str, str], se.SearchIndex] = {}


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def typed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a content-type header, by the form of their URL."""
    kind = (
        F.when(F.col("url").endswith(".html"), "text/html; charset=utf-8")
        .when(F.contains("url", F.lit("?")), F.lit(None).cast("string"))
        .when(F.contains("url", F.lit("#")), "application/xhtml+xml")
        .otherwise("text/html")
    )
    return pages(spark, sf).withColumn("content_type", kind)


def event_micros() -> Column:
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")


def link_table(spark: SparkSession, sf: str) -> DataFrame:
    """(link_id, url, indexed_at): the last event of the user of the same id."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    last = events.groupBy(F.col("user_id").alias("page_id")).agg(
        F.max("ts").alias("indexed_at")
    )
    return (
        pages(spark, sf)
        .select("page_id", "url")
        .join(last, "page_id", "left")
        .select(F.col("page_id").alias("link_id"), "url", "indexed_at")
    )


def graph(spark: SparkSession, sf: str) -> DataFrame:
    """Backlinks among the pages: five links per page, dense at low ids."""
    nodes = pages(spark, sf).select("page_id", "url")
    n = nodes.agg(F.count(F.lit(1)).alias("n")).scalar()
    step = F.pmod(F.col("page_id") * 31 + F.col("j") * 17, F.col("n"))
    aimed = (
        nodes.select("page_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("j"))
        .withColumn("n", n)
        .select(
            F.col("page_id").alias("link_id_from"),
            F.floor(step * step / F.col("n")).cast("bigint").alias("page_id"),
        )
    )
    return (
        aimed.join(nodes, "page_id")
        .select("link_id_from", F.col("url").alias("url_to"))
        .distinct()
    )


def shouted_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The derived links, those of every other page in capitals."""
    odd = F.pmod(F.col("link_id_from"), F.lit(2)) == 1
    return graph(spark, sf).withColumn("url_to", F.when(odd, F.upper("url_to")).otherwise(F.col("url_to")))


def linked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose HTML holds the derived links as well."""
    anchor = F.concat(F.lit('<a href="'), "url_to", F.lit('"></a>'))
    more = graph(spark, sf).groupBy(F.col("link_id_from").alias("page_id")).agg(
        F.concat_ws("", F.array_sort(F.collect_list(anchor))).alias("more")
    )
    linked = pages(spark, sf).join(more, "page_id", "left")
    return linked.withColumn("html", F.concat("html", F.coalesce("more", F.lit("")))).drop("more")


def order_edges(spark: SparkSession, sf: str) -> DataFrame:
    """A larger edge list: order to part."""
    return (
        spark.read.parquet(f"{sf}/lineitem.parquet")
        .select(F.col("l_orderkey").alias("link_id_from"), F.col("l_partkey").cast("string").alias("url_to"))
        .distinct()
    )


def page_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return ex.page_words(ex.page_text(pages(spark, sf)))


def document_words(spark: SparkSession, sf: str) -> DataFrame:
    return ex.settled(
        spark.read.parquet(f"{sf}/documents.parquet").select(
            "doc_id", words.alphabetic_words(F.col("text")).alias("words")
        )
    )


def document_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return document_words(spark, sf).select(F.explode("words").alias("word")).distinct()


def extracted(spark: SparkSession, sf: str) -> DataFrame:
    """What the words of all pages give; links are left out."""
    return ex.extract(pages(spark, sf), links=False)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    return ix.term_frequency(extracted(spark, sf))


def lemma_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lemmas read off the corpus: a word in "ly" whose stem is a word too."""
    known = page_tokens(spark, sf).select(F.explode("words").alias("word")).distinct()
    derived = known.where(F.col("word").endswith("ly")).select(
        F.col("word").alias("surface"),
        F.expr("left(word, length(word) - 2)").alias("word"),
    )
    return derived.join(known, "word", "left_semi").select(
        F.lit("english").alias("lang"), "surface", F.col("word").alias("lemma")
    )


def start_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The lowest page of every host."""
    return (
        pages(spark, sf)
        .groupBy(urls.host(F.col("url")))
        .agg(F.min("page_id").alias("id"), F.min_by("url", "page_id").alias("url"))
        .select("id", "url")
    )


def allowed_domains(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of the German pages."""
    german = pages(spark, sf).where(F.contains("html", F.lit('<html lang="de">')))
    return german.groupBy(urls.host(F.col("url")).alias("domain")).agg(F.min("page_id").alias("id")).select(
        "id", "domain"
    )


def searches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SEARCHES, "query_id BIGINT, query STRING, language STRING, weight_tfidf DOUBLE"
    )


def build_index(spark: SparkSession, sf: str) -> se.SearchIndex:
    """The stored search index over all pages and the derived links."""
    store = IndexStore(spark, scratch_path(spark, "index"))
    index_batch(store, pages(spark, sf), 0, F.to_timestamp(F.lit(NOW)))
    tables = store.tables()
    return store.write_search(ix.IndexTables(tables.links, tables.postings, graph(spark, sf)))


def index(spark: SparkSession, sf: str) -> se.SearchIndex:
    """The index of a table folder, built once per session as a store would be."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = build_index(spark, sf)
    return _indexes[key]
