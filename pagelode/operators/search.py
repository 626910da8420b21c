"""Ranked search over index tables, for one query or a table of queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.functions import ranking
from pagelode.operators import index as ix
from pagelode.operators import match
from pagelode.session import materialize

# Row counts up to which a key set is read by the driver to prune the scan.
# Larger sets join instead, so no result depends on these bounds.
MAX_PRUNING_WORDS = 5_000
MAX_PRUNING_ROWS = 1_000
# Slices of a query's hits that are counted, ranked and cut apart from each other.
SLICES = 64


@dataclass(frozen=True)
class SearchIndex:
    """What search reads. Postings carry their page's score inputs and its URL,
    so ranks, and the order of equal or missing ones, need no join with the
    links; only rows of the result look up their title.

    ``buckets`` is set for stored tables, which are partitioned by the hash of
    their key: postings by word, grams by gram, links by link_id.
    """

    links: DataFrame  # link_id, url, language, title, page_length, inlinks
    postings: DataFrame  # word, link_id, weight, language, page_length, inlinks, url
    words: DataFrame  # word
    grams: DataFrame  # gram, word
    gram_counts: DataFrame  # gram, words
    pairs: Column  # number of word-page pairs
    max_inlinks: Column  # highest backlink count of any target
    buckets: int | None = None


def corpus_stats(postings: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: number of word-page pairs, highest backlink count."""
    pairs = postings.agg(F.count(F.lit(1)).alias("pairs"))
    return pairs.select("pairs", ix.max_inlinks(edges).scalar().alias("max_inlinks"))


def search_index(tables: ix.IndexTables) -> SearchIndex:
    """Adds what the formula needs per page, once, instead of per query."""
    links = (
        tables.links.join(ix.page_length(tables.postings), "link_id")
        .join(
            ix.inlink_count(tables.edges).withColumnRenamed("url_to", "url"), "url", "left"
        )
        .select("link_id", "url", "language", "title", "page_length", "inlinks")
    )
    scored = links.select("link_id", "language", "page_length", "inlinks", "url")
    words = ix.dictionary(tables.postings)
    grams = match.word_grams(words)
    return SearchIndex(
        links=links,
        postings=tables.postings.join(scored, "link_id").select(
            "word", "link_id", "weight", "language", "page_length", "inlinks", "url"
        ),
        words=words,
        grams=grams,
        gram_counts=match.gram_counts(grams),
        pairs=tables.postings.agg(F.count(F.lit(1))).scalar(),
        max_inlinks=ix.max_inlinks(tables.edges).scalar(),
    )


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bounded(df: DataFrame, bound: int) -> list | None:
    """All rows of ``df``, or None when there are more than ``bound``."""
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def _bucket(index: SearchIndex, key: str) -> Column:
    return bucket_of(F.col(key), index.buckets).alias("bucket")


def _is_in(column: str, values: set) -> Column:
    """Membership in a literal list, as one SQL text rather than a call per value."""

    def literal(value) -> str:
        if isinstance(value, int):
            return str(value)
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    if not values:
        return F.lit(False)
    return F.expr(f"{column} IN ({', '.join(map(literal, sorted(values)))})")


def _prune(table: DataFrame, key: str, rows: list) -> DataFrame:
    """Reads only the partitions that can hold the rows' keys, then those keys."""
    return table.where(_is_in("bucket", {row.bucket for row in rows})).where(
        _is_in(key, {row[key] for row in rows})
    )


def hits(index: SearchIndex, query: str, language: str) -> DataFrame:
    """Postings of matching words on pages of the language."""
    matched = match.match_words(index.words, query).select("word")
    rows = None
    if index.buckets:
        rows = _bounded(matched.select("word", _bucket(index, "word")), MAX_PRUNING_WORDS)
    if rows is None:
        found = index.postings.join(matched, "word")
    else:
        found = _prune(index.postings, "word", rows)
    return found.where(F.col("language") == language)


def _rank_column(
    index: SearchIndex, hit_pages: Column, weight: Column, missing_backlinks: str
) -> Column:
    score = ranking.backlink_score(F.col("inlinks"), index.max_inlinks)
    if missing_backlinks == "zero":
        score = F.coalesce(score, F.lit(0.0))
    tfidf = ranking.tf_idf(
        F.col("weight"), F.col("page_length"), index.pairs, hit_pages
    )
    return ranking.blend(tfidf, score, weight)


def _collapse(ranked: DataFrame, keys: list[str], how: str | None) -> DataFrame:
    """Optionally one row per page: its best or summed rank, its first word."""
    if how is None:
        return ranked
    agg = {"max": F.max, "sum": F.sum}[how]
    return ranked.groupBy(*keys, "link_id", "url").agg(
        F.min("word").alias("word"), agg("rank").alias("rank")
    )


SKETCH_BITS = 12


def page_sketches(postings: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(word, language, pages): a mergeable sketch of the pages of each word.

    Sketches of parts of the postings, such as batches, add up by
    ``merge_sketches``. The relative error of a count is about 1.04 divided by
    the root of 2 to the power of ``bits``, 1.6 percent by default, at one
    standard deviation; small counts are all but exact.
    """
    return postings.groupBy("word", "language").agg(F.hll_sketch_agg("link_id", bits).alias("pages"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("word", "language").agg(F.hll_union_agg("pages").alias("pages"))


def approximate_pages(sketches: DataFrame, queries: DataFrame, matched: DataFrame) -> DataFrame:
    """(query_id, pages): about how many pages each query hits, without reading postings.

    ``queries`` holds query_id and language, ``matched`` the words of each query
    (query_id, word). Queries without a hit have no row. An option: the ranking
    counts exactly.
    """
    asked = matched.join(queries.select("query_id", "language"), "query_id")
    found = sketches.join(asked, ["word", "language"])
    return found.groupBy("query_id").agg(F.hll_sketch_estimate(F.hll_union_agg("pages")).alias("pages"))


def _order() -> list[Column]:
    return [F.col("rank").desc_nulls_last(), F.col("url").asc(), F.col("word").asc()]


def _with_titles(index: SearchIndex, candidates: DataFrame) -> DataFrame:
    """Adds the title to result rows; few rows read only their buckets."""
    links = index.links.select("link_id", "title", *(["bucket"] if index.buckets else []))
    if not index.buckets:
        return candidates.join(links, "link_id")
    placed = candidates.withColumn("bucket", _bucket(index, "link_id"))
    rows = _bounded(placed, MAX_PRUNING_ROWS)
    if rows is None:
        return placed.join(links, ["bucket", "link_id"])
    few = links.sparkSession.createDataFrame(rows, placed.schema)
    return _prune(links, "link_id", rows).join(F.broadcast(few), ["bucket", "link_id"])


def search(
    index: SearchIndex,
    query: str,
    language: str,
    weight_tfidf: float = 0.6,
    page: int = 1,
    limit: int | None = 10,
    missing_backlinks: str = "null",
    collapse: str | None = None,
) -> DataFrame:
    """One page of results, best first: (title, url, rank, word).

    One row per matched word and page, so a URL can repeat; without backlinks
    the rank is NULL. ``missing_backlinks="zero"`` and ``collapse`` ("max" or
    "sum", one row per URL) change that. A page below 1 is page 1. Without a
    ``limit`` the first page holds all results.

    The postings alone decide which rows come up to the end of the page, so
    titles are looked up for those only.
    """
    if limit is None and page > 1:
        raise ValueError("without a limit there is one page")
    found = hits(index, query, language)
    hit_pages = found.agg(F.count_distinct("link_id").alias("n")).scalar()
    ranked = _collapse(
        found.select(
            "link_id",
            "url",
            "word",
            _rank_column(index, hit_pages, F.lit(weight_tfidf), missing_backlinks).alias("rank"),
        ),
        [],
        collapse,
    )
    if limit is None:
        return _with_titles(index, ranked).select("title", "url", "rank", "word").orderBy(*_order())
    wanted = max(page, 1) * limit
    rows = ranked.orderBy(*_order()).limit(wanted)
    return (
        _with_titles(index, rows)
        .select("title", "url", "rank", "word")
        .orderBy(*_order())
        .offset(wanted - limit)
        .limit(limit)
    )


def grams_of(index: SearchIndex, needed: DataFrame) -> DataFrame:
    """The stored grams that are needed; of too many to list, the buckets that can hold them."""
    placed = needed.select("gram", _bucket(index, "gram")).distinct()
    rows = _bounded(placed, MAX_PRUNING_WORDS)
    if rows is not None:
        return _prune(index.grams, "gram", rows)
    found = {row.bucket for row in placed.select("bucket").distinct().collect()}
    return index.grams.where(_is_in("bucket", found))


def query_hits(index: SearchIndex, queries: DataFrame) -> DataFrame:
    """Postings each query of a table hits; empty queries hit nothing.

    ``queries`` holds query_id, query, language and weight_tfidf. With a stored
    index the matched words are written once, as several steps read them; they
    prune the postings to their buckets, of which there is a fixed number. The
    join carries no hint: Spark knows the size of the written set, and a word
    that fills a third of the postings is split by the skew join.
    """
    asked = queries.where(F.col("query") != "")
    matched = match.match_queries(
        asked,
        index.grams,
        ["query_id"],
        counts=index.gram_counts,
        prune=(lambda needed: grams_of(index, needed)) if index.buckets else None,
    )
    terms = matched.join(
        asked.select("query_id", F.col("language").alias("_language"), "weight_tfidf"), "query_id"
    )
    if index.buckets:
        terms = materialize(terms.withColumn("bucket", _bucket(index, "word")), "matched")
        found = {row.bucket for row in terms.select("bucket").distinct().collect()}
        joined = index.postings.where(_is_in("bucket", found)).join(terms, ["bucket", "word"])
    else:
        joined = index.postings.join(terms, "word")
    return joined.where(F.col("language") == F.col("_language"))


def search_batch(
    index: SearchIndex,
    queries: DataFrame,
    page: int = 1,
    limit: int = 10,
    missing_backlinks: str = "null",
    collapse: str | None = None,
) -> DataFrame:
    """The page of results of every query: (query_id, pos, title, url, rank, word)."""
    rows = _batch_rows(index, queries, max(page, 1) * limit, limit, missing_backlinks, collapse)
    return _with_titles(index, rows).select("query_id", "pos", "title", "url", "rank", "word")


def _batch_rows(
    index: SearchIndex,
    queries: DataFrame,
    wanted: int,
    limit: int,
    missing_backlinks: str,
    collapse: str | None,
) -> DataFrame:
    """The last ``limit`` of the first ``wanted`` rows of every query, without titles.

    The hits are written once; counting and ranking read them. Both take each
    query in slices by page, so that a query with a third of all hits is many
    tasks, and only the rows a slice can add to the result leave it.
    """
    found = materialize(
        query_hits(index, queries).withColumn("_slice", F.pmod(F.xxhash64("link_id"), F.lit(SLICES))),
        "hits",
    )
    # Per slice the pages are counted exactly, as a page lies in one slice.
    hit_pages = (
        found.groupBy("query_id", "_slice", "link_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("query_id")
        .agg(F.count("one").alias("_hit_pages"))
        .withColumn("_slice", F.explode(F.expr(f"sequence(0L, {SLICES - 1}L)")))
    )
    ranked = _collapse(
        found.join(hit_pages, ["query_id", "_slice"]).select(
            "query_id",
            "_slice",
            "link_id",
            "url",
            "word",
            _rank_column(
                index, F.col("_hit_pages"), F.col("weight_tfidf"), missing_backlinks
            ).alias("rank"),
        ),
        ["query_id", "_slice"],
        collapse,
    )
    sliced = Window.partitionBy("query_id", "_slice").orderBy(*_order())
    cut = ranked.withColumn("_place", F.row_number().over(sliced)).where(F.col("_place") <= wanted)
    ordered = Window.partitionBy("query_id").orderBy(*_order())
    return (
        cut.withColumn("pos", F.row_number().over(ordered))
        .where((F.col("pos") <= wanted) & (F.col("pos") > wanted - limit))
        .select("query_id", "pos", "link_id", "url", "rank", "word")
    )
