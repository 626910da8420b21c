"""Index build: batch, repeated, streamed, and gated."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelode.operators import extract as ex
from pagelode.operators import gates
from pagelode.operators import index as ix
from pagelode.plans.build import build_tables, index_batch
from pagelode.sources.pages import stream_pages
from pagelode.sources.store import IndexStore
from pagelode.streaming.index_stream import stream_index

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
PAGES = "page_id BIGINT, url STRING, html STRING, content_type STRING, fetched_at TIMESTAMP"


def page(i, url, body, title="apple", kind="text/html"):
    head = "" if title is None else f"<title>{title}</title>"
    return (i, url, f"<html>{head}<body>{body}</body></html>", kind, DAY1)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PAGES)


def posting_set(tables):
    return {(r.word, r.link_id, r.weight) for r in tables.postings.collect()}


def link_set(tables):
    return {(r.link_id, r.url, r.title) for r in tables.links.collect()}


def edge_set(tables):
    return {(r.link_id_from, r.url_to) for r in tables.edges.collect()}


def test_counts_and_corner_pages(spark):
    pages = frame(
        spark,
        page(1, "http://a.b/x", 'apple <a href="/l">pear</a><a href="/l">pear</a><a href="tel:1">9</a>'),
        page(2, "http://a.b/y", 'the and 123 <a href="/z">4</a>', title=None),
        page(3, "http://a.b/n", "plum", title=None),
        page(4, "http://a.b/p", "plum", kind="application/pdf"),
        page(5, "http://a.b/q", "plum", kind=None),
        page(9, "http://a.b/x", "second capture"),
    )
    tables = build_tables(pages)
    assert posting_set(tables) == {("apple", 1, 3), ("pear", 1, 2), ("plum", 3, 1)}
    assert link_set(tables) == {(1, "http://a.b/x", "apple"), (3, "http://a.b/n", None)}
    assert edge_set(tables) == {(1, "http://a.b/l")}
    followed = ix.followed_links(ex.extract(gates.mime_filter(pages))).collect()
    assert {r.url for r in followed} == {"http://a.b/l", "http://a.b/z"}


def test_base_href(spark):
    pages = frame(spark, page(1, "http://a.b/c/d", '<base href="/e/"><a href="f?x=1&amp;y=2">w</a>'))
    assert edge_set(build_tables(pages)) == {(1, "http://a.b/e/f?x=1&y=2")}


def test_language_choice(spark):
    rows = [
        (1, ["the", "house", "and", "was"]),
        (2, ["der", "hund", "und", "nicht"]),
        (3, ["xyz"]),
    ]
    df = spark.createDataFrame(rows, "id INT, words ARRAY<STRING>")
    got = {r.id: (r.language, r.words) for r in ex.content_words(ex.detect_language(df)).collect()}
    assert got == {1: ("english", ["house"]), 2: ("german", ["hund"]), 3: ("unknown", ["xyz"])}


def test_lemma_table_merges_counts(spark):
    table = spark.createDataFrame(
        [("english", "mice", "mouse")], "lang STRING, surface STRING, lemma STRING"
    )
    pages = frame(spark, page(1, "u", "mice mouse mice cats", title=None))
    assert posting_set(build_tables(pages, lemma_table=table)) == {("mouse", 1, 3), ("cat", 1, 1)}


FIRST = [
    page(1, "http://a.b/x", 'apple <a href="/l">pear</a>'),
    page(2, "http://a.b/y", "plum"),
]
AGAIN = [
    page(7, "http://a.b/x", 'apple apple kiwi <a href="/m">fig</a>', title="newer"),
    page(8, "http://a.b/z", "date", title=None),
]


def test_index_twice_changes_only_the_time(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"))
    index_batch(store, frame(spark, *FIRST), 0, DAY1)
    before = store.tables()
    sets = posting_set(before), link_set(before), edge_set(before)
    index_batch(store, frame(spark, *FIRST), 1, DAY2)
    after = store.tables()
    assert (posting_set(after), link_set(after), edge_set(after)) == sets
    assert {r.indexed_at for r in store.link().collect()} == {DAY2}


def test_keep_first_adds_only_new_keys(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"))
    index_batch(store, frame(spark, *FIRST), 0, DAY1)
    for _ in range(2):  # the second run repeats the batch
        index_batch(store, frame(spark, *AGAIN), 1, DAY2)
    tables = store.tables()
    assert posting_set(tables) == {
        ("apple", 1, 3), ("pear", 1, 1), ("apple", 2, 2), ("plum", 2, 1),
        ("newer", 1, 2), ("kiwi", 1, 1), ("fig", 1, 1), ("date", 8, 1),
    }
    assert link_set(tables) == {
        (1, "http://a.b/x", "apple"), (2, "http://a.b/y", "apple"), (8, "http://a.b/z", None),
    }
    assert edge_set(tables) == {(1, "http://a.b/l"), (1, "http://a.b/m")}
    times = {r.link_id: r.indexed_at for r in store.link().collect()}
    assert times == {1: DAY2, 2: DAY1, 8: DAY2}


def test_replace_keeps_the_last_version(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"))
    index_batch(store, frame(spark, *FIRST), 0, DAY1, mode="replace")
    index_batch(store, frame(spark, *AGAIN), 1, DAY2, mode="replace")
    tables = store.tables(latest_only=True)
    assert link_set(tables) == {
        (1, "http://a.b/x", "newer"), (2, "http://a.b/y", "apple"), (8, "http://a.b/z", None),
    }
    assert edge_set(tables) == {(1, "http://a.b/m")}
    assert ("apple", 1, 2) in posting_set(tables) and ("pear", 1, 1) not in posting_set(tables)


def test_replace_forgets_a_page_that_lost_its_content(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    two = (page(1, "http://a.b/x", "pear"), page(2, "http://a.b/y", "plum"))
    index_batch(store, frame(spark, *two), 0, DAY1, mode="replace")
    index_batch(store, frame(spark, page(1, "http://a.b/x", "123", title=None)), 1, DAY2, mode="replace")
    tables = store.tables(latest_only=True)
    assert {r.link_id for r in tables.links.collect()} == {2}
    assert {w for w, _, _ in posting_set(tables)} == {"plum", "apple"}


def test_recent_pages_are_skipped(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"))
    index_batch(store, frame(spark, *FIRST), 0, DAY1)
    index_batch(store, frame(spark, *AGAIN), 1, DAY2, ttl_seconds=86401)
    assert ("kiwi", 1, 1) not in posting_set(store.tables())
    index_batch(store, frame(spark, *AGAIN), 2, DAY2, ttl_seconds=86400)
    assert ("kiwi", 1, 1) in posting_set(store.tables())


def test_stream_equals_batch(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr(
        "*", "'text/html' content_type", "timestamp'2024-01-01' fetched_at"
    )
    folder = str(tmp_path / "in")
    pages.repartition(3).write.parquet(folder)
    run = stream_index(
        stream_pages(spark, folder, files_per_batch=1),
        str(tmp_path / "stream"),
        str(tmp_path / "checkpoint"),
        lambda batch: DAY1,
    )
    run.awaitTermination()
    streamed = IndexStore(spark, str(tmp_path / "stream"))
    assert streamed.base("touched").select("batch_id").distinct().count() == 3
    batch = IndexStore(spark, str(tmp_path / "batch"))
    index_batch(batch, pages, 0, DAY1)
    one, other = batch.tables(), streamed.tables()
    assert posting_set(one) == posting_set(other)
    assert link_set(one) == link_set(other)
    assert edge_set(one) == edge_set(other)


def test_term_shares_add_up(spark):
    postings = ix.term_frequency(ex.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")))
    shares = (
        postings.join(ix.page_length(postings), "link_id")
        .groupBy("link_id")
        .agg(F.sum(F.col("weight") / F.col("page_length")).alias("s"))
    )
    assert all(r.s == pytest.approx(1.0) for r in shares.collect())


def test_plans(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = ix.term_frequency(ex.extract(pages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Python" not in plan and "ReadSchema: struct<page_id:bigint,url" in plan


def test_mime_patterns(spark):
    values = ["text/html", "text/html; charset=x", "application/xhtml+xml", None]
    df = spark.createDataFrame([(v,) for v in values], "content_type STRING")
    kept = [r.content_type for r in gates.mime_filter(df).collect()]
    assert kept == values[:2]
    assert gates.mime_filter(df, ("xhtml", "^text")).count() == 3
    assert gates.mime_filter(df, ()).count() == 4


def test_words_alone_look_for_no_links(spark):
    pages = frame(spark, page(1, "http://a.b/x", 'apple <a href="/l">pear</a>'), page(2, "http://a.b/y", "plum"))
    alone, whole = ex.extract(pages, links=False), ex.extract(pages)
    assert "targets" not in alone.columns
    assert sorted(alone.collect()) == sorted(whole.drop("targets").collect())
    assert "href" not in alone._jdf.queryExecution().optimizedPlan().toString().lower()


def test_pages_are_shuffled_once_for_all_their_words(spark, tmp_path):
    """No task counts the words of a whole input split; lengths and folded words need no other shuffle."""
    rows = [(1, "u1", None, "english", ["Ab", "b", "ab"], []), (1, "u1", None, "english", ["b"], [])]
    rows += [(None, "u2", None, "english", ["b"], []), (None, "u3", None, "german", ["b"], []), (3, "u4", None, "german", [], [])]
    kind = "link_id BIGINT, url STRING, title STRING, language STRING, words ARRAY<STRING>, targets ARRAY<STRING>"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/extracted")
    counted = ix.term_frequency(spark.read.parquet(f"{tmp_path}/extracted"))
    got = {(r.word, r.link_id): r.weight for r in counted.collect()}
    assert got == {("Ab", 1): 1, ("ab", 1): 1, ("b", 1): 2, ("b", None): 2}
    for table in (counted.select("*"), ix.page_length(counted)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(link_id#" in plan
        assert plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange") :]
