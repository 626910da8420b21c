"""Segment stores and the live index against whole builds."""

from __future__ import annotations

import re
from datetime import datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from pagelode.functions.folding import folded, folded_text
from pagelode.operators import index as ix
from pagelode.operators import search as se
from pagelode.plans import build, live
from pagelode.plans import fixtures as fx
from pagelode.plans.queries import REGISTERED as QUERIES
from pagelode.session import scratch_path, working
from pagelode.sources import files
from pagelode.sources.segments import SegmentStore, Snapshot, Table
from pagelode.sources.store import IndexStore

FOLDER = "/root/testdata/sf0.001"
NOW = datetime(2024, 1, 31)
TABLES = {
    "link": Table("url STRING, link_id BIGINT", ("url",), "url"),
    "edge": Table("link_from BIGINT, url_to STRING", ("link_from", "url_to"), "link_from"),
    "seen": Table("url STRING, at BIGINT", ("url",), "url", "last"),
    "hits": Table("url STRING, n BIGINT", ("url",), "url", "sum"),
}


@pytest.fixture
def store(spark):
    return SegmentStore(spark, scratch_path(spark, "segments"), TABLES, buckets=4)


def rows(spark, name, *values):
    return spark.createDataFrame(list(values), TABLES[name].columns)


def told(df):
    return sorted(tuple(r)[:-1] for r in df.collect())


def test_kinds_add_up(spark, store):
    base = store.snapshot()
    assert (base.version, told(base.rows("link")), base.last_batch) == (0, [], None)
    one = store.commit(
        base,
        {"link": rows(spark, "link", ("a", 1), ("b", 2)), "seen": rows(spark, "seen", ("a", 5)), "hits": rows(spark, "hits", ("a", 1))},
        batch_id=7,
    )
    two = store.commit(one, {"seen": rows(spark, "seen", ("a", 3), ("b", 4)), "hits": rows(spark, "hits", ("a", 2))}, 8)
    for snapshot in (two, store.snapshot(), SegmentStore(spark, store.path, TABLES, buckets=99).snapshot()):
        assert told(snapshot.rows("link")) == [("a", 1), ("b", 2)]
        assert told(snapshot.rows("seen")) == [("a", 3), ("b", 4)]
        assert told(snapshot.rows("hits")) == [("a", 3)]
        assert (snapshot.last_batch, snapshot.store.buckets) == (8, 4)
    # An older snapshot reads what it read before.
    assert told(one.rows("seen")) == [("a", 5)]
    assert told(two.at("link", rows(spark, "link", ("a", 0)), "url")) in ([("a", 1)], [("a", 1), ("b", 2)])


def test_a_failed_commit_is_not_seen(spark, store):
    one = store.commit(store.snapshot(), {"link": rows(spark, "link", ("a", 1))})
    broken = rows(spark, "link", ("b", 2)).withColumn("link_id", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.commit(one, {"hits": rows(spark, "hits", ("a", 1)), "link": broken})
    assert store.snapshot().version == 1 and store.snapshot().count("hits") == 0
    # A manifest that was not completed is not seen either, and written again.
    store.commit(one, {"link": rows(spark, "link", ("b", 2))})
    files.remove(spark, f"{store.path}/manifest/v2/_SUCCESS")
    assert told(store.snapshot().rows("link")) == [("a", 1)]
    two = store.commit(store.snapshot(), {"link": rows(spark, "link", ("c", 3))})
    assert told(two.rows("link")) == [("a", 1), ("c", 3)]
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(one, {"link": rows(spark, "link", ("d", 4))})


def test_inserts_deletes_and_references(spark, store):
    base = store.commit(store.snapshot(), {"link": rows(spark, "link", ("a", 1), ("b", 2), ("c", 3))})
    new = spark.createDataFrame([(1, "b", 0), (1, "b", 1), (9, "b", 2)], "link_from BIGINT, url_to STRING, pos BIGINT")
    edges = store.insert_ignore(base, "edge", new, "pos", [("link", "link_id", "link_from"), ("link", "url", "url_to")])
    base = store.commit(base, {"edge": edges})
    assert told(base.rows("edge")) == [(1, "b")]
    again = new.withColumn("link_from", F.lit(2).cast("bigint")).union(new)
    assert store.insert_ignore(base, "edge", again, "pos", [("link", "link_id", "link_from")]).collect() == [(2, "b")]

    doomed = rows(spark, "link", ("a", 0), ("b", 0), ("z", 0))
    gone = store.deletions(base, "link", doomed, [("edge", "url_to")])
    base = store.commit(base, gone)
    # b is still linked to, z was never there.
    assert told(base.rows("link")) == [("b", 2), ("c", 3)]
    back = spark.createDataFrame([("a", 7, 0), ("c", 8, 0)], "url STRING, link_id BIGINT, pos BIGINT")
    base = store.commit(base, {"link": store.insert_ignore(base, "link", back, "pos")})
    assert told(base.rows("link")) == [("a", 7), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError, match="neighbours"):
        store.merge(base, base.segments[::2])
    for first in (1, 0):
        merged = store.merge(base, base.segments[first:])
        assert told(merged.rows("link")) == [("a", 7), ("b", 2), ("c", 3)]
        assert told(merged.rows("edge")) == [(1, "b")]
        base = merged
    assert len(base.segments) == 1 and base.count("link_gone") == 0
    store.vacuum(keep=1)
    assert files.children(spark, f"{store.path}/data") == [base.segments[0].folder]
    assert told(store.snapshot().rows("link")) == [("a", 7), ("b", 2), ("c", 3)]


def test_few_segments_stay_live(spark, store):
    snapshot = store.snapshot()
    for i in range(9):
        snapshot = store.commit(snapshot, {"hits": rows(spark, "hits", (f"u{i}", i))}, i)
        snapshot = store.merge(snapshot, store.due(snapshot))
    assert [s.size for s in snapshot.segments] == [8, 1]
    assert snapshot.last_batch == 8 and snapshot.count("hits") == 9


def test_working_tables_are_removed(spark):
    with working(spark, "block") as keep:
        df = keep(spark.range(3), "a")
        path = re.sub("/a/[^/]*$", "", df.inputFiles()[0])
        assert df.count() == 3 and files.exists(spark, path)
    assert not files.exists(spark, path)


# The live index


def whole_index(spark, batches):
    """What an index built at once from all batches holds, batch by batch."""
    store = IndexStore(spark, scratch_path(spark, "whole"))
    for i, batch in enumerate(batches):
        build.index_batch(store, batch, i, NOW)
    return store.write_search(store.tables())


@pytest.fixture(scope="module")
def deliveries(spark):
    pages = fx.linked_pages(spark, FOLDER).select("page_id", "url", "html")
    more = pages.withColumn(
        "html", F.concat("html", F.lit('<p>zzzq therzzz</p><a href="/new"></a><a href="http://thther.example.com/en/54?utm_source=feed"></a>'))
    )
    odd = spark.createDataFrame(
        [(9001, "http://odd.example.com/", None), (9002, "http://odd.example.com/a", "<p>the</p>"), (9003, "http://odd.example.com/b", "")],
        "page_id BIGINT, url STRING, html STRING",
    )
    twice = pages.where("page_id % 4 = 1").withColumn("page_id", F.col("page_id") + 5000)
    return [
        pages.where("page_id % 4 <> 0").union(odd),
        more.where("page_id % 3 = 0"),
        pages.limit(0),
        more.where("page_id % 4 = 0").union(twice),
        pages,
    ]


def test_live_index_equals_a_whole_build(spark, deliveries):
    store = live.live_store(spark, scratch_path(spark, "live"), buckets=3)
    whole = whole_index(spark, deliveries)
    for i, batch in enumerate(deliveries):
        live.index_pages(store, batch, i, NOW)
        if i == 3:
            live.merge_segments(store)
    # A batch that comes again changes nothing.
    assert live.index_pages(store, deliveries[0], 1, NOW).version == store.snapshot().version
    asked = fx.searches(spark).union(spark.createDataFrame([(9, "zzzq ther", "english", 0.3)]))
    expected = sorted(map(tuple, se.search_batch(whole, asked, limit=500).collect()), key=str)
    assert len(expected) > 50
    for _ in range(2):
        index = live.search_index(store.snapshot())
        for name in ("postings", "links"):
            columns = [c for c in getattr(whole, name).columns if c != "bucket"]
            got = getattr(index, name).select(columns).collect()
            assert sorted(got, key=str) == sorted(getattr(whole, name).select(columns).collect(), key=str)
        assert sorted(r.word for r in index.words.collect()) == sorted(r.word for r in whole.words.collect())
        assert sorted(map(tuple, se.search_batch(index, asked, limit=500).collect()), key=str) == expected
        one = [se.search(i, "ther +zzzq", "english", limit=50).collect() for i in (index, whole)]
        assert one[0] == one[1]
        live.merge_segments(store, everything=True)
    assert len(store.snapshot().segments) == 1 and store.snapshot().count("changes") == 0


def test_a_small_batch_reads_few_buckets(spark, deliveries, monkeypatch):
    store = live.live_store(spark, scratch_path(spark, "live"), buckets=50)
    live.index_pages(store, deliveries[0], 0, NOW)
    read, scan = [], Snapshot.scan

    def watched(self, name, buckets=None):
        found = scan(self, name, buckets)
        read.append((name, None if buckets is None else len(buckets)))
        if self.count(name) and buckets:
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"PartitionFilters: \[[^]]*bucket", plan), plan
        return found

    monkeypatch.setattr(Snapshot, "scan", watched)
    page = spark.createDataFrame([(1, "http://one.example.com/", "<p>there</p><a href='/x'>y</a>")], "page_id BIGINT, url STRING, html STRING")
    live.index_pages(store, page, 1, NOW)
    assert {name for name, _ in read} >= {"link", "inlinks"}
    assert all(n is not None and n <= 3 for _, n in read)


def test_recently_indexed_pages_are_skipped(spark):
    store = live.live_store(spark, scratch_path(spark, "live"), buckets=2)
    page = lambda word: spark.createDataFrame([(1, "http://a.example.com/", f"<p>{word}</p>")], "page_id BIGINT, url STRING, html STRING")
    at = lambda hour: F.to_timestamp(F.lit(f"2024-01-01 0{hour}:00:00"))
    words = lambda: sorted(r.word for r in live.search_index(store.snapshot()).words.collect())
    live.index_pages(store, page("firstword"), 0, at(1), ttl_seconds=7200)
    live.index_pages(store, page("secondword"), 1, at(2), ttl_seconds=7200)
    assert words() == ["firstword"]
    live.index_pages(store, page("thirdword"), 2, at(3), ttl_seconds=7200)
    assert words() == ["firstword", "thirdword"]
    live.index_pages(store, page("fourthword"), 3, at(4), ttl_seconds=7200)
    assert words() == ["firstword", "thirdword"]


def test_folded_live_index_equals_a_folded_build(spark):
    shout = lambda text: F.concat(F.lit("<p>ÜBERGANG übergang Straßen</p>"), text)
    pages = fx.linked_pages(spark, FOLDER).select("page_id", "url", "html").where("page_id < 30")
    # The same URLs in capitals, as pages of their own and as targets.
    louder = pages.select(F.col("page_id") + 100, F.upper("url"), shout(F.col("html"))).toDF(*pages.columns)
    links = pages.select(
        F.col("page_id") + 200,
        F.concat(F.lit("http://New.example.com/"), F.col("page_id").cast("string")),
        shout(F.concat(F.lit('<a href="'), F.upper("url"), F.lit('"></a>'))),
    ).toDF(*pages.columns)
    first, second = pages.union(louder), links
    store = live.live_store(spark, scratch_path(spark, "live"), buckets=2)
    live.index_pages(store, first, 0, NOW, fold=True)
    live.index_pages(store, second, 1, NOW, fold=True)
    whole = se.search_index(ix.folded_tables(build.build_tables(first.union(second))))
    asked = fx.searches(spark).select("query_id", folded(F.col("query")).alias("query"), "language", "weight_tfidf")
    asked = asked.union(spark.createDataFrame([(9, folded_text("ÜberGang"), "unknown", 0.5), (10, "strasse", "unknown", 0.5)]))

    def told(index):
        return sorted(map(tuple, se.search_batch(index, asked, limit=300).collect()), key=str)

    expected = told(whole)
    assert len({r[3] for r in expected}) > 10 and {r[0] for r in expected} >= {9, 10}
    assert told(live.search_index(store.snapshot())) == expected
    live.merge_segments(store, everything=True)
    assert told(live.search_index(store.snapshot())) == expected
    assert {r.url for r in store.snapshot().rows("link").collect()} == {r.url.lower() for r in first.union(second).collect()}
    with pytest.raises(ValueError, match="folded"):
        live.index_pages(store, second, 2, NOW)


def test_search_after_batches_gives_all_rows(spark, tmp_path):
    """More hits than the 100,000 rows it once stopped at."""
    words = ["ther" + "".join(end) for end in product("bcdfghk", repeat=6)][:100_020]
    texts = [" ".join(["the of and", *words[i::4]]) for i in range(4)]
    pages = [(i, f"http://a.example.com/{i}.html", f"<title>t</title><p>{text}</p>") for i, text in enumerate(texts)]
    spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["search_after_batches"](spark, str(tmp_path)).collect()
    wanted = {(url, word) for i, (_, url, _) in enumerate(pages) for word in (*words[i::4], "zzzq")}
    assert len(found) == len(wanted) == 100_024
    assert {(r.url, r.word) for r in found} == wanted
    order = [(r["rank"] is None, -(r["rank"] or 0)) for r in found]
    assert order == sorted(order)
