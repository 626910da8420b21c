"""The ranking formula and its corner cases on hand-made tables."""

from __future__ import annotations

import math

import pytest

from pagelode.operators import index as ix
from pagelode.operators import search as se
from pagelode.sources.store import IndexStore


def tables(spark, links, postings, edges):
    return ix.IndexTables(
        spark.createDataFrame(links, "link_id BIGINT, url STRING, language STRING, title STRING"),
        spark.createDataFrame(postings, "word STRING, link_id BIGINT, weight BIGINT"),
        spark.createDataFrame(edges, "link_id_from BIGINT, url_to STRING"),
    )


LINKS = [
    (1, "u1", "english", "t1"),
    (2, "u2", "english", None),
    (3, "u3", "english", "t3"),
    (4, "u4", "german", "t4"),
]
POSTINGS = [
    ("searching", 1, 2), ("other", 1, 2), ("research", 1, 1),
    ("search", 2, 1), ("search", 3, 3), ("page", 3, 1), ("search", 4, 5),
]
EDGES = [(1, "u2"), (3, "u2"), (4, "u2"), (2, "u1"), (4, "u1"), (1, "gone"), (2, "gone"),
         (3, "gone"), (4, "gone"), (1, "u4")]


def expected(weight=0.6):
    pairs, hit_pages, best = 7, 3, 4
    idf = math.log(pairs / hit_pages)
    score = lambda tf, n: tf * idf * weight + (1 - weight) * math.log(n) / math.log(best)
    return [
        ("u1", "research", score(1 / 5, 2)),
        ("u1", "searching", score(2 / 5, 2)),
        ("u2", "search", score(1.0, 3)),
        ("u3", "search", None),
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = IndexStore(spark, str(tmp_path_factory.mktemp("index")))
    return store.write_search(tables(spark, LINKS, POSTINGS, EDGES), buckets=5)


@pytest.fixture(scope="module")
def lazy(spark):
    return se.search_index(tables(spark, LINKS, POSTINGS, EDGES))


def rows(df):
    return [(r.url, r.word, r["rank"]) for r in df.collect()]


def same(got, want):
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want, strict=True):
        assert (g[2] is None) == (w[2] is None)
        if w[2] is not None:
            assert g[2] == pytest.approx(w[2], rel=1e-12)


def in_order(found):
    return sorted(found, key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))


@pytest.mark.parametrize("kind", ["stored", "lazy"])
@pytest.mark.parametrize("weight", [0.6, 1.0])
def test_formula(request, kind, weight):
    index = request.getfixturevalue(kind)
    same(rows(se.search(index, "sear", "english", weight)), in_order(expected(weight)))


@pytest.mark.parametrize("kind", ["stored", "lazy"])
def test_paging(request, kind):
    index = request.getfixturevalue(kind)
    every = in_order(expected())
    for page in (1, 4, 5):
        got = rows(se.search(index, "sear", "english", page=page, limit=1))
        same(got, every[page - 1 : page])
    same(rows(se.search(index, "sear", "english", page=0, limit=2)), every[:2])


def test_columns_and_options(stored):
    found = se.search(stored, "sear", "english")
    assert found.columns == ["title", "url", "rank", "word"]
    zero = rows(se.search(stored, "sear", "english", missing_backlinks="zero"))
    assert all(r[2] is not None for r in zero)
    collapsed = rows(se.search(stored, "sear", "english", collapse="max"))
    assert sorted(r[0] for r in collapsed) == ["u1", "u2", "u3"]
    best = max(r[2] for r in expected() if r[0] == "u1")
    assert dict((r[0], r[2]) for r in collapsed)["u1"] == pytest.approx(best)


def test_maximum_of_one_backlink_gives_no_rank(spark):
    index = se.search_index(tables(spark, LINKS, POSTINGS, [(1, "u2"), (2, "u1")]))
    assert all(r[2] is None for r in rows(se.search(index, "sear", "english")))


@pytest.mark.parametrize("kind", ["stored", "lazy"])
@pytest.mark.parametrize("limit", [2, 1500])
def test_batch_equals_single_searches(spark, request, kind, limit):
    index = request.getfixturevalue(kind)
    asked = [(1, "sear", "english", 0.6), (2, "sear", "german", 0.6), (3, "", "english", 0.6),
             (4, "page other", "english", 0.9), (5, "sea", "english", 0.5)]
    queries = spark.createDataFrame(
        asked, "query_id BIGINT, query STRING, language STRING, weight_tfidf DOUBLE"
    )
    batch = se.search_batch(index, queries, page=1, limit=limit).orderBy("query_id", "pos").collect()
    for i, query, language, weight in asked:
        got = [(r.url, r.word, r["rank"]) for r in batch if r.query_id == i]
        same(got, rows(se.search(index, query, language, weight, limit=limit)))


def test_large_key_sets_take_the_join(stored, monkeypatch):
    monkeypatch.setattr(se, "MAX_PRUNING_WORDS", 1)
    monkeypatch.setattr(se, "MAX_PRUNING_ROWS", 1)
    same(rows(se.search(stored, "sear", "english")), in_order(expected()))


def test_stored_search_reads_only_its_buckets(stored):
    plan = se.hits(stored, "searching", "english")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1]
    assert "PushedFilters: [" in plan and "word" in plan.split("PushedFilters")[1]


def test_ties_across_the_page_edge(spark):
    links = [(i, f"u{i:02d}", "english", "t") for i in range(20)]
    postings = [("word", 19 - i, 1) for i in range(20)]
    index = se.search_index(tables(spark, links, postings, [(1, "gone"), (2, "gone")]))
    got = [r[0] for p in (1, 2, 3) for r in rows(se.search(index, "word", "english", page=p, limit=7))]
    assert got == [f"u{i:02d}" for i in range(20)]


def test_a_query_is_never_one_task_of_raw_hits(spark, stored):
    queries = spark.createDataFrame(
        [(1, "sear", "english", 0.6)], "query_id BIGINT, query STRING, language STRING, weight_tfidf DOUBLE"
    )
    rows = se._batch_rows(stored, queries, 2, 2, "null", None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    sliced = [x for x in shuffles if "hashpartitioning(query_id#" in x and "_slice" in x]
    alone = [x for x in shuffles if "hashpartitioning(query_id#" in x and "_slice" not in x]
    # By the query alone go partial counts, and rows that passed the cut of a slice.
    assert sliced and len(alone) == 2
    assert plan.index("Window [row_number()") < plan.index(alone[-1].strip()[:40])
    assert "postings" not in plan and plan.count("FileScan") == 2


def test_grams_are_read_by_bucket(spark, stored):
    needed = spark.createDataFrame([("sear",)], "gram STRING")
    plan = se.grams_of(stored, needed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_build_is_a_version_and_a_failed_one_is_not_seen(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    with pytest.raises(ValueError):
        store.search_index()
    whole = tables(spark, LINKS, POSTINGS, [(1, "u2")])
    first = store.write_search(whole)
    before = rows(se.search(first, "sear", "english"))
    # A build that broke off before its last table.
    first.words.write.parquet(f"{tmp_path}/search/v=1/words")
    assert store.current_version() == 0
    assert rows(se.search(store.search_index(), "sear", "english")) == before
    for expected in (2, 3):
        store.write_search(whole)
        assert store.current_version() == expected
    assert rows(se.search(store.search_index(), "sear", "english")) == before
    assert sorted(store._versions()) == [2, 3]


def test_sketched_page_counts(spark):
    """Within four standard errors of the exact count, whatever the parts the sketches are made of."""
    postings = spark.range(60_000).selectExpr(
        "array('often', 'rare', 'other')[if(id % 5 < 3, 0, if(id % 500 = 4, 1, 2))] as word",
        "if(id % 2 = 0, 'english', 'german') as language",
        "id % 50000 as link_id",
    )
    parts = [postings.where(f"link_id % 3 = {i}") for i in range(3)] + [postings.where("link_id < 9000")]
    merged = se.merge_sketches(
        se.page_sketches(parts[0]).union(se.page_sketches(parts[1])).union(se.page_sketches(parts[2])).union(se.page_sketches(parts[3]))
    )
    queries = spark.createDataFrame([(1, "english"), (2, "german"), (3, "english")], "query_id BIGINT, language STRING")
    words = [(1, "often"), (1, "other"), (2, "often"), (2, "none"), (3, "none")]
    matched = spark.createDataFrame(words, "query_id BIGINT, word STRING")
    exact = {
        i: postings.where(f"language = '{lang}' and word in ({names})").select("link_id").distinct().count()
        for i, lang, names in ((1, "english", "'often', 'other'"), (2, "german", "'often'"))
    }
    for sketches in (merged, se.page_sketches(postings)):
        got = {r.query_id: r.pages for r in se.approximate_pages(sketches, queries, matched).collect()}
        assert set(got) == {1, 2}
        for i, n in exact.items():
            assert n > 10_000 and abs(got[i] - n) <= 4 * 1.04 / 2**6 * n
    few = se.approximate_pages(merged, queries, spark.createDataFrame([(1, "rare")], "query_id BIGINT, word STRING"))
    rare = postings.where("language = 'english' and word = 'rare'").select("link_id").distinct().count()
    assert [r.pages for r in few.collect()] == [rare]


def test_only_needed_grams_are_read(spark, stored, monkeypatch):
    needed = spark.createDataFrame([("sear",), ("sear",), ("arch",), ("zzzz",)], "gram STRING")
    read = {(r.gram, r.word) for r in se.grams_of(stored, needed).collect()}
    assert {g for g, _ in read} == {"sear", "arch"} and ("arch", "research") in read
    monkeypatch.setattr(se, "MAX_PRUNING_WORDS", 1)
    more = {(r.gram, r.word) for r in se.grams_of(stored, needed).collect()}
    assert more >= read


@pytest.mark.parametrize("kind", ["stored", "lazy"])
@pytest.mark.parametrize("pruned", [1, 1_000])
def test_without_a_limit_all_rows_come_in_order(request, kind, pruned, monkeypatch):
    monkeypatch.setattr(se, "MAX_PRUNING_ROWS", pruned)
    index = request.getfixturevalue(kind)
    for page in (0, 1):
        same(rows(se.search(index, "sear", "english", page=page, limit=None)), in_order(expected()))
    assert rows(se.search(index, "zzzz", "english", limit=None)) == []
    with pytest.raises(ValueError, match="one page"):
        se.search(index, "sear", "english", page=2, limit=None)
