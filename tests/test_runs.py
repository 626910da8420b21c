"""Seen URLs and reachability over several batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pagelode.operators.reach import extend_reach, reach_store, reachable_pages
from pagelode.session import scratch_path
from pagelode.sources.segments import Snapshot
from pagelode.streaming import seen


def listed(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "url STRING")


def test_bits_of_the_filter(spark):
    urls = spark.range(3000).select(F.concat(F.lit("http://h/"), "id").alias("url"))
    others = spark.range(3000, 9000).select(F.concat(F.lit("http://h/"), "id").alias("url"))
    store = seen.seen_store(spark, scratch_path(spark, "seen"), buckets=4)
    assert seen.perhaps_seen(store.snapshot(), urls).count() == 0
    seen.take_urls(store, urls, 0)
    base = store.snapshot()
    assert base.count("filter") == 1
    # No seen URL is missed; of others some 1 in 100 is taken for one.
    assert seen.perhaps_seen(base, urls).count() == 3000
    assert 0 < seen.perhaps_seen(base, others).count() < 300


def test_new_urls_of_batches(spark, monkeypatch):
    rng = random.Random(2)
    store = seen.seen_store(spark, scratch_path(spark, "seen"), buckets=4)
    looked, at = [], Snapshot.at
    monkeypatch.setattr(Snapshot, "at", lambda self, name, keys, column: looked.append(keys.count()) or at(self, name, keys, column))
    first, met = {}, []
    for i in range(5):
        urls = [f"u{rng.randrange(3000)}" for _ in range(900)] if i != 3 else []
        again = sum(u in first for u in set(urls))
        met.append((again, len(set(urls)) - again))
        for u in urls:
            first.setdefault(u, i)
        seen.take_urls(store, listed(spark, *urls, *urls[:9], None), i)
        assert seen.take_urls(store, listed(spark, "other"), i).last_batch == i
        if i % 2:
            seen.merge_seen(store, everything=i == 3)
    got = {r.url: r.batch_id for r in store.snapshot().rows("seen").collect()}
    assert got == first
    # What is looked up exactly: the URLs met again and few new ones.
    for (again, new), n in zip(met, looked, strict=True):
        assert again <= n <= again + 0.1 * new + 3
    seen.merge_seen(store, everything=True)
    assert {r.url for r in seen.perhaps_seen(store.snapshot(), listed(spark, *first)).collect()} == set(first)


@pytest.mark.parametrize("seed", [1, 2])
def test_reach_by_batches_equals_a_restart(spark, seed):
    rng = random.Random(seed)
    n = 60
    url = lambda i: f"http://h{i % 3}.example.com/{i}"
    pages = [(i, url(i)) for i in range(n) if i % 7]
    edges = sorted({(rng.randrange(n), url(rng.randrange(n))) for _ in range(100)})
    start = [(url(i),) for i in (1, 2, 50, 7, 700)]
    domains = spark.createDataFrame([("h0.example.com",), ("h1.example.com",), ("h2.example.com",)], "domain STRING")
    store = reach_store(spark, scratch_path(spark, "reach"), buckets=3)
    place = lambda rows: [rng.randrange(3) for _ in rows]
    dealt = [list(zip(rows, place(rows), strict=True)) for rows in (pages, edges, start)]
    kinds = ("link_id BIGINT, url STRING", "link_id_from BIGINT, url_to STRING", "url STRING")
    sofar = [[], [], []]
    for i in range(3):
        batch = [[r for r, at in rows if at == i] for rows in dealt]
        for all_rows, rows in zip(sofar, batch, strict=True):
            all_rows += rows
        dfs = [spark.createDataFrame(rows + rows[:2], kind) for rows, kind in zip(batch, kinds, strict=True)]
        extend_reach(store, *dfs, i, domains)
        if i == 1:
            store.merge(store.snapshot(), store.snapshot().segments)
        link, hops, begin = (spark.createDataFrame(rows, kind) for rows, kind in zip(sofar, kinds, strict=True))
        want = {r.link_id: r.level for r in reachable_pages(begin, link, hops, domains).collect()}
        assert {r.link_id: r.level for r in store.snapshot().rows("reached").collect()} == want
    assert extend_reach(store, *dfs, 2).version == store.snapshot().version
