"""Links, gates over time, reachability and table upkeep."""

from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelode.operators import links as li
from pagelode.operators import maintain as ma
from pagelode.operators import throttle as th
from pagelode.operators.gates import recrawl_due
from pagelode.operators.reach import reachable_pages
from pagelode.sources.pages import list_rows
from pagelode.session import scratch_path
from pagelode.streaming.gate import accept_batch, accepted_times, gate_store, merge_gate, recrawl_gate
from pagelode.streaming.seen import new_url_stream


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("bound", [0, 10])
def test_allowed_links(spark, bound):
    hosts = ["example.com", "a.example.com", "badexample.com", "example.com.evil.org", "EXAMPLE.com"]
    links = spark.createDataFrame([(f"http://{h}/p",) for h in hosts] + [("/rel",)], "url_to STRING")
    domains = spark.createDataFrame([("example.com",), ("a.example.com",)], "domain STRING")
    kept = values(li.allowed_links(links, domains, literal_bound=bound), "url_to")
    assert kept == [("http://EXAMPLE.com/p",), ("http://a.example.com/p",), ("http://example.com/p",)]
    assert li.allowed_links(links, domains.limit(0), literal_bound=bound).count() == 6


def greedy(times, ttl):
    kept = []
    for t in sorted(set(times)):
        if not kept or t - kept[-1] >= ttl:
            kept.append(t)
    return kept


def test_gate_is_greedy():
    assert accepted_times(np.array([0, 6, 12]), 10, None) == [0, 12]
    assert accepted_times(np.array([5, 10, 11]), 10, 0) == [10]


def test_throttle_equals_brute_force(spark):
    rng = random.Random(7)
    log = [(u, rng.randrange(0, 400)) for u in range(6) for _ in range(10 * (u + 1))] + [(1, 0), (1, 0)]
    arrivals = spark.createDataFrame(log, "url BIGINT, time BIGINT")
    want = sorted((u, t) for u in range(6) for t in greedy([x for k, x in log if k == u], 40))
    assert values(th.recrawl_throttle(arrivals, 40), "url", "time") == want


def test_throttle_null_rule(spark):
    log = [("a", 0), ("a", None), ("a", 5), ("a", 50), (None, 3), (None, 10), (None, 60), (None, None), ("b", None)]
    arrivals = spark.createDataFrame(log, "url STRING, time BIGINT")
    got = {(r.url, r.time) for r in th.recrawl_throttle(arrivals, 40).collect()}
    assert got == {("a", 0), ("a", 50), (None, 3), (None, 60)}
    assert th.recrawl_throttle(arrivals, 0).count() == 6


def test_hot_url_takes_rounds_by_the_log_of_its_accepts(spark, monkeypatch):
    """A third of the arrivals of one URL, a time to live of one second, gaps and bursts."""
    second, rng = 1_000_000, random.Random(11)
    times = [0]
    for _ in range(3000):
        times.append(times[-1] + rng.choice([1, 1000, second // 3, second, 2 * second, 50 * second]))
    log = [("hot", t) for t in times] + [(f"u{i % 900}", rng.randrange(times[-1])) for i in range(6000)]
    arrivals = spark.createDataFrame(log, "url STRING, time BIGINT").repartition(5)
    written, keep = [], th._keep
    monkeypatch.setattr(th, "_keep", lambda df, path: written.append(path) or keep(df, path))
    by_url = {}
    for u, t in log:
        by_url.setdefault(u, []).append(t)
    want = sorted((u, t) for u, ts in by_url.items() for t in greedy(ts, second))
    assert values(th.recrawl_throttle(arrivals, second), "url", "time") == want
    longest = len(greedy(times, second))
    assert longest > 1000 and len(written) <= 2 * (longest.bit_length() + 1) + 6
    # The hot URL lies in several ranges.
    path = f"{tmp_folder(spark)}/next"
    pointers = th.next_due(arrivals.select(F.struct("url").alias("key"), "time").distinct(), second, path)
    assert {r.time: r.to for r in pointers.where("key.url = 'hot'").collect()} == {
        t: min(x for x in times if x >= t + second) for t in times if t + second <= times[-1]
    }
    points = spark.read.parquet(f"{path}/points").where("key.url = 'hot'")
    assert points.select("part").distinct().count() > 2


def tmp_folder(spark):
    return scratch_path(spark, "test")


def test_throttle_goes_on_from_earlier_accepts(spark):
    last = spark.createDataFrame([("a", 100), ("c", 5)], "url STRING, time BIGINT")
    log = [("a", 90), ("a", 130), ("a", 140), ("a", 150), ("b", 1), ("a", 181)]
    got = th.recrawl_throttle(spark.createDataFrame(log, "url STRING, time BIGINT"), 40, last)
    assert values(got, "url", "time") == [("a", 140), ("a", 181), ("b", 1)]


def test_stored_gate_equals_replay_and_forgets(spark):
    rng = random.Random(5)
    log = [(f"u{rng.choice([0, 0, 0, 1, 2, i])}", 10 * i + rng.randrange(30)) for i in range(600)]
    store = gate_store(spark, scratch_path(spark, "gate"), buckets=3)
    seen = []
    for part in range(4):
        batch = log[part * 150 : part * 150 + 150]
        # Within the lateness nothing is lost, if accepts come in time order.
        batch = sorted(batch, key=lambda r: r[1])
        batch = [r for r in batch if not seen or r[1] >= max(t for _, t in seen)]
        seen += batch
        df = spark.createDataFrame([*batch, (None, 3), ("u1", None)], "url STRING, time BIGINT")
        late = spark.createDataFrame([("late", -1)], "url STRING, time BIGINT") if part else df.limit(0)
        accept_batch(store, df.union(late), part, 500, lateness=40)
        assert accept_batch(store, df, part, 500, lateness=40).last_batch == part
        if part == 2:
            merge_gate(store, 500, lateness=40)
    want = sorted((u, t) for u in {u for u, _ in seen} for t in greedy([t for k, t in seen if k == u], 500))
    assert values(store.snapshot().rows("accepted"), "url", "time") == want
    newest = max(t for _, t in seen)
    merge_gate(store, 500, lateness=40, everything=True)
    held = values(store.snapshot().rows("last"), "url", "time")
    assert held and all(t + 500 > newest - 40 for _, t in held) and len(held) < len({u for u, _ in seen})
    accept_batch(store, spark.createDataFrame([("x", newest + 5000)], "url STRING, time BIGINT"), 9, 500, lateness=40)
    accept_batch(store, spark.createDataFrame([("x", newest + 6000)], "url STRING, time BIGINT"), 10, 500, lateness=40)
    accept_batch(store, spark.createDataFrame([("x", newest + 5990)], "url STRING, time BIGINT"), 11, 500, lateness=2000)
    merge_gate(store, 500, lateness=-500, everything=True)
    assert store.snapshot().count("last") == 0
    assert values(store.snapshot().rows("accepted"), "url", "time") == sorted(
        [*want, ("x", newest + 5000), ("x", newest + 6000)]
    )


def test_streamed_gate_equals_replay(spark, tmp_path):
    rng = random.Random(3)
    folder = str(tmp_path / "in")
    log = [(f"u{rng.randrange(3)}", t) for t in sorted(rng.sample(range(2000), 300))]
    for part in range(3):  # files in time order, one per micro-batch
        spark.createDataFrame(log[part * 100 : part * 100 + 100], "url STRING, time BIGINT").coalesce(
            1
        ).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("url STRING, time BIGINT").option("maxFilesPerTrigger", 1).parquet(folder)
    run = (
        recrawl_gate(stream, 50)
        .writeStream.format("memory")
        .queryName("gate")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    arrivals = spark.createDataFrame(log, "url STRING, time BIGINT")
    assert values(spark.table("gate"), "url", "time") == values(
        th.recrawl_throttle(arrivals, 50), "url", "time"
    )


def test_age_equal_to_ttl_is_due(spark):
    pages = spark.createDataFrame([("a",), ("b",), ("c",)], "url STRING")
    link = spark.createDataFrame(
        [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1, 0, 0, 1))], "url STRING, indexed_at TIMESTAMP"
    )
    now = F.lit(datetime(2024, 1, 2))
    assert values(recrawl_due(pages, link, now, 86400), "url") == [("a",), ("c",)]


def test_reachability_with_cycles_and_levels(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}") for i in range(6)], "link_id BIGINT, url STRING")
    pairs = [(0, 1), (1, 2), (2, 0), (2, 3), (5, 4), (3, 9), (0, 2)]
    edges = spark.createDataFrame(
        [(a, f"http://h/{b}") for a, b in pairs], "link_id_from BIGINT, url_to STRING"
    )
    start = spark.createDataFrame([("http://h/0",), ("http://h/99",)], "url STRING")
    got = values(reachable_pages(start, pages, edges), "link_id", "level")
    assert got == [(0, 0), (1, 1), (2, 1), (3, 2)]
    assert values(reachable_pages(start, pages, edges, max_levels=1), "link_id", "level") == got[:3]
    domains = spark.createDataFrame([("other",)], "domain STRING")
    assert values(reachable_pages(start, pages, edges, domains), "link_id", "level") == [(0, 0)]


def test_insert_ignore(spark):
    table = spark.createDataFrame([(1, "a")], "link_id BIGINT, url STRING")
    rows = spark.createDataFrame(
        [(1, "b", 0), (2, "c", 1), (2, "d", 2), (3, "e", 3)], "link_id BIGINT, url STRING, pos INT"
    )
    parent = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    added = ma.insert_ignore(table, rows, ["link_id"], "pos", [(parent, "id", "link_id")])
    assert values(added, "link_id", "url") == [(2, "c")]


def test_insert_with_limited_width(spark):
    table = spark.createDataFrame([("abc",)], "word STRING")
    rows = spark.createDataFrame([("abcd", 0), ("xyz1", 1), ("xyz2", 2)], "word STRING, pos INT")
    assert values(ma.insert_ignore(table, rows, ["word"], "pos", max_len=3), "word") == [("xyz",)]
    assert ma.insert_ignore(table, rows, ["word"], "pos").count() == 3


@pytest.mark.parametrize("within", [None, "1 hour"])
def test_seen_urls_in_a_stream(spark, tmp_path, within):
    folder, name = str(tmp_path / "in"), f"seen_{within is None}"
    at = datetime(2024, 1, 1)
    for part in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([(u, at) for u in part], "url STRING, found_at TIMESTAMP").coalesce(
            1
        ).write.mode("append").parquet(folder)
    stream = (
        spark.readStream.schema("url STRING, found_at TIMESTAMP")
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )
    run = (
        new_url_stream(stream, within)
        .writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    assert values(spark.table(name), "url") == [("a",), ("b",), ("c",)]


def test_upserts(spark):
    table = spark.createDataFrame([("u", "old")], "url STRING, title STRING")
    rows = spark.createDataFrame(
        [("u", "new", 0), ("v", "1", 1), ("v", None, 2)], "url STRING, title STRING, pos INT"
    )
    assert values(ma.upsert_keep_first(table, rows, ["url"], "pos"), "url", "title") == [
        ("u", "old"), ("v", "1"),
    ]
    replaced = {r.url: r.title for r in ma.upsert_replace(table, rows, ["url"], "pos").collect()}
    assert replaced == {"u": "new", "v": None}


def test_resolve_ids_keeps_positions(spark):
    table = spark.createDataFrame([(10, "a"), (11, "b")], "id BIGINT, url STRING")
    rows = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "x")], "pos INT, url STRING")
    got = ma.resolve_ids(rows, table, ["url"], ["id"]).orderBy("pos").collect()
    assert [(r.pos, r.id) for r in got] == [(0, 11), (1, 10), (2, 11)]


def test_touch(spark):
    link = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, None)], "link_id BIGINT, indexed_at TIMESTAMP"
    )
    touched = spark.createDataFrame([(2,), (2,), (9,)], "link_id BIGINT")
    now = datetime(2024, 5, 5)
    assert values(ma.touch_indexed(link, touched, F.lit(now)), "link_id", "indexed_at") == [
        (1, datetime(2024, 1, 1)), (2, now),
    ]


def test_delete_refuses_referenced_keys(spark):
    table = spark.createDataFrame([(1,), (2,), (3,)], "id BIGINT")
    doomed = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    used = spark.createDataFrame([(2,)], "word_id BIGINT")
    assert values(ma.delete_by_key(table, doomed, ["id"], [(used, "word_id")]), "id") == [(2,), (3,)]
    pairs = spark.createDataFrame([(1, "a"), (1, "b")], "link_id_from BIGINT, url_to STRING")
    gone = spark.createDataFrame([(1, "a"), (1, "c")], "link_id_from BIGINT, url_to STRING")
    assert values(ma.delete_by_key(pairs, gone, ["link_id_from", "url_to"]), "url_to") == [("b",)]


def test_seed_only_when_empty(spark):
    setting = spark.createDataFrame([("a;b;;c",)], "s STRING")
    defaults = list_rows(setting, "s", "url")
    table = spark.createDataFrame([("x",)], "url STRING")
    assert values(ma.seed_if_empty(table, defaults), "url") == [("x",)]
    assert values(ma.seed_if_empty(table.limit(0), defaults), "url") == [("a",), ("b",), ("c",)]


def test_new_urls(spark):
    targets = spark.createDataFrame([("a",), ("b",), ("b",)], "url STRING")
    seen = spark.createDataFrame([("a",)], "url STRING")
    assert values(li.new_urls(targets, seen), "url") == [("b",)]
