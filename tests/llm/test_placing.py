"""Shards and mixed order: the laws they state, and the walk step by step."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from pagelode.llm import mixing, sharding


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_balanced_and_gapless(documents, odd, shards):
    for table in (documents, odd):
        rows = table.collect()
        got = sharding.assign_shards(table, sharding.Ring(shards)).collect()
        assert len(got) == len(rows)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        sizes = [len(slots[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        told = Counter((r.doc_id, r.size, r.text_crc32) for r in got)
        bodies = [(r.doc_id, (r.text or "").encode()) for r in rows]
        assert told == Counter((i, len(b) + 16, zlib.crc32(b)) for i, b in bodies)
        assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_the_walk_placed_row_by_row():
    """The plan by counts equals a walk that moves single rows."""
    counts, owners, shards = [5, 0, 9, 1, 4, 4], [0, 1, 2, 0, 2, 1], 3
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = [(arc, rank) for arc, n in enumerate(counts) for rank in range(n)]
    placed, slots, turn = {}, Counter(), 0
    while waiting:
        still = []
        for arc, rank in waiting:
            s = owners[(arc + turn) % len(owners)]
            if room[s]:
                room[s] -= 1
                placed[arc, rank] = (s, slots[s])
                slots[s] += 1
            else:
                still.append((arc, rank))
        waiting, turn = still, turn + 1
    planned = {}
    for span in sharding.plan_spans(counts, owners, shards):
        for rank in range(span.low, span.high):
            planned[span.arc, rank] = (span.shard, span.slot + rank - span.low)
    assert planned == placed


def test_most_rows_stay_on_their_first_point(documents):
    ring = sharding.Ring(8, 256)
    points = sharding._points(documents, ring)
    got = sharding.assign_shards(documents, ring)
    owners = [s for _, s in points]
    hashed = got.selectExpr("doc_id", "shard", "xxhash64('key', doc_id, text_crc32, size) as hashed")
    placed = sharding.with_arc(hashed, [p for p, _ in points]).collect()
    for r in placed:
        assert r.arc == next((i for i, (p, _) in enumerate(points) if p >= r.hashed), 0)
    assert sum(owners[r.arc] == r.shard for r in placed) > 0.75 * len(placed)


def test_few_rows_move(documents):
    """One more shard, or a row less, moves little between the shards that stay."""
    ring = sharding.Ring(8, 256)
    before = {r.doc_id: r.shard for r in sharding.assign_shards(documents, ring).collect()}
    grown = {r.doc_id: r.shard for r in sharding.assign_shards(documents, sharding.Ring(9, 256)).collect()}
    one_less = sharding.assign_shards(documents.where("doc_id <> 3"), ring).collect()
    moved = sum(before[i] != s for i, s in grown.items())
    to_old = sum(before[i] != s and s < 8 for i, s in grown.items())
    assert len(before) / 9 * 0.9 < moved < len(before) / 2 and to_old < 0.35 * len(before)
    assert sum(before[r.doc_id] != r.shard for r in one_less) < 0.1 * len(before)


def test_cells_of_an_arc_rank_as_one(documents, monkeypatch):
    """Many cells give the same places as one, with an id, a null id and a row on many rows."""
    hot = documents.sparkSession.range(300).selectExpr(
        "case when id % 3 = 0 then 5 when id % 3 = 1 then null else 6 end as doc_id",
        "case when id % 3 = 2 then 'same' else concat('text ', id % 90) end as text",
    )
    table = documents.select("doc_id", "text").union(hot)
    one = sorted(sharding.assign_shards(table, sharding.Ring(5, 2)).collect(), key=str)
    monkeypatch.setattr(sharding, "_CELL", 7)
    many = sorted(sharding.assign_shards(table, sharding.Ring(5, 2)).collect(), key=str)
    assert one == many and len(one) == table.count()
    assert len({(r.shard, r.slot) for r in one}) == len(one)


def test_no_shards_of_nothing(empty):
    assert sharding.assign_shards(empty).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 0.7, "b": 0.2, "c": 0.1}])
def test_a_frame_is_less_than_a_block_off(weights):
    given = mixing.shares(weights, 10_000)
    order = mixing.plan_frame(given)
    total = sum(Fraction(w).limit_denominator(1000) for w in weights.values())
    seen = Counter()
    for slot, s in enumerate(order * 3, 1):
        seen[s] += 1
        for name, w in weights.items():
            assert abs(seen[name] - slot * Fraction(w).limit_denominator(1000) / total) < 1


def test_mixing_equals_the_schedule_block_by_block(documents):
    weights = {f"src{i}": 1.0 + i % 3 for i in range(20)}
    got = mixing.mix_sources(documents, weights, block=2).select("doc_id", "source", "mix_slot", "mix_place").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents.collect())
    assert len({(r.mix_slot, r.mix_place) for r in got}) == len(got)
    by_slot = defaultdict(list)
    for r in got:
        by_slot[r.mix_slot].append(r)
    sources = [by_slot[s][0].source for s in range(len(by_slot))]
    assert all({r.source for r in rows} == {sources[s]} for s, rows in by_slot.items())
    # Earliest deadline first, one slot at a time.
    left = {s: -(-n // 2) for s, n in Counter(r.source for r in got).items()}
    expected = []
    while any(left.values()):
        active = {s: weights[s] for s, n in left.items() if n}
        frame = mixing.plan_frame(mixing.shares(active, mixing.FRAME))
        slot = 0
        while all(left[s] for s in active):
            expected.append(frame[slot % len(frame)])
            left[expected[-1]] -= 1
            slot += 1
    assert sources == expected


@pytest.mark.parametrize("n, frame", [(60, 500), (60, 20)])
def test_the_plan_keeps_to_its_bound(n, frame):
    blocks = {f"s{i}": 3 + 2 * i for i in range(n)}
    phases = mixing.plan_phases({s: 1.0 + i % 7 / 3 for i, s in enumerate(blocks)}, blocks, frame)
    assert len(phases) <= n
    assert all(len(p.order) == sum(map(len, p.slots.values())) <= max(frame, n) for p in phases)
    assert all([p.order[i] for i in at] == [s] * len(at) for p in phases for s, at in p.slots.items())
    assert phases[-1].until == blocks


def test_mixing_does_not_depend_on_the_order_of_equal_ids(documents, monkeypatch):
    monkeypatch.setattr(mixing, "_CELL", 9)
    table = documents.selectExpr("doc_id % 5 as doc_id", "text", "'s' as source", "n_chars").distinct()
    one = mixing.mix_sources(table, block=3).collect()
    two = mixing.mix_sources(table.repartition(13), block=3).collect()
    assert sorted(one, key=str) == sorted(two, key=str)
    assert len({(r.mix_slot, r.mix_place) for r in one}) == len(one)


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix_sources(odd, {"a": 3.0, "b": 0.0, "gone": 2.0}, block=1)
    assert got.columns == [*odd.columns, "mix_slot", "mix_place"]
    assert sorted(r.mix_slot for r in got.collect()) == list(range(odd.count()))
    assert mixing.mix_sources(empty).count() == 0
