"""Near-duplicates, vectors and fingerprints against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re

import numpy as np
import pytest

from pagelode.llm import edits, minhash, vectors
from pagelode.llm.components import components
from pagelode.llm.scratch import Scratch

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingles(text, words):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(UPPER))
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, words))
    links = []
    for a, b in itertools.combinations(sorted(sets), 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    return roots(sets, links)


def found(df):
    return {r.doc_id: r.component_id for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize("small", [8, 1])
@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80), (2, 60)])
def test_near_duplicates_equal_brute_force(documents, monkeypatch, small, words, percent):
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = minhash.near_duplicates(documents, minhash.Settings(words, percent))
    assert found(got) == brute(rows, words, percent)


@pytest.fixture(scope="module")
def family(spark):
    """One text with many edited forms, a passage that many share, and chance."""
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(90)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(i % 7):
            text[draw.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(passage + [word() for _ in range(draw.randint(5, 40))])) for i in range(80)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), rows


@pytest.mark.parametrize("small", [8, 1])
def test_hot_groups_lose_no_link(family, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    df, rows = family
    assert found(minhash.near_duplicates(df, minhash.Settings(3, 85))) == brute(rows, 3, 85)


@pytest.mark.parametrize("small", [8, 1])
@pytest.mark.parametrize("times", [2, 4])
def test_repeated_rows_lose_no_link(spark, family, monkeypatch, small, times):
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    df, rows = family
    again = df
    for _ in range(times - 1):
        again = again.union(df)
    got = minhash.near_duplicates(again, minhash.Settings(3, 85)).collect()
    assert len(got) == times * len(rows)
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 85)


@pytest.mark.parametrize("small", [8, 1])
def test_ids_with_several_texts_lose_no_link(spark, family, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    _, rows = family
    # Ids 0 to 39 have three texts each, of the family and of the others; some rows repeat.
    both = rows + [(i, rows[150 + i % 50][1]) for i in range(40)] + [(i, rows[40 + i][1]) for i in range(40)] + rows[:30] * 2
    df = spark.createDataFrame(both, "doc_id BIGINT, text STRING")
    assert found(minhash.near_duplicates(df, minhash.Settings(3, 85))) == brute(both, 3, 85)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = minhash.near_duplicates(odd, minhash.Settings(3, 85)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert (by[1], by[2], by[3]) == ([(0, 1, True)], [(0, 2, True)], [(0, 3, True)])
    assert by[5] == [(1, 5, True)]
    # The long text repeats the short one, so their sets differ in two shingles.
    assert by[4] == [(16, 4, True)] and by[6] == [(14, 4, False)] * 2 and by[7] == [(14, 4, False)]
    assert [x[1:] for x in by[None]] == [(None, True)]
    assert len(got) == odd.count()
    assert minhash.near_duplicates(empty).count() == 0


def test_a_shifted_window_is_one_permutation():
    scatter, windows = minhash._circle(8, 1 << 10)
    assert sorted(scatter) == list(range(1 << 10))
    assert sorted(windows[:, 0]) == list(range(1 << 10))
    assert (windows[5, 1:] == windows[6, :-1]).all()
    sets = [minhash.shingle_set(" ".join(map(str, range(i, i + 400))), 1) for i in (0, 100)]
    x, y = (minhash.signature(s, 256) for s in sets)
    assert abs((x == y).mean() - 300 / 500) < 0.1


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(300, 300), (None, 4)]
    df = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in components(df, "a", "b", Scratch(spark, "t"), "t").collect()}
    expected = {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert got == expected
    assert components(df.limit(0), "a", "b", Scratch(spark, "t"), "t").count() == 0


def test_vectors_equal_brute_force(spark):
    random_ = np.random.default_rng(3)
    rows = []
    centres = random_.standard_normal((12, 24))
    for i in range(500):
        v = centres[i % 12] + random_.standard_normal(24) * (0.05 + 0.3 * (i % 5))
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3 if i % 50 else None))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(20)]
    rows += [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, [None] * 24, 1)]
    rows += [(2004, [], 1), (2005, [float("inf")] + [1.0] * 23, 1), (2006, [2 * x for x in rows[7][1]], rows[7][2])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT").selectExpr(
        "*", "1 as kind", "2 as node", "3 as kept"
    )
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, 0.93).collect()}
    good = [(i, np.array(v), lab) for i, v, lab in rows if lab is not None and v and None not in v]
    good = [(i, v, lab) for i, v, lab in good if np.isfinite(v).all() and np.any(v)]
    links = [
        (a, b)
        for (a, x, k), (b, y, m) in itertools.combinations(good, 2)
        if k == m and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93
    ]
    root = roots([r[0] for r in rows], links)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert got == {i: (n[i], root[i], root[i] == i) for i in n}
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_crowded_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    random_ = np.random.default_rng(5)
    base = random_.standard_normal(16)
    rows = [(i, [float(x) for x in base + random_.standard_normal(16) * 0.1], 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    unit = vectors.unit_vectors(np.array([r[1] for r in rows]))
    near = unit @ unit.T >= 0.93
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(df, 0.93).collect()}
    assert got == {i: int(near[i].sum()) - 1 for i in range(150)}


@pytest.mark.parametrize("crowd", [4, 64])
def test_many_tables_lose_no_link(spark, monkeypatch, crowd):
    """More hyperplanes and tables than the sketch has bits, one label with most rows."""
    monkeypatch.setattr(vectors, "_CROWD", crowd)
    random_ = np.random.default_rng(8)
    centres = random_.standard_normal((150, 32))
    rows = []
    for i in range(1200):
        v = centres[i % 150] + random_.standard_normal(32) * (0.2 + 0.1 * (i % 3))
        rows.append((i, [float(x) for x in v], "x" if i % 4 else "y"))
    # An id with two vectors, a row twice, a null id.
    rows += [(1300, rows[0][1], "y"), (1300, rows[1][1], "x"), (1301, rows[2][1], "x"), (1301, rows[2][1], "x")]
    df = spark.createDataFrame([*rows, (None, rows[3][1], "x")], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label STRING")
    bits, tables = vectors.table_sizes(901, 0.93)
    assert (bits * tables > vectors.SKETCH) == (crowd == 4)
    unit = vectors.unit_vectors(np.array([r[1] for r in rows]))
    marks = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (marks[:, None] == marks[None, :])
    links = [(rows[a][0], rows[b][0]) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    root = roots(sorted({r[0] for r in rows}), [(a, b) for a, b in links if a != b])
    got = vectors.near_vectors(df, 0.93).collect()
    assert sum(r.vec_id is None for r in got) == 1 and len(got) == len(rows) + 1
    assert {r.vec_id: r.component_id for r in got if r.vec_id is not None} == root
    alone = near.sum(axis=1) - 1
    assert {r.vec_id: r.n_links for r in got if r.vec_id is not None and r.vec_id < 1200} == {i: int(alone[i]) for i in range(1200)}


def test_a_pair_at_the_threshold_passes_the_sketch():
    random_ = np.random.default_rng(9)
    x = random_.standard_normal((20_000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = random_.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    planes = vectors._planes(48, vectors.SKETCH)
    apart = ((x @ planes > 0) != (y @ planes > 0)).sum(axis=1)
    assert apart.max() <= vectors.sketch_limit(0.93) < 40


def test_edit_fingerprints_follow_the_definition(documents):
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    got = {r.doc_id: r for r in edits.edit_fingerprints(documents).collect()}
    import hashlib

    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == edits.fingerprint(text) and r.edited_fingerprint == edits.fingerprint(edited)
        assert r.near_next == edits.likeness(r.fingerprint, edits.fingerprint(after))
        assert r.near_edited > 0.5 > 0.3 > r.near_next or text == after


def test_edit_in_the_middle_keeps_a_likeness():
    draw = random.Random(2)
    text = "".join(draw.choice("abcdefghij klmnop") for _ in range(4000))
    near = [edits.likeness(edits.fingerprint(text), edits.fingerprint(text[:k] + "xyz" + text[k:])) for k in range(100, 3900, 200)]
    far = edits.likeness(edits.fingerprint(text), edits.fingerprint(text[::-1]))
    assert sum(near) / len(near) > 0.6 > far + 0.3


def test_edit_fingerprints_of_odd_rows(odd, empty):
    got = edits.edit_fingerprints(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_edited == 1.0
    assert by[6].fingerprint == by[7].fingerprint
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert edits.edit_fingerprints(empty).count() == 0


def test_near_texts_groups_copies(documents):
    told = edits.edit_fingerprints(documents)
    got = found(edits.near_texts(told))
    exact = brute([(r.doc_id, r.text) for r in documents.collect()], 3, 90)
    for i, root in exact.items():
        if i != root:
            assert got[i] == got[root]


def alike_by_brute_force(rows, threshold):
    pairs = itertools.combinations(rows, 2)
    links = [(a, b) for (a, x), (b, y) in pairs if edits.likeness(x, y) >= threshold]
    return roots([i for i, _ in rows], links), links


def test_bands_find_edits_at_the_start_middle_and_end(spark):
    draw = random.Random(4)
    some = lambda n: "".join(draw.choice("abcdefghij klmnop") for _ in range(n))
    texts = []
    for n in (300, 1000, 1020, 4000) * 6:
        base, part = some(n), draw.choice([n // 6, n // 4, n // 3])
        middle = (n - part) // 2
        texts += [base, some(part) + base[part:], base[:-part] + some(part)]
        texts += [base[:middle] + some(part) + base[middle + part :], some(20) + base]
    rows = [(i, edits.fingerprint(t)) for i, t in enumerate(texts)]
    expected, links = alike_by_brute_force(rows, 0.6)
    keys = {i: set(edits.band_keys(told, 0.6)) for i, told in rows}
    assert len(links) > 50 and all(keys[a] & keys[b] for a, b in links)
    assert found(edits.near_texts(spark.createDataFrame(rows, "doc_id BIGINT, fingerprint STRING"))) == expected


@pytest.mark.parametrize("block", [512, 2])
def test_a_band_loses_no_link_its_smallest_node_does_not_see(spark, monkeypatch, block):
    monkeypatch.setattr(edits, "BLOCK", block, raising=False)
    # All in one band, of which the smallest node is like none.
    monkeypatch.setattr(edits, "band_keys", lambda told, threshold=0.6: [1])
    draw = random.Random(6)
    some = lambda n: "".join(draw.choice("abcdefghij klmnop") for _ in range(n))
    texts = [some(1000)]
    for _ in range(5):
        base = some(1000)
        texts += [base, base[:-100] + some(100), base[:-150] + some(150)]
    rows = [(i, edits.fingerprint(t)) for i, t in enumerate(texts)]
    expected, links = alike_by_brute_force(rows, 0.6)
    assert len(links) >= 10 and all(a for a, _ in links)
    got = edits.near_texts(spark.createDataFrame(rows, "doc_id BIGINT, fingerprint STRING"))
    assert found(got) == expected
