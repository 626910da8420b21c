"""Outliers, filter audit and infilling against plain code."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from pagelode.llm import infill, interplay, outliers, queries

FOLDER = "/root/testdata/sf0.001"
LABELS = "doc_id BIGINT, quality INT, toxic INT"
TEXTS = "doc_id BIGINT, text STRING, lang STRING, source STRING"


# Outliers


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    worded = [line for line in lines if re.search(r"[^\x20\x09-\x0D]", line)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for run in runs:
        seen[run] = seen.get(run, 0) + 1
    repeated = {i + j for i, run in enumerate(runs) if seen[run] > 1 for j in range(8)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines) if line in worded)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(worded),
        dup,
        len(repeated),
        sum(a == b for a, b in itertools.pairwise(words)),
        sum(map(str.isupper, text)),
    )


def test_counts_equal_plain_code(documents):
    draw = random.Random(1)
    texts = [r.text or "" for r in documents.collect()]
    texts += ["", " ", "a", "a\n\na\n \n ", "x " * 40, "é<\U0001f600>|\x0b\x0c\x85\xa0 Ä\n" * 3, "a\x00b a\x00b"]
    texts += [" ".join(draw.choice("ab") for _ in range(n)) for n in (7, 8, 9, 15, 16, 17, 60)]
    texts += ["".join(draw.choice("ab \n#") for _ in range(200)) for _ in range(50)]
    for text in texts:
        assert outliers.text_counts(text) == plain_counts(text), text


def plain_vector(counts):
    c = dict(zip(outliers.COUNTS, counts, strict=True))
    raw = (
        math.log((c["word_chars"] + 500) / (c["n_words"] + 100)) / 0.005,
        math.sqrt(c["n_symbols"] / (c["word_chars"] + 500)) / 0.005,
        math.sqrt(c["n_dup_lines"] / (c["n_lines"] + 5)) / 0.025,
        math.sqrt(c["n_repeat_words"] / (c["n_words"] + 100)) / 0.025,
        math.sqrt(c["n_doubled_words"] / (c["n_words"] + 100)) / 0.005,
        c["n_capitals"] / (c["word_chars"] + 500) / 0.0025,
    )
    return [round(x) for x in raw]


def plain_distances(x, centre, cov):
    away = x - centre
    return np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov + 16 * np.eye(6)), away)


def plain_estimate(x, settings):
    """Centre and covariance of one group, step by step over all its vectors."""
    h = math.ceil(settings.support * len(x))
    middle = np.sort(x, axis=0)[(len(x) - 1) // 2]
    width = np.maximum(1.4826 * np.sort(abs(x - middle), axis=0)[(len(x) - 1) // 2], 4.0)
    z = (x - middle) / width
    norm = np.sqrt((z * z).sum(axis=1, keepdims=True))
    signs = np.rint(1000 * np.divide(z, norm, out=np.zeros_like(z), where=norm > 0))
    runs = []
    for moved in (None, np.rint(1000 * np.tanh(z)), signs):
        correlation = np.eye(6)
        if moved is not None:
            cov = np.cov(moved.T, bias=True)
            size = np.sqrt(np.diag(cov))
            size[size == 0] = 1
            correlation = cov / np.outer(size, size)
            np.fill_diagonal(correlation, 1.0)
        centre, cov, volume = middle, correlation * np.outer(width, width), []
        for _ in range(settings.steps):
            at = np.floor(256 * np.log2(1 + plain_distances(x, centre, cov)))
            near = x[at <= np.sort(at)[h - 1]]
            centre = near.mean(axis=0)
            cov = outliers.consistency(settings.support) * np.cov(near.T, bias=True)
            volume.append(np.linalg.slogdet(cov + 16 * np.eye(6))[1])
        runs.append((volume[-1], len(runs), centre, cov))
    _, _, centre, cov = min(runs, key=lambda r: r[:2])
    inside = x[plain_distances(x, centre, cov) <= outliers.chi_square_quantile(settings.reweight, 6)]
    return inside.mean(axis=0), outliers.consistency(settings.reweight) * np.cov(inside.T, bias=True)


@pytest.fixture(scope="module")
def spoilt():
    """Prose of two languages and three sources, a ninth of it full of symbols, and odd groups."""
    draw = random.Random(2)
    rows = []
    for i in range(540):
        lang = "en" if i % 3 else "de"
        source = "a" if i % 2 else ("b" if i % 5 else None)
        long = 3 if lang == "en" else 6
        words = ["".join(draw.choice("abcdefghijk") for _ in range(draw.randint(1, 2 * long))) for _ in range(draw.randint(30, 300))]
        if i % 9 == 4:
            words = [w + draw.choice(["***", "$$$", "|"]) for w in words]
        rows.append((i, ("\n" if i % 4 else " ").join(words), lang, source))
    rows += [(1000 + i, "few words", "fr", "c") for i in range(5)]
    rows += [(1100, " ".join(f"mot{j}" for j in range(50)), "fr", "c"), (1101, None, None, None), (1102, " ".join("###" + str(j) for j in range(90)), "fr", None)]
    return rows


@pytest.mark.parametrize("copies", [1, 3])
def test_verdicts_equal_a_plain_estimate(spark, spoilt, copies):
    # The same number of steps on either side.
    settings = outliers.Settings(steps=4, gain=-math.inf, least=60)
    df = spark.createDataFrame(spoilt, TEXTS)
    for _ in range(copies - 1):
        df = df.union(spark.createDataFrame(spoilt, TEXTS))
    got = outliers.reject_outliers(df, settings).collect()
    assert len(got) == copies * len(spoilt)
    counts = {i: plain_counts(t or "") for i, t, _, _ in spoilt}
    failed = {i: c[0] < 20 or 100 * c[5] > 30 * c[0] for i, c in counts.items()}
    vectors = {i: plain_vector(c) for i, c in counts.items()}
    members = {}
    for i, _, lang, source in spoilt:
        if not failed[i]:
            for key in ((2, lang, source), (1, lang), (0,)):
                members.setdefault(key, []).extend([vectors[i]] * copies)
    fits = {
        k: plain_estimate(np.array(x, float), settings) for k, x in members.items() if len(x) >= settings.least
    }
    assert len(fits) >= 6
    for r in got:
        _, _, lang, source = next(row for row in spoilt if row[0] == r.doc_id)
        assert tuple(r[c] for c in outliers.COUNTS) == counts[r.doc_id]
        assert r.base_failed == failed[r.doc_id]
        if r.base_failed:
            assert r.distance is None and not r.kept
            continue
        key = next(k for k in ((2, lang, source), (1, lang), (0,)) if k in fits)
        (distance,) = plain_distances(np.array([vectors[r.doc_id]], float), *fits[key])
        assert r.distance == pytest.approx(distance, rel=1e-6, abs=1e-9)
        assert r.kept == (distance <= settings.cutoff)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] == (i % 9 != 4) for i in range(540))
    assert not kept[1102]


def test_the_same_answer_in_any_order(spark, spoilt):
    def told(df):
        return {r.doc_id: (r.distance, r.kept) for r in outliers.reject_outliers(df).collect()}

    df = spark.createDataFrame(spoilt, TEXTS)
    assert told(df) == told(df.orderBy(F.rand(3)).repartition(13))


def test_outliers_of_odd_rows(odd, empty):
    got = outliers.reject_outliers(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].base_failed and by[1].n_words == 0 and by[3].base_failed and not by[3].kept
    # Too few documents for any estimate: the rules alone decide.
    assert [r.distance for r in got] == [None] * len(got)
    assert by[4].base_failed and by[4].n_words == 48_000 and by[4].n_repeat_words == 48_000
    assert outliers.reject_outliers(empty).count() == 0


@pytest.mark.parametrize("degrees, quantile", [(6, 12.5916), (8, 15.5073), (1, 3.8415)])
def test_chi_square(degrees, quantile):
    assert outliers.chi_square_quantile(0.95, degrees) == pytest.approx(quantile, abs=1e-3)


# Filter audit


def plain_audit(rows, marks):
    """All rows of the audit, filter by filter."""

    def fails(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }

    judged = [(lang or "", fails(i, t or ""), marks.get(i, (0, 0))) for i, t, lang in rows]
    found = {}
    for part in {p for p, _, _ in judged}:
        mine = [(f, m) for p, f, m in judged if p == part]
        taken = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                out = [(f, m) for f, m in left if f[letter]]
                left = [(f, m) for f, m in left if not f[letter]]
                taken[letter] += len(out)
                found[part, order, step] = (
                    len(left),
                    len(out),
                    sum(f[letter] for f, _ in mine) - len(out),
                    sum(f[letter] and sum(f.values()) == 1 for f, _ in mine),
                    sum(m[0] for _, m in out),
                    sum(m[1] for _, m in out),
                )
        for (p, order, step), row in found.items():
            if p == part:
                found[p, order, step] = (*row, taken[order[step - 1]])
    return found


def audited(df, marks, **named):
    labels = df.sparkSession.createDataFrame([(i, *m) for i, m in marks.items()], LABELS)
    labels = labels.selectExpr("*", "1 as good", "'x' as part", "2 as n")
    return {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in interplay.audit_filters(df, labels, **named).collect()
    }


def test_audit_equals_plain_code(spark, odd, empty):
    draw = random.Random(3)
    some = lambda n: " ".join(draw.choice(["ab", "Cd", "ef", "G", "h#", "ij", *map(str, range(300))]) for _ in range(n))
    rows = [(i, some(draw.choice([5, 150, 250, 400])), draw.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(200 + i, rows[draw.randrange(6)][1], draw.choice(["en", "de"])) for i in range(80)]
    rows += [(300, None, "en"), (301, "", "fr"), (302, None, "fr"), (3, rows[3][1], "en"), (None, rows[4][1], "en"), (None, None, None)]
    marks = {i: (draw.randint(0, 1), draw.randint(0, 1)) for i in range(0, 320, 2)}
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").selectExpr(
        "*", "1 as bits", "'x' as part", "'y' as prefix", "'z' as cells", "0 as n"
    )
    assert audited(df, marks) == plain_audit(rows, marks)
    known = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert audited(odd, {6: (1, 1), 9: (1, 0)}) == plain_audit(known, {6: (1, 1)})
    assert audited(empty, {6: (1, 1)}) == {}


def test_audit_in_blocks_of_parts(spark, monkeypatch):
    monkeypatch.setattr(interplay, "_PARTS", 2)
    rows = [(i, "a" * (i % 4) + "#" * (i % 3), f"l{i % 7}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    assert audited(df, {1: (1, 0)}) == plain_audit(rows, {1: (1, 0)})


def test_repeated_labels_count_once(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, "b", "en")], "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1)], LABELS)
    got = interplay.audit_filters(docs, labels).where("filter_order = 'ABCDE' and step = 1").collect()
    assert [(r.removed, r.good_lost, r.toxic_lost) for r in got] == [(2, 1, 1)]


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_infill"])
def test_query_equals_its_sql(spark, name):
    got = compare.spark_rows(queries.registered()[name](spark, FOLDER))
    assert got == compare.sql_rows(compare.connect(FOLDER), queries.oracle_sql()[name])


# Infilling


def test_wavelet_matrix_ranks():
    random_ = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 500):
        symbols = random_.integers(0, 8, size).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols, 3)
        for symbol in range(8):
            counts = np.concatenate([[0], np.cumsum(symbols == symbol)])
            assert [matrix.rank(symbol, i) for i in range(size + 1)] == counts.tolist()


def plain_infill(doc_id, text):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(tokens)
    told = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(told[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_equals_plain_code(spark):
    draw = random.Random(4)
    texts = ["", " ", "  \n", "a", " a", "a ", "<", "<P", "<P>", "x<S>y", "M>", "é \U0001f600\x85b\xa0c\x0bd "]
    texts += ["".join(draw.choice("ab \n<PSM>\U0001f600é") for _ in range(draw.randint(1, 90))) for _ in range(400)]
    texts += ["word\t" * 30_000, None]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, "one two three", "n"), (3, "a", "again")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, output STRING")
    made = infill.fill_in_middle(df, keep=("doc_id", "output", "text")).toDF(
        "doc_id", "kept", "text", "n", "form", "prefix_chars", "middle_chars", "output"
    )
    got = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    for r in got:
        text = r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_infill(r.doc_id, text)
        assert r.back == text
    assert sorted(r.kept for r in got) == sorted(x for _, _, x in rows)


def test_infill_of_odd_rows(odd, empty):
    got = infill.fill_in_middle(odd, keep=("doc_id", "text", "kept", "row")).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_infill(r.doc_id, r.text or "")
    assert json.dumps([r.row for r in got]) == json.dumps(["y"] * len(got))
    assert infill.fill_in_middle(empty).count() == 0
