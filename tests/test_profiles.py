"""Language profiles and learned lemma rules."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagelode.operators import extract as ex
from pagelode.operators import profiles as pr
from pagelode.plans import fixtures as fx

FOLDER = "/root/testdata/sf0.01"
TEXTS = "id BIGINT, words ARRAY<STRING>, language STRING"


def grams(word):
    marked = f"^{word}$"
    return [marked[i : i + 3] for i in range(max(1, len(marked) - 2))]


def test_scores_equal_plain_code(spark):
    rows = [
        (1, ["the", "there", "other"], "english"),
        (2, ["der", "die", "oder"], "german"),
        (3, ["les", "elles"], "french"),
        (4, ["lesser"], "unknown"),
        (5, ["odder", "odder"], "unknown"),
        (6, [], "unknown"),
        (7, ["ß"], "unknown"),
        (8, None, "unknown"),
        (9, ["東京都"], "japanese"),
        (10, ["京都"], "unknown"),
        (10, ["京都"], "unknown"),
    ]
    texts = spark.createDataFrame(rows, TEXTS)
    counts = {}
    for _, words, language in rows:
        if language != "unknown":
            counts.setdefault(language, Counter()).update(g for w in words for g in grams(w))
    known = len(set().union(*counts.values()))

    def likeliest(words):
        scores = {
            lang: sum(math.log((c[g] + 1) / (c.total() + known)) for w in words for g in grams(w))
            for lang, c in counts.items()
        }
        return min(scores, key=lambda lang: (-scores[lang], lang))

    got = {r.id: r.language for r in pr.settle_languages(texts, "id").collect()}
    assert got == {i: lang if lang != "unknown" or not words else likeliest(words) for i, words, lang in rows}
    assert (got[4], got[5], got[10], got[6], got[8]) == ("french", "german", "japanese", "unknown", "unknown")
    # Without any known text nothing can be told.
    lost = pr.settle_languages(texts.where("language = 'unknown'"), "id").collect()
    assert {r.language for r in lost} == {"unknown"}
    assert pr.settle_languages(texts.limit(0), "id").count() == 0


def test_fewer_documents_stay_unknown(spark):
    names = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}
    told = ex.detect_language(fx.document_words(spark, FOLDER)).select("doc_id", "words", "language")
    given = {r.doc_id: names.get(r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    before = {r.doc_id: r.language for r in told.select("doc_id", "language").collect()}
    after = {r.doc_id: r.language for r in pr.settle_languages(told, "doc_id").collect()}
    unknown = [i for i, lang in before.items() if lang == "unknown"]
    assert len(unknown) >= 9 and sum(lang == "unknown" for lang in after.values()) < 3
    right = sum(after[i] == given[i] for i in unknown)
    assert right >= 0.6 * len(unknown)
    alone = {r.doc_id: r.language for r in pr.score_languages(told.select("doc_id", "words"), pr.language_profiles(told), "doc_id").collect()}
    assert sum(alone[i] == given[i] for i in alone) > 0.97 * len(alone)


@pytest.fixture(scope="module")
def inflected():
    stems = [a + b + c for a in ("str", "bl", "qu", "m") for b in ("a", "o", "ei") for c in ("nd", "ll", "sk", "rt", "mp")]
    rows = []
    for stem in stems:
        rows += [("x", f"{stem}s", stem), ("x", f"{stem}ies", f"{stem}y"), ("x", f"{stem}ing", stem), ("x", f"{stem}", stem)]
    return rows


def test_rules_reproduce_the_table_and_generalise(spark, inflected):
    known, held = [r for i, r in enumerate(inflected) if i % 3], [r for i, r in enumerate(inflected) if not i % 3]
    kind = "lang STRING, surface STRING, lemma STRING"
    rules = pr.lemma_rules(spark.createDataFrame(known * 2, kind))
    words = spark.createDataFrame(known + held, kind).select("lang", F.col("surface").alias("word"))
    got = {r.word: r.lemma for r in pr.apply_lemma_rules(words, rules).collect()}
    assert sum(got[s] == lemma for _, s, lemma in known) >= 0.95 * len(known)
    assert sum(got[s] == lemma for _, s, lemma in held) >= 0.9 * len(held)


def test_rules_of_odd_pairs(spark):
    kind = "lang STRING, surface STRING, lemma STRING"
    pairs = [("a", "was", "be"), ("a", "xs", "x"), ("a", "ys", "y"), ("a", "geschwommen", "schwimmen"), ("a", "", "")]
    pairs += [("b", "xs", "xs"), ("b", "ys", "ys"), (None, "zs", "z"), ("a", None, "n"), ("a", "n", None)]
    rules = pr.lemma_rules(spark.createDataFrame(pairs, kind))
    words = [("a", "cats"), ("b", "cats"), ("a", "s"), ("a", ""), (None, "cats"), ("a", "was"), ("a", "cats")]
    got = pr.apply_lemma_rules(spark.createDataFrame(words, "lang STRING, word STRING"), rules)
    told = {(r.lang, r.word): r.lemma for r in got.collect()}
    assert (told["a", "cats"], told["b", "cats"], told["a", "s"], told["a", ""]) == ("cat", "cats", "s", "")
    assert told[None, "cats"] == "cats" and len(told) == 6
    assert pr.lemma_rules(spark.createDataFrame([], kind)).count() == 0


def test_texts_are_scored_where_they_are(spark, tmp_path, monkeypatch):
    """Profiles meet the texts without a shuffle of their grams, in one part or in several."""
    words = [("english", ["the", "there", "other", "this"]), ("german", ["der", "die", "oder", "das"]), ("french", ["les", "elle"])]
    rows = [(i, words[i % 3][1] * 40, words[i % 3][0]) for i in range(300)]
    rows += [(i, words[i % 3][1][:1] * 30, "unknown") for i in range(300, 390)] + [(None, ["the"], "unknown"), (0, ["die"], "unknown")]
    spark.createDataFrame(rows, TEXTS).write.parquet(f"{tmp_path}/texts")
    texts = spark.read.parquet(f"{tmp_path}/texts")
    profiles = pr.language_profiles(texts)
    found = pr.score_languages(texts.select("id", "words"), profiles, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    got = {r.id: r.language for r in found.collect()}
    assert got == {i: words[i % 3][0] for i in range(390)}
    monkeypatch.setattr(pr, "MAX_BROADCAST_GRAMS", 9)
    parted = pr.score_languages(texts.select("id", "words"), profiles, "id")
    assert {r.id: r.language for r in parted.collect()} == got
