"""Language profiles, the quality classifier and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
import corpus_pipeline
from pagelode.llm import language, minhash, mixing, quality, queries
from pagelode.llm.scratch import Scratch

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_trigrams_of_letters_and_gaps():
    a, b, gap = 1, 2, 0
    code = lambda *x: x[0] << 14 | x[1] << 7 | x[2]
    for text in ("ab", "AB", " 1 a-b".replace("-", ""), "ab!!"):
        assert language.trigrams(text).tolist() == [code(gap, a, b), code(a, b, gap)]
    assert language.trigrams("a, b").tolist() == [code(gap, a, gap), code(a, gap, b), code(gap, b, gap)]
    assert len(language.trigrams("12 !? \n")) == 0 and len(language.trigrams("日本")) == 2


def test_bundle_is_the_sum_of_bound_permuted_letters():
    codes = language.trigrams("Hyper dimension")
    letters = language.letter_vectors(64)
    total = np.zeros(64)
    for c in codes:
        x, y, z = c >> 14, c >> 7 & 127, c & 127
        total += np.roll(letters[x], 2) * np.roll(letters[y], 1) * letters[z]
    assert (language._bundles([codes, codes[:3]], 64)[0] == total).all()


def test_held_out_documents_are_recognised(larger):
    got = {r.doc_id: r for r in language.identify_languages(larger).collect()}
    lang = {r.doc_id: (r.lang, r.n_chars) for r in larger.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].lang_pred == lang[i][0] for i in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(odd, empty):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_languages(odd).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[7][0] == "en"
    assert language.identify_languages(empty).count() == 0


def test_label_model_finds_the_accuracies():
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.8
    wrong = ((0.4, 0.01), (0.5, 0.02), (0.6, 0.005), (0.45, 0.03))
    votes = np.stack([np.where(draw.random(20_000) < np.where(good, f, h), 0, 1) for h, f in wrong], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.05
    for j, (hit, false) in enumerate(wrong):
        assert abs(model.chance[j, 0, 0] - hit) < 0.1 and abs(model.chance[j, 1, 0] - false) < 0.03


def test_quality_against_labels(spark, larger):
    model = quality.fit_quality(larger)
    kept = {r.doc_id: r.kept for r in quality.score_quality(larger, model).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    of = {q: [kept[r.doc_id] for r in labels if r.quality == q] for q in (0, 1)}
    assert sum(of[1]) >= 0.99 * len(of[1]) and sum(of[0]) <= 0.05 * len(of[0])


def test_repeated_rows_are_drawn_once(spark, monkeypatch):
    drawn, train = [], quality.train_scorer
    monkeypatch.setattr(quality, "train_scorer", lambda rows, good: drawn.append(len(rows)) or train(rows, good))
    text = "some words and others that are repeated here and there in a row of many"
    rows = [(7, text)] * 300 + [(None, text)] * 50 + [(i, f"{text} {i}") for i in range(100)]
    quality.fit_quality(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), sample=10_000)
    assert drawn == [102]


def test_shapes_of_long_words_are_whole():
    long = "a1" * 5000
    at, values = quality.features(f"{long}B {long}b")
    assert len(at) == 4 and quality._shape("a0" * 5000) == "a0" * 5000
    assert max(map(len, quality._SHAPES), default=0) <= 64


def test_quality_of_odd_rows(odd, empty):
    model = quality.fit_quality(odd)
    got = quality.score_quality(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.doc_id: r.kept for r in got if r.doc_id in (1, 2, 3)} == {1: False, 2: False, 3: False}
    assert quality.score_quality(empty, quality.fit_quality(empty)).count() == 0


def test_pipeline_stages_against_plain_code(spark, larger):
    docs = larger.where("doc_id < 250")
    rows = docs.collect()
    model = quality.fit_quality(docs)
    expected = [r for r in rows if model.scorer.score(r.text) >= model.threshold]
    docs = corpus_pipeline.by_quality(spark, docs, FOLDER)
    assert sorted(docs.collect()) == sorted(expected) and docs.columns == larger.columns

    prototypes = language.train_prototypes(docs)
    told = {r.doc_id: r for r in language.predict_language(docs, prototypes).collect()}
    expected = [
        r for r in expected
        if told[r.doc_id].lang_pred != "und"
        and not (r.lang is not None and r.lang != told[r.doc_id].lang_pred and told[r.doc_id].margin >= 0.1)
    ]
    docs = corpus_pipeline.by_language(spark, docs, FOLDER)
    assert sorted(docs.collect()) == sorted(expected)

    kept = {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}
    expected = [r for r in expected if r.doc_id in kept]
    docs = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    assert sorted(docs.collect()) == sorted(expected) and docs.columns == larger.columns

    order = {r.doc_id: (r.mix_slot, r.mix_place) for r in mixing.mix_sources(docs).collect()}
    mixed = corpus_pipeline.mix(spark, docs, FOLDER)
    assert [r.doc_id for r in mixed.collect()] == sorted(order, key=order.get)
    assert mixed.columns == larger.columns
    last = corpus_pipeline.tokens(spark, mixed, FOLDER).collect()
    assert sorted(r.doc_id for r in last) == sorted(order) and all(len(r.ids) == r.n_tokens for r in last)


def test_the_mixed_order_survives_files_read_in_any_order(spark, larger, monkeypatch, tmp_path):
    larger.where("doc_id < 250").write.parquet(str(tmp_path / "documents.parquet"))

    def keep(self, df, name):
        # Four files, read again from the last one to the first.
        rows = spark.createDataFrame(df.collect(), df.schema).repartitionByRange(4, F.monotonically_increasing_id().desc())
        path = f"{self.root}/{name}"
        rows.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    mixed = [stage for stage in corpus_pipeline.STAGES if stage[0] in ("mixing", "tokens")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", mixed)
    monkeypatch.setattr(Scratch, "keep", keep)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    order = {r.doc_id: (r.mix_slot, r.mix_place) for r in mixing.mix_sources(larger.where("doc_id < 250")).collect()}
    assert [r.doc_id for r in got] == sorted(order, key=order.get)
    assert {r.doc_id: (r.mix_slot, r.mix_place) for r in got} == order


def test_pipeline_of_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, FOLDER)
            assert name == "tokens" or docs.columns == columns
        assert docs.count() <= n


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names and set(queries.SQL) <= names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = compare.connect(folder)
    assert compare.spark_rows(queries.REGISTERED[name](spark, folder)) == compare.sql_rows(con, queries.SQL[name])


def test_a_kept_text_goes_to_a_worker_once(spark, tmp_path):
    import corpus_pipeline
    from pagelode.llm import language, quality

    rows = [(i, ["The quick brown fox jumps over the lazy dog. " * 9, None, ""][i % 3], "en", "s") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    model = quality.fit_quality(docs)
    prototypes = language.train_prototypes(docs)
    for run, told in ((quality.score_quality, (model,)), (language.predict_language, (prototypes,))):
        once, twice = (run(docs, *told, keep=k) for k in (("doc_id", "text", "lang"), ("doc_id", "lang")))
        assert "_text" not in once._jdf.queryExecution().optimizedPlan().toString()
        assert once.columns[:3] == ["doc_id", "text", "lang"] and once.columns[3:] == twice.columns[2:]
        assert sorted(map(str, once.drop("text").collect())) == sorted(map(str, twice.collect()))
        assert sorted(map(str, once.select(*docs.columns[:3]).collect())) == sorted(map(str, docs.drop("source").collect()))
    kept = corpus_pipeline.by_quality(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 10
