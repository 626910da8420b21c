"""Word matching: rules, and the equality of its two forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagelode.operators import match
from pagelode.operators.index import folded_dictionary
from pagelode.operators.suggest import suggest

WORDS = ["search", "sea", "research", "fur", "für", "seam", "teas", "seaside", "a", "arch"]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([(w,) for w in WORDS], "word STRING")


def found(df):
    return sorted(r.word for r in df.collect())


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("sear", ["research", "search"]),
        ("sea", []),
        ("SEAR", ["research", "search"]),
        ("sea*", ["seam", "search", "seaside", "research"]),
        ("a*", ["arch", "research", "search", "seaside"]),
        ("+sear -rese", ["search"]),
        ("-rese", []),
        ("sear seam", ["research", "seam", "search"]),
        ("+arch +sear", ["research", "search"]),
        ("+arch seam", ["arch", "research", "search"]),
        ("+sea +arch", []),
        ('"sear" ~seam', ["research", "seam", "search"]),
        ("(seam >seas)", ["seam", "seaside"]),
        ("search*", ["research", "search"]),
        ("", []),
        ("zzzz", []),
    ],
)
def test_rules_and_both_forms(spark, dictionary, query, expected):
    assert found(match.match_words(dictionary, query)) == sorted(expected)
    queries = spark.createDataFrame([(1, query)], "query_id INT, query STRING")
    batch = match.match_queries(queries, match.word_grams(dictionary), ["query_id"])
    assert found(batch) == sorted(expected)


def test_many_queries_equal_single_queries(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = documents.select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    ).distinct().where("word <> ''").cache()
    asked = ["ther", "lich keit", "+tion -ther", "sc*", "erth*", "+sch +lich", "the"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id INT, query STRING")
    batch = match.match_queries(queries, match.word_grams(words), ["query_id"]).collect()
    for i, query in enumerate(asked):
        expected = found(match.match_words(words, query))
        assert sorted(r.word for r in batch if r.query_id == i) == expected, query


def test_terms_of_both_forms_agree(spark):
    asked = ['+a -"b c" d* <e> ~f (g h)', '""', "+-x", "Ab  cD"]
    asked += ["ther\u00a0lich", "ther\u3000lich\u2028sc*", "a\u0085b\x0bc\x1fd", "İSTANBUL ΟΔΟΣ ΣΑΣ"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id INT, query STRING")
    rows = match.explode_terms(queries, ["query_id"]).orderBy("query_id", "term_no").collect()
    for i, query in enumerate(asked):
        expected = [(t.text, t.role, t.prefix) for t in match.query_terms(query)]
        assert [(r.term, r.role, r.prefix) for r in rows if r.query_id == i] == expected, query


def test_no_cross_join_in_batch_match(spark, dictionary):
    queries = spark.createDataFrame([(1, "sear")], "query_id INT, query STRING")
    plan = match.match_queries(queries, match.word_grams(dictionary), ["query_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_fold(spark):
    words = spark.createDataFrame(
        [("Fur",), ("für",), ("strasse",), ("straße",), ("x",)], "word STRING"
    )
    rows = {(r.word, r.variants) for r in folded_dictionary(words).collect()}
    assert rows == {("Fur", 2), ("strasse", 2), ("x", 1)}


def test_suggest_order_limit_and_repeats(spark):
    names = [f"lich{'x' * n}" for n in range(9)] + ["aalich"]
    grams = match.word_grams(spark.createDataFrame([(w,) for w in names], "word STRING"))
    queries = spark.createDataFrame([(1, "lich  lich")], "query_id BIGINT, query STRING")
    rows = suggest(queries, grams).orderBy("term_pos", "pos").collect()
    expected = ["lich", "lichx", "aalich", "lichxx", "lichxxx", "lichxxxx"]
    assert [(r.term_pos, r.word) for r in rows] == [
        (p, w) for p in (0, 2) for w in expected
    ]
