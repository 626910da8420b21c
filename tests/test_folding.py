"""Folded keys against the collation, and what is built on them."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from pagelode.functions.folding import folded, folded_text
from pagelode.operators import index as ix
from pagelode.operators import match
from pagelode.operators import search as se


def letters(*spans):
    return [c for low, high in spans for c in map(chr, range(low, high)) if unicodedata.category(c) in ("Lu", "Ll")]


def test_keys_agree_with_the_collation(spark):
    # Latin with its supplements, and the plain Greek and Cyrillic letters.
    listed = letters((0x41, 0x180), (0x1E00, 0x1EF0), (0x386, 0x3CF), (0x400, 0x460))
    df = spark.createDataFrame([(c,) for c in listed], "c STRING").withColumn("key", folded(F.col("c")))
    # Letters with a key of their own that the collation takes for another one.
    apart = {"ŀ", "ŉ", "ŧ", "ı", "ĸ", "ґ"}
    equal = df.groupBy(F.collate("c", "UNICODE_CI_AI")).agg(F.collect_set("key").alias("keys"))
    for r in equal.collect():
        assert len(set(r["keys"]) - apart) <= 1, r
    wrong = df.where("collate(c, 'UNICODE_CI_AI') <> collate(key, 'UNICODE_CI_AI')").collect()
    assert [r.c for r in wrong if r.c not in "ŉİ"] == []
    assert [folded_text(c) for c in listed] == [r.key for r in df.collect()]


def test_keys_of_texts(column):
    texts = ["Straße", "STRASSE", "über", "ÜBER", "Ævar œuvre", "ﬃ", "Łódź", "", None, "日本", "http://A.B/É?x=Ü"]
    got = column(folded, *texts)
    assert got == ["strasse", "strasse", "uber", "uber", "aevar oeuvre", "ffi", "lodz", "", None, "日本", "http://a.b/e?x=u"]
    assert got == [None if t is None else folded_text(t) for t in texts]


def test_folded_matching_in_both_forms(spark):
    words = spark.createDataFrame([(w,) for w in ("für", "fur", "furtherance", "FÜRCHTEN", "straße", "strasse", "gros", "größe")], "word STRING")
    keys = ix.fold_keys(words)
    grams = match.word_grams(keys.select(F.col("key").alias("word")).distinct())
    queries = ["FÜRC", "strasse", "STRASSE", "straß", "größ", "+trás -xyzw", "für", "fü*", '"RÖSS"']
    asked = spark.createDataFrame(list(enumerate(queries)), "id INT, query STRING")
    got = match.match_queries_folded(asked, grams, keys, ["id"]).collect()
    for i, query in enumerate(queries):
        one = sorted(r.word for r in match.match_words_folded(keys, query).collect())
        assert one == sorted(r.word for r in got if r.id == i), query
    assert sorted(r.word for r in got if r.id == 1) == ["strasse", "straße"]
    assert sorted(r.word for r in got if r.id == 4) == ["größe"]
    assert not [r for r in got if r.id == 6]


def test_folded_tables(spark):
    links = spark.createDataFrame(
        [(2, "http://H/A", "english", "two"), (1, "http://h/á", "english", "one"), (3, "http://h/b", "english", None)],
        "link_id BIGINT, url STRING, language STRING, title STRING",
    )
    postings = spark.createDataFrame(
        [("über", 1, 2), ("uber", 1, 3), ("uber", 2, 9), ("uber", 3, 1), ("gräber", 3, 4)],
        "word STRING, link_id BIGINT, weight BIGINT",
    )
    edges = spark.createDataFrame(
        [(1, "HTTP://H/B"), (1, "http://h/b"), (2, "http://h/b"), (3, "http://h/A"), (3, "http://x/Z")],
        "link_id_from BIGINT, url_to STRING",
    )
    tables = ix.folded_tables(ix.IndexTables(links, postings, edges))
    # Pages 1 and 2 have one URL; the first stays, as it is spelt.
    assert sorted((r.link_id, r.url) for r in tables.links.collect()) == [(1, "http://h/á"), (3, "http://h/b")]
    assert sorted(tuple(r) for r in tables.postings.collect()) == [("graber", 3, 4), ("uber", 1, 5), ("uber", 3, 1)]
    assert sorted(tuple(r) for r in tables.edges.collect()) == [(1, "http://h/b"), (3, "http://h/á"), (3, "http://x/z")]
    index = se.search_index(tables)
    found = se.search(index, folded_text("ÜBER"), "english", missing_backlinks="zero").collect()
    assert sorted(r.url for r in found) == ["http://h/b", "http://h/á"]
    empty = ix.folded_tables(ix.IndexTables(links.limit(0), postings.limit(0), edges.limit(0)))
    assert empty.links.count() == empty.postings.count() == empty.edges.count() == 0
