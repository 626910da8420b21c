"""Small cases of the column expressions."""

from __future__ import annotations

import html as stdlib_html
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from pagelode.functions import html, settings, urls, words


def test_markup(column):
    assert column(
        lambda c: F.trim(F.regexp_replace(html.strip_markup(c), " +", " ")),
        '<p>a</p><script>var t="</p>";</script>b<!-- x --><b>c</b>',
        "a<!-- unclosed <p>b",
        '<a title="x > y">t</a>',
        "1 < 2 and <p class=\"x>z",
        "<scripted>s</scripted><style type='a'>p{}</STYLE >t",
        "<script><!-- </script> t",
        "<template><p>x</p></template>y",
    ) == ["a b c", "a", "t", "1 < 2 and z", "s t", "t", "y"]


def test_very_long_tag_and_page(column):
    long_tag = "<p " + 'a="b" ' * 200_000 + ">x</p>"
    many = "<!--" * 50_000 + "x"
    assert column(lambda c: F.trim(html.strip_markup(c)), long_tag, many) == ["x", ""]
    assert column(html.raw_title, long_tag + "<title>t</title>") == ["t"]


def test_title(column):
    assert column(
        html.raw_title,
        "<html><title>A b</title><title>c</title>",
        "<!-- <title>no</title> --><title lang='en'>yes</title>",
        "<script>'<title>no</title>'</script><TITLE>Up</TITLE>",
        "<p>none</p>",
        "<title></title>",
    ) == ["A b", "yes", "Up", None, None]


ENTITIES = [
    "&amp;uuml;",
    "f&uuml;r &Auml;&szlig;&eacute;",
    "&#228;&#xE4;&#x1F600;!",
    "a & b &unknown; &",
    "&lt;b&gt;&quot;&apos;&copy;",
    "no entity",
    "&amp;amp;lt;",
    "x&;y&#;z",
]


def test_entities_equal_the_standard_library(column):
    expected = [stdlib_html.unescape(t) for t in ENTITIES]
    assert column(html.decode_entities, *ENTITIES) == expected


def test_entity_decoded_once(column):
    assert column(html.decode_entities, "&amp;uuml;", "&#0;") == ["&uuml;", " "]


def test_hrefs(column):
    page = (
        '<a href="/a">1</a><a class="x" HREF=\'b?c=1&amp;d=2\'>2</a><a href=bare>3</a>'
        '<a data-href="no" title="href=no" id=x href="yes">4</a><!-- <a href="no"> -->'
        '<a name="no">5</a><a href="">6</a><area href="no"><a\nhref = "/nl">7</a>'
        '<a title="a>b" href="/gt">8</a>'
    )
    assert column(html.raw_hrefs, page) == [
        ["/a", "b?c=1&amp;d=2", "bare", "yes", "", "/nl", "/gt"]
    ]


@pytest.mark.parametrize(
    "base",
    ["http://h.org/a/b/c.html?p=1#f", "https://h.org", "http://h.org/", "http://u:p@h.org:8080/x/y/"],
)
def test_resolution_equals_the_standard_library(spark, base):
    hrefs = [
        "/a", "a/b", "../c", "../../../c", "./d", ".", "..", "../", "//h/x", "?q=1", "#top",
        "http://x/y", "https://x.org/a/../b", "", "  /lead", "a/../b/./c", "/a/../b", "x?y#z",
        "/e/..", "g;x=1", "/p?u=/../v", "mail.html", "/dir/", "ftp://f/g", "a//b",
    ]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(hrefs)], "i INT, h STRING")
    got = (
        rows.select("i", urls.base_parts(F.lit(base)).alias("b"), urls.trim_href(F.col("h")).alias("h"))
        .select("i", urls.resolve_url(F.col("b"), F.col("h")).alias("u"))
        .orderBy("i")
        .collect()
    )
    skip = {"a//b"}  # urljoin drops the empty segment, RFC 3986 keeps it
    for row, href in zip(got, hrefs, strict=True):
        if href not in skip:
            assert row.u == urljoin(base, href), href


def test_followable(column):
    assert column(
        urls.followable, "/a", "tel:1", "telephone.html", "JavaScript:1", "mailto:x", "webcal:y", ""
    ) == [True, False, False, True, False, False, True]


def test_hosts(column):
    assert column(urls.host, "http://A.b:80/x", "https://u@c.d?x", "/rel", "http:///x") == [
        "a.b", "c.d", None, None,
    ]
    assert column(urls.host_suffixes, "a.b.c") == [["a.b.c", "b.c", "c"]]


def test_valid_urls(column):
    assert column(
        urls.valid_url,
        "https://www.example.com", "http://example.com/a?b#c", "ftp://x.org", "example.com",
        "http://nodots", "http://a b.com", "http://localhost:8080/", "mailto:a@b.c", "", None,
    ) == [True, True, True, False, False, False, True, False, False, False]


def test_durations(column):
    assert column(
        settings.duration_seconds, "30s", "5m", "2h", "7d", "1w", "1M", "1y", "9x"
    ) == [30, 300, 7200, 604800, 604800, 2592000, 31536000, 0]


def test_list_items(column):
    assert column(settings.list_items, "a;b;;c", " ; x ;", "") == [["a", "b", "c"], [" x "], []]


def test_words(column):
    assert column(
        words.alphabetic_words, "ab12 foo_bar don't well-known Straße É1 日本 e\u0301 x"
    ) == [["don", "t", "well", "known", "straße", "日本", "x"]]


def test_lemma_rules(column):
    assert column(
        words.english_lemma, "queries", "horses", "cats", "bus", "glass", "aloes", "zombeies", "cat"
    ) == ["query", "horse", "cat", "bus", "glass", "aloe", "zombeie", "cat"]
    assert column(words.german_lemma, "kindern", "frauen", "hauses", "haus", "lampen", "strasse") == [
        "kind", "frau", "haus", "haus", "lamp", "strass",
    ]


def test_numbers_out_of_range_give_a_space(column):
    long = "0" * 40
    texts = ["&#10999990;", "&#x10FFFF0;", f"&#{long}65;", f"&#x{long}41;", "&#99999999999;x", "&#xD800;", "&#0;"]
    assert column(html.decode_entities, *texts) == [" ", " ", "A", "A", " x", " ", " "]


def test_addresses_and_ports_are_bounded(column):
    good = ["http://255.0.10.1/", "http://1.1.1.1:65535/x", "http://a.bc:80"]
    bad = ["http://999.1.1.1/", "http://256.1.1.1/", "http://a.bc:99999/", "http://1.1.1.1:65536"]
    assert column(lambda c: urls.valid_url(c), *good, *bad) == [True] * 3 + [False] * 4
