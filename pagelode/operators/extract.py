"""Pages to text, words, language and link targets; narrow, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import html, urls, words


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a stage of its own.

    A filter above derived columns, such as the one Spark infers for an
    explode, is pushed below them by copying their expressions, and a chain of
    copies grows exponentially. Filters on generated columns stay above, so
    the columns are computed once per row.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def page_text(pages: DataFrame) -> DataFrame:
    """(link_id, url, title, text); the title is put in front of the body text.

    The body text holds the title too, so title words count twice.
    """
    staged = pages.select(
        F.col("page_id").alias("link_id"),
        "url",
        html.raw_title(F.col("html")).alias("_title"),
        html.strip_markup(F.col("html")).alias("_body"),
    )
    return staged.select(
        "link_id",
        "url",
        html.decode_entities(F.col("_title")).alias("title"),
        html.clean_control(
            F.concat_ws(
                " ", html.decode_entities(F.col("_title")), html.decode_entities(F.col("_body"))
            )
        ).alias("text"),
    )


def _words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words.alphabetic_words(F.col("text"))).drop("text")


def _language(df: DataFrame, languages) -> DataFrame:
    names = df.columns
    hits = df.withColumn("_hits", words.any_stop_words("words", languages))
    votes = words.language_votes("_hits", languages)
    counted = hits.select(*names, *[v.alias(f"_votes_{lang}") for lang, v in votes.items()])
    best = words.top_language({lang: F.col(f"_votes_{lang}") for lang in languages})
    return counted.select(*names, best.alias("language"))


def _content(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words.without_stop_words("words", "language"))


def _lemmas(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words.lemmas(F.col("words"), F.col("language")))


def page_words(texts: DataFrame) -> DataFrame:
    """``words``, the lowercased alphabetic words in order, in place of ``text``."""
    return settled(_words(texts))


def detect_language(df: DataFrame, languages=words.LANGUAGES) -> DataFrame:
    """Adds ``language``: the language with most stop words among ``words``."""
    return settled(_language(df, languages))


def content_words(df: DataFrame) -> DataFrame:
    """Drops the stop words of the page's language from ``words``."""
    return settled(_content(df))


def rule_lemmas(df: DataFrame) -> DataFrame:
    """Replaces every word by its lemma."""
    return settled(_lemmas(df))


def table_lemmas(tokens: DataFrame, table: DataFrame) -> DataFrame:
    """Lemma of each (language, word) row from a table (lang, surface, lemma).

    Words the table lacks follow the ending rules. The join has no hint: the
    table is broadcast only if its measured size allows, and otherwise a word
    that fills a third of the rows is split by the skew join.
    """
    keys = table.select(
        F.col("lang").alias("_lang"), F.col("surface").alias("word"), F.col("lemma").alias("_lemma")
    )
    return (
        tokens.withColumn("_lang", words.word_pipeline(F.col("language")))
        .join(keys, ["_lang", "word"], "left")
        .withColumn(
            "word",
            F.coalesce("_lemma", words.rule_lemma(F.col("word"), F.col("language"))),
        )
        .select(*tokens.columns)
    )


def _with_base(df: DataFrame) -> DataFrame:
    """Adds ``base``, the parts of the URL that the page's links are relative to.

    That is the page URL, or ``_declared``, which may be relative to it. One
    column per stage, as each is read several times by the next.
    """
    url = F.when(F.col("_declared") == "", F.col("url")).otherwise(
        urls.resolve_url(F.col("_page"), F.col("_declared"))
    )
    return (
        df.withColumn("_page", urls.base_parts(F.col("url")))
        .withColumn("_url", url)
        .withColumn("base", urls.base_parts(F.col("_url")))
        .drop("_page", "_url", "_declared")
    )


def _followable_hrefs() -> Column:
    decoded = F.transform("_hrefs", html.decode_entities)
    return F.transform(F.filter(decoded, urls.followable), urls.trim_href)


def page_hrefs(pages: DataFrame) -> DataFrame:
    """(link_id, url, base, hrefs) with the hrefs that can be followed."""
    staged = pages.select(
        F.col("page_id").alias("link_id"),
        "url",
        html.base_href(F.col("html")).alias("_base"),
        html.raw_hrefs(F.col("html")).alias("_hrefs"),
    )
    return settled(
        _with_base(
            staged.select(
                "link_id",
                "url",
                urls.trim_href(html.decode_entities(F.col("_base"))).alias("_declared"),
                _followable_hrefs().alias("hrefs"),
            )
        )
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(link_id, url_to), one row per followable link, repeats kept."""
    return (
        page_hrefs(pages)
        .select("link_id", "base", F.explode("hrefs").alias("href"))
        .select("link_id", urls.resolve_url(F.col("base"), F.col("href")).alias("url_to"))
    )


def extract(
    pages: DataFrame, languages=words.LANGUAGES, lemmatise: bool = True, links: bool = True
) -> DataFrame:
    """(link_id, url, title, language, words, targets): all a page contributes.

    One pass over the page, so that the stages that need it read this narrow
    result and never the HTML again. With ``lemmatise=False`` the words stay
    surface forms, for a lemma table to replace later. With ``links=False``
    there are no ``targets``, and links are not looked for.
    """
    if not links:
        worded = _content(_language(_words(page_text(pages)), languages))
        done = _lemmas(worded) if lemmatise else worded
        return settled(done.select("link_id", "url", "title", "language", "words"))
    staged = pages.select(
        F.col("page_id").alias("link_id"),
        "url",
        html.raw_title(F.col("html")).alias("_title"),
        html.strip_markup(F.col("html")).alias("_body"),
        html.base_href(F.col("html")).alias("_base"),
        html.raw_hrefs(F.col("html")).alias("_hrefs"),
    )
    decoded = staged.select(
        "link_id",
        "url",
        html.decode_entities(F.col("_title")).alias("title"),
        html.decode_entities(F.col("_body")).alias("_text"),
        urls.trim_href(html.decode_entities(F.col("_base"))).alias("_declared"),
        _followable_hrefs().alias("hrefs"),
    )
    texts = _with_base(decoded).select(
        "link_id",
        "url",
        "title",
        F.transform(
            "hrefs", lambda href: urls.resolve_url(F.col("base"), href)
        ).alias("targets"),
        # Control characters separate words like spaces, so they may stay here.
        F.concat_ws(" ", "title", "_text").alias("text"),
    )
    worded = _content(_language(_words(texts), languages))
    done = _lemmas(worded) if lemmatise else worded
    return settled(done.select("link_id", "url", "title", "language", "words", "targets"))
