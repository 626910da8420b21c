"""Full-text word matching: substring terms, boolean roles, prefix terms.

``term_filter`` is the form for one query: a predicate on the dictionary.
``match_terms`` and ``match_queries`` are the form for many queries: an
equi-join on 4-grams, so no query is ever paired with the whole dictionary.
Both give the same words.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.folding import folded, folded_text

GRAM = 4

# A term is an optional sign, score operators that do not change what matches,
# and a quoted phrase or a run of other characters. Terms are parted by Unicode
# white space, spelled out as regular expressions differ on it.
_SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_TERM = rf'[+-]?[<>~(]*(?:"[^"]*"|[^{_SPACE}"()]+)'


@dataclass(frozen=True)
class Term:
    text: str
    role: str = "any"  # "any", "must" or "not"
    prefix: bool = False


def query_terms(query: str) -> list[Term]:
    """The terms of a query string: bare, ``+must``, ``-not``, ``pre*``, phrase."""
    terms = []
    for found in re.findall(_TERM, query.lower()):
        role = {"+": "must", "-": "not"}.get(found[0], "any")
        body = re.sub(r"^[+-]?[<>~(]*", "", found)
        if body.startswith('"'):
            terms.append(Term(body.strip('"'), role))
        else:
            terms.append(Term(body.rstrip("*"), role, body.endswith("*")))
    return terms


def matches(word: Column, term: Term) -> Column:
    """A term of four letters is a substring; a shorter one matches only as a
    prefix term, where one of the word's 4-grams has to start with it."""
    size = len(term.text)
    if size >= GRAM:
        return word.contains(term.text)
    if term.prefix and size:
        return F.left(word, F.length(word) - (GRAM - size)).contains(term.text)
    return F.lit(False)


def term_filter(word: Column, terms: list[Term]) -> Column:
    """All musts, no not, and at least one optional term if there is no must."""
    by_role = {
        role: [matches(word, t) for t in terms if t.role == role] for role in ("any", "must", "not")
    }
    wanted = (
        reduce(Column.__and__, by_role["must"])
        if by_role["must"]
        else reduce(Column.__or__, by_role["any"], F.lit(False))
    )
    return reduce(lambda kept, hit: kept & ~hit, by_role["not"], wanted)


def match_words(words: DataFrame, query: str) -> DataFrame:
    """Dictionary words that match one query."""
    return words.where(term_filter(F.col("word"), query_terms(query)))


def match_words_folded(keys: DataFrame, query: str) -> DataFrame:
    """Words (key, word) that match one query, whatever the case and the accents of either."""
    terms = query_terms(folded_text(query))
    return keys.where(term_filter(F.col("key"), terms))


def match_queries_folded(
    queries: DataFrame, grams: DataFrame, keys: DataFrame, columns: list[str], query: str = "query"
) -> DataFrame:
    """(columns, key, word): the words that match each query of a table, folded on either side.

    ``grams`` are the ``word_grams`` of the distinct keys, ``keys`` gives the words of a key.
    """
    asked = queries.withColumn(query, folded(F.col(query)))
    found = match_queries(asked, grams, columns, query).withColumnRenamed("word", "key")
    return found.join(keys, "key").select(*columns, "key", "word")


def word_grams(words: DataFrame) -> DataFrame:
    """Distinct (gram, word), with every 4-gram of every word."""
    starts = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = F.transform(starts, lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    return words.where(F.length("word") >= GRAM).select(
        F.explode(F.array_distinct(grams)).alias("gram"), "word"
    )


def explode_terms(queries: DataFrame, keys: list[str], query: str = "query") -> DataFrame:
    """``query_terms`` for a table: (keys, term_no, term, role, prefix)."""
    raw = queries.select(
        *keys,
        F.posexplode(
            F.regexp_extract_all(F.lower(query), F.lit(_TERM), F.lit(0))
        ).alias("term_no", "_raw"),
    )
    body = F.regexp_replace("_raw", r"^[+-]?[<>~(]*", "")
    phrase = body.startswith('"')
    return raw.select(
        *keys,
        "term_no",
        F.when(phrase, F.regexp_replace(body, '"', ""))
        .otherwise(F.regexp_replace(body, r"\*+$", ""))
        .alias("term"),
        F.when(F.col("_raw").startswith("+"), "must")
        .when(F.col("_raw").startswith("-"), "not")
        .otherwise("any")
        .alias("role"),
        (~phrase & body.endswith("*")).alias("prefix"),
    )


def gram_counts(grams: DataFrame) -> DataFrame:
    """(gram, words): in how many dictionary words each gram occurs."""
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("words"))


def match_terms(
    terms: DataFrame,
    grams: DataFrame,
    counts: DataFrame | None = None,
    prune: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(term, prefix, word) for distinct (term, prefix) rows.

    ``counts`` is the stored ``gram_counts`` of ``grams``; without it the grams
    of the terms are counted here. ``prune`` gives, for a table of the grams
    that are needed, the part of ``grams`` that can hold them.

    A long term joins on its rarest gram alone: every word with the term has
    that gram, and ``contains`` then keeps exactly the right ones. A term with
    a gram no word has is dropped before the join.
    """
    wanted = terms.select("term", "prefix").distinct()
    long_terms = wanted.where(F.length("term") >= GRAM)
    term_grams = long_terms.select(
        "term",
        "prefix",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("term") - (GRAM - 1)),
                lambda i: F.substring(F.col("term"), i, F.lit(GRAM)),
            )
        ).alias("gram"),
    )
    stored = counts is not None
    if not stored:
        counts = gram_counts(
            grams.join(term_grams.select("gram").distinct(), "gram", "left_semi")
        )
    rarest = (
        term_grams.join(counts, "gram", "left")
        .groupBy("term", "prefix")
        .agg(F.min(F.struct(F.coalesce("words", F.lit(0)).alias("n"), "gram")).alias("_best"))
        .where(F.col("_best.n") > 0)
        .select("term", "prefix", F.col("_best.gram").alias("gram"))
    )
    # Short prefix terms name the distinct grams they begin; words join on the gram.
    known = counts if stored else grams.select("gram").distinct()
    heads = F.array(*[F.left("gram", F.lit(n)) for n in range(1, GRAM)])
    begun = (
        known.select("gram", F.explode(heads).alias("term"))
        .join(wanted.where(F.col("prefix") & F.length("term").between(1, GRAM - 1)), "term")
        .select("term", "prefix", "gram")
    )
    if prune is not None:
        grams = prune(rarest.select("gram").union(begun.select("gram")))
    by_gram = (
        grams.join(rarest, "gram")
        .where(F.contains("word", "term"))
        .select("term", "prefix", "word")
    )
    by_prefix = grams.join(begun, "gram").select("term", "prefix", "word").distinct()
    return by_gram.unionByName(by_prefix)


def match_queries(
    queries: DataFrame,
    grams: DataFrame,
    keys: list[str],
    query: str = "query",
    counts: DataFrame | None = None,
    prune: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(keys, word): the dictionary words that match each query of a table."""
    terms = explode_terms(queries, keys, query)
    musts = terms.groupBy(*keys).agg(
        F.count_if(F.col("role") == "must").alias("_musts")
    )
    hits = (
        terms.join(match_terms(terms, grams, counts, prune), ["term", "prefix"])
        .groupBy(*keys, "word")
        .agg(
            *[F.count_if(F.col("role") == r).alias(f"_{r}") for r in ("any", "must", "not")]
        )
        .where(F.col("_not") == 0)
    )
    enough = F.when(F.col("_musts") > 0, F.col("_must") == F.col("_musts")).otherwise(
        F.col("_any") > 0
    )
    return hits.join(musts, keys).where(enough).select(*keys, "word")
