"""Languages by letter-gram profiles, and lemma rules learned by aggregation.

Profiles: the texts whose stop words tell their language say how often each
language uses each gram of a word. Texts without a stop word are scored by the
grams they hold, so short ones and those of scripts without spaces get a
language as well, of those the corpus has.

Lemma rules: every (surface, lemma) pair gives an edit of its ending, told for
endings of several lengths. Per language and ending the most frequent edit
becomes the rule, and a word takes the rule of its longest known ending.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.words import UNKNOWN
from pagelode.session import materialize

GRAM = 3
# Grams of the profiles that go to all tasks at once: a number per language each.
MAX_BROADCAST_GRAMS = 200_000


def word_grams(word: Column, size: int = GRAM) -> Column:
    """All runs of ``size`` letters of a word with a mark on either side, repeats kept."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (size - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.substring(marked, i, F.lit(size)))


def _gram_rows(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, gram, n): how often each gram occurs, counted on the map side."""
    words = texts.select(*keys, F.explode("words").alias("word"))
    counted = words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    grams = counted.select(*keys, F.explode(word_grams(F.col("word"))).alias("gram"), "n")
    return grams.groupBy(*keys, "gram").agg(F.sum("n").alias("n"))


def language_profiles(texts: DataFrame) -> DataFrame:
    """(gram, language, n) from texts (words, language); those of unknown language say nothing."""
    told = texts.where(F.col("language") != UNKNOWN)
    return _gram_rows(told, "language").select("gram", "language", "n")


def score_languages(texts: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """(key, language): of each text the language under which its grams are likeliest.

    The likelihood is that of grams drawn one by one, each counted once more than
    it was seen. Ties go to the first name. A text without a word, or without
    any profile, has no row.
    """
    profiles = materialize(profiles.select("gram", "language", "n"), "profiles")
    # One row per language; the number of distinct grams is that of all languages.
    sizes = profiles.groupBy("language").agg(F.sum("n").alias("size")).orderBy("language").collect()
    texts = texts.where(F.col(key).isNotNull()).select(key, "words")
    if not sizes:
        return texts.limit(0).select(key, F.lit(UNKNOWN).alias("language"))
    known = profiles.agg(F.count_distinct("gram")).first()[0]
    told = F.ln(F.col("n") + F.lit(1.0))
    gains = [f"_gain_{i}" for i in range(len(sizes))]
    columns = [F.sum(F.when(F.col("language") == r.language, told)).alias(g) for g, r in zip(gains, sizes, strict=True)]
    table = materialize(profiles.groupBy("gram").agg(*columns), "profile-columns")
    # The profiles go to the texts, not the grams of the texts to the profiles: a text
    # gives one row of sums. Profiles too large for that go in parts, one pass each.
    grams = texts.select(key, F.explode("words").alias("word")).select(key, F.explode(word_grams(F.col("word"))).alias("gram"))
    parts = 1 + known // MAX_BROADCAST_GRAMS
    of_part = F.pmod(F.xxhash64("gram"), F.lit(parts))
    sums = [F.coalesce(F.sum(g), F.lit(0.0)).alias(g) for g in gains]
    passes = [
        grams.join(F.broadcast(table.where(of_part == i)), "gram", "left")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("total"), *sums)
        for i in range(parts)
    ]
    seen = passes[0] if parts == 1 else reduce(DataFrame.union, passes).groupBy(key).agg(F.max("total").alias("total"), *sums)
    scores = [
        F.struct((F.col("total") * math.log(r.size + known) - F.col(g)).alias("cost"), F.lit(r.language).alias("language"))
        for g, r in zip(gains, sizes, strict=True)
    ]
    return seen.select(key, F.array_min(F.array(*scores))["language"].alias("language"))


def settle_languages(texts: DataFrame, key: str) -> DataFrame:
    """(key, language) of texts (key, words, language), where unknown ones are scored by profile.

    A text whose stop words told a language keeps it; one without a word stays
    unknown. Only the texts without a language are cut into grams to be scored.
    """
    open_texts = texts.where(F.col("language") == UNKNOWN).select(key, "words")
    found = score_languages(open_texts, language_profiles(texts), key)
    return texts.select(key, "language").join(found.withColumnRenamed("language", "_found"), key, "left").select(
        key, F.coalesce("_found", "language").alias("language")
    )


# Lemma rules

ENDING = 5


def lemma_rules(lemma_table: DataFrame, least: int = 2) -> DataFrame:
    """(lang, ending, cut, added): what to take off and put on for each ending.

    A pair tells its edit for every ending of its surface of up to ``ENDING``
    letters that holds what is taken off. The edit that most pairs agree on wins,
    ties to the shorter cut and then the first letters; endings of fewer than
    ``least`` pairs give no rule. Pairs are taken once.
    """
    pairs = lemma_table.select("lang", "surface", "lemma").distinct()
    # What both begin with: the longest prefix of the surface that is one of the lemma.
    lengths = F.sequence(F.lit(0), F.least(F.length("surface"), F.length("lemma")))
    common = F.array_max(
        F.filter(
            lengths,
            lambda n: F.substring("surface", F.lit(1), n) == F.substring("lemma", F.lit(1), n),
        )
    )
    edits = pairs.withColumn("common", common).select(
        "lang",
        "surface",
        (F.length("surface") - F.col("common")).alias("cut"),
        F.expr("substring(lemma, common + 1, length(lemma))").alias("added"),
    )
    sizes = F.expr(f"filter(sequence(0, {ENDING}), n -> n >= cut and n <= length(surface))")
    told = edits.select("lang", "cut", "added", F.col("surface"), F.explode(sizes).alias("size")).select(
        "lang", "cut", "added", F.expr("right(surface, size)").alias("ending")
    )
    counted = told.groupBy("lang", "ending", "cut", "added").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("lang", "ending").agg(
        F.sum("n").alias("pairs"), F.min(F.struct(-F.col("n"), "cut", "added")).alias("best")
    )
    return best.where(F.col("pairs") >= least).select("lang", "ending", "best.cut", "best.added")


def apply_lemma_rules(words: DataFrame, rules: DataFrame) -> DataFrame:
    """(lang, word, lemma) of distinct words (lang, word): the rule of the longest known ending.

    A word without a known ending, or shorter than what its rule takes off and
    one letter, is its own lemma.
    """
    asked = words.select("lang", "word").distinct()
    ends = asked.select(
        "lang", "word", F.explode(F.sequence(F.lit(0), F.least(F.length("word"), F.lit(ENDING)))).alias("size")
    ).withColumn("ending", F.expr("right(word, size)"))
    found = (
        ends.join(rules, ["lang", "ending"])
        .groupBy("lang", "word")
        .agg(F.max_by(F.struct("cut", "added"), "size").alias("rule"))
    )
    lemma = F.when(
        F.length("word") > F.col("rule.cut"),
        F.concat(F.expr("left(word, length(word) - rule.cut)"), "rule.added"),
    )
    return asked.join(found, ["lang", "word"], "left").select(
        "lang", "word", F.coalesce(lemma, "word").alias("lemma")
    )
