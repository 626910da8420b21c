"""Words of a text, page language, stop words and lemmas, as column expressions.

A page is one row and so is its word array; nothing here shuffles. Membership
tests use literal sets, which Spark looks up by hash.
"""

from __future__ import annotations

from functools import cache
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# Languages that have a list in the folder stopwords.
LANGUAGES = (
    "danish",
    "dutch",
    "english",
    "finnish",
    "french",
    "german",
    "hungarian",
    "italian",
    "norwegian",
    "portuguese",
    "russian",
    "spanish",
    "swedish",
    "turkish",
)
UNKNOWN = "unknown"

# A token is a maximal run of letters, digits, marks and underscores; a word is
# a token of letters only, so "ab12" and "foo_bar" yield no word.
_WORD = r"(?<![\p{L}\p{N}\p{M}_])\p{L}++(?![\p{N}\p{M}_])"


@cache
def stop_words(language: str) -> tuple[str, ...]:
    """Stop words that can be a token; entries such as "don't" cannot."""
    listed = resources.files(__package__).joinpath("stopwords", f"{language}.txt")
    words = listed.read_text(encoding="utf-8").split("\n")
    return tuple(sorted({w.lower() for w in words if w.isalpha()}))


def alphabetic_words(text: Column) -> Column:
    """Lowercased words in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _in_list(words) -> str:
    """SQL text of a literal list; the words are letters only."""
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def any_stop_words(words: str, languages=LANGUAGES) -> Column:
    """The words of a column that are a stop word of at least one language."""
    everything = sorted({w for lang in languages for w in stop_words(lang)})
    return F.expr(f"filter({words}, w -> w in {_in_list(everything)})")


def language_votes(hits: str, languages=LANGUAGES) -> dict[str, Column]:
    """Per language, how many of ``hits`` are its stop words."""
    return {
        lang: F.expr(f"size(filter({hits}, w -> w in {_in_list(stop_words(lang))}))")
        for lang in languages
    }


def top_language(votes: dict[str, Column]) -> Column:
    """Most votes wins, ties go to the first name, no vote is unknown."""
    best = F.greatest(*votes.values())
    result = F.lit(UNKNOWN)
    for lang in sorted(votes, reverse=True):
        result = F.when((best > 0) & (votes[lang] == best), lang).otherwise(result)
    return result


def word_pipeline(language: Column) -> Column:
    """German pages use the German rules, all others the English ones."""
    return F.when(language == "german", "german").otherwise("english")


def without_stop_words(words: str, language: str) -> Column:
    """The words of a column that are no stop word of the page's pipeline."""
    return F.when(
        word_pipeline(F.col(language)) == "german",
        F.expr(f"filter({words}, w -> w not in {_in_list(stop_words('german'))})"),
    ).otherwise(F.expr(f"filter({words}, w -> w not in {_in_list(stop_words('english'))})"))


def english_lemma(word: Column) -> Column:
    """Harman's S-stemmer (1991): plural endings only."""
    cut = lambda n: F.substring(word, F.lit(1), F.length(word) - n)
    ends = lambda *xs: word.rlike("(" + "|".join(xs) + ")$")
    return (
        F.when(~word.endswith("s"), word)
        .when(word.endswith("ies") & ~ends("eies", "aies"), F.concat(cut(3), F.lit("y")))
        .when(word.endswith("es") & ~ends("aes", "ees", "oes"), cut(1))
        .when(~ends("us", "ss"), cut(1))
        .otherwise(word)
    )


def german_lemma(word: Column) -> Column:
    """Light inflection endings, off words of six letters and more."""
    cut = lambda n: F.substring(word, F.lit(1), F.length(word) - n)
    return (
        F.when(F.length(word) < 6, word)
        .when(word.endswith("ern"), cut(3))
        .when(word.rlike("e[mnrs]$"), cut(2))
        .when(word.rlike("[ens]$"), cut(1))
        .otherwise(word)
    )


def rule_lemma(word: Column, language: Column) -> Column:
    return F.when(word_pipeline(language) == "german", german_lemma(word)).otherwise(
        english_lemma(word)
    )


def lemmas(words: Column, language: Column) -> Column:
    german = word_pipeline(language) == "german"
    return F.when(german, F.transform(words, german_lemma)).otherwise(
        F.transform(words, english_lemma)
    )
