"""Case- and accent-insensitive keys of words and URLs.

Two texts have the same key if they differ in case and accents only. Keys are
plain strings, so they can be hashed, cut into grams and searched for parts,
which a collation does not give; they agree with the collation UNICODE_CI_AI on
single letters (see the tests).
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A letter that is no other one with a mark, letters that are others
# with a stroke, and letters that stand for several.
_OWN = "й"
_STROKES = {"đ": "d", "ð": "d", "ħ": "h", "ł": "l", "ø": "o"}
_SEVERAL = {
    "ß": "ss",
    "æ": "ae",
    "œ": "oe",
    "ĳ": "ij",
    "ǆ": "dz",
    "ǉ": "lj",
    "ǌ": "nj",
    "ǳ": "dz",
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "st",
    "ﬆ": "st",
}


def _plain(text: str) -> str:
    split = unicodedata.normalize("NFKD", text)
    return "".join(c for c in split if unicodedata.category(c) != "Mn")


def _letter(c: str) -> str:
    """The key of one letter: without marks and case."""
    if c.lower() == _OWN:
        return _OWN
    several = c.lower()
    base = _plain(several) if several in _SEVERAL or _plain(several) in _SEVERAL else _plain(_plain(c).casefold())
    return _STROKES.get(base, base)


@cache
def _table() -> tuple[str, str]:
    """Letters that have another single letter as their key, and these keys; then marks, without any."""
    found, keys = [], []
    for point in range(0x80, 0x30000):
        c = chr(point)
        # Syllables of Hangul split into letters, not into a letter and marks.
        if not c.isalpha() or 0xAC00 <= point < 0xD7B0:
            continue
        key = _letter(c)
        if key != c and len(key) == 1:
            found.append(c)
            keys.append(key)
    marks = [chr(p) for p in range(0x300, 0x370)]
    return "".join(found + marks), "".join(keys)


def folded(text: Column) -> Column:
    """The key of a text. Letters that stand for several others than the listed ones stay."""
    found, keys = _table()
    key = F.translate(F.lower(text), found, keys)
    for letter, several in _SEVERAL.items():
        key = F.replace(key, F.lit(letter), F.lit(several))
    return key


def folded_text(text: str) -> str:
    """``folded`` for a text of the driver, such as a query."""
    found, keys = _table()
    table = dict(zip(map(ord, found), [*keys, *[None] * (len(found) - len(keys))], strict=True))
    key = text.lower().translate(table)
    for letter, several in _SEVERAL.items():
        key = key.replace(letter, several)
    return key
