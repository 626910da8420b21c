"""Pre-tokens of a text and a bounded dictionary from pre-token to ids.

Prose repeats its words, so that looking them up does most of the work of
encoding; an encoder is asked once per word a Python worker meets.
"""

from __future__ import annotations

import re
from functools import cache

import regex

# Fixed value: the pattern that cuts a text into pre-tokens before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same with the classes of the standard library, which is faster.
_FAST = r" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
# The ASCII characters on which the classes differ: white space for one of them only.
_CONTROLS = "\x1c\x1d\x1e\x1f"
# Entries of a worker's dictionary. A full one is emptied, which only costs time.
WORDS = 1_000_000
# Longer words are encoded each time, so that the bound on entries is one on bytes.
LONGEST = 64


@cache
def _patterns():
    """The exact pattern, the fast one, and the characters that ask for the exact one.

    These are all beyond the basic plane and those on which the classes differ.
    """
    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x10000))))
    odd = set()
    for exact, fast in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        odd |= set(regex.findall(exact, everything)) ^ set(re.findall(fast, everything))
    listed = "".join(re.escape(c) for c in sorted(odd))
    return regex.compile(PATTERN), re.compile(_FAST), re.compile(f"[{listed}\U00010000-\U0010ffff]")


def pre_tokens(text: str) -> list[str]:
    exact, fast, odd = _patterns()
    plain = text.isascii() and not any(c in text for c in _CONTROLS)
    return (fast if plain or not odd.search(text) else exact).findall(text)


class WordIds(dict):
    """Pre-token to its ids as 32-bit words; ``encode`` gives the ids of one."""

    def __init__(self, encode, entries: int = WORDS):
        super().__init__()
        self.encode = encode
        self.entries = entries

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST:
            return self.encode(word)
        if len(self) >= self.entries:
            self.clear()
        ids = self[word] = self.encode(word)
        return ids

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, pre_tokens(text)))
