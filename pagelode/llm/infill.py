"""Fill-in-the-middle forms of documents, cut by ranks in a wavelet matrix.

A text is a sequence of character classes: inside a word, last of a word, white
space, and white space that ends the text. A wavelet matrix over them holds one
bit vector per bit of a class, the second one in the order the first one sorts
the characters into, each with counts of its ones up to every 64th place. The
rank of a class up to a place takes one look at each vector.

A token is a word with the white space before it, or the white space that ends
the text, so the ranks of "last of a word" and of "ends the text" add up to the
tokens that end before a place. The place after k tokens is found by bisection
on that sum; places are counted in code points.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.llm.passing import passed

# Fixed values of the form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

INSIDE, WORD_END, SPACE, TEXT_END = range(4)


class WaveletMatrix:
    """Ranks of the symbols of a sequence; a symbol is below 2 to the power of ``levels``."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size = len(symbols)
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(bits) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=ones[1:])
            self.words.append(words)
            self.before.append(ones)
            self.zeros.append(self.size - int(ones[-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def _ones(self, level: int, place: int) -> int:
        """Ones of a level before a place."""
        word, bit = divmod(place, 64)
        part = int(self.words[level][word]) & ((1 << bit) - 1)
        return int(self.before[level][word]) + part.bit_count()

    def rank(self, symbol: int, place: int) -> int:
        """How often ``symbol`` occurs before ``place``."""
        low, high = 0, place
        last = len(self.words) - 1
        for level in range(last + 1):
            ones = self._ones(level, low), self._ones(level, high)
            if symbol >> (last - level) & 1:
                low, high = (self.zeros[level] + x for x in ones)
            else:
                low, high = low - ones[0], high - ones[1]
        return high - low


def character_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    found = np.where(space, np.uint8(SPACE), np.uint8(INSIDE))
    if len(found):
        found[:-1][~space[:-1] & space[1:]] = WORD_END
        found[-1] = TEXT_END if space[-1] else WORD_END
    return found


class Boundaries:
    """The token ends of a text."""

    def __init__(self, text: str):
        self.matrix = WaveletMatrix(character_classes(text), 2)
        self.tokens = self.before(self.matrix.size)

    def before(self, place: int) -> int:
        """Tokens that end at ``place`` or before it."""
        return self.matrix.rank(WORD_END, place) + self.matrix.rank(TEXT_END, place)

    def place(self, tokens: int) -> int:
        """The first place up to which so many tokens end."""
        return bisect_left(range(self.matrix.size + 1), tokens, key=self.before)


@dataclass(frozen=True)
class Settings:
    """``rate`` percent of the documents are rearranged, ``spm`` percent of those suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2 ** 32 that follow from the seed and the id alone."""
    told = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(told[i : i + 4]) for i in range(0, 16, 4)]


def rearranged(doc_id: int | None, text: str, settings: Settings) -> tuple:
    """(tokens, form, prefix_chars, middle_chars, output) of one text."""
    first, second, chosen, order = draws(settings.seed, doc_id)
    ends = Boundaries(text)
    n = ends.tokens
    marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or chosen % 100 >= settings.rate:
        return n, "plain", None, None, text
    cuts = sorted((first % (n + 1), second % (n + 1)))
    a, b = map(ends.place, cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < settings.spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    documents: DataFrame,
    settings: Settings = Settings(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns of every row with n, form, prefix_chars, middle_chars and output.

    ``n`` counts the tokens; ``form`` is ``plain``, ``psm`` or ``spm``. A null or
    empty text, one that holds a marker, and the share not drawn stay plain, with
    null lengths. The cuts follow from the seed and the id, so repeated rows are
    cut alike and a task that runs again gives the same; a null id is drawn as
    the word null. One pass over whole texts without a shuffle; other columns are
    handed through, whatever they are called, or not read.
    """
    kept = documents.select(*keep)
    rows = documents.select(
        *keep, documents[doc_id].cast("bigint").alias("_doc_id"), documents[text].alias("_text")
    )
    # Names of our own on the way, as a kept column may be called like a new one.
    rows = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
    added = "n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output STRING"
    schema = passed(rows.select(*rows.columns[:-2]).schema, added)

    def run(batches):
        for batch in batches:
            ids, texts = batch.columns[-2:]
            told = [rearranged(i.as_py(), t.as_py() or "", settings) for i, t in zip(ids, texts, strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            added = [pa.array([r[at] for r in told], kind) for at, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *added], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*kept.columns, *schema.names[len(kept.columns) :])


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of, from the output and its form.

    No part holds a marker, and no marker overlaps another, so the first
    occurrence of each one is the one that was put there.
    """

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
