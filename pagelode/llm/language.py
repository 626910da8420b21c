"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of plus and minus ones. A trigram's vector
binds those of its letters: the product of the first, permuted twice, the
second, permuted once, and the third, where permuting is a turn by one place.
A text is the bundle, the sum, of its trigram vectors; a language prototype is
the bundle of its texts. The prediction is the prototype with the largest
cosine to the text.

Bundles are sums of whole numbers, so prototypes do not depend on how the
rows were spread over tasks.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.llm.passing import passed, read_once

UNKNOWN = "und"
SIZE = 512
_BITS = 7
_LETTERS = 1 << _BITS
_CODES = 1 << 3 * _BITS
# A batch is worked off in groups of about so many characters.
_GROUP = 800_000


def _letter_class(letter: str) -> int:
    """0 for what is no letter, 1 to 26 for a to z, else a hash of the lower-case letter."""
    if not letter.isalpha():
        return 0
    low = letter.lower()[0]
    if "a" <= low <= "z":
        return ord(low) - ord("a") + 1
    return 27 + zlib.crc32(low.encode()) % (_LETTERS - 27)


@cache
def _plane() -> np.ndarray:
    surrogates = range(0xD800, 0xE000)
    return np.array([0 if c in surrogates else _letter_class(chr(c)) for c in range(1 << 16)], np.uint8)


@cache
def letter_vectors(size: int) -> np.ndarray:
    drawn = np.random.default_rng(97).integers(0, 2, (_LETTERS, size), dtype=np.int8)
    return drawn * np.int8(2) - np.int8(1)


def trigrams(text: str) -> np.ndarray:
    """Codes of the letter trigrams of a text; empty without a letter.

    Runs of other characters, and both ends, are one gap.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = points >= 1 << 16
    found = _plane()[np.where(high, 0, points)]
    if high.any():
        for point in np.unique(points[high]):
            found[points == point] = _letter_class(chr(point))
    letter = found > 0
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    row = np.concatenate([[0], found[keep], [0]] if found[keep][-1] else [[0], found[keep]]).astype(np.int64)
    if row[1] == 0:
        row = row[1:]
    return row[:-2] << 2 * _BITS | row[1:-1] << _BITS | row[2:]


def trigram_vectors(codes: np.ndarray, size: int) -> np.ndarray:
    of = letter_vectors(size)
    first = np.roll(of, 2, axis=1)[codes >> 2 * _BITS]
    second = np.roll(of, 1, axis=1)[codes >> _BITS & _LETTERS - 1]
    return first * second * of[codes & _LETTERS - 1]


def _bundles(listed: list[np.ndarray], size: int) -> np.ndarray:
    """The bundle of each text, of their trigram codes."""
    every = np.concatenate(listed)
    seen = np.zeros(_CODES, bool)
    seen[every] = True
    codes = np.nonzero(seen)[0]
    place = np.empty(_CODES, np.int64)
    place[codes] = np.arange(len(codes))
    owner = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
    counts = np.bincount(owner * len(codes) + place[every], minlength=len(listed) * len(codes))
    counts = counts.reshape(len(listed), len(codes)).astype(np.float32)
    return counts @ trigram_vectors(codes, size).astype(np.float32)


def _groups(texts: list[str | None]):
    """(rows, trigram codes) of bounded size; rows without a letter are left out."""
    rows, listed, held = [], [], 0
    for i, text in enumerate(texts):
        codes = trigrams(text) if text else ()
        if not len(codes):
            continue
        rows.append(i)
        listed.append(codes)
        held += len(codes)
        if held >= _GROUP or len(rows) == 256:
            yield rows, listed
            rows, listed, held = [], [], 0
    if rows:
        yield rows, listed


def train_prototypes(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", size: int = SIZE
) -> dict[str, np.ndarray]:
    """The bundle of each language, of all rows with a text and a non-null language.

    Every task sends one vector per language it met; their sums, one vector per
    language, come to the driver.
    """
    rows = documents.select(documents[lang].cast("string").alias("lang"), documents[text].alias("text"))

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def bundled():
            names, vectors = list(counts), []
            for c in counts.values():
                codes = np.nonzero(c)[0]
                total = np.zeros(size, np.int64)
                for at in range(0, len(codes), 4096):
                    some = codes[at : at + 4096]
                    total += c[some] @ trigram_vectors(some, size).astype(np.int64)
                vectors.append(total.tolist())
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(vectors, pa.list_(pa.int64()))], names=["lang", "bundle"]
            )

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for found, listed in _groups(batch.column(1).to_pylist()):
                by: dict[str, list[np.ndarray]] = {}
                for i, codes in zip(found, listed, strict=True):
                    by.setdefault(langs[i], []).append(codes)
                for name, parts in by.items():
                    told = np.bincount(np.concatenate(parts), minlength=_CODES)
                    counts[name] = counts[name] + told if name in counts else told
                    if len(counts) >= 8:
                        yield bundled()
        yield bundled()

    parts = rows.where("lang is not null and text is not null").mapInArrow(run, "lang STRING, bundle ARRAY<BIGINT>")
    summed = (
        parts.select("lang", F.posexplode("bundle"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("x"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("all"))
        .select("lang", F.expr("transform(all, y -> y.x)").alias("bundle"))
    )
    return {r["lang"]: np.array(r["bundle"], float) for r in sorted(summed.collect(), key=lambda r: r["lang"])}


def predict_language(
    documents: DataFrame,
    prototypes: dict[str, np.ndarray],
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred``, ``score`` and ``margin``.

    ``margin`` is the lead over the next best language; it and the score lie
    between 0 and 1. The score is the cosine to the predicted language's prototype, zero if
    negative; ties go to the first language by name. A text that is null or has
    no letter, or any text when there are no prototypes, is ``und`` with score
    zero. One pass over whole texts, without a shuffle; repeated rows are
    answered each, and other columns are not read.
    """
    names = sorted(prototypes)
    rows, at, n = read_once(documents, keep, text)
    matrix = np.stack([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1.0) for n in names]) if names else None
    kept = documents.select(*keep).schema

    def run(batches):
        for batch in batches:
            told, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            margins = [0.0] * batch.num_rows
            if names:
                for found, listed in _groups(batch.column(at).to_pylist()):
                    bundles = _bundles(listed, matrix.shape[1]).astype(float)
                    length = np.linalg.norm(bundles, axis=1)
                    cosine = bundles @ matrix.T / np.where(length > 0, length, 1.0)[:, None]
                    cosine = np.clip(cosine, 0.0, 1.0)
                    best = cosine.argmax(axis=1)
                    ordered = np.sort(np.pad(cosine, ((0, 0), (1, 0))), axis=1)
                    for i, b, first, second in zip(found, best, ordered[:, -1], ordered[:, -2], strict=True):
                        told[i], scores[i], margins[i] = names[b], float(first), float(first - second)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(told, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())],
                names=[*batch.schema.names[:n], "lang_pred", "score", "margin"],
            )

    return rows.mapInArrow(run, passed(kept, "lang_pred string, score double, margin double"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo 4, is 2.

    A null id is not held out, but nothing is learnt from it either.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify_languages(documents: DataFrame, *, size: int = SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from the table itself."""
    learnt = documents.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    found = predict_language(documents, train_prototypes(learnt, size=size))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin")
