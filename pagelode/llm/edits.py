"""Fingerprints of texts under edits, by randomised edit embedding.

A walk reads a text from left to right. At step j it puts out the character it
stands on and then moves on, or not, as a random bit for the character and j
says; the bits are shared by all texts. After an edit the walks of two texts
differ until chance brings them together again, and then put out the same
characters at the same steps. So a small edit distance becomes a small Hamming
distance of the outputs. Several walks, of which the best counts, make a late
meeting unlikely.

A fingerprint keeps the output at sampled steps, all multiples of a power of
two that grows with the text, so that it is short and covers the whole text.
The samples of a coarser power are among those of a finer one, which makes
texts of different lengths comparable. A band is a few samples at random places
of the whole fingerprint; what shares a band is verified on all samples. The
number of bands keeps the chance to miss a pair at the threshold below one in a
million.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.components import components
from pagelode.llm.ordering import cut_points, part_count, part_of, to_parts
from pagelode.llm.scratch import Scratch

WALKS = 2
SAMPLES = 128
MAX_BANDS = 128
_MISSED = 1e-6
# Nodes of a band that are compared with as many others in one group.
BLOCK = 512
# The shared bits repeat after so many steps; a step number modulo it is a byte.
_PERIOD = 256
_CLASSES = 64
_WIDTH = 2


@cache
def _moves(walk: int) -> list[list[int]]:
    """By character class and step: the step, modulo the period, at which the walk stands on the next character."""
    bits = np.random.default_rng([31, walk]).integers(0, 2, (_CLASSES, _PERIOD))
    bits[np.arange(_CLASSES), np.arange(_CLASSES) % _PERIOD] = 1
    moves = []
    for row in bits:
        places = np.nonzero(row)[0]
        at = np.searchsorted(places, np.arange(_PERIOD)) % len(places)
        moves.append(((places[at] + 1) % _PERIOD).tolist())
    return moves


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _classes(points: np.ndarray) -> bytes:
    return ((points * np.uint32(2654435761)) >> np.uint32(26)).astype(np.uint8).tobytes()


def walk_on(classes: bytes, walk: int, step: int = 0) -> bytes:
    """The step, modulo the period, after each character, for a walk that begins at ``step``."""
    moves = _moves(walk)
    return bytes([step := moves[c][step] for c in classes])


def level_of(n: int) -> int:
    """The power of two of the samples of a text of n characters."""
    return max(0, math.ceil(math.log2(2 * n / SAMPLES))) if n else 0


def _samples(points: np.ndarray, states: bytes) -> bytes:
    """One byte per sampled step, a hash of the characters from the one stood on."""
    n = len(points)
    after = np.frombuffer(states, np.uint8)
    taken = np.diff(after, prepend=np.uint8(0)).astype(np.int64)
    taken[taken == 0] = _PERIOD
    left = np.cumsum(taken)  # step at which the walk leaves each character
    steps = np.arange(0, left[-1], 1 << level_of(n))
    stood = np.searchsorted(left, steps, side="right")
    found = np.zeros(len(steps), np.uint32)
    for i in range(_WIDTH):
        at = stood + i
        found = found * np.uint32(2246822519) + np.where(at < n, points[np.minimum(at, n - 1)], np.uint32(0))
    return ((found * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8).tobytes()


def _told(n: int, samples: list[bytes]) -> str:
    return ":".join([f"{level_of(n):02d}", *(s.hex() for s in samples)])


def fingerprint(text: str) -> str:
    """The level and, per walk, the samples in hex."""
    points = _points(text)
    if not len(points):
        return _told(0, [b""] * WALKS)
    classes = _classes(points)
    return _told(len(points), [_samples(points, walk_on(classes, w)) for w in range(WALKS)])


def _parsed(told: str) -> tuple[int, list[np.ndarray]]:
    level, *walks = told.split(":")
    return int(level), [np.frombuffer(bytes.fromhex(w), np.uint8) for w in walks]


def likeness(a: str, b: str) -> float:
    """Share of equal samples at the coarser level, of the better walk; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    (level_a, walks_a), (level_b, walks_b) = _parsed(a), _parsed(b)
    level = max(level_a, level_b)
    best = 0.0
    for x, y in zip(walks_a, walks_b, strict=True):
        x, y = x[:: 1 << (level - level_a)], y[:: 1 << (level - level_b)]
        longer = max(len(x), len(y))
        if longer:
            both = min(len(x), len(y))
            best = max(best, int((x[:both] == y[:both]).sum()) / longer)
    return best


class _Text:
    """A text with its walks, which an edit of its end goes on from."""

    def __init__(self, text: str):
        self.text = text
        self.points = _points(text)
        self.classes = _classes(self.points)
        self.states = [walk_on(self.classes, w) for w in range(WALKS)]
        n = len(self.points)
        samples = [_samples(self.points, s) for s in self.states] if n else [b""] * WALKS
        self.fingerprint = _told(n, samples)

    def with_end_of(self, other: _Text) -> tuple[str, str]:
        """The text whose last quarter gave way to the beginning of another one; its fingerprint."""
        n = len(self.points)
        cut = n - n // 4
        if cut == n:
            return self.text, self.fingerprint
        points = np.concatenate([self.points[:cut], other.points[: n // 4]])
        samples = []
        for walk, states in enumerate(self.states):
            rest = walk_on(other.classes[: n // 4], walk, states[cut - 1])
            samples.append(_samples(points, states[:cut] + rest))
        return self.text[:cut] + other.text[: n // 4], _told(len(points), samples)


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def edit_fingerprints(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of an edited form of it.

    The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many, or all, of the next document by ascending doc_id; after the
    last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next, the likeness to the edited
    and to the next document.

    A null text counts as empty: its fingerprint has no samples and is like
    itself only. Rows with a null doc_id come before all others, in the order of
    their texts; the row after the last one is still the one with the smallest
    id. Rows that repeat an id follow each other in the order of their texts.
    Other columns are not read; an empty table gives an empty result. Texts are
    shuffled once, to ranges of the id; a task holds two of them at a time.
    """
    rows = documents.select(
        documents[doc_id].cast("bigint").alias("id"), F.coalesce(documents[text], F.lit("")).alias("text")
    )
    cuts = cut_points(rows, "id", part_count(documents.sparkSession))
    last = max(0, len(cuts) - 1)
    part = part_of(F.col("id"), cuts)
    # The first document of a part also ends the part before it.
    first = F.col("id").isin(cuts) if cuts else F.lit(False)
    own = F.struct(part.cast("int").alias("part"), F.lit(False).alias("tail"))
    before = F.when(part > 0, part - 1).otherwise(F.lit(last))
    ended = F.struct(before.cast("int").alias("part"), F.lit(True).alias("tail"))
    placed = rows.select(
        "id", "text", F.explode(F.when(first, F.array(own, ended)).otherwise(F.array(own))).alias("place")
    ).select("id", "text", "place.part", "place.tail")
    ordered = to_parts(placed, "part", len(cuts), "tail", "id", "text")

    def run(batches):
        held, at_part, closed = None, None, True
        found = []

        def answer(held, other):
            edited, told = held[1].with_end_of(other)
            mine = held[1].fingerprint
            return (
                held[0],
                len(held[1].points),
                hashlib.sha256(edited.encode()).hexdigest(),
                mine,
                told,
                likeness(mine, told),
                likeness(mine, other.fingerprint),
            )

        for batch in batches:
            for i, t, p, tail in zip(*(c for c in batch.columns), strict=True):
                p, tail = p.as_py(), tail.as_py()
                if p != at_part:
                    # A part whose ids are all null has no tail: it closes with itself.
                    if held is not None and not closed:
                        found.append(answer(held, held[1]))
                    held, at_part, closed = None, p, False
                if closed:
                    continue
                now = _Text(t.as_py())
                if held is not None:
                    found.append(answer(held, now))
                held, closed = (i.as_py(), now), tail
                if len(found) >= 256:
                    yield _batch(found)
                    found = []
        if held is not None and not closed:
            found.append(answer(held, held[1]))
        if found:
            yield _batch(found)

    schema = """doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING,
        edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"""
    return ordered.select("id", "text", "part", "tail").mapInArrow(run, schema)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
    )


def band_shape(threshold: float) -> tuple[int, int]:
    """Bands and samples per band: as many samples as ``MAX_BANDS`` bands allow, one at least.

    A pair whose share of equal samples is the threshold t shares a band of k
    samples with a chance of t ** k, so bands of one walk miss it with
    (1 - t ** k) ** bands.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")

    def bands(k: int) -> int:
        met = threshold**k
        return 1 if met == 1 else math.ceil(math.log(_MISSED) / math.log1p(-met))

    k = 1
    while k < SAMPLES // 4 and bands(k + 1) <= MAX_BANDS:
        k += 1
    return bands(k), k


@cache
def _places(length: int, bands: int, k: int) -> np.ndarray:
    """Per band, k random places among the first ``length``: those of the smallest ranks.

    The ranks of the places do not depend on the length, so two fingerprints
    take the same place with the chance min / max of their lengths.
    """
    return np.random.default_rng(53).random((length, bands * k)).argmin(axis=0).reshape(bands, k)


def band_keys(told: str, threshold: float = 0.6) -> list[int]:
    """Keys of a fingerprint: per walk, at its own level and at the coarser ones of texts that may be alike."""
    level, walks = _parsed(told)
    bands, k = band_shape(threshold)
    # A text of a level above 0 has more samples than this: a walk takes a step per character at least.
    least = threshold * (SAMPLES // 4 + 1)
    keys = []
    for walk, samples in enumerate(walks):
        coarser = 0
        while len(samples) and (coarser == 0 or len(samples) >= least):
            places = _places(len(samples), bands, k)
            rows = np.concatenate([places.astype("<u4").view(np.uint8), samples[places]], axis=1)
            for band, row in enumerate(rows):
                seed = ((level + coarser) * WALKS + walk) * bands + band
                keys.append(xxhash.xxh3_64_intdigest(row.tobytes(), seed) - (1 << 63))
            samples, coarser = samples[::2], coarser + 1
    return keys


def _apart(placed: DataFrame) -> DataFrame:
    """Pairs of nodes of a band in different components, but for those with its smallest node.

    A band is cut into blocks by the hash of the node; a group holds two blocks.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    cut = placed.where("node <> least").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    every = F.sequence(F.lit(0), blocks - 1)
    x = cut.select("band", F.col("block").alias("x"), F.explode(every).alias("y"), F.col("node").alias("a"), F.col("component").alias("of_x"))
    y = cut.select("band", F.explode(every).alias("x"), F.col("block").alias("y"), F.col("node").alias("b"), F.col("component").alias("of_y"))
    return x.join(y, ["band", "x", "y"]).where("a < b and of_x <> of_y").select("a", "b").distinct()


def near_texts(
    fingerprints: DataFrame, threshold: float = 0.6, *, scratch: Scratch | None = None
) -> DataFrame:
    """(doc_id, component_id) over documents whose fingerprints are alike.

    ``fingerprints`` has doc_id and fingerprint. Equal fingerprints are one
    node. Each node of a band is first verified against the smallest one in it,
    by the likeness of all samples. Nodes of a band that this leaves in
    different components are then compared with each other, block by block, so
    every pair that shares a band is verified or linked by others; the pairs
    grow with the square of a band of unlike nodes. ``component_id`` is the
    smallest doc_id reachable. A null doc_id is left out. Only the bands are
    left to chance: see ``band_shape``.
    """
    scratch = scratch or Scratch(fingerprints.sparkSession, "edits")
    rows = fingerprints.where("doc_id is not null and fingerprint is not null").select("doc_id", "fingerprint")
    nodes = scratch.keep(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "nodes")

    band_shape(threshold)

    @F.udf("array<bigint>")
    def keys(told):
        return band_keys(told, threshold)

    @F.udf("double")
    def alike(a, b):
        return likeness(a, b)

    every = nodes.select("node", F.explode(keys("fingerprint")).alias("band")).distinct()
    least = every.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    banded = scratch.keep(every.join(least, "band"), "bands")
    of_a = nodes.select(F.col("node").alias("a"), F.col("fingerprint").alias("of_a"))
    of_b = nodes.select(F.col("node").alias("b"), F.col("fingerprint").alias("of_b"))

    def verified(pairs):
        return pairs.join(of_b, "b").join(of_a, "a").where(alike("of_a", "of_b") >= threshold).select("a", "b")

    stars = banded.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    met = scratch.keep(verified(stars), "met")
    linked = components(met, "a", "b", scratch, "met-stars")
    placed = banded.where("n > 2").join(linked, "node", "left").select(
        "band", "n", "node", "least", F.coalesce("component", "node").alias("component")
    )
    rest = scratch.keep(_apart(placed), "rest")
    more = scratch.keep(verified(rest), "more")
    copies = rows.join(nodes, "fingerprint").where("node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    joined = components(met.union(more).union(copies), "a", "b", scratch, "stars")
    found = rows.select("doc_id").distinct().join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return found.select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))
