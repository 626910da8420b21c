"""Near-duplicate documents by circulant MinHash.

Signature: a shingle is hashed to a slot of a circle; one permutation scatters
the slots, a second one gives each a value. Coordinate k of a signature is the
smallest value over the document's slots after a shift by k along the circle,
so two permutations make all coordinates and the values a shingle contributes
are one contiguous window of the second.

Candidates share a band of coordinates. Before banding, documents with equal
shingle sets become one node. Bands with few nodes give all their pairs. A band
with many gives each node with the band's smallest one; nodes of it that this
leaves in different components are compared through the rarest shingles of
their sets: two sets can only reach the threshold if they share one of those,
so no pair is lost and no pair is made of what all members have in common.

Links are confirmed on the full sets, of 64-bit shingle hashes. The number of
bands keeps the chance to miss a pair at the threshold below one in a million.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.llm.components import components
from pagelode.llm.scratch import Scratch

SLOTS = 1 << 20
SMALL_BAND = 8
_MISSED = 1e-6
_ROWS = 512
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class Settings:
    """``percent``: link when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80
    rows: int = 6

    @property
    def bands(self) -> int:
        return math.ceil(math.log(_MISSED) / math.log1p(-((self.percent / 100) ** self.rows)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text.

    A-Z are lower-cased; words are maximal runs of bytes other than the space
    and 0x09 to 0x0D. With fewer words than a shingle has, all of them make one;
    without any the set is empty.
    """
    listed = text.encode().lower().split() if text else []
    if not listed:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))
    width = min(words, len(listed))
    found = np.full(len(listed) - width + 1, width, np.uint64)
    for i in range(width):
        found = _mixed(found * _M1 + hashed[i : len(listed) - width + 1 + i])
    return np.unique(found)


@cache
def _circle(length: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation and all windows of ``length`` values of the second."""
    random = np.random.default_rng(20240501)
    scatter = random.permutation(slots).astype(np.uint32)
    values = random.permutation(slots).astype(np.uint32)
    around = np.concatenate([values, values[: length - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(around, length)


def signature(shingles: np.ndarray, length: int, slots: int = SLOTS) -> np.ndarray:
    """Circulant MinHash coordinates of a set that is not empty."""
    scatter, windows = _circle(length, slots)
    at = scatter[(shingles % np.uint64(slots)).astype(np.int64)]
    least = windows[at[:_ROWS]].min(axis=0)
    for i in range(_ROWS, len(at), _ROWS):
        np.minimum(least, windows[at[i : i + _ROWS]].min(axis=0), out=least)
    return least


def _bands(least: np.ndarray, rows: int) -> np.ndarray:
    grouped = least.astype(np.uint64).reshape(-1, rows)
    found = np.arange(len(grouped), dtype=np.uint64)
    for i in range(rows):
        found = _mixed(found * _M1 + grouped[:, i])
    return found.view(np.int64)


def sketches(documents: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, ``whole`` (digest of the set) and ``bands`` of every document."""
    words, rows, length = settings.words, settings.rows, settings.rows * settings.bands

    def run(batches):
        for batch in batches:
            sizes, wholes, bands = [], [], []
            for t in batch.column(1):
                found = shingle_set(t.as_py(), words)
                sizes.append(len(found))
                wholes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(_bands(signature(found, length), rows) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(wholes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "whole", "bands"],
            )

    rows_in = documents.select(documents[doc_id], documents[text])
    return rows_in.mapInArrow(run, "doc_id BIGINT, n_shingles BIGINT, whole BINARY, bands ARRAY<BIGINT>")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, whole, shingles), the sorted hashes as bytes, once per node and set, of (node, text)."""

    def run(batches):
        for batch in batches:
            found = {}
            for node, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = shingle_set(t.as_py(), words).tobytes()
                found[node, xxhash.xxh3_128_digest(raw)] = raw
            nodes, wholes = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(wholes, pa.binary()), pa.array(found.values(), pa.binary())],
                names=["node", "whole", "shingles"],
            )

    # Rows may repeat, and an id may have several texts.
    return texts.mapInArrow(run, "node BIGINT, whole BINARY, shingles BINARY").dropDuplicates(["node", "whole"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                common = int(np.count_nonzero(large[at] == small))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # The hot side, if any, is a: one node of a band with many. It is joined last,
    # when each row holds one set, and its key can be split.
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(run, "a BIGINT, b BIGINT")


def _by_rarest(sets: DataFrame, part: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components that share one of their rarest shingles.

    Let both sets be in one common order, here by rarity. A set of n shingles
    that reaches the threshold with a set that is no longer shares with it one
    of its first n - ceil(p * n) + 1, where p is the threshold, and that one is
    among the first m - ceil(2 * p / (1 + p) * m) + 1 of the shorter set's m.
    What both hold after the first shared one bounds what they share in all; a
    meeting below that bound is no such first one, or no pair.
    """

    def run(batches):
        for batch in batches:
            for node, whole, raw in zip(*batch.columns, strict=True):
                found = np.frombuffer(raw.as_buffer(), np.int64)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node.as_py()] * n, pa.int64()),
                        pa.array([whole.as_py()] * n, pa.binary()),
                        pa.array(found),
                        pa.array([n] * n, pa.int64()),
                    ],
                    names=["node", "whole", "shingle", "n"],
                )

    listed = sets.join(part, "node").select("node", "whole", "shingles").mapInArrow(
        run, "node BIGINT, whole BINARY, shingle BIGINT, n BIGINT"
    )
    rarity = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("rarity"))
    # A shingle of one set pairs nothing, but holds its place in the order. A node
    # has as many sets as its id has texts, and each has a prefix of its own.
    order = Window.partitionBy("node", "whole").orderBy("rarity", "shingle")
    first = (
        listed.join(rarity, "shingle")
        .withColumn("at", F.row_number().over(order))
        .where(f"at <= n - ceil({percent} * n / 100) + 1 and rarity > 1")
        .join(part, "node")
        .select("shingle", "node", "n", "at", "component")
    )
    x, y = (first.select("shingle", *(F.col(c).alias(f"{s}_{c}") for c in first.columns[1:])) for s in "xy")
    shorter = x.where(f"x_at <= x_n - ceil(2 * {percent} * x_n / (100 + {percent})) + 1")
    met = shorter.join(y, "shingle").where(
        f"""(x_n < y_n or x_n = y_n and x_node < y_node) and x_node <> y_node
        and x_component <> y_component and 100 * x_n >= {percent} * y_n
        and (100 + {percent}) * (1 + least(x_n - x_at, y_n - y_at)) >= {percent} * (x_n + y_n)"""
    )
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def near_duplicates(
    documents: DataFrame,
    settings: Settings = Settings(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    ``component_id`` is the smallest doc_id reachable over links, the document
    itself included; ``kept`` marks that document. A null or empty text, or one
    without words, has no shingles and links with nothing. Rows with the same
    doc_id are one node. Rows with a null doc_id link with nothing: they are
    kept, with a null component. Repeated rows are answered each. Only doc_id
    and text are read, whatever other columns are called; an empty table gives
    an empty result.
    """
    scratch = scratch or Scratch(documents.sparkSession, "minhash")
    percent = settings.percent
    documents = documents.select(documents[doc_id].cast("bigint").alias("doc_id"), documents[text].alias("text"))
    every = scratch.keep(sketches(documents, settings), "sketches")

    # Documents with equal sets are one node, named by the smallest of them.
    worded = every.where("n_shingles > 0 and doc_id is not null")
    same = worded.groupBy("whole").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows"))
    same = scratch.keep(same, "same")
    copies = (
        worded.select("doc_id", "whole")
        .join(same.where("rows > 1").select("node", "whole"), "whole")
        .where("node <> doc_id")
        .select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    )

    # Bands with more than one node.
    alone = worded.join(same.select(F.col("node").alias("doc_id"), "whole"), ["doc_id", "whole"], "left_semi")
    banded = alone.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band")).distinct()
    met = banded.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("nodes"))
    bands = scratch.keep(banded.join(met.where("nodes > 1"), "band"), "bands")
    few = (
        bands.where(f"nodes <= {SMALL_BAND}")
        .groupBy("band")
        .agg(F.collect_list("node").alias("x"))
        .select(
            F.explode(
                F.expr(
                    "flatten(transform(x, a -> transform(filter(x, b -> b > a), b -> struct(a as a, b as b))))"
                )
            ).alias("p")
        )
        .select("p.a", "p.b")
    )
    many = bands.where(f"nodes > {SMALL_BAND} and node <> least").select(
        F.col("least").alias("a"), F.col("node").alias("b")
    )
    pairs = scratch.keep(few.union(many).distinct(), "pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # The same plan at every size: the texts are shuffled once, whatever is asked.
    texts = documents.join(asked.hint("merge"), "doc_id").select(F.col("doc_id").alias("node"), "text")
    sets = scratch.keep(_sets(texts, settings.words), "sets")
    links = scratch.keep(_confirmed(pairs, sets, percent), "links")
    found = components(links, "a", "b", scratch, "stars")

    # What is left of bands with many nodes.
    large = bands.where(f"nodes > {SMALL_BAND}").select("band", "node")
    placed = large.join(found, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )
    open_bands = (
        placed.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
    )
    part = scratch.keep(
        placed.join(open_bands, "band", "left_semi").select("node", "component").distinct(), "open"
    )
    rest = _by_rarest(sets, part, percent).join(pairs, ["a", "b"], "left_anti")
    more = scratch.keep(_confirmed(rest, sets, percent), "more")

    joined = scratch.keep(
        components(links.union(more).union(copies), "a", "b", scratch, "all"), "joined"
    )
    scratch.drop("same", "bands", "pairs", "sets", "links", "open", "more")
    named = joined.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    return (
        every.select("doc_id", "n_shingles")
        .join(named, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )
