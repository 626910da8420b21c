"""Quality rules with robust multivariate outliers per language and source.

Counts of a whole text give two fixed rules and a vector of transformed
statistics. For every language and source the minimum covariance determinant
estimates centre and scatter of the vectors: from several starts, concentration
steps keep the share of vectors nearest by Mahalanobis distance and estimate
again, which never raises the determinant; the start that ends lowest wins, and
one reweighting step follows. Vectors too far from their group go.

All documents that the rules leave take part. Statistics are whole numbers of
steps, so equal vectors are counted once and all later work is on the distinct
ones; sums are of whole numbers, so they do not depend on the order of the rows
and a task that runs again gives the same. Cuts by rank go through counts per
bin of the distance, never through a sorted group. A group of few documents
takes the estimates of its language, and that of a small language those of all.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.llm.scratch import Scratch
from pagelode.operators.extract import settled

# Base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
WINDOW = 8
SYMBOLS = "#*$%&|<>"

_LINE = re.compile(r"[^\x20\x09-\x0D]")
_SPACE, _SYMBOL, _CAPITAL = 1, 2, 4


# Counts of a text

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_doubled_words",
    "n_capitals",
)
_kinds: list[np.ndarray] = []


def _kinds_of_characters() -> np.ndarray:
    """Space, symbol and capital flags by code point, made once in a worker."""
    if not _kinds:
        kinds = np.zeros(0x110000, np.uint8)
        kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
        kinds[[ord(c) for c in SYMBOLS]] = _SYMBOL
        kinds[[i for i in range(0x110000) if chr(i).isupper()]] = _CAPITAL
        _kinds.append(kinds)
    return _kinds[0]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more.

    Windows are compared exactly: equal runs of 1, 2, 4 and so on words get
    equal numbers, and two runs that cover a window tell it.
    """
    n = len(ids)
    names, length = ids.astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        count = len(names) - step
        if count < 2:
            return 0
        pairs = names[:count] * np.int64(n + 1) + names[step:]
        distinct, names = np.unique(pairs, return_inverse=True)
        if len(distinct) == count:
            return 0
        length += step
    again = np.bincount(names)[names] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[: len(again)] += again
    edges[window : window + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(edges)[:n]))


def text_counts(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text."""
    words = text.encode().split()
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = np.bincount(_kinds_of_characters()[points], minlength=5)
    numbered = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbered.__getitem__, words), np.int64, len(words))
    lines = [line for line in text.split("\n") if _LINE.search(line)]
    return (
        len(words),
        len(points) - int(kinds[_SPACE]),
        int(kinds[_SYMBOL]),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
        int(kinds[_CAPITAL]),
    )


# The vector: name, transformation of the counts, size of a step. Some average
# text is added to each rate, so that short texts do not scatter. No spread is
# taken to be less than FLOOR steps.
STATISTICS = (
    ("word_length", lambda c: np.log((c["word_chars"] + 500) / (c["n_words"] + 100)), 0.005),
    ("symbols", lambda c: np.sqrt(c["n_symbols"] / (c["word_chars"] + 500)), 0.005),
    ("duplicate_lines", lambda c: np.sqrt(c["n_dup_lines"] / (c["n_lines"] + 5)), 0.025),
    ("repeated_words", lambda c: np.sqrt(c["n_repeat_words"] / (c["n_words"] + 100)), 0.025),
    ("doubled_words", lambda c: np.sqrt(c["n_doubled_words"] / (c["n_words"] + 100)), 0.005),
    ("capitals", lambda c: c["n_capitals"] / (c["word_chars"] + 500), 0.0025),
)
FLOOR = 4.0
DIMENSIONS = len(STATISTICS)
_NAMES = [name for name, _, _ in STATISTICS]
_PAIRS = list(combinations_with_replacement(range(DIMENSIONS), 2))


def vector(counts: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The statistics in whole steps."""
    return [np.rint(f(counts) / step).astype(np.int32) for _, f, step in STATISTICS]


def document_counts(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")
) -> DataFrame:
    """doc_id, ``key_0``.. for the grouping columns, the counts, base_failed and the statistics of every row."""
    keys = [f"key_{i}" for i in range(len(by))]

    def run(batches):
        for batch in batches:
            told = np.array([text_counts(t.as_py() or "") for t in batch.column(batch.num_columns - 1)], np.int64)
            told = told.reshape(-1, len(COUNTS))
            counts = dict(zip(COUNTS, told.T, strict=True))
            failed = (counts["n_words"] < LEAST_WORDS) | (
                100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"]
            )
            added = [*counts.values(), failed, *vector(counts)]
            names = [*batch.schema.names[:-1], *COUNTS, "base_failed", *_NAMES]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, added)], names=names)

    rows = documents.select(
        documents[doc_id].cast("bigint").alias("doc_id"),
        *[documents[c].cast("string").alias(k) for c, k in zip(by, keys, strict=True)],
        documents[text].alias("_text"),
    )
    schema = ", ".join(
        ["doc_id BIGINT", *[f"{k} STRING" for k in keys], *[f"{c} BIGINT" for c in COUNTS]]
        + ["base_failed BOOLEAN", *[f"{c} INT" for c in _NAMES]]
    )
    return rows.mapInArrow(run, schema)


# Chi-square


def chi_square(x: float, degrees: int) -> float:
    """The distribution function, by the series of the incomplete gamma function."""
    a, x = degrees / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = math.exp(a * math.log(x) - x - math.lgamma(a + 1))
    n = 1
    while term > 1e-17 * total:
        term *= x / (a + n)
        total += term
        n += 1
    return min(1.0, total)


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < share and high < 1e6:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """By how much the scatter of the nearest ``share`` of normal vectors has to grow."""
    return share / chi_square(chi_square_quantile(share, DIMENSIONS), DIMENSIONS + 2)


# Estimates


@dataclass(frozen=True)
class Settings:
    """``support``: share of the vectors whose scatter is smallest. ``tail``: share of
    normal vectors that the final distance would reject. ``least``: documents a group
    needs for estimates of its own. ``steps``: concentration steps at most; they
    end before when none lowers a log-determinant by more than ``gain``."""

    support: float = 0.75
    tail: float = 1e-5
    reweight: float = 0.975
    least: int = 100
    steps: int = 12
    gain: float = 0.01

    @property
    def cutoff(self) -> float:
        """Largest squared distance that is kept."""
        return chi_square_quantile(1 - self.tail, DIMENSIONS)


STARTS = ("independent", "hyperbolic", "signs")
_ESTIMATE = "start INT, key STRING, centre ARRAY<DOUBLE>, inverse ARRAY<DOUBLE>, volume DOUBLE"


def scatter(n: int, sums, products) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of whole-numbered vectors from their sums, exact up to the division."""
    mean = np.array([s / n for s in sums])
    cov = np.empty((DIMENSIONS, DIMENSIONS))
    for (i, j), p in zip(_PAIRS, products, strict=True):
        cov[i, j] = cov[j, i] = (n * int(p) - int(sums[i]) * int(sums[j])) / (n * n)
    return mean, cov


def estimate(centre: np.ndarray, cov: np.ndarray, factor: float) -> tuple[list[float], list[float], float]:
    """Centre, entries of the inverse and log-determinant, with the least spread added."""
    whole = factor * cov + FLOOR**2 * np.eye(DIMENSIONS)
    inverse = np.linalg.inv(whole)
    return centre.tolist(), [float(inverse[i, j]) for i, j in _PAIRS], float(np.linalg.slogdet(whole)[1])


def _with_distance(vectors: DataFrame, estimates: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Adds the squared distance from the estimate of the same key, and its other columns."""
    rest = [c for c in estimates.columns if c not in ("centre", "inverse")]
    # Plain columns keep the generated code short.
    told = estimates.select(
        *rest,
        *[F.col("centre")[i].alias(f"centre_{i}") for i in range(DIMENSIONS)],
        *[F.col("inverse")[at].alias(f"inverse_{at}") for at in range(len(_PAIRS))],
    )
    away = [F.col(c) - F.col(f"centre_{i}") for i, c in enumerate(_NAMES)]
    terms = [(1.0 if i == j else 2.0) * F.col(f"inverse_{at}") * away[i] * away[j] for at, (i, j) in enumerate(_PAIRS)]
    joined = vectors.join(told, key, how)
    return joined.select(
        *vectors.columns, *[c for c in rest if c != key], sum(terms[1:], terms[0]).alias("distance")
    )


def _moments(rows: DataFrame, *keys: str, names: list[str] = _NAMES) -> DataFrame:
    """Count, sums and sums of products of counted vectors per group."""
    n = F.col("n")
    sums = [F.sum(n * F.col(c)) for c in names]
    products = [F.sum(n * F.col(names[i]) * F.col(names[j])) for i, j in _PAIRS]
    return rows.groupBy(*keys).agg(
        F.sum(n).alias("n"), F.array(*sums).alias("sums"), F.array(*products).alias("products")
    )


def _estimates(moments: DataFrame, factor: float) -> DataFrame:
    """One estimate per (start, key) from its moments; each is a row of its own."""

    def run(frames):
        for frame in frames:
            rows = [
                (r.start, r.key, *estimate(*scatter(int(r.n), r.sums, r.products), factor))
                for r in frame.itertuples(index=False)
            ]
            yield pd.DataFrame(rows, columns=["start", "key", "centre", "inverse", "volume"])

    return moments.select("start", "key", "n", "sums", "products").mapInPandas(run, _ESTIMATE)


def _middle(counted: DataFrame, *keys: str) -> DataFrame:
    """The lower median of ``value`` per group, from (keys, value, n): few values, each once."""
    counts = counted.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*keys).orderBy("value")
    total = Window.partitionBy(*keys)
    passed = counts.withColumn("upto", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(total))
    return passed.where("2 * upto >= total").groupBy(*keys).agg(F.min("value").alias("middle"))


def _by_statistic(vectors: DataFrame) -> DataFrame:
    values = F.array(*[F.col(c).cast("bigint") for c in _NAMES])
    return vectors.select("key", "n", F.posexplode(values).alias("at", "value"))


def _listed(middles: DataFrame, name: str) -> DataFrame:
    """(key, name): the values of all statistics of a key as one array."""
    told = F.array_sort(F.collect_list(F.struct("at", "middle")))
    return middles.groupBy("key").agg(F.transform(told, lambda x: x["middle"]).alias(name))


def _starts(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """First estimates: the medians, and scatters from median deviations and three correlations.

    Correlations are none, those of hyperbolic tangents, and those of the signs
    of the standardised vectors in space.
    """
    single = _by_statistic(vectors)
    medians = scratch.keep(_middle(single, "key", "at"), "medians")
    away = single.join(medians, ["key", "at"]).withColumn("value", F.abs(F.col("value") - F.col("middle")))
    spread = _listed(medians, "medians").join(
        _listed(_middle(away.select("key", "at", "value", "n"), "key", "at"), "deviations"), "key"
    )
    spread = scratch.keep(spread, "spread")

    z = [
        (F.col(c) - F.col("medians")[i]) / F.greatest(1.4826 * F.col("deviations")[i], F.lit(FLOOR))
        for i, c in enumerate(_NAMES)
    ]
    standard = settled(vectors.join(spread, "key").select("key", "n", *[x.alias(c) for x, c in zip(z, _NAMES, strict=True)]))
    squares = [F.col(c) * F.col(c) for c in _NAMES]
    standard = settled(standard.withColumn("norm", F.sqrt(sum(squares[1:], squares[0]))))
    whole = [
        [F.rint(1000 * F.tanh(c)).cast("bigint") for c in _NAMES],
        [F.when(F.col("norm") > 0, F.rint(1000 * F.col(c) / F.col("norm"))).otherwise(0).cast("bigint") for c in _NAMES],
    ]
    moved = F.array(
        *[
            F.struct(F.lit(at).alias("start"), *[x.alias(c) for x, c in zip(columns, _NAMES, strict=True)])
            for at, columns in enumerate(whole, 1)
        ]
    )
    found = _moments(standard.select("key", "n", F.inline(moved)), "start", "key").join(spread, "key")
    plain = spread.select(
        F.lit(0).alias("start"),
        "key",
        F.lit(1).cast("bigint").alias("n"),
        F.array_repeat(F.lit(0).cast("bigint"), DIMENSIONS).alias("sums"),
        F.array(*[F.lit(int(i == j)).cast("bigint") for i, j in _PAIRS]).alias("products"),
        "medians",
        "deviations",
    )
    every = found.select(*plain.columns).union(plain)

    def run(frames):
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                _, cov = scatter(int(r.n), r.sums, r.products)
                size = np.sqrt(np.diag(cov))
                size[size == 0] = 1.0
                correlation = cov / np.outer(size, size)
                np.fill_diagonal(correlation, 1.0)
                width = np.maximum(1.4826 * np.array(r.deviations, float), FLOOR)
                told = estimate(np.array(r.medians, float), correlation * np.outer(width, width), 1.0)
                rows.append((r.start, r.key, *told))
            yield pd.DataFrame(rows, columns=["start", "key", "centre", "inverse", "volume"])

    return every.mapInPandas(run, _ESTIMATE)


def _concentrated(vectors: DataFrame, estimates: DataFrame, sizes: DataFrame, support: float) -> DataFrame:
    """Moments of the ``support`` of each key nearest by its estimate.

    The cut is the bin of the distance in which the share is reached; vectors of
    that bin belong to it.
    """
    binned = _with_distance(vectors, estimates, "key").withColumn(
        "bin", F.floor(256 * F.log2(1 + F.col("distance")))
    )
    counts = binned.groupBy("start", "key", "bin").agg(F.sum("n").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("start", "key").orderBy("bin"))
    cuts = (
        counts.withColumn("upto", up_to)
        .join(sizes, "key")
        .where(F.col("upto") >= F.ceil(support * F.col("documents")))
        .groupBy("start", "key")
        .agg(F.min("bin").alias("cut"))
    )
    near = binned.join(cuts, ["start", "key"]).where("bin <= cut")
    return _moments(near, "start", "key")


def fit_outliers(counted: DataFrame, by: int, settings: Settings, scratch: Scratch) -> DataFrame:
    """Estimates (key, centre, inverse) for every combination of the ``by`` grouping columns.

    ``counted`` is what ``document_counts`` gives; documents the base rules
    reject take no part. Keys name a level and its values, a null as none: all
    grouping columns, one less, and so on, down to all documents. A combination
    with fewer than ``least`` documents takes the finest level that has them; if
    even all documents are fewer, it has no row here.
    """
    levels = _levels(by)
    kept = counted.where("not base_failed")
    one = kept.groupBy(*[f"key_{i}" for i in range(by)], *_NAMES).agg(F.count(F.lit(1)).alias("n"))
    one = scratch.keep(one, "distinct")
    keyed = one.select(F.explode(F.array(*levels)).alias("key"), "n", *_NAMES)
    sizes = keyed.groupBy("key").agg(F.sum("n").alias("documents")).where(F.col("documents") >= settings.least)
    sizes = scratch.keep(sizes, "sizes")
    vectors = keyed.join(sizes.select("key"), "key").groupBy("key", *_NAMES).agg(F.sum("n").alias("n"))
    vectors = scratch.keep(vectors, "vectors")

    found = scratch.keep(_starts(vectors, scratch), "estimates-0")
    for step in range(1, settings.steps + 1):
        before = found.select("start", "key", F.col("volume").alias("before"))
        moments = _concentrated(vectors, found, sizes, settings.support)
        found = scratch.keep(_estimates(moments, consistency(settings.support)), f"estimates-{step}")
        gained = found.join(before, ["start", "key"]).agg(F.max(F.col("before") - F.col("volume"))).first()[0]
        scratch.drop(f"estimates-{step - 1}")
        if gained is None or (step > 1 and gained <= settings.gain):
            break

    best = found.groupBy("key").agg(F.min(F.struct("volume", "start", "centre", "inverse")).alias("x"))
    best = best.select(F.col("x.start").alias("start"), "key", "x.centre", "x.inverse")
    inside = _with_distance(vectors, best, "key").where(
        F.col("distance") <= chi_square_quantile(settings.reweight, DIMENSIONS)
    )
    final = _estimates(_moments(inside, "start", "key"), consistency(settings.reweight))
    final = scratch.keep(final.select("key", "centre", "inverse"), "final")

    groups = one.select(levels[0].alias("group"), F.posexplode(F.array(*levels)).alias("level", "key")).distinct()
    chosen = (
        groups.join(final, "key")
        .groupBy("group")
        .agg(F.min(F.struct("level", "centre", "inverse")).alias("x"))
        .select("group", "x.level", "x.centre", "x.inverse")
    )
    chosen = scratch.keep(chosen, "chosen")
    scratch.drop("distinct", "sizes", "vectors", "medians", "spread", f"estimates-{step}", "final")
    return chosen


def _levels(by: int) -> list[Column]:
    """Keys of a row, the finest first; the number of columns in front tells them apart."""
    return [
        F.concat(F.lit(f"{k}"), F.to_json(F.struct(*[F.col(f"key_{i}") for i in range(k)])) if k else F.lit(""))
        for k in range(by, -1, -1)
    ]


def reject_outliers(
    documents: DataFrame,
    settings: Settings = Settings(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    by: tuple[str, ...] = ("lang", "source"),
    scratch: Scratch | None = None,
) -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept of every row.

    ``base_failed``: fewer than 20 words, or more than 30 percent of them in
    windows of eight words found twice or more. ``distance`` is the squared
    robust distance of the other documents from their language and source, in
    spreads; a document is kept up to the cutoff. It is null, and decides
    nothing, where even the whole table has too few documents to estimate from.

    A null or empty text has no words and fails; null languages and sources are
    groups like others. Repeated rows are counted and answered each. Only the
    named columns are read; an empty table gives an empty result. Texts are read
    once, the rest works on narrow tables.
    """
    scratch = scratch or Scratch(documents.sparkSession, "outliers")
    counted = scratch.keep(document_counts(documents, doc_id=doc_id, text=text, by=by), "counts")
    chosen = fit_outliers(counted, len(by), settings, scratch)
    grouped = counted.withColumn("group", _levels(len(by))[0])
    near = F.when(~F.col("base_failed"), F.col("distance"))
    return _with_distance(grouped, chosen, "group", "left").select(
        "doc_id",
        *COUNTS,
        "base_failed",
        near.alias("distance"),
        (~F.col("base_failed") & F.coalesce(near <= settings.cutoff, F.lit(True))).alias("kept"),
    )
