"""Quality classifier from weak labels.

Simple labellers vote on every document: bad, good or nothing. They overlap and
err; expectation-maximisation estimates how often each votes what on good and
on bad documents, from how the votes of all documents agree, and with that the
chance that a document is good. Only the counts of vote patterns, a few at most,
come to the driver. The posteriors label a bounded sample of documents, on
which a linear scorer over hashed word shapes is trained; it scores all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.passing import passed, read_once

# At most so many documents train the scorer, those with the smallest hashed id.
SAMPLE = 20_000
BUCKETS = 1 << 12
THRESHOLD = 0.5


# Labellers


def shape_counts(text: str) -> np.ndarray:
    """What the labellers look at, of a whole text.

    Words, capital letters, other letters, marks other than . and , words with
    such a mark, words with two capitals in a row, words equal to the one
    before, and distinct words, in this order.
    """
    words = text.split()
    plain = text.translate(_CLASSES)
    shapes = plain.split()
    return np.array(
        [
            len(words),
            plain.count("A"),
            plain.count("a"),
            plain.count("#"),
            sum(["#" in s for s in shapes]),
            sum(["AA" in s for s in shapes]),
            sum(map(str.__eq__, words, words[1:])),
            len(set(words)),
        ],
        float,
    )


class _Classes(dict):
    """Character to A (capital), a (other letter), 0 (digit), space, . , or # (any other mark)."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        if c.isalpha():
            found = "A" if c.isupper() else "a"
        elif c.isspace():
            found = " "
        elif c.isdigit():
            found = "0"
        else:
            found = c if c in ".," else "#"
        self[point] = found
        return found


_CLASSES = _Classes()

# Name, ratio, good up to, bad from. Between the two a labeller abstains, as all
# do on texts of few words.
LEAST_WORDS = 20
LABELLERS = (
    ("marks", lambda c: c[3] / max(1.0, c[1] + c[2] + c[3]), 0.03, 0.06),
    ("marked_words", lambda c: c[4] / c[0], 0.05, 0.10),
    ("capitals", lambda c: c[1] / max(1.0, c[1] + c[2]), 0.06, 0.25),
    ("shouted_words", lambda c: c[5] / c[0], 0.05, 0.20),
    ("repeats", lambda c: c[6] / c[0], 0.05, 0.20),
    # Long texts repeat words: distinct ones grow about with the root of the length.
    ("sameness", lambda c: 1 - c[7] / c[0] * np.sqrt(max(1.0, c[0] / 200)), 0.5, 0.7),
)


def votes(counts: np.ndarray) -> list[int]:
    """One vote per labeller: 0 bad, 1 good, 2 none."""
    if counts[0] < LEAST_WORDS:
        return [2] * len(LABELLERS)
    told = []
    for _, ratio, good, bad in LABELLERS:
        x = ratio(counts)
        told.append(0 if x >= bad else 1 if x <= good else 2)
    return told


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and P(vote | class) per labeller: [labeller, class, vote]."""

    good: float
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) of rows of votes."""
        at = np.arange(patterns.shape[1])
        logs = [
            np.log(prior) + np.log(self.chance[at, k, patterns]).sum(axis=1)
            for k, prior in ((0, 1 - self.good), (1, self.good))
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> LabelModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from labellers that each find three in ten bad documents and are
    seldom wrong about good ones, as there are several ways to be bad.
    Abstaining is taken to be independent of the class, so silence says nothing.
    """
    n_labellers = patterns.shape[1]
    chance = np.empty((n_labellers, 2, 3))
    chance[:, 0] = (0.3, 0.7, 1.0)
    chance[:, 1] = (0.005, 0.995, 1.0)
    model = LabelModel(0.8, chance)
    for _ in range(steps):
        is_good = model.posterior(patterns)
        weight = np.stack([(1 - is_good) * counts, is_good * counts])
        chance = np.ones((n_labellers, 2, 3))
        for j in range(n_labellers):
            for k in range(2):
                seen = np.array([weight[k][patterns[:, j] == v].sum() for v in (0, 1)]) + 1e-2
                chance[j, k, :2] = seen / seen.sum()
        good = float(np.clip(weight[1].sum() / counts.sum(), 1e-6, 1 - 1e-6))
        if abs(good - model.good) < 1e-12 and np.allclose(chance, model.chance, atol=1e-12):
            break
        model = LabelModel(good, chance)
    return model


# Scorer


def features(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of a text: shares of word shapes and of steps between words.

    A shape is the word with its characters replaced by their classes, runs of
    one class cut to one. A step tells whether a word equals the one before. All
    shares shrink with the number of words, as a short text says little.
    """
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    shapes = Counter(map(_shape, text.translate(_CLASSES).split()))
    repeats = sum(map(str.__eq__, words, words[1:]))
    found = {_bucket("shape " + s, buckets): 0.0 for s in shapes}
    for s, n in shapes.items():
        found[_bucket("shape " + s, buckets)] += n / len(words)
    b = _bucket("repeat", buckets)
    found[b] = found.get(b, 0.0) + repeats / len(words)
    b = _bucket("variety", buckets)
    found[b] = found.get(b, 0.0) + min(1.0, len(set(words)) / len(words) * np.sqrt(max(1.0, len(words) / 200)))
    at = np.fromiter(found, np.int64, len(found))
    return at, np.fromiter(found.values(), float, len(found)) * (len(words) / (len(words) + LEAST_WORDS))


# Entries of a worker's dictionaries, which other stages of a pipeline keep in memory.
_HELD = 20_000
_SHAPES: dict[str, str] = {}
_BUCKET_OF: dict[tuple[str, int], int] = {}


def _shape(classes: str) -> str:
    found = _SHAPES.get(classes)
    if found is None:
        if len(_SHAPES) >= _HELD:
            _SHAPES.clear()
        found = "".join(c for c, before in zip(classes, " " + classes, strict=False) if c != before)
        # Words that are long are too many to keep.
        if len(classes) <= 64:
            _SHAPES[classes] = found
    return found


def _bucket(name: str, buckets: int) -> int:
    found = _BUCKET_OF.get((name, buckets))
    if found is None:
        found = zlib.crc32(name.encode()) % buckets
        if len(_BUCKET_OF) >= _HELD:
            _BUCKET_OF.clear()
        if len(name) <= 72:
            _BUCKET_OF[name, buckets] = found
    return found


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """P(good); an empty text has none of what makes a text good or bad: zero."""
        at, values = features(text or "", len(self.weights))
        if not len(at):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(values @ self.weights[at] + self.bias, -700, 700))))


def train_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]],
    good: np.ndarray,
    buckets: int = BUCKETS,
    epochs: int = 5,
    rate: float = 0.5,
    decay: float = 1e-5,
) -> Scorer:
    """Logistic regression on the features and soft labels of documents.

    The steps are adaptive gradient steps. Classes weigh as often as they occur,
    so a text too short to tell is scored as what most texts are.
    """
    weights, bias, steps, bias_step = np.zeros(buckets), 0.0, np.full(buckets, 1e-8), 1e-8
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            p = 1 / (1 + np.exp(-np.clip(values @ weights[at] + bias, -700, 700)))
            g = p - good[i]
            slope = g * values + decay * weights[at]
            steps[at] += slope * slope
            weights[at] -= rate * slope / np.sqrt(steps[at])
            bias_step += g * g
            bias -= rate * g / np.sqrt(bias_step)
    return Scorer(weights, bias)


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel
    scorer: Scorer
    threshold: float = THRESHOLD


def label_votes(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``votes``, one number per labeller, of every row."""

    def run(batches):
        for batch in batches:
            told = [votes(shape_counts(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(told, pa.list_(pa.int32()))], names=["doc_id", "votes"]
            )

    rows = documents.select(documents[doc_id].cast("bigint").alias("doc_id"), documents[text])
    return rows.mapInArrow(run, "doc_id BIGINT, votes ARRAY<INT>")


def fit_quality(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> QualityModel:
    """Fit the label model on the votes of all documents and the scorer on a sample.

    The sample is the documents whose hashed ids fall below a bound that lets
    about ``sample`` rows pass, rows that repeat an id and its text once; their
    features come to the driver, not their texts. An empty table gives a model
    that lets everything with a word pass.
    """
    told = label_votes(documents, doc_id=doc_id, text=text)
    patterns = told.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not patterns:
        chance = np.full((len(LABELLERS), 2, 3), 0.5)
        return QualityModel(LabelModel(0.5, chance), Scorer(np.zeros(BUCKETS), 1.0), threshold)
    patterns.sort(key=lambda r: r.votes)
    model = fit_label_model(np.array([r.votes for r in patterns]), np.array([float(r.n) for r in patterns]))

    total = sum(r.n for r in patterns)
    below = int(min(1.0, sample / total) * (1 << 32))
    drawn_by = F.xxhash64(F.lit("quality"), documents[doc_id], documents[text]).alias("_drawn")
    chosen = documents.select(drawn_by, documents[text].alias("_text")).where(
        F.pmod("_drawn", F.lit(1 << 32)) < below
    )
    # Without this, a row on a third of the table would be as many rows of the sample.
    chosen = chosen.dropDuplicates(["_drawn"])

    def run(batches):
        for batch in batches:
            at, values, told = [], [], []
            for t in batch.column(0):
                body = t.as_py() or ""
                a, v = features(body)
                at.append(a.tolist())
                values.append(v.tolist())
                told.append(votes(shape_counts(body)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float64())),
                    pa.array(told, pa.list_(pa.int32())),
                ],
                names=["at", "values", "votes"],
            )

    rows = chosen.select("_text").mapInArrow(run, "at ARRAY<INT>, values ARRAY<DOUBLE>, votes ARRAY<INT>")
    drawn = sorted(r for r in rows.collect() if r["at"])
    if not drawn:
        return QualityModel(model, Scorer(np.zeros(BUCKETS), 1.0), threshold)
    good = model.posterior(np.array([r["votes"] for r in drawn]))
    listed = [(np.array(r["at"]), np.array(r["values"])) for r in drawn]
    return QualityModel(model, train_scorer(listed, good), threshold)


def score_quality(
    documents: DataFrame, model: QualityModel, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns of every row with ``quality``, from 0 to 1, and ``kept``.

    A row is kept when its score reaches the threshold of the model. A null or
    empty text, or one without words, scores zero and is not kept. One pass over
    whole texts without a shuffle; repeated rows are answered each, and other
    columns are not read.
    """
    scorer, threshold = model.scorer, model.threshold
    kept = documents.select(*keep).schema

    def run(batches):
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(scores, pa.float64()), pa.array([s >= threshold for s in scores])],
                names=[*batch.schema.names[:n], "quality", "kept"],
            )

    rows, at, n = read_once(documents, keep, text)
    return rows.mapInArrow(run, passed(kept, "quality double, kept boolean"))
