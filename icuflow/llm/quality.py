"""A quality classifier by nearest neighbours among labelled latent-semantic vectors.

A text's terms are hashed shapes: trigrams of character classes (which tell prose from lists, shouting and symbols in any
language) and how often its words repeat, in all and at once. The labelled sample's weighted term matrix gives the latent space by its
singular vectors. The labelled vectors, whose number and width are parameters, are broadcast; every document's cosine to
every one of them is computed exactly, a block of documents at a time, and its nearest vote with a power of their
similarity, chosen by leaving each labelled row out of its own vote.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icuflow.llm.common import text_of, without

#: Characters with a class of their own; the others are capitals, digits, or lower-case and anything beyond ASCII.
ALONE = " \n\t.,;:!?'\"()[]{}<>|/\\*#$%&@+-=_~^`"
SHAPES, REPEATS = 992, 16
WIDTH = SHAPES + 2 * REPEATS + 1
#: Labelled rows the classifier is fitted on at most, taken evenly over the ids' hashes.
SAMPLE = 4096
LATENT, NEIGHBOURS = 48, 25
#: Powers of the cosine that a neighbour may vote with. Any two texts of prose have a high cosine, so that the plain one
#: can give all neighbours the same say, and a rare label none where few rows are labelled. The sample itself decides.
POWERS = (1, 2, 4, 8, 16)
#: Documents whose cosines are computed together.
BLOCK = 64


def _classes() -> np.ndarray:
    table = np.full(256, len(ALONE), dtype=np.int64)
    table[[ord(c) for c in ALONE]] = range(len(ALONE))
    table[65:91], table[48:58] = len(ALONE) + 1, len(ALONE) + 2
    return table


_CLASS = _classes()
_CLASSES = len(ALONE) + 3


def terms(text: str) -> np.ndarray:
    """The share of each term in a text, as square roots; all zero for a text without characters."""
    out = np.zeros(WIDTH)
    kinds = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if len(kinds) > 2:
        grams = (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:]
        # Each class trigram has a cell of its own as long as there are cells; hashing spreads them.
        cells = ((grams * 2654435761) >> 12) % SHAPES
        out[:SHAPES] = np.bincount(cells, minlength=SHAPES) / len(grams)
    if words := text.split():
        counted = Counter(words)
        counts = np.fromiter(counted.values(), dtype=np.int64, count=len(counted))
        total = counts.sum()
        often = np.minimum(np.log2(counts).astype(int), REPEATS - 1)
        rare = np.minimum(np.log2(total / counts).astype(int), REPEATS - 1)
        out[SHAPES : SHAPES + REPEATS] = np.bincount(often, weights=counts / total, minlength=REPEATS)
        out[SHAPES + REPEATS : -1] = np.bincount(rare, weights=counts / total, minlength=REPEATS)
        out[-1] = sum(map(eq, words, words[1:])) / len(words)
    return np.sqrt(out)


@dataclass
class Model:
    """`axes` takes weighted terms to the latent space; `vectors` are the labelled rows there, of length 1 (or 0)."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: int = 1

    def latent(self, rows: np.ndarray) -> np.ndarray:
        spread = rows * self.weights @ self.axes
        size = np.linalg.norm(spread, axis=1, keepdims=True)
        return np.divide(spread, size, out=np.zeros_like(spread), where=size > 0)

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        return np.round(self.latent(rows) @ self.vectors.T, 9)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return voted(self.cosines(rows), self.labels, self.neighbours, self.power)


def voted(cosine: np.ndarray, labels: np.ndarray, neighbours: int, power: int) -> np.ndarray:
    """The labels of each row's nearest, weighted by a power of the cosine; equal cosines go by the sample's order. 0.5
    without a vote."""
    if not len(labels):
        return np.full(len(cosine), 0.5)
    k = min(neighbours, len(labels))
    edge = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
    above = cosine > edge
    level = cosine == edge
    room = k - above.sum(axis=1, keepdims=True)
    chosen = above | (level & (np.cumsum(level, axis=1) <= room))
    votes = np.where(chosen, np.maximum(cosine, 0) ** power, 0)
    total = votes.sum(axis=1)
    score = np.divide(votes @ labels, total, out=np.full(len(cosine), 0.5), where=total > 0)
    return np.clip(score, 0, 1)


def sharpest(model: Model, rows: np.ndarray, powers: tuple[int, ...] = POWERS) -> int:
    """The power by which the labelled rows, each left out of its own vote, score closest to their labels: the mean of both
    labels' mean squared errors, equal ones by the smaller power."""
    missed = {power: np.zeros(len(rows)) for power in powers}
    for first in range(0, len(rows), BLOCK):
        part = np.arange(first, min(first + BLOCK, len(rows)))
        cosine = model.cosines(rows[part])
        # A row is no neighbour of its own: at -1 it has no vote even where there are too few others.
        cosine[np.arange(len(part)), part] = -1
        for power in powers:
            missed[power][part] = (voted(cosine, model.labels, model.neighbours, power) - model.labels[part]) ** 2
    of = [model.labels == label for label in np.unique(model.labels)]
    return min(powers, key=lambda p: (round(float(np.mean([missed[p][own].mean() for own in of])), 12), p))


def fit_rows(rows: np.ndarray, labels: np.ndarray, latent: int = LATENT, neighbours: int = NEIGHBOURS) -> Model:
    """The latent space of labelled term rows, and the power that their votes on one another ask for."""
    if not len(labels):
        return Model(np.ones(WIDTH), np.zeros((WIDTH, 1)), np.zeros((0, 1)), np.zeros(0), neighbours)
    weights = np.log((1 + len(rows)) / (1 + np.count_nonzero(rows, axis=0))) + 1
    weighted = rows * weights
    _, axes = np.linalg.eigh(weighted.T @ weighted)
    model = Model(weights, axes[:, ::-1][:, : min(latent, WIDTH)].copy(), np.zeros((0, 1)), labels.astype(float), neighbours)
    model.vectors = model.latent(rows)
    model.power = sharpest(model, rows)
    return model


@F.arrow_udf(T.BinaryType())
def _terms(texts: pa.Array) -> pa.Array:
    return pa.array([terms(t).astype("<f4").tobytes() for t in texts.to_pylist()], type=pa.binary())


def held_out(doc_id: str = "doc_id"):
    """Whether labels of this document are kept for testing: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality", text: str = "text", doc_id: str = "doc_id"
) -> Model:
    """Fit on at most `sample` labelled documents that are not held out: those whose ids have the smallest hashes.

    Labels other than 0 and 1 (null among them) are left out; of several labels of a document the lowest counts. The
    sample's term rows come to the driver: `sample` times WIDTH numbers.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("_labelled"))
        .agg(F.min(label).cast("int").alias("_label"))
        .join(docs.select(F.col(doc_id).alias("_labelled")), "_labelled", "left_semi")
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(sample)
    )
    # `sample` rows at most.
    rows = (
        docs.select(F.col(doc_id).alias("_labelled"), text_of(text).alias("_text"))
        .join(F.broadcast(known), "_labelled")
        .groupBy("_labelled", "_label")
        .agg(F.min("_text").alias("_text"))
        .select("_labelled", "_label", _terms("_text").alias("_terms"))
        .toArrow()
    )
    rows = rows.sort_by([("_labelled", "ascending")])
    made = [np.frombuffer(t, dtype="<f4") for t in rows["_terms"].to_pylist()]
    return fit_rows(np.array(made, dtype=float).reshape(-1, WIDTH), rows["_label"].to_numpy())


def scorer(spark: SparkSession, model: Model):
    """A function Column -> Column: the score of a text column (null gives null)."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        given, own = texts.to_pylist(), sent.value
        done = np.full(len(given), np.nan)
        there = [k for k, t in enumerate(given) if t is not None]
        for first in range(0, len(there), BLOCK):
            part = there[first : first + BLOCK]
            rows = np.array([terms(given[k]) for k in part], dtype="<f4")
            done[part] = own.score(rows.astype(float))
        return pa.array(done, type=pa.float64(), mask=np.array([t is None for t in given], dtype=bool))

    return score


def classify(
    docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """Add `score` (0 to 1, higher: label 1 is likelier) and `predicted` (1 if the score is at least `threshold`).

    The score depends on the text alone: repeated rows score the same. Null and empty texts have no terms and, like any
    text if nothing is labelled, score 0.5. Other columns stay; those of the two names are replaced.
    """
    given = without(docs, [x for x in (score, predicted) if x != text])
    scored = given.withColumn(score, scorer(docs.sparkSession, model)(text_of(text)))
    return scored.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
