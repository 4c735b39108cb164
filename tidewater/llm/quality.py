"""Quality scores learnt from preferences: Bradley-Terry on pairs of labelled documents.

A document's strength is ``w . x`` over features of its whole text (character classes, words,
repetition; never language, source, id or a label). In a pair of one good and one bad document the
good one wins with probability ``sigmoid(w . (x_good - x_bad))``; ``w`` minimises the logistic loss
over such pairs. The cut lies at the quantile of the labelled strengths above which the labelled
share of good documents lies; ``score`` is a logistic curve through 0.7 at that cut.

The fit uses at most ``MAX_LABELLED`` labelled documents (those with the smallest hash of the id)
and ``PAIRS`` pairs in a step, both parameters. Everything else, feature extraction and scoring, is
one pass over all documents.

Nulls, empties, ties: a null text is an empty one; a text of few characters is drawn towards the
average of the labelled texts, so it is judged by little evidence only mildly. Labels that are null
or neither 0 nor 1 are left out; repeated labels count repeatedly. Without labels of both kinds
nothing can be learnt and every score is 1. Repeated rows score alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import carried, pick, restored, texts

MAX_LABELLED = 20_000
PAIRS = 4096
STEPS = 400
SCORE_AT_CUT = 0.7
SHRINK = 30.0

_PUNCTUATION = np.array([i for i in range(33, 127) if not chr(i).isalnum()])
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)


def features(text: bytes) -> list[float]:
    """Shares and averages that describe a text; the last entry is the weight of evidence (bytes)."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    w = max(1, len(words))
    distinct, bodies = set(words), [x for x in lines if x]
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    own = [
        upper / max(1, upper + lower), counts[_DIGIT].sum() / max(1, n), counts[128:].sum() / max(1, n), counts[10] / w, (n - len(words)) / w / 10,
        len(distinct) / w, sum(map(len, distinct)) / max(1, n), len(set(bodies)) / max(1, len(bodies)), np.log1p(n / w), np.log1p(n) / 10, np.log1p(n / len(lines)) / 5,
        *np.minimum(counts[_PUNCTUATION] / w, 2.0),
    ]
    return [*own, float(n)]


WIDTH = len(features(b""))


def feature_matrix(bodies: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in bodies], np.float64).reshape(len(bodies), WIDTH)


@dataclass(frozen=True)
class Model:
    """Strength weights over standardised features, and the logistic curve over strengths."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _standard(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.strength(x) - self.cut) + np.log(SCORE_AT_CUT / (1 - SCORE_AT_CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    evidence = x[:, -1:] / (x[:, -1:] + SHRINK)
    return np.clip((x[:, :-1] - mean) / scale, -8, 8) * evidence


def fit_pairs(x: np.ndarray, good: np.ndarray, seed: int = 7, steps: int = STEPS, pairs: int = PAIRS, decay: float = 1e-3) -> Model | None:
    """Bradley-Terry by Adam over random pairs of a good and a bad document; None without both kinds."""
    win, lose = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(win) or not len(lose):
        return None
    mean, scale = x[:, :-1].mean(0), x[:, :-1].std(0)
    scale[scale < 1e-9] = 1.0
    z, rng = _standard(x, mean, scale), np.random.default_rng(seed)
    w, m, v = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for t in range(1, steps + 1):
        diff = z[rng.choice(win, pairs)] - z[rng.choice(lose, pairs)]
        miss = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))
        grad = -(miss @ diff) / pairs + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    strengths = z @ w
    order, rejects = np.sort(strengths), len(lose)
    cut = (order[rejects - 1] + order[rejects]) / 2
    spread = np.median(strengths[win]) - np.median(strengths[lose])
    return Model(mean, scale, w, float(cut), float(6 / max(spread, 1e-6)))


def labelled_features(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                      allowed: Column | None = None, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample; ``allowed`` is a condition on ``doc_id``."""
    own = pick(labels, doc_id="doc_id", label=label).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    own = own.filter(allowed) if allowed is not None else own
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled)     # bounded, so it may be broadcast
    base = pick(docs, doc_id=doc_id, text=text).join(F.broadcast(own), "doc_id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), pa.array(batch.column("label").to_pylist(), pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    got = base.mapInArrow(emit, "doc_id string, label int, x array<double>").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(2 * max_labelled).toPandas()
    return np.array(got["x"].tolist(), np.float64).reshape(len(got), WIDTH), got["label"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        allowed: Column | None = None, max_labelled: int = MAX_LABELLED) -> Model | None:
    x, good = labelled_features(docs, labels, doc_id, text, label, allowed, max_labelled)
    return fit_pairs(x, good) if len(good) else None


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row, in one pass over the whole texts."""
    base = pick(docs, doc_id=doc_id, text=text)
    if model is None:
        return base.select("doc_id", F.lit(1.0).alias("score"))
    return base.withColumn("score", scorer(model)("text")).select("doc_id", "score")


def scorer(model: Model):
    """Column function: text to score, in Arrow batches."""

    @F.arrow_udf("double")
    def quality(text: pa.Array) -> pa.Array:
        bodies = [b or b"" for b in text.cast(pa.binary()).to_pylist()]
        return pa.array(model.score(feature_matrix(bodies)) if bodies else [], pa.float64())

    return quality


def keep_good(docs: DataFrame, model: Model | None, text: str = "text", at_least: float = SCORE_AT_CUT) -> DataFrame:
    """Rows of ``docs`` (all columns) that score at least ``at_least``."""
    return docs if model is None else restored(carried(docs, text=text).filter(scorer(model)("text") >= at_least), docs)


def main_fold(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the contract: learnt from all but the held-out fold."""
    return fit(docs, labels, allowed=F.expr("pmod(crc32(cast(doc_id as string)), 4) <> 2"))
