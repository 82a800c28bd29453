"""Document quality by Bradley-Terry ranking of preference pairs.

A document has a strength, a weighted sum of its features. In a pair the good document is
preferred with the logistic probability of the difference of strengths; the weights minimise
the logistic loss over many pairs (one document marked 1, one marked 0), with a small ridge
penalty, by Newton steps. The threshold is a quantile of strengths: below it lies the share of
labelled documents that is marked 0. A score is the logistic function of the distance to the
threshold, placed so that the threshold itself scores ``CUT``.

The features (``features``) say how a text is written and not what it is about: relative
frequencies of three neighbouring byte classes, how often words and lines repeat, how long
words are. They are taken from whole texts.

The fit reads at most ``SAMPLE`` labelled documents of each mark, those with the smallest
hashed ids, whole; the shares of the marks are counted over all labelled documents. Everything
else is one pass over the documents, without a shuffle.

Nulls: a null text is an empty one and gets a score; labels without id or mark count for
nothing; an id marked both ways is not learned from; a null id is scored but never labelled.
Ties: of texts with one id the smallest hashes are taken first. Equal texts get equal scores.
Without documents of both marks there are no pairs, and every score is the share of mark 1
(one half without any label). An empty table gives no rows. Other columns are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import list_column, small

#: Labelled documents of each mark that the fit reads at most.
SAMPLE = 10_000
#: Preference pairs of the fit.
PAIRS = 40_000
#: The score of a document at the threshold.
CUT = 0.3
#: Ridge penalty on the weights of standardised features, and how far those may reach.
RIDGE, REACH = 1e-4, 8.0

#: Byte classes: other, small letters (and all bytes past ASCII), capitals, digits, blanks,
#: line feeds, marks, full stops and commas.
_CLASS = np.zeros(256, np.uint16)
_CLASS[33:127] = 6
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[65:91], _CLASS[48:58] = 2, 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[10] = 5
_CLASS[[44, 46]] = 7
_CLASSES = 8
#: Bytes counted at once.
_PIECE = 1 << 20


def _class_trigrams(data: bytes) -> np.ndarray:
    counts = np.zeros(_CLASSES**3, np.int64)
    for begin in range(0, max(len(data) - 2, 0), _PIECE):
        kinds = _CLASS[np.frombuffer(data[begin : begin + _PIECE + 2], np.uint8)]
        grams = (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:]
        counts += np.bincount(grams, minlength=len(counts))
    return np.sqrt(counts / max(len(data) - 2, 1))


def features(data: bytes) -> np.ndarray:
    """The features of a text in UTF-8."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n = max(len(words), 1)
    lengths = np.array([len(word) for word in words] or [0])
    distinct = len(set(words)) / n if words else 1.0
    neighbours = sum(map(eq, words, words[1:])) / n
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    size = np.log1p(len(words))
    own = [size, distinct, distinct * size, neighbours, repeated, lengths.mean(), lengths.std()]
    return np.concatenate([_class_trigrams(data), own]).astype(np.float32)


@dataclass
class Ranking:
    """Weights of features and what turns strengths into scores."""

    weights: np.ndarray
    offset: float
    scale: float
    centre: np.ndarray
    spread: np.ndarray

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.spread, -REACH, REACH) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        at = (self.strengths(rows) - self.offset) / self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -500, 500)))


def constant(width: int, share: float) -> Ranking:
    """Every text scores ``share``."""
    share = min(max(share, 1e-9), 1 - 1e-9)
    offset = np.log(CUT / (1 - CUT)) - np.log(share / (1 - share))
    return Ranking(np.zeros(width), float(offset), 1.0, np.zeros(width), np.ones(width))


def bradley_terry(pairs: np.ndarray, steps: int = 25) -> np.ndarray:
    """Weights that minimise the mean logistic loss of feature differences (better - worse)."""
    weights = np.zeros(pairs.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(pairs @ weights, -30, 30)))
        slope = RIDGE * weights - (pairs * lost[:, None]).mean(0)
        bend = (pairs * (lost * (1 - lost))[:, None]).T @ pairs / len(pairs)
        step = np.linalg.solve(bend + RIDGE * np.eye(len(weights)), slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def rank(good: np.ndarray, bad: np.ndarray, share_bad: float) -> Ranking:
    """Fit on the features of good and bad documents; ``share_bad`` of all labelled ones are bad."""
    both = np.concatenate([good, bad]).astype(np.float64)
    centre, spread = both.mean(0), both.std(0)
    spread[spread < 1e-6] = np.inf
    model = Ranking(np.zeros(both.shape[1]), 0.0, 1.0, centre, spread)
    moving = np.flatnonzero(np.isfinite(spread))
    rows = np.clip((both - centre) / spread, -REACH, REACH)[:, moving].astype(np.float32)
    draw = np.random.default_rng(12)
    better = draw.integers(0, len(good), PAIRS)
    worse = draw.integers(len(good), len(both), PAIRS)
    if len(moving):
        model.weights[moving] = bradley_terry(rows[better] - rows[worse])
    strengths = model.strengths(both)
    weight = np.concatenate([np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))])
    order = np.argsort(strengths, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), share_bad - 1e-12))
    edge = strengths[order[[below, min(below + 1, len(order) - 1)]]]
    model.offset = float(edge.mean())
    model.scale = max(1.0, float(np.quantile(np.abs(strengths - model.offset), 0.99)) / 10)
    return model


def _rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    texts = batch.column(column).to_pylist()
    return np.stack([features(text or b"") for text in texts])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE,
) -> Ranking:
    """Learn from ``labels`` (id, mark 0 or 1) and the texts that they name."""
    width = len(features(b""))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    marks = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("mark"))
        .where("id IS NOT NULL AND mark IN (0, 1)")
        .groupBy("id").agg(F.min("mark").alias("mark"), F.max("mark").alias("most")).where("mark = most")
        .join(texts.select("id"), "id", "left_semi")
        .select("id", "mark")
    )
    counts = {row["mark"]: row["n"] for row in marks.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return constant(width, counts.get(1.0, 0) / total if total else 0.5)

    def run(batches):
        for batch in small(batches, 256):
            rows = _rows(batch, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), list_column(rows.reshape(-1), np.full(len(rows), width), pa.float32())], ["at", "row"]
            )

    found = {}
    for mark in (0.0, 1.0):
        named = F.broadcast(marks.where(F.col("mark") == mark).orderBy(F.xxhash64("id"), "id").limit(sample).select("id"))
        chosen = texts.join(named, "id").select(F.xxhash64("id", "text").alias("at"), "text").orderBy("at", "text").limit(sample)
        table = chosen.mapInArrow(run, "at long, row array<float>").toArrow()
        order = np.argsort(table["at"].to_numpy(), kind="stable")
        found[mark] = table["row"].combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
    return rank(found[1.0], found[0.0], counts[0.0] / total)


def score_documents(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches):
        for batch in small(batches):
            if batch.num_rows:
                scores = pa.array(model.scores(_rows(batch, 1)), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["id", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
