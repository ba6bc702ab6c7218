"""Text quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are hashed byte pairs and a few pseudo-terms for its form (repeated
words, capitals, symbols, word length). Weights are log counts times inverse document
frequency; a truncated SVD of a bounded labelled sample gives the latent space. The
labelled vectors, whose number is bounded by a parameter, go to every task; documents
are multiplied with all of them, a block of documents at a time, and the nearest ones
vote with their similarity. No candidate search: the cosines are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import class_weights, fold, labelled_sample, table

# Labelled rows of each class that the space is fitted on and that vote.
TRAIN_ROWS = 2000
PAIRS = 1024
FORMS = 12
RANK = 32
NEIGHBOURS = 15
SHARPNESS = 4
THRESHOLD = 0.3
# Bytes of text whose counts are held at once; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
# Weight of a pseudo-term against a byte pair.
FORM_WEIGHT = 6.0


def forms(text: str, data: np.ndarray) -> list[float]:
    """Shares between 0 and 1 that describe the form of a text."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(data))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    upper = ((data >= 65) & (data <= 90)).sum()
    lower = ((data >= 97) & (data <= 122)).sum()
    digits = ((data >= 48) & (data <= 57)).sum()
    marks = size - upper - lower - digits - (data >= 128).sum() - (data <= 32).sum()
    lines = text.split("\n")
    return [
        again / n,
        1 - len(set(words)) / n if n > 50 else 0.0,
        upper / max(1, upper + lower),
        digits / size,
        min(1.0, marks / n),
        min(1.0, 10 * marks / size),
        min(1.0, size / n / 20),
        1 - len(set(lines)) / len(lines),
        min(1.0, sum(w in ("|", "||") for w in words) / n),
        float(marks > n / 2),
        float(upper > lower),
        float(5 * again > n),
    ]


def counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Rows of pair counts and forms, block by block of texts in order."""
    at = 0
    while at < len(texts):
        block, held = [], 0
        while at < len(texts) and (not block or held + len(texts[at]) <= BLOCK_BYTES):
            held += len(texts[at])
            block.append(texts[at])
            at += 1
        datas = [np.frombuffer(text.encode(), np.uint8) for text in block]
        rows = np.zeros((len(block), PAIRS + FORMS), np.float32)
        codes = [
            ((d[:-1].astype(np.uint32) * 257 + d[1:]) * np.uint32(2654435761) >> np.uint32(22)) + i * PAIRS
            for i, d in enumerate(datas)
        ]
        pairs = np.bincount(np.concatenate(codes).astype(np.int64), minlength=len(block) * PAIRS)
        rows[:, :PAIRS] = pairs.reshape(len(block), PAIRS)
        rows[:, PAIRS:] = [forms(text, data) for text, data in zip(block, datas, strict=True)]
        yield rows


@dataclass(frozen=True)
class Space:
    """Term weights, the projection, and the labelled unit vectors."""

    weights: np.ndarray
    mean: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    # How many labelled rows each vector stands for.
    stands_for: np.ndarray
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = (weighted(rows) * self.weights - self.mean) @ self.axes
        norms = np.linalg.norm(latent, axis=1, keepdims=True)
        return (latent / np.maximum(norms, 1e-9)).astype(np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Share of the similarity that votes for label 1; the prior for empty texts."""
        scores = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return scores
        whole = [i for i, text in enumerate(texts) if text and text.strip()]
        at, k = 0, min(NEIGHBOURS, len(self.vectors))
        for rows in counts([texts[i] for i in whole]):
            cosines = self.project(rows) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, 1), 1e-3) ** SHARPNESS * self.stands_for[near]
            scores[whole[at : at + len(rows)]] = (votes * self.labels[near]).sum(1) / votes.sum(1)
            at += len(rows)
        return np.clip(scores, 0, 1)


def weighted(rows: np.ndarray) -> np.ndarray:
    """Log counts of unit length beside the forms."""
    pairs = np.log1p(rows[:, :PAIRS])
    pairs /= np.maximum(np.linalg.norm(pairs, axis=1, keepdims=True), 1e-9)
    return np.hstack([pairs, rows[:, PAIRS:]])


def fit_space(texts: list[str], labels: list[int], weights: tuple[float, float] = (1.0, 1.0)) -> Space:
    """Latent space of labelled texts; empty ones are left out.

    In votes and in the prior a text of label 0 or 1 counts ``weights`` times.
    """
    used = [(text, label) for text, label in zip(texts, labels, strict=True) if text and text.strip()]
    stands_for = np.array([weights[label] for _, label in used], np.float32)
    prior = float(np.average([label for _, label in used], weights=stands_for)) if used else 0.5
    if not used:
        none = np.zeros((0, 0), np.float32)
        return Space(none, none, none, none, none, stands_for, prior)
    rows = weighted(np.vstack(list(counts([text for text, _ in used]))))
    n = len(rows)
    frequency = np.log((1 + n) / (1 + (rows[:, :PAIRS] > 0).sum(0))) + 1
    term_weights = np.concatenate((frequency, np.full(FORMS, FORM_WEIGHT / FORMS**0.5))).astype(np.float32)
    rows = rows * term_weights
    mean = rows.mean(0)
    spread = (rows - mean).astype(np.float64)
    _, axes = np.linalg.eigh(spread.T @ spread)
    axes = axes[:, ::-1][:, :RANK].astype(np.float32)
    latent = (spread @ axes).astype(np.float32)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return Space(term_weights, mean, axes, latent, np.array([y for _, y in used], np.float32), stands_for, prior)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Space:
    """The space of at most ``rows`` labelled documents of each class, held-out ones excluded.

    The classes vote with their shares of all labels that are not held out.
    """
    keep = fold("doc_id", 5) != 0
    found = labelled_sample(docs, labels, "quality", keep, rows).orderBy("doc_id").toPandas()
    weights = class_weights(labels, "quality", keep, rows)
    return fit_space(found["text"].tolist(), found["label"].astype(int).tolist(), weights)


def rate(docs: DataFrame, space: Space) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    Null, empty and blank texts have the share of label 1 as score; repeated
    rows and null ids get a row each; an empty table gives an empty result. Other
    columns are ignored. Without labelled rows every score is 0.5.
    """
    # Plain arrays: a broadcast, unlike a function, is not pickled with its classes.
    parts = tuple(getattr(space, name) for name in Space.__dataclass_fields__)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(*shared.value)
        for batch in batches:
            scores = space.score(batch.column(1).to_pylist())
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(scores >= THRESHOLD).cast(pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int"
    )


def op4_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = rate(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
