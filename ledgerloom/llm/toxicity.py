"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rows import Hashes, distinct_name, grams, hashed, labelled

BITS = 20  # features are hashed to 2**BITS coordinates; weights are sent to every task, 4 MB at most
SAMPLE = 16_000  # labelled documents that the model learns from, about that many at most, in one task
ALPHA, BETA, L1, L2 = 0.3, 1.0, 6.0, 0.1  # learning rate, its smoothing, sparsity, shrinkage
POSITIVE = 3.0  # weight of an example with label 1
EPOCHS = 3
SEED = 42
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_"


def plain(token: str) -> int:
    return hashed(token.strip(EDGES).lower())


def coordinates(text: str, cache: Hashes) -> np.ndarray:
    """Coordinates of a text's words, pairs of neighbours, triples, and pairs that skip one or two words."""
    words = cache.of(text.split())
    shapes = ((), (1,), (1, 1), (2,), (3,))
    parts = [words * np.uint64(0x9E3779B97F4A7C15)] + [grams(words + np.uint64(sum(s) * 8 + len(s)), *s) for s in shapes[1:]]
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


def ftrl(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the coordinates and, last, the bias, after so many turns over (distinct coordinates, label)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + root) / ALPHA + L2))

    for _ in range(epochs):
        for at, label in examples:
            own, root = z[at], np.sqrt(n[at])
            w = weights(own, root)
            gradient = sigmoid(w.sum()) - label
            gradient *= POSITIVE if label else 1.0
            squares = n[at] + gradient * gradient
            z[at] = own + gradient - (np.sqrt(squares) - root) / ALPHA * w
            n[at] = squares
    return weights(z, np.sqrt(n))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id as text is divisible by 5; a null id is the empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates with a weight, and their weights; from documents with a label (``doc_id, label``).

    About ``sample`` labelled documents at most are hashed where they lie, and only their coordinates meet in the task
    that learns, in an order that a hash of the id gives. Without examples there are no weights and every score is 0.5.
    """
    chosen = labelled(docs, labels, sample, seed)

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Hashes(plain)
        for batch in batches:
            made = [np.append(np.unique(coordinates(t, cache)), 1 << BITS).astype(np.int32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())], names=["turn", "label", "at"])

    turned = chosen.select(F.xxhash64("doc_id", F.lit(seed + 1)).alias("turn"), "text", F.col("label").cast("int").alias("label"))
    hashed_texts = turned.mapInArrow(hash_texts, "turn long, label int, at binary")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "label", "at"])
        weights = ftrl([(np.frombuffer(a, np.int32), int(y > 0)) for a, y in zip(rows["at"], rows["label"])])
        at = np.flatnonzero(weights)
        return pd.DataFrame({"at": at, "weight": weights[at]})

    found = hashed_texts.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "at long, weight double").toArrow()
    return found["at"].to_numpy(), found["weight"].to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` without their text, with the score (0 to 1) of each whole text; a null text is empty.

    Each coordinate counts once for a text. Rows stay as they are.
    """
    kept = [c for c in docs.columns if c not in (text, name)]
    at, weight = model
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, values = sent.value
        weights = np.zeros((1 << BITS) + 1)
        weights[where] = values
        used, cache = weights != 0, Hashes(plain)
        for batch in batches:
            sums = np.full(batch.num_rows, weights[-1])
            for i, body in enumerate(batch.column(len(kept)).to_pylist()):
                found = coordinates(body, cache)
                found = found[used[found]]
                if len(found):
                    sums[i] += weights[np.unique(found)].sum()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sigmoid(sums))], names=[*kept, name])

    body = F.coalesce(F.col(text), F.lit("")).alias(distinct_name(docs, "_body"))
    return docs.select(*kept, body).mapInArrow(run, docs.select(*kept).schema.add(name, "double"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document; learned from ``labels.toxic`` of the rows that are not held out."""
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs.select("doc_id", "text"), train(docs, known))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
