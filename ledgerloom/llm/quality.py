"""Quality by importance resampling: two generative models of hashed n-grams, and Gumbel top-k."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rows import Hashes, distinct_name, grams, hashed, labelled
from ledgerloom.session import stage

BITS = 16  # n-grams are hashed to 2**BITS buckets; the ratios of all are sent to every task, 0.5 MB
SMOOTHING = 1.0  # added to each bucket's count
SAMPLE = 16_000  # labelled documents, about that many at most, of which the good ones are the target
SEED = 42
PUNCTUATION = re.compile(r"[^\w\s]+")


def packed(token: str) -> int:
    """Hash of a token's letters and digits in the high half, of its punctuation in the low one (0: none)."""
    marks = "".join(PUNCTUATION.findall(token))
    core = hashed(PUNCTUATION.sub("", token)) >> 32
    return core << 32 | (hashed(marks, 1) >> 32 if marks else 0)


REPEATED = np.uint64(0x5851F42D4C957F2D)


def buckets(text: str, cache: Hashes) -> np.ndarray:
    """Buckets of a text's n-grams: words, punctuation marks, pairs of neighbouring words, pairs of their marks.

    A word that follows itself makes the same pair whichever word it is.
    """
    tokens = cache.of(text.split())
    words, marks = tokens >> np.uint64(32), tokens & np.uint64(0xFFFFFFFF)
    pairs = grams(words, 1)
    pairs[words[:-1] == words[1:]] = REPEATED
    parts = (words * REPEATED, marks[marks > 0] * REPEATED + np.uint64(1 << 60), pairs, grams(marks + np.uint64(7), 1))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts (the one column). Tasks count for themselves, then the counts are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total = Hashes(packed), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                total += np.bincount(buckets(body, cache), minlength=1 << BITS) if len(body) > 1 << 16 else 0
                if len(body) <= 1 << 16:
                    np.add.at(total, buckets(body, cache), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    added = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS)
    out[added["bucket"].to_numpy()] = added["n"].to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the n-gram probabilities of the target's model over those of the raw text's."""
    smooth = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * len(c))
    return np.log(smooth(target)) - np.log(smooth(raw))


def weighed(docs: DataFrame, ratio: np.ndarray, text: str = "text", name: str = "log_weight") -> DataFrame:
    """``docs`` with the log importance weight of each whole text: the sum of the ratios of its n-grams.

    A null or empty text has weight 0.
    """
    body = distinct_name(docs, "_body")
    sent, names = docs.sparkSession.sparkContext.broadcast(ratio), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, ratios = Hashes(packed), sent.value
        for batch in batches:
            made = [float(ratios[buckets(t, cache)].sum()) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.float64())], names=names)

    sized = docs.select("*", F.coalesce(F.col(text), F.lit("")).alias(body))
    return sized.mapInArrow(run, docs.select("*").schema.add(name, "double"))


def cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that best parts good from bad labelled documents: the middle of the widest gap with the fewest errors."""
    if not len(weights) or good.all():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    errors = np.concatenate([[(~g).sum()], (~g).sum() + np.cumsum(np.where(g, 1, -1))])  # the first i are rejected
    edges = np.concatenate([[w[0] - 2.0], w, [w[-1] + 2.0]])
    gaps = np.diff(edges)
    best = max(np.flatnonzero((errors == errors[gaps > 0].min()) & (gaps > 0)), key=lambda i: gaps[i])
    return float((edges[best] + edges[best + 1]) / 2)


def kth(keys: DataFrame, k: int) -> float | None:
    """The k-th largest of a frame's only column, doubles; null if there are fewer. Exact.

    The range of keys is cut in 4096 parts, counted, and the part that holds the k-th is cut again, until it has one value.
    """
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k < 1:
        return None
    while low < high:
        step = (high - low) / 4096
        part = F.least(F.floor((F.col("key") - low) / step), F.lit(4095)).alias("part") if step > 0 else F.lit(0).alias("part")
        inside = keys.filter((F.col("key") >= low) & (F.col("key") <= high))
        found = inside.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).orderBy(F.desc("part")).collect()
        for row in found:
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        else:
            return None
    return low


def resample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``log_weight``, ``key`` and ``kept`` (clashing columns are replaced).

    The target model is made of the good documents of a sample of labelled ones (``doc_id, label``), the raw model of all
    documents. A document's key is its log weight plus Gumbel noise from a hash of its id and text, and the k
    documents with the largest keys are kept; k is the number of documents whose weight is above that which best parts
    the labelled good and bad ones. Ties at the k-th key are all kept (equal rows are). Without any label of 0 all are kept.
    """
    spark = docs.sparkSession
    docs = docs.drop("log_weight", "key", "kept")
    chosen = stage(labelled(docs, labels, sample, seed, doc_id, text), "labelled")
    ratio = log_ratio(counts(chosen.filter("label > 0").select("text")), counts(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))))
    known = weighed(chosen, ratio).select("label", "log_weight").toArrow()
    least = cut(known["log_weight"].to_numpy(), known["label"].to_numpy() > 0)
    u = (F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.lit(seed)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    keyed = stage(weighed(docs, ratio, text).withColumn("key", F.col("log_weight") - F.log(-F.log(u))), "keyed")
    k = keyed.filter(F.col("log_weight") >= float(max(least, -1e300))).count()
    threshold = kth(keyed.select("key"), k)
    return keyed.withColumn("kept", F.lit(False) if threshold is None else F.col("key") >= threshold)
