"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rows import boxed, grams, row_key, unboxed
from ledgerloom.llm.words import hashed_words, split
from ledgerloom.session import stage

SEED_WORDS = 4  # words in a seed; an item of fewer words is one seed
SHAPES = ((1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 1, 1))  # steps from word to word of a seed: one word of five may be another
SPAN = 5  # words from a seed's first to its last, at most
CHANCE = 1e-8  # a seed is rare if chance alone should bring it at a smaller share of places, from the frequencies of its words
LEAST_SEEDS = 16  # seeds that an item keeps even if they are not rare, the rarest
FILTER_BITS = 24  # seeds are looked up in a table of 2**FILTER_BITS bits (2 MB, sent to every task) before the join
PROBES = (0, FILTER_BITS)  # a hash fills the bits that its digits from these on name
MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5  # part of the item's own score from which an alignment is a leak

def shapes(n_words: int) -> tuple[tuple[int, ...], ...]:
    """The shapes of an item's seeds: SHAPES, or for fewer than SEED_WORDS words the whole item."""
    return SHAPES if n_words >= SEED_WORDS else ((1,) * (n_words - 1),) if n_words else ()


def seeds(words: np.ndarray, wanted: tuple[tuple[int, ...], ...]) -> list[np.ndarray]:
    """For each shape the hashes of its seeds, by the place of their first word.

    A hash is that of the seed's words in order, whatever the gap: so a text that lost a word still has a seed in common.
    """
    return [grams(words, *steps) for steps in wanted]


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and start and end of its words in the passage.

    A row of the table at a time; a gap along the row is a running maximum. Each cell also carries the place where its
    alignment starts.
    """
    n = len(passage)
    at = np.arange(n + 1)
    # score and start in one number: of equal scores the later start wins, which is the shorter span
    width = n + 2
    above = np.zeros(n + 1, np.int64) * width + at
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        score = np.empty(n + 1, np.int64)
        score[0] = 0
        score[1:] = np.maximum(above[:-1] + step * width, above[1:] + GAP * width)
        score = np.maximum(score, at)  # an empty alignment that starts here
        score = np.maximum.accumulate(score - GAP * width * at) + GAP * width * at
        score = np.maximum(score, at)
        end = int(np.argmax(score // width))
        if score[end] // width > best[0]:
            best = (int(score[end] // width), int(score[end] % width), end)
        above = score
    return best


def passages_schema() -> str:
    return "doc_id long, key string, part int, start int, words string, place array<int>, seed array<long>"


def find_passages(docs: DataFrame, sent: Broadcast, margin: int, wanted: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Passages of texts around words whose seed of a wanted shape passes the filter, ``margin`` words more on either side.

    Passages that touch are one. ``place`` and ``seed`` are the seeds' places in the passage and hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            rows = []
            texts = batch.column(2).to_pylist()
            for doc_id, key, text, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, hashed_words(texts)):
                found = seeds(words, wanted)
                passed = [np.flatnonzero(passes(filled, h)) for h in found]
                at, own = np.concatenate(passed), np.concatenate([h[p] for h, p in zip(found, passed)])
                if not len(at):
                    continue
                tokens = split(text)
                turn = np.argsort(at, kind="stable")
                at, own = at[turn], own[turn]
                breaks = np.flatnonzero(np.diff(at) > 2 * margin + SPAN) + 1
                for part, group in enumerate(np.split(np.arange(len(at)), breaks)):
                    start, end = max(int(at[group[0]]) - margin, 0), int(at[group[-1]]) + SPAN + margin
                    rows.append((doc_id, key, part, start, " ".join(tokens[start:end]), at[group] - start, own[group].view(np.int64)))
            names = ["doc_id", "key", "part", "start", "words", "place", "seed"]
            types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.mapInArrow(run, passages_schema())


def word_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``word, n``: how often the words (hashes) of ``wanted`` occur in all texts, and the number of all words at word 0.

    A task counts the words that pass the filter and sends sums; the join keeps the words that are wanted.
    """
    sent = filter_of(wanted, "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            total, parts = 0, []
            for words in hashed_words(batch.column(0).to_pylist()):
                total += len(words)
                parts.append(words[passes(filled, words)])
            words, n = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(words.view(np.int64), 0)), pa.array(np.append(n, total))], names=["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.join(wanted.select("word").union(docs.sparkSession.range(1).select(F.col("id").alias("word"))).distinct(), "word")


def filter_of(hashes: DataFrame, column: str) -> Broadcast:
    """The filter that the hashes fill: 2**FILTER_BITS bits, whatever their number. Words of 64 bits come to the driver."""
    probes = F.array(*[F.shiftrightunsigned(column, p).bitwiseAND((1 << FILTER_BITS) - 1).cast("int") for p in PROBES])
    words = hashes.select(F.explode(probes).alias("probe")).groupBy(F.shiftright("probe", 6).alias("word"))
    filled = words.agg(F.bit_or(F.expr("shiftleft(1L, probe & 63)")).alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bits[filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    packed = np.packbits(np.unpackbits(bits.view(np.uint8), bitorder="little"))
    return hashes.sparkSession.sparkContext.broadcast(packed)


def passes(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << FILTER_BITS) - 1)
    first, *rest = (filled[((hashes >> np.uint64(p)) & low).astype(np.int64)] for p in PROBES)
    for more in rest:
        first &= more
    return first


def item_seeds(items: DataFrame) -> DataFrame:
    """``item_id, item, n_words, seed, shape, place, words``: the seeds of each item, with the hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, items, texts = (c.to_pylist() for c in batch.columns)
            for item_id, item, words in zip(ids, items, hashed_words(texts)):
                wanted = shapes(len(words))
                for shape, (steps, found) in enumerate(zip(wanted, seeds(words, wanted))):
                    at = np.cumsum((0, *steps))
                    rows += [(item_id, item, len(words), h, shape, i, words[i + at].view(np.int64)) for i, h in enumerate(found.view(np.int64))]
            names = ["item_id", "item", "n_words", "seed", "shape", "place", "words"]
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return items.mapInArrow(run, "item_id long, item string, n_words int, seed long, shape int, place int, words array<long>")


def rare_seeds(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, item, n_words, seed``: the seeds of each item that chance alone should bring at less than CHANCE of all places.

    The chance is the product of the word frequencies, which are shares of the corpus: so an item keeps the same seeds
    however often the corpus is repeated, also one that leaked into many documents. An item keeps its LEAST_SEEDS rarest
    seeds at any rate.
    """
    own = stage(item_seeds(items), "item-seeds")
    known = stage(word_counts(docs, own.select(F.explode("words").alias("word")).distinct()), "word-counts")
    total = known.filter("word = 0").agg(F.max("n")).first()[0] or 1
    spread = own.select("item_id", "item", "n_words", "seed", "shape", "place", F.posexplode("words").alias("i", "word"))
    rated = spread.join(known.filter("word <> 0"), "word", "left")
    log = F.log(F.coalesce("n", F.lit(1)).cast("double") / float(total))
    rated = rated.groupBy("item_id", "item", "n_words", "seed", "shape", "place").agg(F.sum(log).alias("chance"))
    ranked = rated.groupBy("item_id", "item", "n_words").agg(F.sort_array(F.collect_list(F.struct("chance", "place", "shape", "seed"))).alias("seeds"))
    chosen = F.filter("seeds", lambda s, i: (i < LEAST_SEEDS) | (s["chance"] < math.log(CHANCE)))
    return ranked.select("item_id", "item", "n_words", F.explode(F.transform(chosen, lambda s: s["seed"])).alias("seed")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item: str = "text", score: float = SCORE) -> DataFrame:
    """``doc_id, key, item_id, score, start_word, end_word``: documents that hold a benchmark item, whole or edited.

    Words are runs of other characters than ASCII white space; case and punctuation around them do not count. Equality on a rare seed joins passages to items, and each pair that shares one is aligned; ``score`` is the best
    alignment's score over that of the item with itself, the span is its words in the document (the end exclusive).
    One row per document row's id and text (``key``) and item, repeated rows once. Null or empty texts and items without
    words match nothing; null ids are kept as they are.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.md5(item).alias("item"), F.col(item).alias("text")).filter("text IS NOT NULL").distinct()
    items = stage(items, "items")
    rare = stage(rare_seeds(texts, items), "rare-seeds")
    margin = rare.agg(F.max("n_words")).first()[0] or 0
    short = [r.n_words for r in rare.filter(F.col("n_words") < SEED_WORDS).select("n_words").distinct().collect()]
    wanted = (*SHAPES, *(shapes(n)[0] for n in sorted(short)))
    passages = stage(find_passages(texts, filter_of(rare, "seed"), margin, wanted), "passages")
    hits = passages.select("doc_id", "key", "part", F.explode(F.array_distinct("seed")).alias("seed"))
    pairs = hits.join(rare.select("seed", "item_id", "item"), "seed").select("doc_id", "key", "part", "item_id", "item").distinct()
    pairs = stage(pairs, "pairs")
    named = passages.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("part").alias("_part"), "start", "words").dropDuplicates(["_key", "_part"])
    at = (F.col("key") == F.col("_key")) & (F.col("part") == F.col("_part"))
    aligned = pairs.join(named, at).select("doc_id", "key", "item_id", "item", "start", "words")
    wanted = items.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), F.col("text").alias("item_text"))
    aligned = aligned.join(wanted, F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item") == F.col("_item")))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for start, own, passage in zip(batch["start"], hashed_words(batch["item_text"]), hashed_words(batch["words"])):
                best, first, last = smith_waterman(own, passage)
                rows.append((best / (MATCH * len(own)), start + first, start + last))
            yield batch[["doc_id", "key", "item_id"]].assign(**dict(zip(("score", "start_word", "end_word"), np.array(rows).T if rows else [[], [], []])))

    columns = aligned.select("doc_id", "key", "item_id", "start", "words", "item_text")
    scored = columns.mapInPandas(align, "doc_id long, key string, item_id long, score double, start_word long, end_word long")
    best = F.max(F.struct("score", (-F.col("start_word")).alias("earlier"), "end_word")).alias("best")
    found = scored.filter(F.col("score") >= score).groupBy("doc_id", "key", "item_id").agg(best)
    return found.select("doc_id", "key", "item_id", "best.score", (-F.col("best.earlier")).alias("start_word"), F.col("best.end_word").alias("end_word"))


def cleaned(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak; columns as they are, whatever their names."""
    found = stage(leaks(docs, benchmark, doc_id, text).select("key").distinct(), "leaks")
    return unboxed(boxed(docs, own=row_key(doc_id, text)).join(found, F.col("own") == F.col("key"), "left_anti"), docs)
