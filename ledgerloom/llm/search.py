"""Ranked lexical search of a table of items over all documents, without an index of the documents.

All items' terms make one Aho-Corasick automaton, each between two guards so that only whole terms match. A first scan of
the texts counts the documents that hold each term, a second one scores every document for the items that its terms
lead to and keeps the best of each item per task; only these are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GUARD = b" "
#: Bytes of UTF-8 text as the automaton reads them: lower-case letters, digits and bytes above ASCII, guards between.
FOLDED = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else GUARD[0] for b in range(256))
TOP = 20
GROUP_BYTES = 1 << 22  # bytes of terms of the items that share an automaton, which every task builds
GROUP_ITEMS = 4096  # and so many items
CELLS = 1 << 18  # scores of documents for items that a task holds at once
FLOOR = 75  # 100 - 25: the part of a document's m that does not depend on its length
NO_TERM, ALL_TERMS = -1, -2  # numbers that stand for documents with terms and for their terms, in the counts of the first scan


@dataclass
class Plan:
    """What tasks need of a group of items: the terms, and for each the items that hold it and how often."""

    terms: list[bytes]
    start: np.ndarray  # of the term's items in the two next ones
    item: np.ndarray
    times: np.ndarray
    names: list[tuple[int | None, str]]  # id and digest of each item

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word((GUARD + term + GUARD).decode("latin-1"), number)
        made.make_automaton()
        return made


def plan(rows: list) -> Plan:
    """From the rows (``item_id, item, terms``) of one group."""
    held = [Counter(t.encode() for t in r.terms) for r in rows]
    terms = sorted(set().union(*held))
    number = {t: i for i, t in enumerate(terms)}
    found = sorted((number[t], i, n) for i, own in enumerate(held) for t, n in own.items())
    term, item, times = (np.array(c, np.int64) for c in zip(*found))
    return Plan(terms, np.searchsorted(term, np.arange(len(terms) + 1)), item, times, [(r.item_id, r.item) for r in rows])


def counted(automaton: ahocorasick.Automaton, body: bytes) -> tuple[int, Counter]:
    """Number of all terms of a text in UTF-8, and how often it has each term of the automaton."""
    text = body.translate(FOLDED)
    inside = np.frombuffer(GUARD + text, np.uint8) != GUARD[0]
    n = int(np.count_nonzero(inside[1:] & ~inside[:-1]))
    return n, Counter(map(itemgetter(1), automaton.iter((GUARD + text + GUARD).decode("latin-1"))))


_automata: dict[int, ahocorasick.Automaton] = {}  # of this Python worker


def automaton_of(sent) -> ahocorasick.Automaton:
    if sent.value is not _automata.get("plan"):
        _automata.update(plan=sent.value, made=sent.value.automaton())
    return _automata["made"]


def statistics(texts: DataFrame, sent) -> dict[int, int]:
    """Documents that hold each term by the term's number, and under two numbers below zero the corpus's own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, df = automaton_of(sent), np.zeros(len(sent.value.terms) + 2, np.int64)  # the last two by negative index
        for batch in batches:
            for body in batch.column(0).to_pylist():
                n, found = counted(automaton, body)
                df[list(found)] += 1
                df[NO_TERM] += n > 0
                df[ALL_TERMS] += n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at < len(df) - 2, at, at - len(df)).astype(np.int32)), pa.array(df[at])], names=["term", "n"])

    return {r.term: r.n for r in texts.select("body").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}


class Best:
    """The best documents of each item so far: scores, then ascending ids, null ids last."""

    def __init__(self, items: int, top: int) -> None:
        self.items, self.top, self.least = items, top, np.ones(items, np.int64)
        self.item = self.score = self.id = np.empty(0, np.int64)
        self.none = np.empty(0, bool)

    def add(self, item: np.ndarray, score: np.ndarray, id_: np.ndarray, none: np.ndarray) -> None:
        item, score, id_, none = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.id, id_), (self.none, none)))
        turn = np.lexsort((id_, none, -score, item))
        first = np.searchsorted(item[turn], np.arange(self.items + 1))
        turn = turn[np.arange(len(turn)) - np.repeat(first[:-1], np.diff(first)) < self.top]
        self.item, self.score, self.id, self.none = item[turn], score[turn], id_[turn], none[turn]
        sizes = np.bincount(self.item, minlength=self.items)
        full = np.flatnonzero(sizes >= self.top)
        self.least[full] = self.score[np.cumsum(sizes)[full] - 1]


def scored(texts: DataFrame, sent, counts: dict[int, int], top: int) -> DataFrame:
    """``item_id, item, doc_id, score``: of each task the best documents of each item."""
    documents, words = counts.get(NO_TERM, 0), max(counts.get(ALL_TERMS, 0), 1)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(sent.value.terms))], np.int64)
    weighed = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, own, weight = automaton_of(sent), sent.value, weighed.value
        items, width = len(own.names), np.diff(own.start)
        best = Best(items, top)
        held: list[tuple[int | None, int, np.ndarray, np.ndarray]] = []  # id, m, terms, their counts
        spread = 0

        def flush() -> None:
            ids, m, found, times = zip(*held)
            doc = np.repeat(np.arange(len(held)), [len(f) for f in found])
            term, tf = np.concatenate(found), np.concatenate(times)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.array(m, np.int64)[doc]))
            # each term of a document leads to its items
            n = width[term]
            at = np.arange(n.sum()) + np.repeat(own.start[term] - (np.cumsum(n) - n), n)
            score = np.zeros(len(held) * items, np.int64)
            np.add.at(score, np.repeat(doc, n) * items + own.item[at], np.repeat(part, n) * own.times[at])
            score = score.reshape(len(held), items)
            doc, item = np.nonzero(score >= best.least)
            none = np.array([i is None for i in ids])[doc]
            best.add(item, score[doc, item], np.array([i or 0 for i in ids], np.int64)[doc], none)
            held.clear()

        for batch in batches:
            for id_, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, found = counted(automaton, body)
                if found:
                    term = np.fromiter(found, np.int64, len(found))
                    held.append((id_, FLOOR + (25 * n * documents) // words, term, np.fromiter(found.values(), np.int64, len(found))))
                    spread += int(width[term].sum())
                if len(held) * items >= CELLS or spread >= CELLS:
                    flush()
                    spread = 0
        if held:
            flush()
        ids, digests = ([own.names[i][k] for i in best.item] for k in (0, 1))
        docs = pa.array(best.id, mask=best.none)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string()), docs, pa.array(best.score)], names=["item_id", "item", "doc_id", "score"])

    return texts.select("doc_id", "body").mapInArrow(run, "item_id long, item string, doc_id long, score long")


def grouped(items: DataFrame) -> DataFrame:
    """Adds ``part``: items of a part have GROUP_BYTES of terms and GROUP_ITEMS at most, but for an item that is larger alone.

    The number of parts is doubled until the largest keeps the bounds.
    """
    large = F.col("bytes") > GROUP_BYTES // 2
    total = items.filter(~large).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    parts = max(1, math.ceil((total["bytes"] or 0) / GROUP_BYTES), math.ceil(total["n"] / GROUP_ITEMS))
    while True:
        dealt = items.withColumn("part", F.when(large, F.concat(F.lit("i"), "item", F.coalesce(F.col("item_id").cast("string"), F.lit("")))).otherwise(F.pmod(F.xxhash64("item_id", "item"), F.lit(parts)).cast("string")))
        largest = dealt.filter(~large).groupBy("part").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).agg(F.max("bytes").alias("bytes"), F.max("n").alias("n")).first()
        if (largest["bytes"] or 0) <= GROUP_BYTES and (largest["n"] or 0) <= GROUP_ITEMS:
            return dealt
        parts *= 2


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item: str = "text", top: int = TOP) -> DataFrame:
    """``item_id, item, rank, doc_id, score``: for each item the ``top`` documents of highest score above 0.

    Terms are maximal runs of ASCII letters, digits and all characters above ASCII, A-Z in lower case. Equal scores rank by
    ascending id, null ids last. ``item`` is the MD5 of the item's text: rows of items that agree in id and text are one
    item, other texts of one id are items of their own. Null and empty texts have no terms: such a document counts
    nowhere and such an item has no rows. Repeated documents each count and rank.

    Items are cut into parts of bounded size, and each part takes two scans of the texts; a part's terms and counts are
    broadcast. A task holds CELLS scores, and sends ``top`` rows an item.
    """
    terms = F.regexp_extract_all(F.translate(F.col(item), UPPER, LOWER), F.lit(TERM), F.lit(0))
    known = items.filter(F.col(item).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.md5(F.col(item).cast("binary")).alias("item"), terms.alias("terms"))
    known = known.filter(F.size("terms") > 0).dropDuplicates(["item_id", "item"])
    known = stage(known.withColumn("bytes", F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t))")), "items")
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    dealt = grouped(known)
    found = texts.sparkSession.createDataFrame([], "item_id long, item string, doc_id long, score long")
    for part in [r.part for r in dealt.select("part").distinct().toLocalIterator()]:
        sent = docs.sparkSession.sparkContext.broadcast(plan(dealt.filter(F.col("part") == part).select("item_id", "item", "terms").collect()))
        found = found.union(scored(texts, sent, statistics(texts, sent), top))
    order = Window.partitionBy("item_id", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "item", "rank", "doc_id", "score")
