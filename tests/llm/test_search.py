"""Ranked search against plain Python over all documents and items."""

import math
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from ledgerloom.llm import search

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=20):
    """``item_id, text, rank, doc_id, score`` of (id, text) rows."""
    held = [(i, Counter(own), len(own)) for i, text in docs if (own := terms(text))]
    n_docs, words = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, own, _ in held for t in own)
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        scores = []
        for doc_id, own, n in held:
            m = 100 - 25 + (25 * n * n_docs) // words
            score = 0
            for t, times in Counter(terms(text)).items():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * weight * ((1_000_000_000 * own[t]) // (1000 * own[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, text, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def ran(spark, docs, items, **options):
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS body", "2 AS item", "3 AS score", "4 AS part")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS terms", "2 AS bytes", "3 AS item", "4 AS part")
    found = search.ranked(a, b, **options)
    texts = {(r.item_id, r.item): None for r in found.select("item_id", "item").distinct().collect()}
    for i, t in items:
        import hashlib

        if t is not None and (key := (i, hashlib.md5(t.encode()).hexdigest())) in texts:
            texts[key] = t
    return sorted(((r.item_id, texts[r.item_id, r.item], r.rank, r.doc_id, r.score) for r in found.collect()), key=repr)


def rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "中文", "ÄB", "x\xa0y", "A1b", "Ω"]
    gaps = [" ", "  ", "\n", "-", "_", "\x00", ".", "\x7f", "' "]
    made = lambda n: "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(n))
    docs = [(i * 7 % 101, made(rng.randrange(40))) for i in range(100)] + [(3, None), (4, ""), (5, " - "), (None, made(30)), (None, made(20)), (9, "w1 W1 w1"), (9, "w1 W1 w1")]
    docs += [(200, made(20_000)), (201, "w2" * 100_000), (202, "w5 " * 50_000)]
    items = [(i, made(rng.randrange(1, 12))) for i in range(30)] + [(1, "W1"), (1, "W1"), (31, None), (32, ""), (33, "--"), (None, "w1 é"), (34, "nowhere"), (35, "w3 " * 4000), (36, "w2" * 100_000)]
    return docs, items


@pytest.mark.parametrize("bounds", [{}, {"GROUP_BYTES": 100}, {"GROUP_ITEMS": 3}, {"CELLS": 1}])
def test_ranks_are_those_of_all_pairs(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(search, name, value)
    docs, items = rows(12)
    if "GROUP_BYTES" in bounds:
        items = items[:12]
    top = 5 if bounds else 20
    expected = [r for r in plain(docs, items, top) if r[1] is not None]
    assert expected and ran(spark, docs, items, top=top) == expected


def test_empty_tables(spark):
    docs, items = rows(13)
    assert ran(spark, [], items) == [] and ran(spark, docs, []) == [] and ran(spark, [(1, None)], items) == []


def test_query_is_whole(spark):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*c).collect()]
    expected = plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    found = entry.queries()["op12_ranked_search"](spark, FOLDER).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in found) == sorted((i, rank, d, s) for i, _, rank, d, s in expected)
