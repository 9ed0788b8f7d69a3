"""Operators without SQL, and the whole pipeline, against plain versions over all rows and pairs."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import plain
from ledgerloom.llm import decontamination, quality, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    return {name: read(name) for name in ("documents", "labels", "benchmark")}


def uniform(docs):
    """What the quality operator draws for each row, from Spark's hash of its id and text."""
    u = (F.pmod(F.xxhash64("doc_id", "text", F.lit(quality.SEED)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return [r.u for r in docs.select(u.alias("u")).collect()]


def test_toxicity_is_that_of_a_plain_model(tables):
    texts = {r.doc_id: r.text for r in tables["documents"].collect()}
    turns = {r.doc_id: r.turn for r in tables["documents"].select("doc_id", F.xxhash64("doc_id", F.lit(toxicity.SEED + 1)).alias("turn")).collect()}
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    labels = {r.doc_id: r.toxic for r in tables["labels"].collect() if not out(r.doc_id)}
    examples = [(texts[i] or "", labels[i]) for i in sorted(labels, key=lambda i: turns[i]) if i in texts]
    ids = sorted(texts)
    expected = dict(zip(ids, plain.toxicity_scores([texts[i] or "" for i in ids], examples)))
    for r in toxicity.judge(tables["documents"], tables["labels"]).collect():
        assert math.isclose(r.score, expected[r.doc_id], abs_tol=1e-9) and r.held_out == out(r.doc_id) and r.predicted == (r.score >= 0.5)


def test_quality_is_that_of_plain_models(tables):
    docs = tables["documents"].orderBy("doc_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels = {r.doc_id: r.quality for r in tables["labels"].collect()}
    weights, kept = plain.quality_kept(rows, labels, uniform(docs))
    found = {r.doc_id: r for r in quality.resample(docs, tables["labels"].select("doc_id", F.col("quality").alias("label"))).collect()}
    for (i, _), weight, keep in zip(rows, weights, kept):
        assert math.isclose(found[i].log_weight, weight, rel_tol=1e-9, abs_tol=1e-6) and found[i].kept == keep
    assert 0 < sum(kept) < len(rows)


def edited(rng, words, share):
    return [w if rng.random() >= share else f"e{rng.randrange(10**6)}" for w in words]


def leaky(seed):
    """Documents, some with an item of which a tenth to three tenths of the words are replaced, and items of 2 to 40 words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([4, 8, 15, 20, 40])))) for i in range(24)] + [(30, "rare1 rare2"), (31, "rare3"), (32, ""), (33, None), (34, "Rare4, rare5 rare6!")]
    docs = []
    for i in range(240):
        words = rng.choices(vocabulary, k=rng.randrange(20, 80))
        item = rng.choice(items)[1]
        if i % 3 and item:
            own = item.split()
            own = edited(rng, own, rng.choice([0, 0.1, 0.2, 0.3])) if len(own) > 4 else own
            if rng.random() < 0.3:
                del own[rng.randrange(len(own))]
            words[10:10] = own
        docs.append((i, " ".join(words)))
    return docs, items


def test_leaks_are_those_of_all_alignments(spark):
    caught = wanted = long_missed = 0
    for seed in (1, 2):
        docs, items = leaky(seed)
        expected = plain.leaks(docs, items)
        found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        got = {(r.doc_id, r.item_id): r.score for r in found.collect()}
        assert set(got) <= set(expected) and all(math.isclose(s, expected[p]) for p, s in got.items())
        caught, wanted = caught + len(got), wanted + len(expected)
        n_words = {i: len(plain.bare(t)) for i, t in items}
        long_missed += sum(n_words[i] >= 15 for _, i in set(expected) - set(got))
    # what is missed are pairs that share two or three words of an item of two to eight
    assert wanted > 150 and caught >= 0.9 * wanted and not long_missed


def test_rare_seeds_do_not_change_with_a_repeated_corpus(spark):
    docs, items = leaky(3)
    texts = spark.createDataFrame(docs, "doc_id long, text string").select("text")
    own = spark.createDataFrame(items, "item_id long, text string").where("text is not null").select("item_id", F.md5("text").alias("item"), "text")
    ten = texts.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10)))).select("text")
    chosen = lambda t: sorted(map(tuple, decontamination.rare_seeds(t, own).collect()))
    assert chosen(texts) == chosen(ten)


def test_pipeline_is_that_of_plain_stages(spark, tables):
    docs = tables["documents"].orderBy("doc_id")
    rows = [r.asDict() for r in docs.collect()]
    labels = {r.doc_id: r.quality for r in tables["labels"].collect()}
    _, kept = plain.quality_kept([(r["doc_id"], r["text"]) for r in rows], labels, uniform(docs))
    rows = [r for r, keep in zip(rows, kept) if keep]
    stay = plain.one_of_each([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if r["doc_id"] in stay]
    leaked = {d for d, _ in plain.leaks([(r["doc_id"], r["text"]) for r in rows], [(r.item_id, r.text) for r in tables["benchmark"].collect()])}
    rows = [r for r in rows if r["doc_id"] not in leaked]
    for r in rows:
        new = plain.masked(r["text"])
        r.update(text=new, n_chars=len(new) if new != r["text"] else r["n_chars"])
    expected = []
    for i, (copies, size, source_size, target) in plain.mix([(r["doc_id"], r["text"], r["source"]) for r in rows]).items():
        expected += [(*rows[i].values(), size, source_size, target, n) for n in range(1, copies + 1)]
    mixed = pipeline.run(spark, FOLDER)
    assert mixed.columns == [*docs.columns, "size", "source_size", "target", "copy"]
    found = sorted(map(tuple, mixed.collect()), key=repr)
    expected.sort(key=repr)
    assert [r[:7] + r[8:] for r in found] == [r[:7] + r[8:] for r in expected]
    assert all(math.isclose(a[7], b[7]) for a, b in zip(found, expected))
    assert leaked and len(stay) < sum(kept) < len(kept)
