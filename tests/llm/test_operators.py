"""The operators against plain versions of themselves, and on odd rows and empty tables."""

import base64
import gzip
import hashlib
import math
import random
import re
import tempfile
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, embeddings, induced, mixing, quality, secrets, simhash, suffix_dedup, toxicity, url_filter, warc
from ledgerloom.llm.components import connected


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 160)}}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# WARC


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 40_000  # more than one segment, cut inside characters
    pages = [(1, "http://a/", big), (2, "http://b/", "x"), (3, None, big), (4, "http://d/", None), (None, "u", "x"), (5, "http://e/", big + "!"), (5, "http://e/", big + "!")]
    path = str(tmp_path / "warc")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    sha = lambda t: warc.base32(hashlib.sha1((t or "").encode()).hexdigest())
    got = sorted(map(tuple, warc.resolved(spark, path).collect()), key=str)
    expected = [(1, big, "revisit", 3), (2, "x", "response", None), (3, big, "response", None), (4, "", "response", None), (None, "x", "revisit", 2)] + 2 * [(5, big + "!", "response", None)]
    assert got == sorted(((i, len(t.encode()), sha(t), kind, to, True) for i, t, kind, to in expected), key=str)
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.pages(spark, path).where("record_type = 'response'").collect()}
    assert payloads == {2: "x", 3: big, 4: "", 5: big + "!"}


def test_warc_segments_that_do_not_fit(spark):
    rows = [
        ("response", "a", None, 1, None, b"12"), ("continuation", "a2", "a", 2, 4, b"34"),
        ("response", "b", None, 1, None, b"12"), ("continuation", "b3", "b", 3, 4, b"34"),  # a number is missing
        ("response", "c", None, 1, None, b"12"), ("continuation", "c2", "c", 2, 5, b"34"),  # another total
        ("continuation", "d2", "d", 2, 2, b"34"),  # no first segment
    ]
    parts = spark.createDataFrame(rows, "type string, record_id string, origin string, segment long, total long, block binary")
    parts = parts.withColumns({c: F.lit(None).cast("string") for c in ("refers", "uri", "digest")})
    got = {r.record_id: (r.complete, r.block and bytes(r.block)) for r in warc.joined_segments(parts).collect()}
    assert got == {"a": (True, b"1234"), "b": (False, None), "c": (False, None), "d": (False, None)}


def test_chunked_coding():
    assert warc.dechunked(b"3;x=1\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    assert warc.dechunked(b"3\r\nab") is None and warc.dechunked(b"") is None
    assert warc.dechunked(warc.chunked(b"x" * 10_001, 1000)) == b"x" * 10_001


# Mixing


def test_targets_are_capped_and_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 2000), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30.0 and got[None] == 150.0  # both stop at three times their size
    assert math.isclose(got["b"], 2880 * 2 / 3) and math.isclose(got["c"], 2880 / 3)


def test_mix_takes_near_the_target(spark, documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice("abbbbbbc")) for i in range(3000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert mixed.where("taken > 3 * size OR taken <> copies * size").count() == 0
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect():
        assert abs(r.t - r.target) < 130
    odd = mixing.mix(documents)
    assert odd.count() == documents.count() and odd.where("doc_id = 3").first().size == 0
    assert mixing.mix(documents.limit(0)).count() == 0


# Toxicity and quality


def test_toxicity_learns_a_word(spark, documents):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(vocabulary, k=30)
        toxic = int(i % 3 == 0)
        words[5:5] = ["moron"] if toxic else []
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(documents.select(F.col("doc_id") + 10_000, "text"))
    judged = toxicity.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in judged if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(judged) == 910 and len(held) > 100
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.98 * len(held)
    none = toxicity.judge(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.where("score <> 0.5").count() == 0


def test_quality_keeps_good_and_rejects_junk(spark, documents):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(w + (rng.choice(["###", "|"]) if i % 5 == 0 else "") for w in rng.choices(vocabulary, k=60))) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)], "doc_id long, label int")
    found = quality.resample(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    assert all(r.kept == (r.doc_id % 5 > 0) for r in found)
    assert quality.resample(documents, labels.limit(0)).where("kept").count() == documents.count()
    assert quality.resample(documents.limit(0), labels).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 999, 1000, 1001])
def test_kth_is_exact(spark, k):
    values = [random.Random(4).gauss(0, 1e6) for _ in range(500)] + [random.Random(5).random() for _ in range(500)]
    expected = sorted(values, reverse=True)[k - 1] if k <= 1000 else None
    assert quality.kth(spark.createDataFrame([(v,) for v in values], "key double"), k) == expected


# Decontamination


def test_leaks_whole_and_edited(spark, documents):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(5)] + [None, ""]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, k=100)
        if i < 10:
            item = items[i % 5].split()
            if i >= 5:  # every eighth word replaced, one dropped
                item = [w if j % 8 else "other" for j, w in enumerate(item)][:-1]
            words[50:50] = item
        rows.append((i, " ".join(words)))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.leaks(docs, benchmark).collect()}
    assert set(found) == {(i, i % 5) for i in range(10)}
    assert all((r.score == 1.0 and (r.start_word, r.end_word) == (50, 90)) == (i < 5) for (i, _), r in found.items())
    assert decontamination.cleaned(docs, benchmark).count() == 50
    assert decontamination.cleaned(documents, benchmark).columns == documents.columns
    assert decontamination.cleaned(documents, benchmark).count() == documents.count()
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0 and decontamination.leaks(docs.limit(0), benchmark).count() == 0


def test_smith_waterman_against_a_plain_table():
    rng = random.Random(7)
    for _ in range(60):
        a, b = (np.array([rng.randrange(4) for _ in range(rng.randrange(1, 14))], np.uint64) for _ in range(2))
        table, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
        for i in range(len(a)):
            for j in range(len(b)):
                step = decontamination.MATCH if a[i] == b[j] else decontamination.MISMATCH
                table[i + 1, j + 1] = max(0, table[i, j] + step, table[i, j + 1] + decontamination.GAP, table[i + 1, j] + decontamination.GAP)
                best = max(best, table[i + 1, j + 1])
        assert decontamination.smith_waterman(a, b)[0] == best


# Secrets

PLAIN = {"assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def base_spans(text):
    found = []
    for n, (kind, shape) in enumerate(PLAIN.items()):
        for m in re.finditer(shape, text):
            value = m.group(1) if kind == "assign" else m.group()
            if len(value) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def test_secret_spans(spark, documents):
    rng = random.Random(8)
    bits = ["token=abc", "é", " ", "secret: token:abcdefgh", "AKIA", "ABCDEFGHIJKLMNOP0", "0123456789abcdef", "\n", "PassWord='", "hunter2hunter2", "api_key=", "x" * 5, "token=token=abcdefg"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 25))) for _ in range(300)] + ["token=abcdef " * 300, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    scanned = secrets.scan(df).select("doc_id", secrets.listed(F.filter("secrets", lambda s: s["kind_no"] < 3)).alias("base")).collect()
    assert all(r.base == base_spans(texts[r.doc_id] or "") for r in scanned)
    assert secrets.scan(documents).count() == documents.count() and secrets.scan(documents.limit(0)).count() == 0


def test_entropy_spans_and_masks(spark):
    key, words = "q8Zr2LmXv0Kt7Wn4YbGd", "internationalizationandmore"
    text = f"a {key} b {words} 123e4567-e89b-12d3-a456-426614174000 c token={key}"
    df = secrets.scan(spark.createDataFrame([(text,)], "text string"))
    assert df.select(secrets.listed(F.col("secrets"))).first()[0] == f"entropy:2:22,assign:{text.index('token')}:{len(text)}"
    assert df.select(secrets.masked("text")).first()[0] == f"a [SECRET] b {words} 123e4567-e89b-12d3-a456-426614174000 c [SECRET]"
    counts = [key.count(c) for c in set(key)]
    exact = -sum(c / 20 * math.log2(c / 20) for c in counts)
    assert math.isclose(spark.range(1).select(F.expr(secrets.entropy(f"'{key}'"))).first()[0], exact)


# URLs


def test_url_rules(spark):
    urls = ["http://a.net/x", "https://B.example.NET/en/1", "http://example.net/EN/", "http://x.example.com/de/", "http://q.org/fr/?a", "http://q.org/de/", "http://net", None, "no scheme", "http://ads.shop.io/", "http://shop.io/cart/1", "http://a.io/f.zip"]
    judged = url_filter.judge(spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string"), url_filter.rules(spark))
    got = {r.page_id: (r.host, r.path, r.rule if r.priority == 1 else None, r.verdict) for r in judged.collect()}
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2][2:] == ("net/", "block") and got[3][2:] == ("example.com/de/", "block") and got[4][2:] == ("org/fr/", "allow")
    assert got[5][2:] == (None, "allow") and got[6] == ("net", "", None, "allow") and got[7] == got[8] == ("", "", None, "allow")
    assert [got[i][3] for i in (9, 10, 11)] == ["block"] * 3


def test_literals_are_whole_tokens(spark):
    patterns = {"||net/": ["net"], "/ad": [], "/ad/": ["ad"], "||ads.*^": ["ads"], "foo": [], "/a/*/b/": ["a", "b"], ".zip|": ["zip"]}
    df = spark.createDataFrame([(p,) for p in patterns], "p string")
    assert {r.p: r.l for r in df.select("p", url_filter.literals(F.col("p")).alias("l")).collect()} == patterns


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(documents):
    for text in ("", " \n", "A b", "ÄÖ ü A b c d e f", "x " * 700):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_links_are_all_pairs_within_the_distance(spark):
    rng = random.Random(9)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(6):
            values.add(base)
            for _ in range(rng.randrange(1, 4)):
                base ^= 1 << rng.randrange(64)
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    got = sorted(map(tuple, simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()))
    assert got == sorted((a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_spanning_links_keep_all_components(spark):
    rng = random.Random(11)
    values = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(12):  # families wider than the distance, so that a crowd's centre does not reach all
        base = rng.getrandbits(64)
        for _ in range(25):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))))
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long").cache()
    full = {(r.a, r.b) for r in simhash.links(fps).collect()}
    expected = sorted(map(tuple, connected(simhash.links(fps)).collect()))
    for crowd in (1, 3, 10_000):
        some = [tuple(r) for r in simhash.spanning(fps, crowd=crowd).collect()]
        assert len(some) == len(set(some)) and set(some) <= full
        assert crowd < 10_000 or set(some) == full
        assert sorted(map(tuple, connected(simhash.spanning(fps, crowd=crowd)).collect())) == expected


def test_a_crowd_of_near_copies_is_linked_through_centres(spark):
    base = random.Random(12).getrandbits(64)
    pairs = {base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)}  # all within four bits of each other
    fps = spark.createDataFrame([(signed(v),) for v in pairs], "fp long")
    assert len(pairs) == 2017
    found = simhash.spanning(fps).cache()
    assert found.count() <= 64 * len(pairs)  # of 2,033,136 pairs
    assert {r.component for r in connected(found).collect()} == {min(map(signed, pairs))}


def test_simhash_classes_and_one_of_each(spark, documents):
    classes = {(r.doc_id, r.component_id) for r in simhash.classes(documents).collect()}
    assert {(1, 1), (3, 3), (4, 3), (7, 7), (8, 7), (None, None)} <= classes
    kept = simhash.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and {3, 5, 6, 7, None} <= set(ids) and not {4, 8} & set(ids)
    assert simhash.classes(documents.limit(0)).count() == 0


# Embeddings


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_classes(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "CELL", 40)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        v = rows[i - 1][1] if i % 3 and rng.random() < 0.8 else rng.normal(size=6).tolist()
        rows.append((i, [float(x) for x in np.array(v) + (0 if i % 5 == 0 else rng.normal(size=6) * 0.15)], int(rng.integers(2))))
    odd = [(300, None, 1), (301, [0.0] * 6, 1), (302, [math.nan] * 6, 1), (303, rows[0][1], None), (304, [1.0, None], 0), (305, rows[5][1], rows[5][2]), (306, [1.0, 2.0], 0), (307, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    good = [r for r in rows + odd if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows + odd}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93:
                links[a[0]].add(b[0])
    least = {i: i for i in links}
    for _ in links:
        least = {i: min([least[i], *(least[j] for j in links[i])]) for i in links}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.classes(df).collect()}
    assert got == {i: (len(links[i]), least[i], least[i] == i) for i in links}
    assert embeddings.classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 100])
def test_embedding_vectors_are_not_repeated_for_each_cell(spark, monkeypatch, block):
    """Without clusters a vector must be compared in nearly all cells below its own; it is stored once for all of them."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "CELL", 8)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(2400, 32)).astype(np.float32)
    for i in range(0, 2400, 4):  # each is close to one of another number, so chains arise
        vectors[i] = vectors[rng.integers(2400)] + rng.normal(size=32) * 0.15
    labels = rng.integers(2, size=2400)
    df = spark.createDataFrame([(i, v.tolist(), int(x)) for i, (v, x) in enumerate(zip(vectors, labels, strict=True))], "vec_id long, embedding array<float>, label int")
    stored = {}

    def counted(frame, name="stage", plain=embeddings.stage):
        found = plain(frame, name)
        stored[name] = found.count()
        return found

    monkeypatch.setattr(embeddings, "stage", counted)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.classes(df).collect()}
    unit = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :]) & ~np.eye(2400, dtype=bool)
    least = np.arange(2400)
    while (lower := np.minimum(least, np.where(linked, least[None, :], 2400).min(axis=1))).tolist() != least.tolist():
        least = lower
    assert linked.sum() > 500 and got == {i: (int(linked[i].sum()), int(least[i])) for i in range(2400)}
    assert stored["placed"] == 2400 and max(stored.values()) <= 2400


def test_embedding_products_of_two_blocks(monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 7)
    rng = np.random.default_rng(4)
    vectors = embeddings.unit(np.cumsum(rng.normal(size=(60, 3)) * 0.2, axis=0) + 1)  # a walk: long chains
    node, copies = rng.permutation(60).astype(np.int64) * 10, rng.integers(1, 4, 60)
    side = lambda at: (node[at], copies[at], vectors[at])
    first, second = np.arange(0, 60, 2), np.arange(1, 60, 2)
    for left, right in ((np.arange(60), None), (first, second), (first, first[:0]), (first[:0], second)):
        linked = vectors @ vectors.T >= 0.98
        np.fill_diagonal(linked, False)
        if right is not None:
            linked &= np.isin(np.arange(60), left)[:, None] & np.isin(np.arange(60), right)[None, :]
            linked |= linked.T
        least = node.copy()
        for _ in range(60):
            least = np.minimum(least, np.where(linked, least[None, :], 10_000).min(axis=1))
        expected = {(int(node[i]), int(copies[linked[i]].sum()), int(least[i])) for i in np.flatnonzero(linked.any(axis=1))}
        found = embeddings.in_blocks(side(left), None if right is None else side(right), 0.98)
        assert set(zip(*(x.tolist() for x in found), strict=True)) == expected
        assert bool(expected) == bool(len(left) and (right is None or len(right)))


# Suffixes


@pytest.mark.parametrize("seed", range(12))
def test_suffix_order(monkeypatch, seed):
    rng = random.Random(seed)
    if seed % 2:  # tiny batches and queues that go to files
        monkeypatch.setattr(induced, "BATCH", 7)
        monkeypatch.setattr(induced, "HELD", 5)
    limit, letters, n = rng.choice([3, 20]), rng.choice([1, 2, 4]), rng.choice([0, 1, 60, 300])
    text = [rng.randrange(letters) + induced.FIRST for _ in range(n)] + [induced.GAP, induced.END]
    padded = np.array(text + [0] * (limit + induced.PACKED), np.uint16)
    with tempfile.TemporaryDirectory() as folder:
        found = list(induced.suffixes(padded, len(text), limit, folder))
    at = [p for positions, _ in found for p in positions.tolist()]
    common = [c for _, x in found for c in x.tolist()]
    assert sorted(at) == list(range(n + 1))
    assert [text[p : p + limit] for p in at] == sorted((text[p : p + limit] for p in range(n + 1)), reverse=True)
    for i in range(1, len(at)):
        a, b = text[at[i - 1] :], text[at[i] :]
        equal = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[i] == min(equal, limit)


def plain_removed(rows):
    """Per row: bytes, removed bytes, spans and what is left, by a set of all strings before."""
    places: dict[bytes, list[tuple[float, int]]] = {}
    order = [(math.inf if d is None else d, (t or "").encode()) for d, t in rows]
    for d, text in order:
        for p in range(len(text) - 99):
            places.setdefault(text[p : p + 100], []).append((d, p))
    first = {s: min(x) for s, x in places.items()}
    out = []
    for d, text in order:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - 99):
            if first[text[p : p + 100]] < (d, p):
                gone[p : p + 100] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(text), int(gone.sum()), runs, bytes(np.frombuffer(text, np.uint8)[~gone])))
    return out


def test_repeated_strings_are_removed(spark, documents):
    rng = random.Random(10)
    passages = ["".join(rng.choices("abcdé ", k=rng.randrange(90, 400))) for _ in range(8)]
    rows = [(i, "".join(rng.choice([*passages, "".join(rng.choices("xyz ", k=rng.randrange(1, 150)))]) for _ in range(rng.randrange(0, 6)))) for i in range(80)]
    rows += [(200, "ab" * 500), (201, "a" * 700), (202, "a" * 99), (203, None), (None, passages[0]), (None, passages[1]), (5, rows[5][1]), (6, rows[9][1])]
    rng.shuffle(rows)
    rows += [(r.doc_id, r.text) for r in documents.where("doc_id <> 5").collect()]
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(((d, *x) for (d, _), x in zip(rows, plain_removed(rows))), key=key)
    assert suffix_dedup.removed(documents.limit(0)).count() == 0


def test_segments_of_one_hash_never_exceed_a_shard(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", 3000)
    rng, sorted_, largest = random.Random(11), suffix_dedup.shard_repeats, []

    def watched(rows):
        per = rows.where("hash IS NOT NULL").select("hash", "segment").distinct().groupBy("hash").agg(F.sum(F.length("segment")).alias("n"))
        largest.append(per.agg(F.max("n")).first()[0])
        return sorted_(rows)

    monkeypatch.setattr(suffix_dedup, "shard_repeats", watched)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    line, passage = some(80), some(300)
    rows = [(i, some(rng.randrange(150, 200)) + rng.choice([line, passage]) + some(rng.randrange(150, 200))) for i in range(90)]
    rows += [(100, rows[3][1]), (101, rows[4][1]), (4, rows[5][1]), (102, "a" * 9000), (103, "ba" * 3000), (None, passage)]
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert largest[0] is None or largest[0] <= 3000
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(((d, *x) for (d, _), x in zip(rows, plain_removed(rows))), key=key)


# Long values, broken archives, and columns with the operators' own names


def test_archives_with_a_long_url(spark, tmp_path):
    url = "http://a/" + base64.b64encode(np.random.default_rng(1).bytes(3 << 20)).decode()  # does not compress
    pages = [(1, url, "first"), (2, "http://b/", "second"), (3, None, "third" * 300_000)]
    path = str(tmp_path / "warc")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).sortWithinPartitions("page_id"), path)
    got = {r.page_id: (r.uri, bytes(r.payload).decode()) for r in warc.pages(spark, path).collect()}
    assert got == {i: (u, h) for i, u, h in pages}


def test_broken_archives_raise():
    good = warc.record({"WARC-Type": "response"}, b"abc") + warc.END
    assert [b for _, b in warc.parsed(good + b"\r\n" + good)] == [b"abc", b"abc"] and list(warc.parsed(b"\r\n")) == list(warc.parsed(b"")) == []
    for broken in (good[:-8], good + b"WARC/1.1\r\nWARC-Type: x", good + b"other\r\n\r\n", good + b"WARC/1.1\r\nX: y\r\n\r\n", gzip.compress(good)[:-9]):
        with pytest.raises(warc.BrokenArchive):
            list(warc.parsed(broken))


def test_long_candidates(spark):
    n = 1_000_000
    rng = random.Random(14)
    made = lambda letters: "".join(rng.choices(letters, k=n))
    lower, upper, digits = "abcdefghijklnopqrstuvwyz", "ABCDEFGHIJKLNOPQRSTUVWYZ", "0123456789"  # without the words that are allowed
    texts = {
        "path": ("g1h2z3k4x9/" * (n // 11), False), "path, then more": ("g1h2z3k4x9/" * (n // 11) + "Z", False), "no slash": ("g1h2z3k4x9" * (n // 10) + "Z", False),
        "lower": (made(lower), False), "digits": (made(digits), False), "both cases": (made(lower + upper), True), "hex": (made("0123ABCDEF"), True),
        "letters and digits": (made(lower + upper + digits), True), "base64": (made(lower + upper + digits + "+/"), True), "url": (made(lower + upper + digits + "_-"), True),
        "ruler": ("=" * n, False), "ends hot": ("zy1" * (n // 3) + "q8Zr2LmXv0Kt7Wn4YbGd", True), "spans": ('token="abcdef1234567890abcdef" and 9x8y7z6w5v4u3t2s1r0q ' * 15_000, None),
    }
    texts["path, then more"] = (texts["path, then more"][0], secret_of("g1h2z3k4x9/" * 4 + "Z"))
    texts["no slash"] = (texts["no slash"][0], secret_of("g1h2z3k4x9" * 4 + "Z"))
    df = spark.createDataFrame([(k, v) for k, (v, _) in texts.items()], "name string, text string").repartition(8)
    start = time.time()
    found = {r.name: r.n for r in secrets.scan(df).select("name", F.size(F.filter("secrets", lambda s: s["kind_no"] == 3)).alias("n")).collect()}
    assert time.time() - start < 60
    assert {k: found[k] > 0 for k in texts if texts[k][1] is not None} == {k: v for k, (_, v) in texts.items() if v is not None}
    assert found["spans"] == 15_000


def secret_of(value):
    """Whether a candidate is a secret, by the plain version."""
    import plain

    return any(kind == 3 for _, kind, _ in plain.secret_spans(value))


def test_long_words_and_pages(spark):
    long = "x1" * 200_000
    docs = spark.createDataFrame([(1, long), (2, long + " b"), (3, "a " * 200_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.judge(docs, labels).count() == quality.resample(docs, labels.selectExpr("doc_id", "quality AS label")).count() == 3
    pages = spark.createDataFrame([(1, "http://a.net/" + "a1/" * 100_000), (2, "http://" + "b." * 100_000 + "net/")], "page_id long, url string")
    assert {r.page_id: r.rule for r in url_filter.judge(pages, url_filter.rules(spark)).collect()} == {1: "net/", 2: "net/"}


def test_empty_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(none, str(tmp_path / "none"))
    assert warc.resolved(spark, str(tmp_path / "none")).count() == 0
    assert url_filter.judge(none, url_filter.rules(spark)).count() == 0


OWN = {
    "secrets": (lambda d: secrets.scan(d), {"secrets"}), "cleaned": (lambda d: decontamination.cleaned(d, d.sparkSession.createDataFrame([(1, "a b c d e")], "item_id long, text string")), set()),
    "removed": (lambda d: suffix_dedup.removed(d), {"kept", "n_bytes", "n_removed", "n_spans"}), "judge": (lambda d: url_filter.judge(d, url_filter.rules(d.sparkSession)), {"host", "path", "priority", "rule", "verdict"}),
    "mixture": (lambda d: mixing.mixture(d), set()), "resample": (lambda d: quality.resample(d, d.sparkSession.createDataFrame([], "doc_id long, label int")), {"log_weight", "key", "kept"}), "one_of_each": (lambda d: simhash.one_of_each(d), set()),
}


@pytest.mark.parametrize("name", sorted(OWN))
def test_columns_with_own_names_stay(spark, name):
    """Every name that an operator gives a column of its own, with an underscore and without, is a caller's column here."""
    operator, replaced = OWN[name]
    names = "text assign access hex strings entropy base body stretches key own leak other spans url copies row id place part least value found of size copy fingerprint root hash".split()
    more = {n: f"'{n}'" for x in names for n in (x, "_" + x) if n != "text"} | {n: "'mine'" for n in replaced}
    docs = spark.createDataFrame([(1, "some words here", "a"), (2, "q8Zr2LmXv0Kt7Wn4YbGd", None)], "doc_id long, text string, source string")
    docs = docs.selectExpr("*", *[f"{v} AS {n}" for n, v in more.items()])
    found = operator(docs)
    kept = [c for c in docs.columns if c not in replaced]
    assert set(kept) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
    rows = {r.doc_id: r for r in found.collect()}
    assert rows and all(rows[i][n] == n for i in rows for n in more if n in kept)
