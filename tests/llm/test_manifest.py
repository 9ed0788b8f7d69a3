"""The manifest against plain trees of all rows, in blocks of few levels."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.llm import manifest

FOLDER = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return levels


def siblings_of(levels, pos):
    return [row[(pos >> up) ^ 1] for up, row in enumerate(levels[:-1]) if (pos >> up) ^ 1 < len(row)]


def plain(rows):
    """``{(id, leaf): (subroot, root, siblings)}`` and the root, for rows of id, source, lang, n_chars, text."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(((r[0] is None, r[0] or 0), plain_leaf(*r), r[0]))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    lows = {lang: sorted(langs[lang], key=lambda x: x[:2]) for lang in order}
    levels = {lang: climb([x[1] for x in own]) for lang, own in lows.items()}
    high = climb([levels[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for pos, (_, leaf, id_) in enumerate(lows[lang]):
            out.append((id_, leaf, levels[lang][-1][0], siblings_of(levels[lang], pos) + siblings_of(high, place)))
    return sorted(out, key=repr), high[-1][0]


def test_addresses_are_a_recursive_layout():
    # four levels: the upper two, then four trees of two levels below
    places = [manifest.address(4, d, np.arange(1 << d)).tolist() for d in range(4)]
    assert places == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]
    for levels in range(1, 13):
        every = np.concatenate([manifest.address(levels, d, np.arange(1 << d)) for d in range(levels)])
        assert sorted(every.tolist()) == list(range((1 << levels) - 1))
        # every subtree of the lower half is one stretch
        top = levels // 2
        for i in range(1 << top if levels > 1 else 0):
            below = np.concatenate([manifest.address(levels, top + d, (i << d) + np.arange(1 << d)) for d in range(levels - top)])
            assert below.max() - below.min() + 1 == len(below)


@pytest.mark.parametrize("levels", [1, 2, 3, 10])
def test_proofs_are_those_of_plain_trees(spark, levels):
    sizes = {None: 1, "de": 2, "en": 37, "": 5, "Ünï": 8, "fr": 9, "x\x00": 3}
    rows = [(1000 - i, f"s{i % 3}" if i % 5 else None, lang, i if i % 4 else None, "é" * i if i % 7 else None) for lang, n in sizes.items() for i in range(n)]
    rows += [(5, "s", "en", 1, "same")] * 3 + [(None, "s", "en", 1, "no id"), (None, None, None, None, None), (7, "s", "fr", 2, "long " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    made = manifest.build(docs, levels=levels)
    expected, root = plain(rows)
    assert made.root.hex() == root
    got = manifest.proofs(made).withColumn("folded", manifest.folded(F.lower(F.hex("digest")), F.col("siblings"), F.col("sides"))).collect()
    found = sorted(((r.id, r.digest.hex(), r.subroot.hex(), [r.siblings[i : i + 32].hex() for i in range(0, len(r.siblings), 32)]) for r in got), key=repr)
    assert found == expected
    assert {r.folded for r in got} == {root}
    assert all(sum(s != "-" for s in r.sides) * 32 == len(r.siblings) for r in got)
    blocks = [b for t in made.documents.tiers for b in t.collect()]
    assert all(b.n <= 1 << levels and len(b.nodes) == 32 * ((2 << b.height) - 1) for b in blocks)


def test_one_row_and_no_row(spark, documents):
    one = manifest.build(documents.where("doc_id = 2"))
    found = manifest.proofs(one).first()
    assert one.root == found.digest == found.subroot and found.siblings == b"" and found.sides == ""
    none = manifest.build(documents.limit(0))
    assert none.root is None and manifest.proofs(none).count() == 0


def test_odd_rows_and_clashing_columns(spark, documents):
    docs = documents.selectExpr("*", "1 AS tree", "2 AS pos", "3 AS size", "4 AS digest", "5 AS _place", "6 AS id", "7 AS root", "8 AS block", "9 AS _part")
    made = manifest.build(docs, kept=F.col("pos"))
    found = manifest.proofs(made)
    assert found.count() == docs.count() and {r.kept for r in found.collect()} == {2}
    assert made.root == manifest.build(documents).root


def test_query_finds_tampered_rows(spark):
    found = entry.queries()["op11_merkle_manifest"](spark, FOLDER).collect()
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected, root = plain(rows)
    assert sorted((r.doc_id, r.leaf, r.subroot, r.proof_sha256) for r in found) == sorted((i, leaf, sub, sha(*path)) for i, leaf, sub, path in expected)
    for r in found:
        assert r.root == root and r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) == (r.folded_root == root)
