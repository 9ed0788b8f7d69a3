"""Near copies by 64-bit SimHash fingerprints, found through deletion-variant signatures."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected
from ledgerloom.llm.rows import distinct_name
from ledgerloom.session import stage

WORDS = 4  # words in a shingle
SEED = 42  # of the shingles' XXH64
DISTANCE = 4  # fingerprints link at this many differing bits or fewer
SEGMENTS = ((0, 21), (21, 42), (42, 64))  # of DISTANCE bits, one of three segments gets one at most
REST = 22  # bits of the longest segment
CROWD = 64  # fingerprints with one signature from which they are linked through a centre first; results do not depend on it


def fingerprint(text: bytes) -> int:
    """Of one text in UTF-8: bit is 1 if it is set in over half of the shingles' hashes; no word gives 0."""
    words = text.lower().split()  # on bytes: A-Z, and the six ASCII spaces
    if not words:
        return 0
    n = max(len(words) - WORDS + 1, 1)
    shingles = zip(*(words[i:] for i in range(WORDS))) if len(words) >= WORDS else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), np.uint64, n)
    return int(np.packbits(2 * ones(hashes) > n, bitorder="little").view(np.uint64)[0])


LANES = np.uint64(0x0101010101010101)  # the lowest bit of each byte


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit 0, 1, ... 63 set."""
    rows = np.zeros((-(-len(hashes) // 255), 255), np.uint64)  # 255 ones fit in a byte
    rows.ravel()[: len(hashes)] = hashes
    counts = np.empty((8, 8), np.int64)  # byte, bit in it
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.ravel()


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` without its text, with the fingerprint as a signed long. A null text counts as empty."""
    kept = [c for c in docs.columns if c != text]
    sent = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(distinct_name(docs, "_bytes")))
    schema = docs.select(*kept).schema.add(name, "long")

    def run(batches):
        for batch in batches:
            made = np.fromiter((fingerprint(t) for t in batch.column(len(kept)).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made.view(np.int64))], names=[*kept, name])

    return sent.mapInArrow(run, schema)


def variants(fp: Column) -> Column:
    """The 64 signatures of a fingerprint: for each bit, its number and the rest of its segment without it.

    Two segments that differ in one bit at most share a signature: that of the differing bit, or all if they are equal.
    """
    made = []
    for low, high in SEGMENTS:
        segment = F.shiftrightunsigned(fp, low).bitwiseAND((1 << (high - low)) - 1)
        made += [(segment.bitwiseAND(~(1 << (bit - low))) + (bit << REST)).cast("int") for bit in range(low, high)]
    return F.array(*made)


def first_shared(x: Column) -> Column:
    """The lowest bit whose signature two fingerprints share, from the bits ``x`` in which they differ."""
    out = F.lit(-1)
    for low, high in reversed(SEGMENTS):
        own = x.bitwiseAND(F.lit(((1 << (high - low)) - 1) << low if high < 64 else -(1 << low)))
        out = F.when(own == 0, low).when(F.bit_count(own) == 1, F.bit_count(own - 1) if high < 64 else F.when(own < 0, F.when(own == F.lit(-(1 << 63)), 63).otherwise(-1)).otherwise(F.bit_count(own - 1))).otherwise(out)
    return out


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: pairs of different fingerprints (column ``fp``, distinct) at most ``distance`` bits apart, each once.

    Found by equality on a signature; the join itself verifies the distance and keeps a pair only at the first
    signature that it shares, so that no pair is emitted twice. At most five bits, by the pigeonhole principle.
    """
    index = signatures(fps, distance)
    left, right = (index.select("signature", F.col("fp").alias(c)) for c in "ab")
    near, once = linked(F.col("a"), F.col("b"), left["signature"], distance)
    return left.join(right, (left["signature"] == right["signature"]) & (F.col("a") < F.col("b")) & near & once).select("a", "b")


def signatures(fps: DataFrame, distance: int) -> DataFrame:
    """``fp, signature``: 64 rows a fingerprint."""
    if not 0 < distance < 2 * len(SEGMENTS):
        raise ValueError(f"distance must be 1 to {2 * len(SEGMENTS) - 1}")
    return fps.select(F.col("fp"), F.explode(variants(F.col("fp"))).alias("signature"))


def linked(a: Column, b: Column, signature: Column, distance: int) -> tuple[Column, Column]:
    """Whether two fingerprints link, and whether the signature is the first that they share."""
    differ = a.bitwiseXOR(b)
    return F.bit_count(differ) <= distance, first_shared(differ) == F.shiftrightunsigned(signature, REST)


def spanning(fps: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that reach the same fingerprints as all of :func:`links`.

    Fingerprints that share a signature with more than ``crowd - 1`` others have a centre, the one of lowest hash. Those
    within ``distance`` of it link to it, and not to each other: m near copies make m links instead of their square.
    All other pairs are met as in :func:`links`: of a crowd, what is farther from the centre meets everyone.

    No pair gets apart by this. At the first signature that a pair shares, it either is met or both link to the centre, whose
    hash is lower than both; a link to a centre that first shares another signature is a pair of the same kind there,
    with a lower hash each time.
    """
    index = signatures(fps, distance)
    crowded = stage(index.groupBy("signature").count().filter(F.col("count") > crowd).select("signature"), "crowded")
    lowest = F.min(F.struct(F.xxhash64("fp").alias("rank"), "fp")).alias("lowest")
    centres = stage(index.join(crowded, "signature").groupBy("signature").agg(lowest).select("signature", F.col("lowest.fp").alias("centre")), "centres")
    close = F.coalesce(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= distance, F.lit(False)).alias("close")
    # stored, so that the planner can split a crowd on both sides of the join
    marked = stage(index.join(centres, "signature", "left").select("fp", "signature", "centre", close), "signatures")
    _, once = linked(F.col("fp"), F.col("centre"), F.col("signature"), distance)
    stars = marked.filter(F.col("close") & (F.col("fp") != F.col("centre")) & once).select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    left = marked.filter(~F.col("close")).select("signature", F.col("fp").alias("a"))
    right = marked.select(F.col("signature").alias("shared"), F.col("fp").alias("b"), "close")
    near, once = linked(F.col("a"), F.col("b"), F.col("signature"), distance)
    met = left.join(right, (F.col("signature") == F.col("shared")) & (F.col("close") | (F.col("a") < F.col("b"))) & near & once)
    return stars.union(met.select("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (signed long), ``component_id``.

    The component is the smallest id that the document reaches over links between fingerprints, its own included; null
    ids are passed over, and a component without any other id has null. Repeated rows stay and share a component.
    Equal fingerprints are one node from the start, so that no pair of copies is ever formed, and near ones of a crowd are
    linked through its centre.
    """
    own = stage(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), "fingerprints")
    nodes = stage(own.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected(spanning(nodes.select("fp"), distance))
    rooted = stage(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = stage(rooted.join(least, "root").select("fp", "component_id"), "named")
    return own.join(named, own["fingerprint"] == named["fp"]).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; columns as they were.

    Of several rows with that id in one component (other texts, repeated rows, null ids) one stays: the one with the
    lowest text hash, and of equal ones any.
    """
    row, key, least = F.struct(*docs.columns).alias("row"), F.xxhash64(F.col(text), F.lit(7)).alias("key"), F.col(doc_id).alias("doc_id")
    own = stage(fingerprints(docs.select(least, key, F.col(text).alias("text"))), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("least")
    nodes = stage(own.groupBy(F.col("fingerprint").alias("fp")).agg(first), "nodes")
    roots = connected(spanning(nodes.select("fp"), distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("least", F.coalesce("component", "fp").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias("_id"), F.col("least.key").alias("_key"))
    found = docs.select(row, least, key).join(stage(kept, "kept"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return found.dropDuplicates(["doc_id", "key"]).select("row.*")
