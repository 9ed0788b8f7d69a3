"""Near copies among vectors: spherical k-means cells, blocked cosine products, one representative per group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerloom.llm.components import connected
from ledgerloom.session import stage

COSINE = 0.93
SAMPLE = 8192  # most vectors, in the mean, that centroids are fitted on
CELL = 256  # n vectors of a label have the power of two next to sqrt(n / CELL) cells
MOST_CELLS = 256  # most centroids; they are sent to every task (256 x dimensions doubles)
BLOCK = 16384  # most vectors in a block, in the mean; products are of two blocks
NUMBERS = 1 << 20  # most components of a block's vectors, in the mean
TILE = 1024  # rows and columns of a product that are formed at once
ROUNDS = 12
SEED = 42


def usable(vector: Column, label: Column) -> Column:
    """Label and vector are there, and the vector is not zero and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def centroids(sample: np.ndarray, cells: int, seed: int = SEED) -> np.ndarray:
    """Spherical k-means: unit vectors go to the centroid of largest cosine, centroids are the normed sums of theirs."""
    rng = np.random.default_rng(seed)
    centers = sample[np.sort(rng.choice(len(sample), min(cells, len(sample)), replace=False))]
    for _ in range(ROUNDS):
        nearest = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), centers)
    return np.unique(centers, axis=0)


def rows_of(column: pa.Array, n: int) -> np.ndarray:
    """Lists of n numbers as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n).astype(np.float64, copy=False)


def binaries(vectors: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * np.int32(vectors.itemsize * vectors.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(vectors))])


def numbers(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Of all rows together, of what ``binaries`` made of them."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def reached(vectors: np.ndarray, centers: np.ndarray, cosine: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The cell in which each vector is at home, and the other cells in which it must be compared.

    A vector's home is the nearest centroid. A partner at home in cell i lies beyond the plane between the two centroids, so the vector is at most the chord of
    the threshold away from that plane, or has no partner there. Of two homes, the pair is compared in the cell with the
    lower number: a vector only visits cells below its own.
    """
    close = vectors @ centers.T
    home = close.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centers @ centers.T, 0))[home]
    chord = math.sqrt(2 - 2 * cosine) + 1e-9
    near = close[np.arange(len(home)), home][:, None] - close <= chord * apart + 1e-9
    near &= np.arange(len(centers))[None, :] < home[:, None]
    return home, [np.flatnonzero(x) for x in near]


def in_blocks(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...] | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``node, links, least`` of the vectors that have a link: how many copies each links to (``links`` counts the
    partners' copies), and the smallest node that it reaches by the links found here.

    The two sides are nodes, copies and vectors of each, without a common node; without a right side the left one is
    compared with itself.
    """
    own = right is None
    node, copies, vectors = left if own else (np.concatenate(x) for x in zip(left, right, strict=True))
    split = 0 if own else len(left[0])
    links = np.zeros(len(node), np.int64)
    parts = []
    for i in range(0, split or own * len(node), TILE):
        for j in range(i if own else split, len(node), TILE):
            linked = vectors[i : min(i + TILE, split or len(node))] @ vectors[j : j + TILE].T >= cosine
            if i == j:  # each pair once
                linked = np.triu(linked, 1)
            if linked.any():
                rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                linked, rows, columns = linked[np.ix_(rows, columns)], rows + i, columns + j
                links[rows] += linked @ copies[columns]
                links[columns] += copies[rows] @ linked
                parts.append((rows, columns, linked))
    some = np.flatnonzero(links)
    some = some[np.argsort(node[some])]
    rank = np.zeros(len(node), np.int32)
    rank[some] = np.arange(len(some))
    least, most = np.arange(len(some), dtype=np.int32), np.int32(len(some))
    while True:
        lower = least.copy()
        for rows, columns, linked in parts:
            x, y = rank[rows], rank[columns]
            lower[x] = np.minimum(lower[x], np.where(linked, lower[y][None, :], most).min(axis=1))
            lower[y] = np.minimum(lower[y], np.where(linked, lower[x][:, None], most).min(axis=0))
        lower = lower[lower]
        if (lower == least).all():
            return node[some], links[some], node[some][least]
        least = lower


def classes(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors with equal labels and as many dimensions link at a cosine of ``cosine`` or more, in double precision. No link
    is lost: a vector is compared in every cell where a partner may be at home. Equal vectors with equal labels are one
    node that knows its copies, so copies are never paired; ``n_links`` counts them all. Vectors without a label, null,
    zero or with null or non-finite components have no link and are their own component. The component is the
    smallest id reached (null ids passed over); ``kept`` is false for a null id. Repeated rows are copies of each other.

    Centroids are fitted on about ``SAMPLE`` vectors at most; every vector is placed. A label has as many cells as its
    size asks for. Vectors at home in a cell are dealt to blocks by a hash of the node, and a block is one row from then
    on, as are those of its vectors that visit another cell: blocks are repeated for the products, not vectors. Each
    pair of blocks is one group, so that neither cells nor labels bound a task's memory.
    """
    spark = df.sparkSession
    held = df.select(F.col(vector)).schema[0].dataType
    dtype = np.float32 if isinstance(held, ArrayType) and isinstance(held.elementType, FloatType) else np.float64  # floats are kept as floats
    numeric = F.col(vector).cast("array<float>" if dtype is np.float32 else "array<double>")
    rows = df.select(F.col(vec_id).alias("vec_id"), numeric.alias("vector"), F.col(label).cast("string").alias("label"))
    good = usable(F.col("vector"), F.col("label"))
    name = F.when(good, F.xxhash64("label", "vector"))
    rows = stage(rows.withColumn("vector", F.when(good, F.col("vector"))).withColumn("label", F.when(good, F.col("label"))).withColumn("hash", name), "vectors")
    groups = rows.filter("vector IS NOT NULL").groupBy("hash", "label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    # numbered, not named by the hash: different vectors may share a hash
    nodes = stage(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")
    kind = ["label", "n"]
    size = F.count(F.lit(1))
    cells = F.least(F.lit(float(MOST_CELLS)), F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.round(F.log2(F.sqrt(size / CELL))))))
    sizes = stage(nodes.groupBy("label", F.size("vector").alias("n")).agg(size.alias("size"), cells.cast("int").alias("cells")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    part = min(1.0, SAMPLE / max(total, 1))
    chosen = nodes.filter(F.pmod(F.xxhash64("hash", F.lit(SEED)), F.lit(1 << 30)) < int(part * (1 << 30))).select(F.size("vector").alias("n"), "vector", "hash")
    sample = chosen.orderBy("hash").toPandas()
    by_size = {int(n): unit(np.vstack(x["vector"].to_numpy())) for n, x in sample.groupby("n")}
    wanted = [(r.n, r.cells) for r in sizes.select("n", "cells").distinct().collect()]
    sent = spark.sparkContext.broadcast({(n, k): centroids(by_size[n], k) for n, k in wanted if n in by_size})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.column_stack([batch.column(c).to_numpy() for c in ("n", "cells")])
            for n, k in np.unique(key, axis=0):
                own = batch.filter(pa.array((key == (n, k)).all(axis=1)))
                vectors = rows_of(own.column("vector"), n)
                centers = sent.value.get((int(n), int(k)))
                cell, visits = (np.zeros(len(vectors), np.int64), [[]] * len(vectors)) if centers is None else reached(unit(vectors), centers, cosine)
                columns = [own.column(c) for c in ("node", "copies", "label", "n")]
                values = [pa.array(cell, pa.int32()), pa.array(visits, pa.list_(pa.int32())), binaries(vectors.astype(dtype))]
                yield pa.RecordBatch.from_arrays([*columns, *values], names=["node", "copies", "label", "n", "cell", "visits", "vector"])

    placed = nodes.select("node", "copies", "label", F.size("vector").alias("n"), "vector").join(sizes.drop("size"), kind)
    placed = stage(placed.mapInArrow(place, "node long, copies long, label string, n int, cell int, visits array<int>, vector binary"), "placed")
    cell_key = [*kind, "cell"]
    blocks = F.ceil(size / F.greatest(F.lit(1.0), F.least(F.lit(float(BLOCK)), F.lit(NUMBERS) / F.col("n"))))
    at_home = placed.groupBy(*cell_key).agg(blocks.alias("blocks"))
    guests = placed.select(*kind, F.explode("visits").alias("cell")).groupBy(*cell_key).agg(blocks.alias("rooms"))
    met = stage(at_home.join(guests, cell_key, "left").withColumn("rooms", F.coalesce("rooms", F.lit(0).cast("long"))), "cells")
    dealt = placed.join(met, cell_key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, n, cell, block = (x.as_py() for x in key)
        rows = pa.Table.from_batches(batches)
        visits = rows.column("visits").combine_chunks()
        row, to = np.repeat(np.arange(len(visits)), visits.value_lengths().to_numpy()), visits.flatten().to_numpy()
        node, copies, vectors = rows.column("node").to_numpy(), rows.column("copies").to_numpy(), numbers(rows.column("vector"), dtype).reshape(-1, n)

        def packed(at: np.ndarray, other: int) -> pa.RecordBatch:
            held = [np.ascontiguousarray(x[at]).tobytes() for x in (node, copies, vectors)]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, [label, n, other, other == cell, cell, block, *held], strict=True))], schema)

        yield packed(np.arange(len(node)), cell)
        for other in np.unique(to).tolist():
            yield packed(row[to == other], other)

    schema = pa.schema([("label", pa.string()), ("n", pa.int32()), ("cell", pa.int32()), ("home", pa.bool_()), ("of", pa.int32()), ("block", pa.int64()), ("node", pa.binary()), ("copies", pa.binary()), ("vector", pa.binary())])
    packs = dealt.select(*cell_key, "block", "node", "copies", "visits", "vector").groupBy(*cell_key, "block")
    packs = packs.applyInArrow(pack, "label string, n int, cell int, home boolean, of int, block long, node binary, copies binary, vector binary")
    # blocks of a cell meet each other (first <= second) and its rooms, over which the visiting blocks are dealt
    homes = F.expr("transform(sequence(0L, blocks - 1), x -> struct(least(block, x) AS first, greatest(block, x) AS second, false AS visit))")
    rooms = F.expr("transform(filter(sequence(0L, rooms), x -> x < rooms), x -> struct(block AS first, x AS second, true AS visit))")
    visits = F.expr("transform(sequence(0L, blocks - 1), x -> struct(x AS first, pmod(xxhash64(of, block), rooms) AS second, true AS visit))")
    meets = F.explode(F.when(F.col("home"), F.concat(homes, rooms)).otherwise(visits)).alias("meet")
    held = ["home", "block", "node", "copies", "vector"]
    paired = packs.join(met, cell_key).select(*cell_key, meets, *held).select(*cell_key, "meet.*", *held)

    def compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        _, n, _, first, second, visit = (x.as_py() for x in key)
        left = np.array([h and b == first for h, b in zip(rows.column("home").to_pylist(), rows.column("block").to_pylist(), strict=True)])

        def side(at: np.ndarray) -> tuple[np.ndarray, ...]:
            held = rows.filter(pa.array(at))
            vectors = numbers(held.column("vector"), dtype).astype(np.float64).reshape(-1, n)
            return numbers(held.column("node"), np.int64), numbers(held.column("copies"), np.int64), unit(vectors)

        found = in_blocks(side(left), None if first == second and not visit else side(~left), cosine)
        return pa.table(dict(zip(("node", "links", "least"), map(pa.array, found), strict=True)))

    found = paired.groupBy(*cell_key, "first", "second", "visit").applyInArrow(compare, "node long, links long, least long")
    found = stage(found, "found")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    joined = nodes.select("node", "hash", "label", "vector", "copies", "least").join(counted, "node", "left").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    joined = stage(joined.select("hash", "label", "vector", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")), "joined")
    ids = stage(joined.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = stage(joined.join(ids, "root").select("hash", F.col("label").alias("_label"), F.col("vector").alias("_vector"), "n_links", "component_id"), "named")
    same = (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    linked = rows.filter("vector IS NOT NULL").join(named, "hash").filter(same).select("vec_id", "n_links", "component_id")
    alone = rows.filter("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
