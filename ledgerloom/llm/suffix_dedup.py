"""Removing bytes of strings that also occur earlier in the corpus, by external induced suffix sorting of shards.

Equal strings of ``LENGTH`` bytes have the same least hash of a shorter string in them, so the windows of a text are cut
into segments of equal least hash, and segments meet by it. A hash that occurs once cannot hold a repeat, and equal
segments are repeats as a whole; only different segments of one hash go to the suffix sorter of their shard. Where these
would exceed a shard, their windows meet by themselves instead.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import induced
from ledgerloom.llm.rows import boxed, distinct_name, field, mixed
from ledgerloom.session import stage

LENGTH = 100  # bytes
GRAM = 32  # bytes that are hashed
WINDOW = LENGTH - GRAM + 1  # hashes in a window
BUFFER = 1 << 18  # bytes that are hashed together
LEAST_BITS, MOST_BITS = 20, 27  # the filter of repeated hashes has 2**LEAST_BITS to 2**MOST_BITS bits (16 MB), sent to every task
BITS_EACH = 12  # bits of the filter for a repeated hash, up to MOST_BITS; beyond that a join follows the filter
PROBES = (0, 18, 36)  # a hash fills the bits that its digits from these on name
SHARD = 1 << 24  # bytes from which on the segments gathered in a task are sorted; a hash with more of its own is dealt by window
WINDOWS = 1 << 16  # windows that are dealt out together
LAST = (1 << 63) - 1  # takes the place of a null id

RATIO = 0x9E3779B97F4A7C15 | 1
POWERS = np.cumprod(np.full(BUFFER, RATIO, np.uint64))
INVERSE = np.cumprod(np.full(BUFFER, pow(RATIO, -1, 1 << 64), np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes in up to BUFFER bytes, by one running sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS[: len(data)], out=sums[1:])
    n = len(data) - GRAM + 1
    return mixed((sums[GRAM:] - sums[:n]) * INVERSE[:n])


def runs(data: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of one piece whose least hash is the same: first window, last window, hash, and if it occurs twice.

    ``piece`` tells for each byte which text it belongs to; windows over two texts are left out.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, bool))
    hashes = gram_hashes(data)
    low = np.uint64(BUFFER - 1)
    least, width = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * width <= WINDOW:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:n], least[WINDOW - width : WINDOW - width + n])
    place = (least & low).astype(np.int64)  # of several least hashes the first
    value = hashes[place]
    whole = piece[:n] == piece[LENGTH - 1 :]
    fresh = np.append(True, (value[1:] != value[:-1]) | (piece[1:n] != piece[: n - 1]))
    start = np.flatnonzero(fresh)
    moved = np.append(0, np.cumsum(place[1:] != place[:-1]))
    end = np.append(start[1:], n)
    valid = np.append(0, np.cumsum(whole))
    count = valid[end] - valid[start]  # a text's windows come first, those that leave it last
    some = count > 0
    start, count, value = start[some], count[some], value[start[some]]
    last = start + count - 1
    return start, last, value, moved[last] > moved[start]


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of whole texts, and of long texts cut with an overlap: bytes, piece per byte, and text and offset per piece."""
    held, size = [], 0

    def out(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        lengths = np.array([len(p) for _, _, p in held])
        return data, np.repeat(np.arange(len(held)), lengths), np.array([t for t, _, _ in held]), np.array([o for _, o, _ in held]) - np.append(0, np.cumsum(lengths)[:-1])

    for number, text in enumerate(texts):
        for offset in range(0, max(len(text) - LENGTH + 1, 0), BUFFER - LENGTH + 1):
            part = text[offset : offset + BUFFER]
            if size + len(part) > BUFFER:
                yield out(held)
                held, size = [], 0
            held.append((number, offset, part))
            size += len(part)
    if held:
        yield out(held)


def repeated_hashes(texts: DataFrame) -> DataFrame:
    """``hash`` of the runs that occur twice or more in the corpus (column ``body``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.repeat(value, 1 + twice) for data, piece, _, _ in pieces(batch.column(0).to_pylist()) for _, _, value, twice in [runs(data, piece)]]
            value, n = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["hash", "n"])

    return texts.select("body").mapInArrow(run, "hash long, n byte").groupBy("hash").agg(F.sum("n").alias("n")).filter("n >= 2").select("hash")


def filter_bits(n: int) -> int:
    """The power of two that the filter's bits for so many hashes have; without MOST_BITS that of more."""
    return max(LEAST_BITS, (BITS_EACH * n - 1).bit_length())


def filter_of(hashes: DataFrame, power: int) -> Broadcast:
    """The filter's bits, in numbers of 64: 2**power of them, whatever the number of hashes."""
    probes = F.array(*[F.shiftrightunsigned("hash", p).bitwiseAND((1 << power) - 1).cast("int") for p in PROBES])
    spread = hashes.select(F.explode(probes).alias("probe"))
    filled = spread.groupBy(F.shiftright("probe", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, probe & 63)")).alias("bits")).toArrow()
    bits = np.zeros(1 << power - 6, np.uint64)
    bits[filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = np.ones(len(value), bool)
    for p in PROBES:
        probe = (value >> np.uint64(p)) & np.uint64(64 * len(bits) - 1)
        out &= (bits[(probe >> np.uint64(6)).astype(np.int64)] >> (probe & np.uint64(63))) & np.uint64(1) > 0
    return out


def segments(texts: DataFrame, repeated: Broadcast) -> DataFrame:
    """``hash, doc, key, start, size, twice, segment``: runs that pass the filter, with the bytes of all their windows.

    Of equal segments in a batch only the earliest has its bytes; the later ones are repeats as a whole (null hash).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = repeated.value
        for batch in batches:
            docs, keys, bodies = (c.to_pylist() for c in batch.columns)
            found = []
            for data, piece, text, shift in pieces(bodies):
                start, last, value, twice = runs(data, piece)
                some = passes(bits, value)
                own = piece[start[some]]
                found += zip(value[some].view(np.int64).tolist(), text[own].tolist(), (start[some] + shift[own]).tolist(), (last[some] - start[some] + LENGTH).tolist(), twice[some].tolist())
            found.sort(key=lambda x: (docs[x[1]], x[2]))
            first: dict[tuple[int, bytes], tuple[int, int]] = {}
            rows = []
            for value, i, start, size, twice in found:
                part = bodies[i][start : start + size]
                at = (docs[i], start)
                if first.setdefault((value, part), at) < at:
                    rows.append((None, docs[i], keys[i], start, size, False, None))
                else:
                    rows.append((value, docs[i], keys[i], start, size, twice, part))
            columns = list(zip(*rows)) or [[]] * 7
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["hash", "doc", "key", "start", "size", "twice", "segment"])

    return texts.select("doc", "key", "body").mapInArrow(run, "hash long, doc long, key binary, start long, size long, twice boolean, segment binary")


class Shard:
    """Different segments, gathered until they are sorted together."""

    def __init__(self) -> None:
        self.held: list[tuple[bytes, int, int, list[bytes]]] = []
        self.size = 0

    def add(self, segment: bytes, doc: int, start: int, keys: list[bytes]) -> None:
        self.held.append((segment, doc, start, keys))
        self.size += len(segment) + 1

    def repeats(self) -> Iterator[tuple[int, bytes, int, int]]:
        """``doc, key, start, size`` of strings of windows each of which also occurs earlier in the shard."""
        held, self.held, self.size = self.held, [], 0
        sizes = np.array([len(s) for s, _, _, _ in held])
        begin = np.append(0, np.cumsum(sizes + 1))
        length = int(begin[-1]) + 1
        text = np.zeros(length + LENGTH + induced.PACKED, np.uint16)
        text[: length - 1] = np.frombuffer(b"\x00".join(s for s, _, _, _ in held) + b"\x00", np.uint8).astype(np.uint16) + induced.FIRST
        text[begin[1:] - 1] = induced.GAP
        doc, start = (np.array([h[i] for h in held], np.int64) for i in (1, 2))
        later = np.zeros(length, bool)
        best: tuple[int, int, int] | None = None  # the earliest of the strings that are open at a batch's end
        with tempfile.TemporaryDirectory() as folder:  # this task's own queues, gone when it ends
            for at, common in induced.suffixes(text, length, LENGTH, folder):
                group = np.cumsum(common < LENGTH)
                own = np.searchsorted(begin, at, "right") - 1
                inside = at + LENGTH < begin[own + 1]
                at, group, own = at[inside], group[inside], own[inside]
                id_, place = doc[own], start[own] + at - begin[own]
                if best is not None and len(group) and group[0] == 0:  # the first group goes on
                    group, at, id_, place = (np.append(b, x) for b, x in zip((0, *best), (group, at, id_, place)))
                if not len(at):
                    best = None if common.min() < LENGTH else best
                    continue
                turn = np.lexsort((place, id_, group))
                at, id_, place, group = at[turn], id_[turn], place[turn], group[turn]
                head = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(group)), 0))
                later[at[(id_ != id_[head]) | (place != place[head])]] = True
                closed = int((common < LENGTH).sum())
                best = (int(at[head[-1]]), int(id_[head[-1]]), int(place[head[-1]])) if group[-1] == closed else None
        edges = np.flatnonzero(np.diff(np.concatenate([[0], later.astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            i = int(np.searchsorted(begin, a, "right")) - 1
            for key in held[i][3]:
                yield held[i][1], key, held[i][2] + a - int(begin[i]), b - a + LENGTH - 1


def shard_repeats(rows: DataFrame) -> DataFrame:
    """``doc, key, start, size`` of the repeats among segments, which meet by their hash.

    Rows come sorted by hash, segment and place, so that equal segments are neighbours, the earliest first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, group, hash_, any_twice = Shard(), [], None, False

        def close() -> None:
            if len(group) > 1 or any_twice:
                for one in group:
                    shard.add(*one)

        def out(found: list[tuple[int, bytes, int, int]]) -> pa.RecordBatch:
            types = pa.int64(), pa.binary(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found)) or [[]] * 4, types)], names=["doc", "key", "start", "size"])

        for batch in batches:
            found = []
            for value, doc, key, start, twice, segment in zip(*(c.to_pylist() for c in batch.columns)):
                if value != hash_:
                    close()
                    group, hash_, any_twice = [], value, False
                    if shard.size >= SHARD:
                        found += shard.repeats()
                any_twice |= twice
                if group and group[-1][0] == segment:
                    _, own_doc, own_start, keys = group[-1]
                    if (doc, start) != (own_doc, own_start):
                        found.append((doc, key, start, len(segment)))
                    elif key not in keys:
                        keys.append(key)
                else:
                    group.append((segment, doc, start, [key]))
            yield out(found)
        close()
        if shard.held:
            yield out(list(shard.repeats()))

    columns = ["hash", "doc", "key", "start", "twice", "segment"]
    dealt = rows.filter("hash IS NOT NULL").select(*columns).repartition(F.col("hash"))
    return dealt.sortWithinPartitions("hash", "segment", "doc", "start").mapInArrow(run, "doc long, key binary, start long, size long")


def crowded(rows: DataFrame) -> DataFrame:
    """``hash`` of more than SHARD bytes in different segments; fewer than there are shards in all segments."""
    own, size = rows.filter("hash IS NOT NULL"), F.sum(F.col("size") + 1)
    large = own.groupBy("hash").agg(size.alias("bytes")).filter(F.col("bytes") > SHARD).select("hash")
    told = own.join(F.broadcast(large), "hash").groupBy("hash", F.xxhash64("segment").alias("segment")).agg(F.first("size").alias("size"))
    return stage(told.groupBy("hash").agg(size.alias("bytes")).filter(F.col("bytes") > SHARD).select("hash"), "crowded")


def window_repeats(rows: DataFrame) -> DataFrame:
    """``doc, key, start, size`` of strings of windows that occur earlier in the rows' segments.

    Of equal segments (by 128-bit hashes) all but the earliest are repeats as a whole and drop out first. The windows of
    the others meet by 128-bit hashes, and windows of a document that follow each other are put together again.
    """
    place = F.struct("doc", "start")
    own = stage(rows.select("doc", "key", "start", "size", "segment", F.md5("segment").alias("name")), "crowd")
    firsts = stage(own.groupBy("name").agg(F.min(place).alias("first")), "firsts").withColumnRenamed("name", "of")
    told = stage(own.join(firsts, F.col("name") == F.col("of")).select("doc", "key", "start", "size", "segment", (place > F.col("first")).alias("later")), "told")
    rows, whole = told.filter("NOT later"), told.filter("later").select("doc", "key", "start", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(made: list[tuple[bytes, int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*made)) or [[]] * 4, (pa.binary(), pa.int64(), pa.binary(), pa.int64()))], names=["window", "doc", "key", "start"])

        for batch in batches:
            made = []
            for doc, key, start, segment in zip(*(c.to_pylist() for c in batch.columns)):
                made += [(xxhash.xxh3_128_digest(segment[p : p + LENGTH]), doc, key, start + p) for p in range(len(segment) - LENGTH + 1)]
                if len(made) >= WINDOWS:
                    yield out(made)
                    made = []
            yield out(made)

    windows = stage(rows.select("doc", "key", "start", "segment").mapInArrow(run, "window binary, doc long, key binary, start long"), "windows")
    least = windows.groupBy("window").agg(F.min(place).alias("least"), F.max(place).alias("last")).filter("least < last")
    found = windows.join(stage(least.select("window", "least"), "least"), "window").filter(place > F.col("least"))
    # starts that follow each other have one difference to their rank, in stretches that bound what meets in a task
    found = found.select("doc", "key", "start", F.floor(F.col("start") / WINDOWS).alias("stretch")).distinct()
    rank = F.row_number().over(Window.partitionBy("doc", "key", "stretch").orderBy("start"))
    runs = found.withColumn("run", F.col("start") - rank).groupBy("doc", "key", "stretch", "run").agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("n"))
    return whole.unionByName(runs.select("doc", "key", "start", (F.col("n") + (LENGTH - 1)).alias("size")))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, key, start, size``: byte ranges to remove, which may overlap; ``key`` is that of ``named``."""
    texts = named(docs, doc_id, text)
    hashes = stage(repeated_hashes(texts), "hashes")
    power = filter_bits(hashes.count())
    rows = segments(texts, filter_of(hashes, min(power, MOST_BITS)))
    if power > MOST_BITS:
        # too many hashes for the filter to keep most others out: what passes is joined to them, null hashes stay
        rows = rows.filter("hash IS NULL").union(rows.filter("hash IS NOT NULL").join(hashes, "hash", "left_semi"))
    rows = stage(rows, "segments")
    whole = rows.filter("hash IS NULL").select("doc", "key", "start", "size")
    many = crowded(rows)
    if many.isEmpty():
        return whole.union(shard_repeats(rows))
    rest = rows.join(F.broadcast(many), "hash", "left_anti")
    return whole.union(shard_repeats(rest)).union(window_repeats(rows.join(F.broadcast(many), "hash")))


def document_key(doc_id: str, text: str) -> Column:
    """128 bits of a row's id and text; a null text is empty."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(F.col(text), F.lit("")))))


def named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc`` (a null id comes last), ``key`` of id and text, and ``body``, the text in UTF-8; a null text is empty."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), document_key(doc_id, text).alias("key"), body.alias("body"))


def merged(found: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Ranges as maximal runs of covered bytes, in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], min(s["start"] + s["size"], size)) for s in found or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``kept`` (binary, what is left of the text), ``n_bytes``, ``n_removed`` and ``n_spans``.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document of smaller id, or earlier
    in the same. Rows with equal ids are one document in this (equal places are not earlier); a null id is
    greater than all. Strings never cross texts. Rows stay, also repeated ones; clashing columns are replaced.
    """
    new = ("kept", "n_bytes", "n_removed", "n_spans")
    docs = docs.drop(*new)
    found = stage(spans(docs, doc_id, text), "spans")
    listed = stage(found.groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("found")), "listed")
    joined = boxed(docs, own=document_key(doc_id, text)).join(listed, F.col("own") == F.col("key"), "left")
    columns = [c for c in docs.columns if c != text]
    sent = joined.select(*[F.col(field(c)).alias(c) for c in (*columns, text)], F.col("found").alias(distinct_name(docs, "_found")))
    schema = docs.select(*[F.col(f"`{c}`") for c in (*columns, text)]).schema
    for name, kind in zip(new, ("binary", "long", "long", "long")):
        schema = schema.add(name, kind)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for body, own in zip(batch.column(len(columns)).to_pylist(), batch.column(len(columns) + 1).to_pylist()):
                data = (body or "").encode()
                gone = merged(own, len(data))
                edges = [0, *(x for pair in gone for x in pair), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                made.append((kept, len(data), len(data) - len(kept), len(gone)))
            values = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], names=names)

    return sent.mapInArrow(run, schema)
