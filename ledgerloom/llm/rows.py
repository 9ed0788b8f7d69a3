"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"  # a word of the contracts


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by its id and text, null safe: rows that agree in both have one key."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.md5(F.concat(own[0], F.lit("\x00"), F.when(F.col(text).isNull(), "0").otherwise("1"), own[1]))


def distinct_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front until no column of the frame has the name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


class Hashes(dict):
    """Token to a 64-bit number by ``value``, remembered; forgets all at ``limit`` tokens, so memory stays bounded."""

    def __init__(self, value: Callable[[str], int], limit: int = 300_000) -> None:
        super().__init__()
        self.value, self.limit = value, limit

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self.value(token)
        return value

    def of(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def hashed(token: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), seed)


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def grams(words: np.ndarray, *steps: int) -> np.ndarray:
    """Hashes of the words at i, i + steps[0], i + steps[0] + steps[1] ... for every i at which all exist."""
    n = len(words) - sum(steps)
    if n <= 0:
        return words[:0]
    out, at = words[:n], 0
    for step in steps:
        at += step
        out = mixed(out * ODD + words[at : at + n])
    return out


def share(column: Column, part: float, seed: int) -> Column:
    """Keeps about that part of the values, always the same ones."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) < int(min(max(part, 0.0), 1.0) * (1 << 30))


def labelled(docs: DataFrame, labels: DataFrame, most: int, seed: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, label`` of documents with a label: about ``most`` ids at most, always the same ones.

    ``labels`` has ``doc_id, label`` (0 or 1; null ids and labels are left out, of several labels the largest counts).
    Only the chosen ids are sent to the documents, whose texts are not shuffled.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.filter(share(F.col("doc_id"), most / max(known.count(), 1), seed))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.join(F.broadcast(chosen), "doc_id")


ROW = "_row"


def boxed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns as fields of one, so that no operator's column can clash with them; ``field`` names one of them.

    ``more`` are columns beside it, from the columns of ``docs``.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *[v.alias(n) for n, v in more.items()])


def field(name: str) -> str:
    return f"{ROW}.`{name}`"


def unboxed(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(field(c)).alias(c) for c in like.columns])
