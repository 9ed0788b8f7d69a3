"""Set operations between frames by key, with duplicates kept on the side that is returned."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from ledgerloom.operators.joins import as_list, even_join


def semi(b: DataFrame, a: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of b whose key occurs in a."""
    return even_join(b, a.select(*as_list(key)).distinct(), key, "left_semi")


def anti(b: DataFrame, a: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of b whose key does not occur in a; all of b when a is empty."""
    return even_join(b, a.select(*as_list(key)).distinct(), key, "left_anti")


def union_new(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """All rows of a, then the rows of b whose key is not in a."""
    return a.unionByName(anti(b, a, key))


def sym_diff(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of a not in b, then rows of b not in a."""
    return anti(a, b, key).unionByName(anti(b, a, key))


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by position: later branches take the names of the first, types widen."""
    names = frames[0].columns
    return reduce(lambda x, y: x.union(y), [f.toDF(*names) for f in frames])


def stack_frames(*frames: DataFrame) -> DataFrame:
    """Several tables read as one; a column a table lacks is NULL there."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
