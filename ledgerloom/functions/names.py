"""Column names (driver-side: names only, the data stays where it is)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, count

from pyspark.sql import DataFrame

from ledgerloom.functions.text import ACCENTED, PLAIN

# What happens to symbols in a column name.
REPLACED = {" ": "_", ".": "_", "&": "and", "%": "percent"}
REMOVED = "-()?!@$^*:"


def standard_name(name: str) -> str:
    if name == "":
        name = "blank"
    table = str.maketrans({**REPLACED, **dict.fromkeys(REMOVED, "")})
    out = name.lower().translate(table).strip().translate(str.maketrans(ACCENTED, PLAIN))
    return f"n{out}" if out[:1].isdigit() else out


def unique_names(names: Sequence[str]) -> list[str]:
    """A repeated name gets the first free suffix of _2, _3, ..."""
    taken: dict[str, None] = {}  # in the order of the columns
    for name in names:
        choices = chain([name], (f"{name}_{n}" for n in count(2)))
        taken[next(c for c in choices if c not in taken)] = None
    return list(taken)


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([standard_name(c) for c in df.columns]))
