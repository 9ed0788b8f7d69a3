"""Classification and conditional columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_when(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First branch whose condition is true wins; a NULL condition falls through."""
    condition, value = branches[0]
    out = F.when(condition, value)
    for condition, value in branches[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def bucket(col: Column, bounds: Sequence[float], labels: Sequence[str], default: str) -> Column:
    """Bands closed on the right. ``labels`` has one more entry than ``bounds``: the last is for values above all
    bounds. NULL gets ``default``."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label per bound and one for larger values")
    branches = [(col <= F.lit(b), F.lit(label)) for b, label in zip(bounds, labels)]
    branches.append((col > F.lit(bounds[-1]), F.lit(labels[-1])))
    return case_when(branches, F.lit(default))


def null_if(condition: Column, col: Column) -> Column:
    """NULL where the condition is true; a NULL condition keeps the value."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(None)).otherwise(col)


def signed_amount(amount: Column, negative: Column) -> Column:
    return F.when(negative, -amount).otherwise(amount)


def flag(condition: Column) -> Column:
    """Three-valued condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def state_changed(new: Column, old: Column) -> Column:
    """True where two flags differ; a missing flag counts as false."""
    return flag(new) != flag(old)
