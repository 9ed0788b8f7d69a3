"""Joins that stay balanced when one key holds a large share of the rows, and joins with a residual condition.

The adaptive planner splits a skewed join side where both sides come straight out of a shuffle, so a plain join is right
wherever tables meet. Two cases are left: ``even_join`` is for a right side that is an aggregate on the join key (an
existence test, a per-key total), ``spread_join`` for heavy keys on the right of a left outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SLICE = 100_000  # a key with more rows than this is cut into slices of about this size
SHARES = 10_000  # a heavy key holds more than one such share of all rows, so there are fewer heavy keys than this
NULL_SLICES = 1_024
UNHASHABLE = (T.MapType, T.VariantType)


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """Keys (as ``_h_0``, ...) with more rows than a slice should have, and the number of ``_slices`` for each.

    A slice is ``rows_per_slice`` rows or one of ``SHARES`` equal shares of all rows, whichever is more. So there are less
    than ``SHARES`` such keys, with less than twice as many slices in all, whatever the size of the input: the list may
    be broadcast. The count is a partial aggregate that reads the key columns alone, the total reads no column. Both
    only decide how work is cut, never what is returned.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    slice_rows = F.greatest(F.lit(rows_per_slice), F.ceil(total / SHARES))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", slice_rows).where("_n > _slice")
    return counts.selectExpr(*[f"`{k}` AS _h_{i}" for i, k in enumerate(keys)], "CAST(ceil(_n / _slice) AS INT) AS _slices")


def _row_hash(df: DataFrame, spread_by: Sequence[str] | None) -> str:
    """Hash of the row's own values: a retried task puts every row into the slice it had before."""
    names = spread_by or [f.name for f in df.schema.fields if not isinstance(f.dataType, UNHASHABLE)]
    return f"xxhash64({', '.join(f'`{n}`' for n in names)})"


def _match(left: Sequence[str], right: Sequence[str], null_safe: bool = False) -> Column:
    equal = "<=>" if null_safe else "="
    return F.expr(" AND ".join(f"`{a}` {equal} `{b}`" for a, b in zip(left, right)))


def even_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    residual: Column | None = None,
) -> DataFrame:
    """Join rows to an aggregate on the same key so that heavy keys on the left, NULL among them, are split at run time.

    The planner would take the aggregate as it lies, and the adaptive planner splits nothing then. A second key that is
    always equal makes it shuffle the aggregate, one row per key, for the join. Same result as a plain join; supports
    inner, left, left_semi and left_anti. Columns other than the keys must have different names.
    """
    keys = as_list(on)
    names = [f"_r_{i}" for i in range(len(keys))]
    rest = [] if how in ("left_semi", "left_anti") and residual is None else [f"`{c}`" for c in right.columns if c not in keys]
    same = f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), 1)"
    near = left.selectExpr("*", f"{same} AS _same")
    far = right.selectExpr(*[f"`{k}` AS {n}" for k, n in zip(keys, names)], f"{same} AS _r_same", *rest)
    condition = _match(keys, names, null_safe) & _match(["_same"], ["_r_same"])
    joined = near.join(far, condition if residual is None else condition & residual, how)
    return joined.selectExpr(*[f"`{c}`" for c in left.columns], *(rest if how in ("inner", "left") else []))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    hot: str = "left",
    null_safe: bool = False,
    residual: Column | None = None,
    count_left: DataFrame | None = None,
    count_right: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    spread_right_by: Sequence[str] | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Equi-join with the rows of heavy keys spread over several tasks; same result as ``left.join(right, on, how)``.

    ``hot`` names the side that may hold heavy keys (``left``, ``right`` or ``both``). Rows of those keys are cut into
    slices on that side, and the matching rows of the other side are repeated once per slice. Rows whose key is NULL
    never match, and are spread as well. Slices of the right side are only used where they hold rows, so that a left
    outer join reports no false unmatched row.

    ``count_left`` and ``count_right`` name cheaper frames with the same key column to look for heavy keys in (such as
    the base table of a long pipeline). ``spread_by`` and ``spread_right_by`` name columns that tell the rows of a side
    apart; without them all columns are hashed. ``count_right`` must hold the columns of ``spread_right_by``, and all
    keys of the right side. ``residual`` is a further condition over columns of both sides. Columns other than the
    keys must have different names. Supports inner, left, left_semi and left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how!r}")
    keys = as_list(on)
    size = rows_per_slice or ROWS_PER_SLICE
    existence = how in ("left_semi", "left_anti")
    if existence:
        hot = "left"
        right = right if residual is not None else right.select(*keys).distinct()

    heavy_names = [f"_h_{i}" for i in range(len(keys))]
    by_key = _match(keys, heavy_names, null_safe)
    near, near_columns = left, [f"`{c}`" for c in left.columns]
    far, far_columns = right, [f"`{c}`" for c in right.columns]
    salts = []

    if hot in ("left", "both"):
        heavy = F.broadcast(heavy_keys(left if count_left is None else count_left, keys, size))
        slices = "coalesce(_slices, 1)"
        if not null_safe:
            missing = " OR ".join(f"`{k}` IS NULL" for k in keys)
            slices = f"CASE WHEN {missing} THEN {NULL_SLICES} ELSE {slices} END"
        salt = f"CAST(pmod({_row_hash(left, spread_by)}, {slices}) AS INT) AS _a"
        near = near.join(heavy, by_key, "left").selectExpr(*near_columns, salt)
        every = "explode(sequence(0, coalesce(_slices, 1) - 1)) AS _a"
        far = far.join(heavy, by_key, "left").selectExpr(*far_columns, every)
        salts.append("_a")

    if hot in ("right", "both"):
        base = right if count_right is None or not spread_right_by else count_right
        heavy = F.broadcast(heavy_keys(right if count_right is None else count_right, keys, size))
        salt = f"CAST(pmod({_row_hash(right, spread_right_by)}, coalesce(_slices, 1)) AS INT) AS _b"
        far = far.join(heavy, by_key, "left").selectExpr(*far_columns, *salts, salt)
        used = base.join(heavy, by_key, "inner").selectExpr(*heavy_names, salt)
        used = used.groupBy(*heavy_names).agg(F.collect_set("_b").alias("_used"))
        every = "explode(coalesce(_used, array(0))) AS _b"
        near = near.join(F.broadcast(used), by_key, "left").selectExpr(*near_columns, *salts, every)
        salts.append("_b")

    names = [f"_r_{i}" for i in range(len(keys) + len(salts))]
    rest = [f"`{c}`" for c in right.columns if c not in keys]
    far = far.selectExpr(*[f"`{k}` AS {n}" for k, n in zip([*keys, *salts], names)], *rest)
    condition = _match(keys, names, null_safe) & _match(salts, names[len(keys) :])
    if residual is not None:
        condition = condition & residual
    joined = near.join(far, condition, how)
    return joined.selectExpr(*near_columns, *([] if existence else rest))


def anti_before_first(
    purchases: DataFrame,
    firsts: DataFrame,
    key: str,
    first_key: str,
    ts: str,
    first_ts: str,
) -> DataFrame:
    """Drop the rows of a key that lie before that key's first time in ``firsts``.

    ``firsts`` has one row per key. Written as an explicit anti-join with a range residual: a left join with an IS
    NULL test would carry every matched row through the join first.
    """
    bound = firsts.select(F.col(first_key).alias(key), F.col(first_ts).alias("_first"))
    early = F.col(ts) < F.col("_first")
    return even_join(purchases, bound, key, "left_anti", residual=early)


def rejoin_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Join a group-by of the input back to its rows. Rows with a NULL key get NULL totals, as in an equi-join."""
    sums = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return even_join(df, sums, keys, "left")
