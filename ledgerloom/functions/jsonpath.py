"""Values out of JSON text. The three readers differ in what they do with objects, arrays and non-strings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _kind(parsed: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))


def json_scalar(col: Column, path: str) -> Column:
    """Text of a string, number or boolean; NULL for objects, arrays, JSON null, missing paths and bad JSON.

    Only a result that looks like an object or array is parsed a second time, to tell it from a string.
    """
    value = F.get_json_object(col, path)
    kind = _kind(F.try_parse_json(col), path)
    nested = F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(True))
    looks_nested = F.left(value, F.lit(1)).isin("{", "[")
    # Joined to an empty text or NULL instead of chosen by a CASE: so the path is looked up once per row.
    return F.concat(value, F.when(looks_nested & nested, F.lit(None)).otherwise(F.lit("")))


def json_value(record: Column, path: str) -> Column:
    """Scalar of a struct, map or array column."""
    return json_scalar(F.to_json(record), path)


def field_value(df: DataFrame, name: str, path: str) -> Column:
    """Scalar out of a column of any kind. A path of plain names into a struct is read as a field, without JSON, when
    the field is text, a whole number or a boolean; other structured columns go through JSON, and text is JSON."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return json_scalar(F.col(f"`{name}`"), path)
    steps = path.removeprefix("$.").split(".")
    leaf: T.DataType | None = kind
    for step in steps:
        known = isinstance(leaf, T.StructType) and step in leaf.names
        leaf = leaf[step].dataType if known else None
    if isinstance(leaf, (T.StringType, T.IntegralType, T.BooleanType)):
        return F.col(".".join(f"`{part}`" for part in (name, *steps))).cast("string")
    return json_value(F.col(f"`{name}`"), path)


def json_string(col: Column, key: str) -> Column:
    """A JSON string by key, and the empty string for anything else."""
    return _string_at(F.try_parse_json(col), key)


def _string_at(parsed: Column, key: str) -> Column:
    path = f"$['{key}']"
    is_string = _kind(parsed, path) == "STRING"
    return F.when(is_string, F.try_variant_get(parsed, path, "string")).otherwise(F.lit(""))


def with_json_strings(df: DataFrame, col: str, keys: Mapping[str, str]) -> DataFrame:
    """Add one string column per key (alias to JSON key), parsing each row once."""
    parsed = df.withColumn("_parsed", F.try_parse_json(F.col(col)))
    found = {alias: _string_at(F.col("_parsed"), key) for alias, key in keys.items()}
    return parsed.withColumns(found).drop("_parsed")
