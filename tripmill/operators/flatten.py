"""Nested JSON to flat tables: structs become ``a__b`` columns, arrays become child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "__"


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out = []
    for f in schema.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            out.extend(_leaves(f.dataType, here))
        else:
            out.append((here, f.dataType))
    return out


def _field(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every struct field at any depth as its own column; arrays stay as they are."""
    return df.select([_field(p).alias(SEPARATOR.join(p)) for p, _ in _leaves(df.schema)])


def child_table(flat: DataFrame, array_col: str, parent_key: list[str]) -> DataFrame:
    """One row per array element with the parent's key and the element's position.

    Struct elements become columns, other elements a column ``value``. An empty or null array
    has no rows. Elements are unfolded within their row's task, so nothing shuffles.
    """
    parent = [F.col(k).alias(f"parent_{k}") for k in parent_key]
    items = flat.select(*parent, F.posexplode(array_col).alias("list_idx", "value"))
    if isinstance(items.schema["value"].dataType, T.StructType):
        keys = [c for c in items.columns if c != "value"]
        return flatten_structs(items.select(*keys, "value.*"))
    return items


def normalize_json(df: DataFrame, name: str, key: str) -> dict[str, DataFrame]:
    """The root table and one table per array at any depth, named ``root__array``.

    A child of a child carries the key of the top row and one position per level.
    """
    tables: dict[str, DataFrame] = {}

    def add(label: str, nested: DataFrame, keys: list[str]) -> None:
        flat = flatten_structs(nested)
        arrays = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.ArrayType)]
        tables[label] = flat.drop(*arrays)
        for a in arrays:
            child = child_table(flat, a, keys)
            if any(isinstance(f.dataType, T.ArrayType) for f in child.schema.fields):
                add(f"{label}{SEPARATOR}{a}", child, [f"parent_{k}" for k in keys] + ["list_idx"])
            else:
                tables[f"{label}{SEPARATOR}{a}"] = child

    add(name, df, [key])
    return tables
