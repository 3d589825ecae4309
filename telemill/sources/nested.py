"""Nested lists of a variant column as child tables, at any depth.

An object flattens into its row, a list becomes a table of its own: ``<table>__<path>``, one row an item, with the
id of the row that holds the list and the item's place in it. Lists within lists are children of children. Which
lists and fields there are, the data say: the items of each list are folded to one schema by an aggregate, level
by level, so the driver sees one schema a list and no value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Path = tuple[str, ...]
ROOT_ID, PARENT, PLACE, ITEM = "_id", "_parent_id", "_list_idx", "_item"


@dataclass(frozen=True)
class Shape:
    """Fields and lists of the items of one table; a field that is sometimes a list is both."""

    fields: tuple[Path, ...]
    lists: tuple[Path, ...]


def _ddl(schema: str) -> str:
    """A variant schema as a type; names in backticks are left as they are."""
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    return "".join(part if part.startswith("`") else part.replace("OBJECT<", "STRUCT<") for part in parts)


def shape_of(items: DataFrame, column: str = ITEM) -> Shape:
    """What the values of a variant column are made of, whatever kinds stand at one place."""
    fields, lists = [], []
    for path, kind in _kinds(items.select(F.col(column).alias(ITEM)), ()):
        (lists if kind == "list" else fields).append(path)
    return Shape(tuple(fields), tuple(lists))


def _kinds(items: DataFrame, path: Path) -> Iterator[tuple[Path, str]]:
    """(path, "field" or "list") below a place; a path may be both.

    Values of different kinds fold to no schema, so objects are folded apart from the others, and a field that
    holds several kinds is looked at by itself.
    """
    kind = F.schema_of_variant(ITEM)
    is_object, is_list = kind.startswith("OBJECT<"), kind.startswith("ARRAY<")
    seen = items.filter(F.col(ITEM).isNotNull()).agg(
        F.schema_of_variant_agg(F.when(is_object, F.col(ITEM))).alias("objects"),
        F.coalesce(F.bool_or(is_list), F.lit(False)).alias("lists"),
        F.coalesce(F.bool_or(~is_object & ~is_list & (kind != "VOID")), F.lit(False)).alias("fields"),
    ).first()
    if seen.lists:
        yield path, "list"
    if seen.fields:
        yield path, "field"
    if seen.objects and seen.objects.startswith("OBJECT<"):
        for below, leaf in _leaves(T.StructType.fromDDL(f"v {_ddl(seen.objects)}")["v"].dataType, ()):
            if isinstance(leaf, T.VariantType):
                yield from _kinds(items.select(_at(below, "variant").alias(ITEM)), path + below)
            elif not isinstance(leaf, T.NullType):
                yield path + below, "list" if isinstance(leaf, T.ArrayType) else "field"


def _leaves(kind: T.DataType, path: Path) -> Iterator[tuple[Path, T.DataType]]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from _leaves(field.dataType, (*path, field.name))
    else:
        yield path, kind


def _at(path: Path, kind: str) -> Column:
    """The value at a place below the item, as a type; null where there is none or it is of another type."""
    value = F.col(ITEM)
    if not any("'" in name and '"' in name for name in path):
        quoted = [f"""["{name}"]""" if "'" in name else f"['{name}']" for name in path]
        return F.try_variant_get(value, "$" + "".join(quoted), kind)
    for name in path:  # no path can hold a name with both quotes
        value = F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(name))
    return F.try_variant_get(value, "$", kind)


def _name(path: Path) -> str:
    return "__".join(path)


def row_id(parent: Column, table: str, place: Column) -> Column:
    """The id of an item: a hash of its parent's id, its table and its place, so a replay gives the same."""
    return F.sha2(F.concat_ws("|", parent, F.lit(table), place.cast("string")), 256)


def child_tables(rows: DataFrame, key: Column, column: str, table: str) -> dict[str, DataFrame]:
    """Every list below a variant column as a table (_id, _parent_id, _list_idx, fields as text).

    ``key`` makes the id of a row of ``rows``. An item that is no object has its text in ``value``; objects have
    a column a field, ``a__b`` for a field within one. Nulls, empty lists and rows without the list have no items.
    """
    found: dict[str, DataFrame] = {}
    level = [(table, rows.select(key.cast("string").alias(ROOT_ID), F.col(column).alias(ITEM)))]
    while level:
        following = []
        for name, items in level:
            shape = shape_of(items)
            if name != table:
                found[name] = items.select(ROOT_ID, PARENT, PLACE, *_fields(shape))
            for path in shape.lists:
                # a list right below a list has no name of its own
                child = _free(f"{name}__{_name(path) or 'list'}", {*found, *(n for n, _ in following), *(n for n, _ in level)})
                held = _at(path, "array<variant>")
                inner = items.select(F.col(ROOT_ID).alias(PARENT), F.posexplode(held).alias(PLACE, ITEM))
                following.append((child, inner.withColumn(ROOT_ID, row_id(F.col(PARENT), child, F.col(PLACE)))))
        level = following
    return found


def _free(name: str, taken: set[str]) -> str:
    """The name, marked until it differs from the others whatever their case."""
    lower = {other.lower() for other in taken}
    while name.lower() in lower:
        name += "_"
    return name


def _fields(shape: Shape) -> list[Column]:
    out: dict[str, Column] = {}
    for path in shape.fields:
        # a field that is a list or an object elsewhere: those are in their table or their own fields
        kind = F.schema_of_variant(_at(path, "variant"))
        text = F.when(~kind.startswith("ARRAY<") & ~kind.startswith("OBJECT<"), _at(path, "string"))
        name = _free(_name(path) or "value", {ROOT_ID, PARENT, PLACE, *out})
        out[name] = text.alias(name)
    return list(out.values())
