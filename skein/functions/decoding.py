"""Strict typed decoding: a result's columns as declared fields, or an error.

Fields are declared by width: bool, int8 to int64, uint8 to uint64, float32, float64, string, bytes, date,
instant, decimal(p,s), arrays of these (array<int64>), with ? behind for fields that may be null. A column's own logical
type is that of its metadata's key "logical" where Spark has none (unsigned integers, fixed(n) strings,
enums), else Spark's.

Rules: integer widths and signs must be equal, nothing is widened; float64 takes float32 and float64, float32
only itself; string takes strings, fixed strings (without their closing NULs) and enums (by name; a value
without a name is an error); bytes takes binary; instant takes any temporal column. A field without column, and
null in a field that isn't optional, raise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Spark's names and the logical ones.
LOGICAL = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64", "boolean": "bool", "binary": "bytes", "string": "string", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz"}
STORED = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)", "float32": "float", "float64": "double", "string": "string", "bytes": "binary", "bool": "boolean", "date": "date", "instant": "timestamp"}


class DecodeError(ValueError):
    """A field that can't be decoded from its column as declared."""


def logical(field: T.StructField) -> str:
    if "logical" in (field.metadata or {}):
        return field.metadata["logical"]
    if isinstance(field.dataType, T.ArrayType):
        return f"array<{logical(T.StructField('', field.dataType.elementType))}>"
    name = field.dataType.simpleString()
    return LOGICAL.get(name, name)


def as_logical(c: Column, name: str, kind: str, **more: object) -> Column:
    """c under a name, with a logical type that Spark has none for; an enum's names by value are given as names={0: "a", ...}."""
    return c.alias(name, metadata={"logical": kind} | {k: {str(a): b for a, b in v.items()} if isinstance(v, dict) else v for k, v in more.items()})


def _decoded(field: T.StructField, want: str) -> Column:
    own, c = logical(field), F.col(f"`{field.name}`")
    if want == own:
        return c
    if want == "float64" and own == "float32":
        return c.cast("double")
    if want == "string" and re.fullmatch(r"fixed\(\d+\)", own):
        return F.rtrim(c.cast("string"), F.lit("\0"))
    if want == "string" and own == "enum":
        names = F.create_map(*(F.lit(x) for k, v in field.metadata["names"].items() for x in (int(k), v)))
        found = F.try_element_at(names, c.cast("int"))
        return F.when(c.isNotNull(), F.coalesce(found, F.raise_error(F.concat(F.lit(f"{field.name}: no name for "), c.cast("string"))).cast("string")))
    if want == "instant" and own in ("date", "timestamp", "timestamp_ntz"):
        return c.cast("timestamp")
    raise DecodeError(f"{field.name}: {own} is not {want}")


def decoded(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The fields, by name, of rows. Types are checked at once, nulls and enum values as rows are read."""
    own, out = {f.name: f for f in rows.schema}, []
    for name, want in fields.items():
        if name not in own:
            raise DecodeError(f"{name}: no such column")
        kind = want.removesuffix("?")
        if not re.fullmatch(r"decimal\(\d+,\d+\)|array<\w+>", kind) and kind not in STORED:
            raise DecodeError(f"{name}: {kind} has no width" if kind in ("int", "uint") else f"{name}: unknown type {kind}")
        c = _decoded(own[name], kind)
        if not want.endswith("?"):
            c = F.coalesce(c, F.raise_error(F.lit(f"{name}: null")).cast(STORED.get(kind, own[name].dataType.simpleString())))
        out.append(c.alias(name))
    return rows.select(*out)


def refused(rows: DataFrame, fields: dict[str, str]) -> bool:
    """Whether the types alone forbid it."""
    try:
        decoded(rows, fields)
    except DecodeError:
        return True
    return False
