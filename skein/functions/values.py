"""Strict conversions between column types, and values of named enums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Smallest and largest number of each width.
RANGES = {f"int{n}": (-(1 << n - 1), (1 << n - 1) - 1) for n in (8, 16, 32, 64)} | {f"uint{n}": (0, (1 << n) - 1) for n in (8, 16, 32, 64)}
_STORED = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}


def fits(c: Column, width: str) -> Column:
    low, high = RANGES[width]
    return c.cast("decimal(38,0)").between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)"))


def in_width(c: Column, width: str) -> Column:
    """An integer in a width; one that doesn't fit raises, null stays."""
    return F.when(fits(c, width), c.cast("decimal(38,0)").cast(_STORED[width])).when(c.isNotNull(), F.raise_error(F.concat(F.lit(f"not in {width}: "), c.cast("string"))).cast(_STORED[width]))


def try_in_width(c: Column, width: str) -> Column:
    """The same, null where it doesn't fit."""
    return F.when(fits(c, width), c.cast("decimal(38,0)").cast(_STORED[width]))


def instant(local: Column, zone: str) -> Column:
    """The instant at which clocks of a zone show a local time."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def enum_name(value: Column, names: dict[int, str]) -> Column:
    """An enum's name; a value without one raises."""
    found = F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), value)
    return F.when(value.isNotNull(), F.coalesce(found, F.raise_error(F.concat(F.lit("no name for "), value.cast("string"))).cast("string")))


def enum_value(name: Column, names: dict[int, str]) -> Column:
    found = F.try_element_at(F.create_map(*(F.lit(x) for k, v in names.items() for x in (v, k))), name)
    return F.when(name.isNotNull(), F.coalesce(found, F.raise_error(F.concat(F.lit("no value for "), name)).cast("int")))


def zeros(n: Column) -> Column:
    """So many zero bytes."""
    return F.unhex(F.repeat(F.lit("00"), n))


def natural_key(text: Column) -> Column:
    """A sort key that puts the number at a text's end in order of its value: a user's collation as a key, so that Spark sorts in the JVM."""
    tail = F.regexp_extract(text, r"([0-9]*)$", 1)
    return F.concat(F.substr(text, F.lit(1), F.length(text) - F.length(tail)), F.lpad(tail, 20, "0"))
