"""Statements with bound values: values never become part of the text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Short type names and Spark's for them.
TYPES = {
    "Bool": "BOOLEAN", "Int8": "TINYINT", "Int16": "SMALLINT", "Int32": "INT", "Int64": "BIGINT", "UInt8": "SMALLINT", "UInt16": "INT", "UInt32": "BIGINT",
    "UInt64": "DECIMAL(20,0)", "Float32": "FLOAT", "Float64": "DOUBLE", "String": "STRING", "Date": "DATE", "DateTime": "TIMESTAMP",
}
_QUOTED = r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`"
_MARK = re.compile(rf"({_QUOTED})|\{{(\w+):\s*(\w+)\}}|\$(\d+)")


def run_bound(spark: SparkSession, sql: str, *values: object, tables: dict[str, DataFrame] | None = None, **named: object) -> DataFrame:
    """Runs sql with {name:Type} bound from named, and $1, $2, ... or ? from values; {table} stands for one of tables.

    A value that is missing or not used, and a type that isn't known, raise ValueError.
    """
    used: set[str] = set()

    def mark(m: re.Match[str]) -> str:
        quoted, name, kind, place = m.groups()
        if quoted is not None:
            return quoted
        if name is not None:
            if kind not in TYPES:
                raise ValueError(f"unknown type {kind}")
            used.add(name)
            return f"CAST(:{name} AS {TYPES[kind]})"
        used.add(f"p{place}")
        return f":p{place}"

    text = _MARK.sub(mark, sql)
    if not used:
        if named:
            raise ValueError(f"not used: {sorted(named)}")
        return spark.sql(text, args=list(values) or None, **(tables or {}))
    given = named | {f"p{i}": v for i, v in enumerate(values, 1)}
    if given.keys() != used:
        raise ValueError(f"missing: {sorted(used - given.keys())}, not used: {sorted(given.keys() - used)}")
    return spark.sql(text, args=given, **(tables or {}))


def scalar(df: DataFrame) -> object:
    """The one value of a result of one row and one column; anything else raises ValueError."""
    rows = df.take(2)
    if len(df.columns) != 1 or len(rows) != 1:
        raise ValueError("not exactly one row and one column")
    return rows[0][0]
