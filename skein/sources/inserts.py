"""A table that takes checked, idempotent inserts, and transactions over them.

Each insert is a folder of Parquet files, written under a hidden name and renamed when complete, so readers
see all of it or nothing. An insert with a token goes to the folder of that token: the same token again adds
nothing, also after a failure half way. Rows are counted while they are written.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from .shared import file_system


class SchemaMismatch(ValueError):
    """An insert that omits, adds or re-types a column."""


@dataclass(frozen=True)
class Summary:
    """Counters of inserts; they add up."""

    rows: int = 0
    inserts: int = 0
    duplicates: int = 0

    def __add__(self, other: "Summary") -> "Summary":
        return Summary(self.rows + other.rows, self.inserts + other.inserts, self.duplicates + other.duplicates)


class Sink:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._staged: list[tuple[str, str]] | None = None
        fs, where = file_system(spark, self.path)
        fs.mkdirs(where)

    def checked(self, rows: DataFrame) -> DataFrame:
        """rows in the table's order of columns; null where the table has none fails the write."""
        own, given = {f.name: f for f in self.schema}, {f.name: f for f in rows.schema}
        if own.keys() != given.keys():
            raise SchemaMismatch(f"missing: {sorted(own.keys() - given.keys())}, unknown: {sorted(given.keys() - own.keys())}")
        if wrong := [n for n in own if given[n].dataType != own[n].dataType and given[n].dataType != T.NullType()]:
            raise SchemaMismatch(f"other types: {wrong}")
        out = []
        for name, f in own.items():
            c = F.col(f"`{name}`").cast(f.dataType)
            out.append((c if f.nullable else F.coalesce(c, F.raise_error(F.lit(f"null in {name}")).cast(f.dataType))).alias(name))
        return rows.select(*out)

    def insert(self, rows: DataFrame, token: str | None = None) -> Summary:
        rows = self.checked(rows)
        name = "t" + hashlib.sha256(token.encode()).hexdigest()[:32] if token is not None else "u" + uuid.uuid4().hex
        fs, final = file_system(self.spark, f"{self.path}/{name}")
        if fs.exists(final) or any(f == f"{self.path}/{name}" for _, f in self._staged or []):
            return Summary(duplicates=1)
        hidden, seen = f"{self.path}/_{name}-{uuid.uuid4().hex}", Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(hidden)
        if self._staged is None:
            self._publish(hidden, f"{self.path}/{name}")
        else:
            self._staged.append((hidden, f"{self.path}/{name}"))
        return Summary(rows=int(seen.get["rows"]), inserts=1)

    def insert_all(self, batches: Iterable[DataFrame], token: str | None = None) -> Summary:
        """Inserts one after another; with a token each has one of its own, so a repeat resumes where it broke off."""
        return sum((self.insert(b, None if token is None else f"{token}/{k}") for k, b in enumerate(batches)), Summary())

    def _publish(self, hidden: str, final: str) -> None:
        fs, source = file_system(self.spark, hidden)
        if not fs.rename(source, file_system(self.spark, final)[1]):  # someone else's insert of this token came first
            fs.delete(source, True)

    @contextmanager
    def transaction(self) -> Iterator["Sink"]:
        """Inserts inside become visible at its end, or not at all if it raises."""
        self._staged = []
        try:
            yield self
            staged, self._staged = self._staged, None
            for hidden, final in staged:
                self._publish(hidden, final)
        except BaseException:
            for hidden, _ in self._staged or []:
                fs, where = file_system(self.spark, hidden)
                fs.delete(where, True)
            raise
        finally:
            self._staged = None

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)


def updated(rows: DataFrame, where, values: dict) -> DataFrame:
    """UPDATE: rows for which where is true take the values; all others, also where it is null, stay."""
    hit = F.coalesce(where, F.lit(False))
    return rows.withColumns({k: F.when(hit, v).otherwise(F.col(k)) for k, v in values.items()})


def deleted(rows: DataFrame, where) -> DataFrame:
    """DELETE: rows for which where is true go."""
    return rows.where(~F.coalesce(where, F.lit(False)))


def violations(rows: DataFrame, not_null: list[str] = (), checks: dict | None = None, unique: list[list[str]] = (), references: dict[str, DataFrame] | None = None) -> DataFrame:
    """rule and n for every constraint that rows break: NOT NULL, CHECK (null passes), UNIQUE (null is never equal), FOREIGN KEY.

    references: a column and the one-column table that its values must be in. Row rules take one pass together.
    """
    single = {f"not_null:{c}": F.col(c).isNull() for c in not_null} | {f"check:{k}": ~F.coalesce(c, F.lit(True)) for k, c in (checks or {}).items()}
    parts = []
    if single:
        counted = rows.agg(*(F.count_if(c).alias(k) for k, c in single.items()))
        pairs = F.array(*(F.struct(F.lit(k).alias("rule"), F.col(f"`{k}`").alias("n")) for k in single))
        parts.append(counted.select(F.explode(pairs).alias("_")).select("_.*"))
    for key in unique:
        again = rows.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        parts.append(again.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n")).select(F.lit(f"unique:{','.join(key)}").alias("rule"), "n"))
    for name, parent in (references or {}).items():
        lost = rows.where(F.col(name).isNotNull()).join(parent.toDF(name), name, "left_anti")
        parts.append(lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"references:{name}").alias("rule"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("n > 0")


def enforced(rows: DataFrame, **constraints) -> DataFrame:
    """rows, if they break no constraint; ValueError with what they break otherwise."""
    if broken := {r.rule: r.n for r in violations(rows, **constraints).collect()}:  # a row for each constraint at most
        raise ValueError(f"constraints broken: {broken}")
    return rows
