"""Change capture between snapshots, and applying changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, op (INSERT, UPDATE, DELETE) and the new values (for DELETE the old ones) of every row that differs."""
    values = [c for c in old.columns if c != key]
    a, b = old.select(key, F.struct(*values).alias("_old")), new.select(key, F.struct(*values).alias("_new"))
    both = a.join(b, key, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    op = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").otherwise("UPDATE")
    row = F.coalesce("_new", "_old")
    return both.select(key, op.alias("op"), *(row[c].alias(c) for c in values))


def apply_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """target after the changes; those in conflict (INSERT of a key that is there, UPDATE or DELETE of one that isn't) are left out."""
    values = [c for c in target.columns if c != key]
    a, b = target.select(key, F.struct(*values).alias("_row")), changes.select(key, "op", F.struct(*values).alias("_new"))
    both = a.join(b, key, "full")
    there, op = F.col("_row").isNotNull(), F.col("op")
    row = F.when(there & (op == "UPDATE"), F.col("_new")).when(there & (op == "DELETE"), None).when(~there & (op == "INSERT"), F.col("_new")).otherwise(F.col("_row"))
    return both.select(key, row.alias("_")).where("_ is not null").select(key, *(F.col(f"_.{c}") for c in values))


def watched(changes: DataFrame, condition: Column | None = None) -> DataFrame:
    """Change frames; with a condition on the new row, deletions are dropped."""
    return changes if condition is None else changes.where((F.col("op") != "DELETE") & condition)
