"""Functions that users bring: scalar functions of fixed arity, and aggregates by zero, step, merge and finish."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def register_scalar(spark: SparkSession, name: str, f: Callable[..., pd.Series], returns: str, arity: int):
    """Registers f, over whole columns of a batch, under a name for SQL; another number of arguments, or an error in f, fails the query."""

    @F.pandas_udf(returns)
    def run(*columns: pd.Series) -> pd.Series:
        if len(columns) != arity:
            raise TypeError(f"{name} takes {arity} arguments, not {len(columns)}")
        return f(*columns)

    return spark.udf.register(name, run)


def aggregated(rows: DataFrame, keys: list[str], value: str, into: str, zero: Callable[[], object], step: Callable, merge: Callable, finish: Callable, returns: str = "double") -> DataFrame:
    """keys and into: finish of all values stepped into a state. Without keys there is one row, also if there are no rows.

    Each task steps its own rows and gives one state for each key; states are merged by key behind a shuffle.
    """
    names = keys or ["_all"]
    rows = rows.select(*keys, F.col(value).alias("_value")) if keys else rows.select(F.lit(0).alias("_all"), F.col(value).alias("_value"))
    kinds = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, object] = {}
        for b in batches:
            for key, own in b.groupby(names, dropna=False):
                state = states[key] if key in states else zero()
                for v in own["_value"]:
                    state = step(state, v)
                states[key] = state
        if states:
            yield pd.DataFrame([(*k, pickle.dumps(s)) for k, s in states.items()], columns=[*names, "_state"])

    def finished(own: pd.DataFrame) -> pd.DataFrame:
        state = zero()
        for s in own["_state"]:
            state = merge(state, pickle.loads(s))
        return own[names].head(1).assign(**{into: [finish(state)]})

    states = rows.mapInPandas(steps, f"{kinds}, _state binary")
    if not keys:
        states = states.unionByName(rows.sparkSession.createDataFrame([(0, bytearray(pickle.dumps(zero())))], "_all int, _state binary"))
    return states.groupBy(*names).applyInPandas(finished, f"{kinds}, `{into}` {returns}").drop("_all")


def _turned(digits: Column) -> Column:
    """Sixteen hex digits with their pairs in reverse order."""
    return F.concat(*(F.substr(digits, F.lit(i), F.lit(2)) for i in range(15, 0, -2)))


def sum_state(total: Column) -> Column:
    """A sum's partial state as a value: eight bytes, the lowest first."""
    return F.unhex(_turned(F.lpad(F.hex(total.cast("long")), 16, "0")))


def merged_sum(state: Column) -> Column:
    """The sum of such states, by a combinable aggregate."""
    return F.sum(F.conv(_turned(F.hex(state)), 16, -10).cast("long"))
