"""Generated rows, and a table provider whose rows are made on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def numbers(spark: SparkSession, n: int, first: int = 0) -> DataFrame:
    """number: n consecutive numbers from first on."""
    return spark.range(first, first + n).withColumnRenamed("id", "number")


def series(spark: SparkSession, first: int, last: int, step: int = 1) -> DataFrame:
    """value: from first to last, both included."""
    return spark.range(first, last + (1 if step > 0 else -1), step).withColumnRenamed("id", "value")


class _Slice(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class SquaresReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", 0))
        self.parts = max(1, int(options.get("parts", 4)))

    def partitions(self) -> list[_Slice]:
        cuts = [self.first + (self.last - self.first) * k // self.parts for k in range(self.parts + 1)]
        return [_Slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        for at in range(partition.first, partition.last, 10_000):
            n = pa.array(range(at, min(at + 10_000, partition.last)), pa.int64())
            yield pa.RecordBatch.from_arrays([n, pa.compute.multiply(n, n)], ["n", "square"])


class Squares(DataSource):
    """A virtual table (n, square) for n from first up to last, in so many parts."""

    @classmethod
    def name(cls) -> str:
        return "skein_squares"

    def schema(self) -> str:
        return "n long, square long"

    def reader(self, schema) -> SquaresReader:
        return SquaresReader(self.options)


def provided(spark: SparkSession, source: type[DataSource], **options: object) -> DataFrame:
    """The rows of a table provider."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**{k: str(v) for k, v in options.items()}).load()
