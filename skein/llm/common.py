"""Helpers shared by the operators: written intermediate tables, components, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own where that is unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="skein-"))
    return sc.getCheckpointDir().rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


class Table:
    """A table written to the shared folder, which cuts the lineage and survives lost executors.

    What is not dropped goes when the driver's JVM ends, also after the session was stopped.
    """

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark = session(df)
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        fs, where = _file_system(self.spark, self.path)
        df.write.parquet(self.path)
        fs.deleteOnExit(where)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def saved(df: DataFrame, name: str) -> DataFrame:
    return Table(df, name).df


class Scratch:
    """Tables of one computation: those not asked to stay are dropped at its end, also if it fails."""

    def __init__(self) -> None:
        self.tables: list[Table] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_: object) -> None:
        for t in self.tables:
            t.drop()

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(Table(df, name))
        return self.tables[-1].df


def components(links: DataFrame) -> DataFrame:
    """Connected components of the links (a, b: long): one row (node, component) per node that has a link.

    component is the smallest node reachable. Alternates the large-star and small-star steps until
    the links stop changing; the neighbours' minimum is a combinable aggregate, so a node with very
    many links is reduced before the shuffle.
    """
    now = Table(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    last = None
    while True:
        e = now.df
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.n).where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # small star: neighbours below a node are joined to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least.withColumnRenamed("b", "n"), F.col("b") == F.col("n"))
        out = small.select(F.col("m").alias("l"), F.col("a").alias("r")).union(least.select("m", "b")).where("l < r").distinct()
        new = Table(out.toDF("a", "b"), "links")
        mark = new.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now.drop()
        now = new
        if mark == last:
            break
        last = mark
    e = now.df
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(e.select("a", "a").distinct())


_MULT = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


def word_bytes_table(alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(is this byte inside a word, the byte's random value with A-Z read as a-z)."""
    inside = np.ones(256, bool)
    inside[[9, 10, 11, 12, 13, 32]] = False
    if alnum:
        inside[:128] = [chr(b).isalnum() for b in range(128)]
    value = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
    value[65:91] = value[97:123]
    return inside, value


def word_hashes(data: np.ndarray, ends: np.ndarray, inside: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie behind one another in data (UTF-8 bytes).

    ends: where each text ends; a text's end always ends its last word. Returns the words' hashes
    and, for each text, the number of its first word and of the word behind its last (bounds), plus
    the words' starts and ends in bytes. All texts are hashed at once by prefix sums of a
    polynomial in the bytes, modulo 2**64.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(ends) + 1, np.int64), z, z
    word = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[ends] = True  # a text begins here
    cut[0] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:n]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value[data] * up[:n], out=sums[1:])
    h = mix((sums[e] - sums[s]) * down[s] ^ ((e - s).astype(np.uint64) * _MULT))
    bounds = np.concatenate(([0], np.searchsorted(s, ends)))
    return h, bounds, s, e


def text_chunks(column, size: int = 1 << 20):
    """Slices of an Arrow string column as (first row, row count, bytes, ends), about size bytes each, never part of a text."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j - i, data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
        i = j


class Memory:
    """What a worker remembers of words: at most about twice limit entries, the ones met lately."""

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    def of(self, words: set, learn) -> dict:
        """A dict that has all the words; learn(list) gives the pairs of those not remembered."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        new = words.difference(self.young)
        again = new.intersection(self.old)
        self.young.update((w, self.old[w]) for w in again)
        new -= again
        if new:
            self.young.update(learn(list(new)))
        return self.young

    def lists(self, split: list[list[str]], learn) -> Iterator[list]:
        """For each list of words, the list of what is remembered of them; learn(list) gives the pairs of those that are not."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        found = [list(map(self.young.get, words)) for words in split]
        missing = {w for words, values in zip(split, found) if None in values for w, v in zip(words, values) if v is None}
        again = [w for w in missing if w in self.old]
        self.young.update((w, self.old[w]) for w in again)
        missing.difference_update(again)
        self.young.update(learn(list(missing)))
        for words, values in zip(split, found):
            yield [self.young[w] if v is None else v for w, v in zip(words, values)] if None in values else values
