"""Line dedup with levelled sorted runs (operator 4).

Batches of documents, from the largest doc_ids down, each add one run of line keys, sorted and
bucketed by the key's hash. A new batch is merged against all runs: its keys that no run has are
new and get a holder (the batch's largest doc_id with that key); known keys only add to the count.
Two runs of one level are merged into one of the next level, so a key is rewritten a logarithmic
number of times. Runs share their bucketing, so neither those merges nor the batch's joins shuffle
the runs again. The last merge tells which keys are common; those leave every document but the
holder.

A document is a doc_id: rows that repeat one count once for a line, and all rows of the holder's doc_id
keep the line. A null doc_id counts as the smallest one. A null text is one empty line. Short keys are
never common. Keys are compared by 128 bits of hashes. Other columns pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import LOWER, SPACE, UPPER, Table, remove, saved, shared_dir

LOWEST = -(1 << 63)


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all else as it is; lower() itself where the text is ASCII, as it is faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


class LineRuns:
    """Levelled runs (h1, h2, docs, holder), each with one row per key."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets, self.levels = spark, buckets, {}

    def _write(self, run: DataFrame) -> str:
        name = f"skein_run_{uuid.uuid4().hex}"
        run.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{shared_dir(self.spark)}/{name}").saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, f"{shared_dir(self.spark)}/{name}")

    def runs(self) -> list[str]:
        return [n for level in sorted(self.levels) for n in self.levels[level]]

    def novel(self, keys: DataFrame) -> DataFrame:
        """keys with a column novel: no run has the key."""
        known = F.lit(False)
        for i, name in enumerate(self.runs()):
            keys = keys.join(self.spark.table(name).select("h1", "h2", F.lit(True).alias(f"in{i}")), ["h1", "h2"], "left")
            known = known | F.col(f"in{i}").isNotNull()
        return keys.withColumn("novel", ~known).select("h1", "h2", "docs", "holder", "novel")

    def add(self, lines: DataFrame) -> None:
        """lines: h1, h2, doc_id of a batch, the doc_ids below those of earlier batches."""
        own = lines.distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("holder"))
        run = self.novel(own).select("h1", "h2", "docs", F.when(F.col("novel"), F.col("holder")).alias("holder"))
        self.levels.setdefault(0, []).append(self._write(run))
        level = 0
        while len(self.levels.get(level, [])) == 2:
            a, b = self.levels.pop(level)
            self.levels.setdefault(level + 1, []).append(self._write(self.merged(a, b)))
            self.drop(a)
            self.drop(b)
            level += 1

    def merged(self, a: str, b: str) -> DataFrame:
        x, y = self.spark.table(a), self.spark.table(b).toDF("h1", "h2", "docs_b", "holder_b")
        return x.join(y, ["h1", "h2"], "full").select("h1", "h2", (F.coalesce("docs", F.lit(0)) + F.coalesce("docs_b", F.lit(0))).alias("docs"), F.coalesce("holder", "holder_b").alias("holder"))

    def compact(self) -> DataFrame:
        """All runs as one."""
        while len(names := self.runs()) > 1:
            a, b = names[:2]
            for level in self.levels.values():
                level[:] = [n for n in level if n not in (a, b)]
            self.levels.setdefault(99, []).insert(0, self._write(self.merged(b, a)))
            self.drop(a)
            self.drop(b)
        return self.spark.table(self.runs()[0])

    def close(self) -> None:
        for name in self.runs():
            self.drop(name)


def line_keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """h1, h2, doc_id: the hashed keys of at least least_chars code points, once per document."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    keys = F.array_distinct(F.filter(F.transform(F.split(text, "\n", -1), key_of), lambda k: F.length(k) >= least_chars))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc_id"), F.explode(keys).alias("key")).select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"), "doc_id")


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = 4) -> DataFrame:
    """docs with text lacking the common lines (but in their holder), and n_lines and n_dropped added."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)), reverse=True)
    batch = sum((F.when(F.col("doc_id") < cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    lines = Table(line_keys(docs, least_chars).withColumn("batch", batch), "lines")
    runs = LineRuns(spark, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    try:
        for k in range(len(cuts) + 1):
            runs.add(lines.df.where(F.col("batch") == k).select("h1", "h2", "doc_id"))
        common = saved(runs.compact().where(F.col("docs") >= least_docs).select("h1", "h2", "holder"), "common")
    finally:
        runs.close()
    drops = lines.df.join(common, ["h1", "h2"]).where("doc_id <> holder").groupBy(F.col("doc_id").alias("__skein_id")).agg(F.collect_set(F.struct("h1", "h2")).alias("__skein_drop"))
    held = docs.withColumn("__skein_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))).join(drops, "__skein_id", "left")

    def stays(line: Column) -> Column:
        key = key_of(lower_ascii(line))
        return (F.length(key) < least_chars) | ~F.array_contains("__skein_drop", F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")))

    whole = F.coalesce("text", F.lit(""))
    held = held.withColumn("__skein_kept", F.when(F.col("__skein_drop").isNotNull(), F.filter(lines_of(F.col("text")), stays)))
    n = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    held = held.withColumn("n_lines", n.cast("long")).withColumn("n_dropped", F.when(F.col("__skein_kept").isNull(), 0).otherwise(n - F.size("__skein_kept")).cast("long"))
    # a text that loses nothing stays as it was, null included
    return held.withColumn("text", F.when(F.col("__skein_kept").isNull(), F.col("text")).otherwise(F.array_join("__skein_kept", "\n"))).drop("__skein_id", "__skein_drop", "__skein_kept")
