"""Durable-stream consumption: filters by subject, deduplication by message id, sinks with exactly one copy."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skein.sources.shared import new_folder


def subject_pattern(subject: Column, pattern: str) -> Column:
    """Dot-separated tokens; * stands for one token and > for all the rest (one at least)."""
    tokens = [{"*": r"[^.]+", ">": r".+"}.get(t, re.escape(t)) for t in pattern.split(".")]
    return subject.rlike("^" + r"\.".join(tokens) + "$")


def valid_subject(subject: Column) -> Column:
    """Dot-separated tokens of letters, digits, - _ * > $, none of them empty."""
    return subject.rlike(r"\A[A-Za-z0-9_\-*>$]+(?:\.[A-Za-z0-9_\-*>$]+)*\z")


def valid_name(name: Column) -> Column:
    """A stream's or consumer's name: 1 to 255 letters, digits, - and _."""
    return name.rlike(r"\A[A-Za-z0-9_-]{1,255}\z")


def glob_regex(pattern: str) -> str:
    """The regular expression of a glob: * any text, ? one character, [..] and [^..] classes, \\ makes the next one plain."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and (end := pattern.find("]", i + 2)) > 0:
            inner = pattern[i + 1 : end].replace("\\", "\\\\").replace("[", "\\[")
            out, i = f"{out}[{inner}]", end
        elif c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)\\A{out}\\z"


def routed(messages: DataFrame, channel: str, subscriptions: dict[str, str]) -> DataFrame:
    """A row for each message and each subscriber (name: glob) whose pattern fits its channel; the channel stays as it is."""
    fits = F.array(*(F.when(F.col(channel).rlike(glob_regex(p)), F.lit(name)) for name, p in subscriptions.items()))
    return messages.withColumn("subscriber", F.explode(F.array_compact(fits)))


def deduplicated(messages: DataFrame, message_id: str, at: str, window: str) -> DataFrame:
    """The first message of each id within the window; messages without an id all stay."""
    with_id = messages.where(F.col(message_id).isNotNull()).withWatermark(at, window).dropDuplicatesWithinWatermark([message_id])
    return with_id.unionByName(messages.where(F.col(message_id).isNull()).withWatermark(at, window))


def read_available(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Runs a stream over all that is there now, into a table of the shared folder, and reads that."""
    path = new_folder(spark, "stream")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
