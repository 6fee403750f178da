"""Durable streams as tables: sequence numbers, publish replies, and the state of a consumer folded from its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from skein.sources.shared import written


def sequenced(messages: DataFrame, stream: str, order: list[str]) -> DataFrame:
    """messages with seq: from 1 in each stream, by order (which should be without ties).

    Rows are sorted into ranges and written; each file numbers its own, and only the files' counts are summed up by
    stream. So a stream that holds most messages is numbered by as many tasks as it has files.
    """
    sort = [stream, *order]
    files = written(messages.repartitionByRange(*sort).sortWithinPartitions(*sort), "sequenced").withColumn("_file", F.col("_metadata.file_path"))
    own = Window.partitionBy("_file", stream).orderBy(*order)
    counts = files.groupBy(stream, "_file").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    before = Window.partitionBy(stream).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(stream).alias("_stream"), F.col("_file").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = files.withColumn("_place", F.row_number().over(own))
    joined = numbered.join(starts, numbered[stream].eqNullSafe(starts["_stream"]) & (F.col("_file") == F.col("_of")))
    return joined.withColumn("seq", (F.col("_start") + F.col("_place")).cast("long")).select(*messages.columns, "seq")


def publish_replies(messages: DataFrame, stream: str, message_id: str, order: list[str]) -> DataFrame:
    """messages with duplicate and seq: a message whose id came before in its stream is a duplicate and gets the first one's number.

    Messages without an id are never duplicates.
    """
    first = messages.where(F.col(message_id).isNotNull()).groupBy(stream, message_id).agg(F.min(F.struct(*order)).alias("_first"))
    marked = messages.join(first, [stream, message_id], "left").withColumn("duplicate", F.coalesce(F.struct(*order) != F.col("_first"), F.lit(False)))
    marked = written(marked.drop("_first"), "replies")
    stored = sequenced(marked.where(~F.col("duplicate")).drop("duplicate"), stream, order)
    again = marked.where("duplicate").join(stored.where(F.col(message_id).isNotNull()).select(stream, message_id, "seq"), [stream, message_id])
    return stored.withColumn("duplicate", F.lit(False)).unionByName(again.select(*messages.columns, "duplicate", "seq"))


def consumer_state(log: DataFrame, now: Column, ack_wait: int = 30, max_deliver: int = -1, ack_all: bool = False) -> DataFrame:
    """consumer, seq, attempts, state and due of every message that a consumer was given, folded from its log.

    log: consumer, seq, at (seconds, long), op (deliver, ack, nak, term, progress), delay (of a nak, or null). The last op
    counts; of ops at one time the one named last in that list. States: acked, dead (terminated, or due again after
    max_deliver attempts), pending (not due yet), and redeliver. due is when a message may be delivered again. With ack_all an
    ack covers all earlier messages of the consumer. Each message is one combinable aggregate.
    """
    rank = F.when(F.col("op") == "deliver", 0).when(F.col("op") == "ack", 1).when(F.col("op") == "nak", 2).when(F.col("op") == "term", 3).otherwise(4)
    done = F.max(F.when(F.col("op").isin("ack", "term"), F.struct("at", rank.alias("rank"), "op"))).alias("done")
    last = F.max(F.struct("at", rank.alias("rank"), "op", F.coalesce("delay", F.lit(0).cast("long")).alias("delay"))).alias("last")
    own = log.groupBy("consumer", "seq").agg(F.count_if(F.col("op") == "deliver").alias("attempts"), done, last)
    acked = F.col("done.op") == "ack"
    if ack_all:
        top = log.where("op = 'ack'").groupBy("consumer").agg(F.max("seq").alias("top"))
        own = own.join(top, "consumer", "left")
        acked = F.coalesce(acked, F.lit(False)) | F.coalesce(F.col("seq") <= F.col("top"), F.lit(False))
    due = F.col("last.at") + F.when(F.col("last.op") == "nak", F.col("last.delay")).otherwise(ack_wait)
    spent = (F.col("attempts") >= max_deliver) if max_deliver >= 0 else F.lit(False)
    state = F.when(acked, "acked").when(F.col("done.op") == "term", "dead").when(due > now, "pending").when(spent, "dead").otherwise("redeliver")
    own = own.where("attempts > 0").withColumn("state", state)
    return own.select("consumer", "seq", "attempts", "state", F.when(F.col("state").isin("pending", "redeliver"), due).alias("due"))


def batch_size(wanted: Column, buffered: Column, policy: str, at_least: int = 1) -> Column:
    """How many messages a fetch gives at once, or null while it waits for more: policies fill, any_available, at_least."""
    least = {"fill": wanted, "any_available": F.lit(1), "at_least": F.greatest(F.lit(1), F.least(F.lit(at_least), wanted))}[policy]
    return F.when(buffered >= least, F.least(wanted, buffered))
