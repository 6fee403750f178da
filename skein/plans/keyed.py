"""Key/value families, change capture, text search, encodings, JSON and streams over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.functions.encodings import base64url, hex_of, ipv4_number, ipv4_text
from skein.operators import changes, keyvalue as kv, search
from skein.streaming.messages import deduplicated, read_available, subject_pattern

from .tables import query, table


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))


@query("SELECT o_orderkey, o_custkey * 2 AS key, c_name AS value, c_custkey IS NOT NULL AS found FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2")
def kv_mget(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("key"))
    return kv.multi_get(asked, _store(spark, sf_dir)).select("o_orderkey", "key", "value", "found")


@query("SELECT o_custkey AS key, arg_max(o_orderstatus, o_orderkey) AS value FROM orders GROUP BY o_custkey UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def kv_mset_lww(spark: SparkSession, sf_dir: str) -> DataFrame:
    writes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("value"), "o_orderkey")
    return kv.upsert(_store(spark, sf_dir), writes, "o_orderkey")


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes of which some hit one key twice; orders tell which came first."""
    return table(spark, sf_dir, "part").select((F.col("p_partkey") - F.col("p_partkey") % 2).alias("key"), F.col("p_name").alias("value"), F.col("p_partkey").alias("at"))


_WRITES = "SELECT p_partkey - p_partkey % 2 AS key, p_name AS value, p_partkey AS place FROM part"


@query(f"SELECT c_custkey AS key, c_name AS value FROM customer UNION ALL SELECT key, arg_min(value, place) FROM ({_WRITES}) WHERE key NOT IN (SELECT c_custkey FROM customer) GROUP BY key")
def kv_setnx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.set_if_absent(_store(spark, sf_dir), _writes(spark, sf_dir), "at")


@query(f"SELECT c_custkey AS key, coalesce(last, c_name) AS value FROM customer LEFT JOIN (SELECT key, arg_max(value, place) AS last FROM ({_WRITES}) GROUP BY key) ON key = c_custkey")
def kv_setxx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.set_if_present(_store(spark, sf_dir), _writes(spark, sf_dir), "at")


@query("SELECT c_custkey AS key FROM customer WHERE c_acctbal < 0 OR c_acctbal > 1000")
def kv_ttl_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("expires_at"))
    return kv.alive(store, F.lit(1000.0)).select("key")


@query("SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_name) - 1 AS rank FROM supplier")
def zset_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.ranked(table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "s_name").select("s_nationkey", "s_name", "rank")


@query("SELECT s_nationkey, s_name, s_acctbal FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_name) = 1")
def zset_popmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.pop_min(table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "s_name")


@query("SELECT l_orderkey, array_to_string((list(l_partkey ORDER BY l_linenumber, l_partkey))[-3:], ',') AS last3 FROM lineitem GROUP BY l_orderkey")
def list_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))["l_partkey"].alias("a"))
    return lists.select("l_orderkey", F.array_join(kv.range_of(F.col("a"), F.lit(-3), F.lit(-1)).cast("array<string>"), ",").alias("last3"))


@query("SELECT user_id, CAST(sum(CASE event_type WHEN 'purchase' THEN 5 WHEN 'error' THEN -1 ELSE 1 END) AS BIGINT) AS counter FROM events GROUP BY user_id")
def kv_incrby(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = F.when(F.col("event_type") == "purchase", 5).when(F.col("event_type") == "error", -1).otherwise(1)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.sum(delta).alias("counter"))


@query("SELECT c_custkey AS key, substr(c_name, 3, 4) AS part, right(c_name, 3) AS tail, left(c_name, length(c_name) - 2) AS head, '' AS none, length(c_name) AS n FROM customer")
def kv_getrange(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    parts = {"part": (2, 5), "tail": (-3, -1), "head": (0, -3), "none": (5, 2)}
    return _store(spark, sf_dir).select("key", *(kv.substring_of(v, *r).alias(k) for k, r in parts.items()), F.length(v).cast("long").alias("n"))


_OLD = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 11 <> 3"
_NEW = "SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 5 = 1 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 7 <> 0"
_DIFF = f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'INSERT' WHEN b.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op,
  coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice FROM ({_OLD}) a FULL JOIN ({_NEW}) b ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of orders: the rows that differ are the feature."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = o.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 5 == 1, 1).otherwise(0))
    return o.where("o_orderkey % 11 <> 3"), new


@query(_DIFF)
def cdc_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.snapshot_diff(*_snapshots(spark, sf_dir), "o_orderkey")


@query(_NEW)
def changeset_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return changes.apply_changes(old, changes.snapshot_diff(old, new, "o_orderkey"), "o_orderkey")


@query(f"SELECT * FROM ({_DIFF}) WHERE op <> 'DELETE' AND o_totalprice > 100000")
def watch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.watched(changes.snapshot_diff(*_snapshots(spark, sf_dir), "o_orderkey"), F.col("o_totalprice") > 100_000)


_TERMS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> '')"


@query(f"SELECT doc_id FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE list_contains(w, 'the') AND (list_contains(w, 'token') OR list_contains(w, 'license')) AND NOT list_contains(w, 'secret')")
def fts_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = search.terms(F.col("text"))
    return table(spark, sf_dir, "documents").where(search.matches(words, ("the",), ("token", "license"), ("secret",))).select("doc_id")


@query(f"""WITH w AS (SELECT doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'software')) AS b FROM w),
s AS (SELECT count(*) AS docs, avg(n) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM t)
SELECT doc_id, round(ln(1 + (docs - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean)) + ln(1 + (docs - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean)), 6) AS score
FROM t, s WHERE a > 0 OR b > 0""")
def fts_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25(table(spark, sf_dir, "documents"), "doc_id", ["license", "software"]).select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT p_partkey, lower(hex(encode(p_name))) AS hexed, rtrim(translate(to_base64(encode(p_name)), '+/', '-_'), '=') AS url64, true AS same FROM part")
def hex_and_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.encode("p_name", "UTF-8")
    return table(spark, sf_dir, "part").select("p_partkey", hex_of(raw).alias("hexed"), base64url(raw).alias("url64"), (F.decode(F.unhex(hex_of(raw)), "UTF-8") == F.col("p_name")).alias("same"))


@query("SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day FROM orders")
def date_day_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))


@query("SELECT o_orderkey, (n >> 24) || '.' || ((n >> 16) & 255) || '.' || ((n >> 8) & 255) || '.' || (n & 255) AS text, n AS back FROM (SELECT o_orderkey, CAST(o_orderkey * 65537 % 4294967296 AS BIGINT) AS n FROM orders)")
def ipv4_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = ipv4_text(F.col("o_orderkey") * 65537 % 4294967296)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"), ipv4_number(text).alias("back"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    m = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")  # as a pattern: a stream's plain path must be a folder
    return m.select("event_id", "user_id", F.concat_ws(".", F.lit("events"), "event_type", (F.col("user_id") % 10).cast("string")).alias("subject"), F.col("ts").cast("timestamp").alias("at"))


@query("SELECT event_id FROM events WHERE event_type = 'click'")
def stream_subject_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_available(spark, _messages(spark, sf_dir).where(subject_pattern(F.col("subject"), "events.click.*")).select("event_id"))


@query("SELECT user_id, 1 AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_available(spark, deduplicated(_messages(spark, sf_dir), "user_id", "at", "60 days").select("user_id")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
