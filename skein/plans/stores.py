"""Queries: inserts, binding, generators, providers, typed decoding, key/value families and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.functions.decoding import as_logical, decoded, refused
from skein.functions.user import aggregated, merged_sum, register_scalar, sum_state
from skein.operators import governance, keyvalue as kv
from skein.sources import binding, generators
from skein.sources.inserts import SchemaMismatch, Sink, Summary, deleted, updated, violations
from skein.sources.shared import new_folder
from skein.streaming import consumers, messages

from .tables import query, table


@query("SELECT range AS number FROM range(7, 1007)")
def numbers_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.numbers(spark, 1000, 7)


@query("SELECT generate_series AS value FROM generate_series(3, -12, -5)")
def series_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.series(spark, 3, -12, -5)


@query("SELECT n, n * n AS square, n_name FROM range(0, 25) t(n) JOIN nation ON n_nationkey = n")
def table_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    squares = generators.provided(spark, generators.Squares, first=0, last=25, parts=3)
    return squares.join(table(spark, sf_dir, "nation"), F.col("n") == F.col("n_nationkey")).select("n", "square", "n_name")


@query("SELECT o_orderkey, '{name:String} $1 ?' AS kept FROM orders WHERE o_orderstatus = 'O' AND o_orderkey <= 5000 AND o_totalprice > 1000.5")
def bind_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT o_orderkey, '{{name:String}} $1 ?' AS kept FROM {orders} WHERE o_orderstatus = {status:String} AND o_orderkey <= {most:Int64} AND o_totalprice > {least:Float64}"
    return binding.run_bound(spark, sql, tables={"orders": table(spark, sf_dir, "orders")}, status="O", most=5000, least=1000.5)


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey = 3")
def bind_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = {"customer": table(spark, sf_dir, "customer")}
    first = binding.run_bound(spark, "SELECT c_custkey FROM {customer} WHERE c_mktsegment = $1 AND c_acctbal > $2", "BUILDING", 100, tables=customers)
    return first.unionAll(binding.run_bound(spark, "SELECT c_custkey FROM {customer} WHERE c_custkey = ?", 3, tables=customers))


@query("SELECT count(*) AS n FROM region")
def scalar_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(F.lit(binding.scalar(table(spark, sf_dir, "region").agg(F.count(F.lit(1))))).alias("n"))


def _orders_sink(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Sink]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders, Sink(spark, new_folder(spark, "orders"), orders.schema)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def insert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches under one token, sent twice: every row is there once."""
    orders, sink = _orders_sink(spark, sf_dir)
    for _ in range(2):
        sink.insert_all((orders.where(F.pmod("o_orderkey", F.lit(3)) == k) for k in range(3)), token="nightly")
    return sink.read()


@query("SELECT count(*) AS rows, 3 AS inserts, 3 AS duplicates FROM orders")
def insert_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, sink = _orders_sink(spark, sf_dir)
    total = Summary()
    for _ in range(2):
        total = total + sink.insert_all((orders.where(F.pmod("o_orderkey", F.lit(3)) == k) for k in range(3)), token="nightly")
    return spark.createDataFrame([(total.rows, total.inserts, total.duplicates)], "rows long, inserts int, duplicates int")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def insert_rolled_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transaction that fails leaves nothing, one that ends leaves all."""
    orders, sink = _orders_sink(spark, sf_dir)
    try:
        with sink.transaction():
            sink.insert(orders.where("o_orderstatus = 'F'"))
            raise InterruptedError
    except InterruptedError:
        pass
    with sink.transaction():
        sink.insert(orders.where("o_orderstatus = 'O'"))
    return sink.read()


@query("SELECT * FROM (VALUES ('added', true), ('omitted', true), ('other order', false), ('re-typed', true), ('untyped null', false)) AS t(rows, refused)")
def insert_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, sink = _orders_sink(spark, sf_dir)
    cases = {"added": orders.withColumn("more", F.lit(1)), "omitted": orders.drop("o_totalprice"), "other order": orders.select("o_totalprice", "o_orderkey", "o_orderstatus"), "re-typed": orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")), "untyped null": orders.withColumn("o_totalprice", F.lit(None))}

    def bad(rows: DataFrame) -> bool:
        try:
            sink.checked(rows)
        except SchemaMismatch:
            return True
        return False

    return spark.createDataFrame([(k, bad(v)) for k, v in cases.items()], "rows string, refused boolean")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE NOT o_orderkey % 10 = 3")
def update_and_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return deleted(updated(orders, F.col("o_orderstatus") == "P", {"o_totalprice": F.lit(0.0)}), F.col("o_orderkey") % 10 == 3).drop("o_orderstatus")


@query("""SELECT * FROM (
SELECT 'check:positive' AS rule, count(*) FILTER (NOT c_acctbal > 0) AS n FROM customer
UNION ALL SELECT 'unique:c_nationkey', count(*) - count(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'references:c_nationkey', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)) WHERE n > 0""")
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select("s_nationkey").distinct()
    return violations(table(spark, sf_dir, "customer"), ["c_custkey"], {"positive": F.col("c_acctbal") > 0}, [["c_custkey"], ["c_nationkey"]], {"c_nationkey": nations})


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey FROM customer")
def redacted_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.secured(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), "customer", lambda t, c: "ignore" if c == "c_name" else "allow")


@query("SELECT * FROM (VALUES ('SELECT 1', 'select'), ('DROP TABLE x', 'drop_table'), ('INSERT INTO x VALUES (1)', 'insert'), ('DELETE FROM x WHERE a = 1', 'delete'), ('CREATE TABLE x (a INT)', 'create_table'), ('SHOW TABLES', 'unknown')) AS t(statement, action)")
def statement_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    statements = ["SELECT 1", "DROP TABLE x", "INSERT INTO x VALUES (1)", "DELETE FROM x WHERE a = 1", "CREATE TABLE x (a INT)", "SHOW TABLES"]
    return spark.createDataFrame([(s, governance.action_of(spark, s)) for s in statements], "statement string, action string")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    status = as_logical((F.col("p_partkey") % 3).cast("tinyint"), "status", "enum", names={0: "new", 1: "open", 2: "closed"})
    fixed = as_logical(F.rpad(F.substr("p_brand", F.lit(1), F.lit(8)), 12, "\0"), "brand", "fixed(12)")
    return p.select(as_logical(F.col("p_partkey"), "key", "uint32"), "p_size", F.col("p_retailprice").cast("float").alias("price"), status, fixed, F.when(F.col("p_size") > 10, F.col("p_size")).alias("large"), F.date_from_unix_date("p_size").alias("day"), F.array("p_partkey").alias("keys"))


@query("SELECT p_partkey AS key, p_size, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price, CASE p_partkey % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'open' ELSE 'closed' END AS status, substr(p_brand, 1, 8) AS brand, CASE WHEN p_size > 10 THEN p_size END AS large FROM part")
def decode_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(_typed(spark, sf_dir), {"key": "uint32", "p_size": "int32", "price": "float64", "status": "string", "brand": "string", "large": "int32?"})


@query("SELECT * FROM (VALUES ('same width', false), ('wider', true), ('other sign', true), ('no width', true), ('double from float', false), ('float from double', true), ('missing', true), ('instant from date', false), ('array', false), ('array of another width', true)) AS t(rule, refused)")
def decode_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = {"same width": {"p_size": "int32"}, "wider": {"p_size": "int64"}, "other sign": {"key": "int64"}, "no width": {"p_size": "int"}, "double from float": {"price": "float64"}, "float from double": {"cost": "float32"}, "missing": {"other": "string"}, "instant from date": {"day": "instant"}, "array": {"keys": "array<int64>"}, "array of another width": {"keys": "array<int32>"}}
    rows = _typed(spark, sf_dir).withColumn("cost", F.lit(1.0).cast("double"))
    return spark.createDataFrame([(k, refused(rows, v)) for k, v in cases.items()], "rule string, refused boolean")


@query("SELECT n_nationkey, round(n_nationkey / 2.0 + length(n_name), 2) AS v FROM nation")
def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_scalar(spark, "skein_half_plus", lambda a, b: a / 2.0 + b.str.len(), "double", 2)
    return table(spark, sf_dir, "nation").select("n_nationkey", F.round(F.call_function("skein_half_plus", "n_nationkey", "n_name"), 2).alias("v"))


@query("SELECT n_regionkey, CAST(product(n_nationkey + 1) AS DOUBLE) AS p FROM nation GROUP BY n_regionkey UNION ALL SELECT NULL, 1.0")
def udaf_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's product by group; over no rows at all it is still finished, to 1."""
    rule = {"zero": lambda: 1.0, "step": lambda s, v: s * v, "merge": lambda a, b: a * b, "finish": lambda s: s}
    rows = table(spark, sf_dir, "nation").withColumn("v", (F.col("n_nationkey") + 1).cast("double"))
    by = aggregated(rows, ["n_regionkey"], "v", "p", **rule)
    return by.unionByName(aggregated(rows.where("false"), [], "v", "p", **rule).withColumn("n_regionkey", F.lit(None).cast("int")))


@query("SELECT l_returnflag, CAST(sum(l_partkey) AS BIGINT) AS total FROM lineitem GROUP BY l_returnflag")
def sum_states_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by day kept as states of eight bytes, merged later."""
    states = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_shipdate").agg(sum_state(F.sum("l_partkey")).alias("state"))
    return states.groupBy("l_returnflag").agg(merged_sum(F.col("state")).alias("total"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.percentile("value", F.lit(0.5)), 6).alias("p50"), F.round(F.percentile("value", F.lit(0.99)), 6).alias("p99"))


@query("SELECT l_orderkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_orderkey")
def bitmap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.bit_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("SELECT event_type, true AS close FROM events GROUP BY event_type")
def hll_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates of different users, merged from daily sketches, within a tenth of the exact number."""
    e = table(spark, sf_dir, "events")
    daily = kv.distinct_estimates(e.withColumn("k", F.concat_ws("|", "event_type", F.to_date("ts").cast("string"))), "k", "user_id").withColumn("event_type", F.substring_index("k", "|", 1))
    exact = e.groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    return kv.merged_estimates(daily, "event_type").join(exact, "event_type").select("event_type", (F.abs(F.col("n") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"))


def _hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_regionkey").alias("key"), F.col("n_name").alias("field"), F.col("n_nationkey").cast("long").alias("value"))


@query("SELECT n_regionkey AS key, max(CASE WHEN n_name = 'CANADA' THEN n_nationkey END)::BIGINT AS canada, CAST(NULL AS BIGINT) AS missing, max(CASE WHEN n_name = 'CHINA' THEN n_nationkey END)::BIGINT AS china FROM nation GROUP BY n_regionkey")
def hash_mget(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = kv.hash_mget(_hashes(spark, sf_dir), ["CANADA", "no such field", "CHINA"])
    return got.select("key", *(F.get("values", F.lit(i)).alias(n) for i, n in enumerate(("canada", "missing", "china"))))


@query("SELECT n_regionkey AS key, count(*)::INTEGER AS n, string_agg(n_name || '=' || CAST(n_nationkey + CASE WHEN n_nationkey % 2 = 0 THEN 100 ELSE 0 END AS VARCHAR), ',' ORDER BY n_name) AS listed FROM nation GROUP BY n_regionkey")
def hash_get_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashes(spark, sf_dir)
    writes = h.where("value % 2 = 0").select("key", "field", (F.col("value") + 100).alias("value"), F.lit(2).alias("at")).unionAll(h.where("value % 2 = 0").select("key", "field", F.lit(-1).cast("long"), F.lit(1)))
    got = kv.hash_get_all(kv.hash_set(h, writes, "at"))
    return got.select("key", "n", F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("listed"))


@query("SELECT n_regionkey AS key, n_name AS field, (n_nationkey + CASE WHEN n_nationkey < 10 THEN 7 ELSE 0 END)::BIGINT AS value FROM nation UNION ALL SELECT 99, 'new', 7")
def hash_incrby(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashes(spark, sf_dir)
    deltas = h.where("value < 10").select("key", "field", F.lit(4).alias("delta")).unionAll(h.where("value < 10").select("key", "field", F.lit(3))).unionAll(spark.sql("SELECT 99, 'new', 7"))
    return kv.hash_increment(h, deltas)


@query("SELECT o_custkey AS request, count(c_custkey) AS n FROM (SELECT o_custkey, o_custkey * 2 AS k FROM orders) LEFT JOIN customer ON c_custkey = k GROUP BY o_custkey")
def kv_exists_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("request"), (F.col("o_custkey") * 2).alias("key"))
    return kv.exists_count(asked, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), "request")


def _expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal")).alias("expires_at"))


@query("SELECT k AS key, CASE WHEN c_custkey IS NULL OR (c_acctbal >= 0 AND floor(c_acctbal) <= 1000) THEN -2 WHEN c_acctbal < 0 THEN -1 ELSE CAST(floor(c_acctbal) AS BIGINT) - 1000 END AS ttl FROM (SELECT p_partkey * 2 AS k FROM part) LEFT JOIN customer ON c_custkey = k")
def kv_ttl_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "part").select((F.col("p_partkey") * 2).alias("key"))
    return kv.ttl_state(asked, _expiring(spark, sf_dir), F.lit(1000))


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 77 WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS expires_at FROM customer")
def kv_expire_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _expiring(spark, sf_dir)
    store = kv.expire(store, store.where("key % 3 = 0"), None)
    return kv.expire(store, store.where("key % 3 = 1"), F.lit(77))


@query("SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 1 ELSE c_custkey END AS key, c_name AS value FROM customer WHERE c_custkey % 5 <> 1")
def kv_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that end in 0 or 5 take the place of the next one."""
    store = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))
    return kv.rename_keys(store, store.where("key % 5 = 0").select("key", (F.col("key") + 1).alias("new")))


@query("SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_name) - 1 AS rank FROM supplier QUALIFY rank BETWEEN 1 AND 3")
def zset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.rank_range(table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "s_name", 1, 3).select("s_nationkey", "s_name", "rank")


@query("SELECT o_orderkey AS key, o_custkey AS member, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey = o_custkey) AS is_member FROM orders")
def set_is_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_suppkey").alias("member"))
    return kv.set_members(sets, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("member")))


_KM = "2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 48.0) / 2), 2) + cos(radians(48.0)) * cos(radians(lat)) * pow(sin(radians(lon - 11.0) / 2), 2)))"


@query(f"SELECT key, round({_KM}, 3) AS km FROM (SELECT c_custkey AS key, c_custkey % 180 - 90 AS lat, c_custkey % 359 - 179 AS lon FROM customer) WHERE {_KM} <= 3000")
def geo_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 180 - 90).cast("double").alias("lat"), (F.col("c_custkey") % 359 - 179).cast("double").alias("lon"))
    return kv.within_km(places, 48.0, 11.0, 3000.0).select("key", F.round("km", 3).alias("km"))


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq FROM events")
def stream_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumers.sequenced(table(spark, sf_dir, "events").select("event_type", "ts", "event_id"), "event_type", ["ts", "event_id"]).select("event_id", "seq")


_IDS = "SELECT event_id, event_type, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id % 40 END AS mid FROM events"


@query(f"""WITH e AS ({_IDS}), d AS (SELECT *, mid IS NOT NULL AND row_number() OVER (PARTITION BY event_type, mid ORDER BY ts, event_id) > 1 AS duplicate FROM e),
s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq FROM d WHERE NOT duplicate)
SELECT event_id, duplicate, seq FROM s UNION ALL SELECT d.event_id, true, s.seq FROM d JOIN s ON s.event_type = d.event_type AND s.mid = d.mid WHERE d.duplicate""")
def publish_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.when(F.col("event_id") % 4 != 0, F.col("user_id") % 40).alias("mid"))
    return consumers.publish_replies(e, "event_type", "mid", ["ts", "event_id"]).select("event_id", "duplicate", "seq")


_OPS = "SELECT event_type AS consumer, user_id AS seq, epoch_us(ts) // 1000000 AS tm, CASE event_id % 7 WHEN 0 THEN 'ack' WHEN 1 THEN 'nak' WHEN 2 THEN 'term' WHEN 3 THEN 'progress' ELSE 'deliver' END AS op, CASE WHEN event_id % 7 = 1 THEN user_id * 100 ELSE 0 END AS delay FROM events"
_STATE = """WITH o AS ({ops}), r AS (SELECT *, CASE op WHEN 'deliver' THEN 0 WHEN 'ack' THEN 1 WHEN 'nak' THEN 2 WHEN 'term' THEN 3 ELSE 4 END AS k FROM o),
g AS (SELECT consumer, seq, count(*) FILTER (op = 'deliver') AS attempts, max(struct_pack(tm := tm, k := k, op := op)) FILTER (op IN ('ack', 'term')) AS done,
  max(struct_pack(tm := tm, k := k, op := op, delay := delay)) AS l FROM r GROUP BY consumer, seq),
t AS (SELECT consumer, max(seq) AS top FROM o WHERE op = 'ack' GROUP BY consumer),
d AS (SELECT g.*, top, l.tm + CASE WHEN l.op = 'nak' THEN l.delay ELSE 86400 END AS due0 FROM g LEFT JOIN t ON t.consumer = g.consumer WHERE attempts > 0),
s AS (SELECT *, CASE WHEN {acked} THEN 'acked' WHEN done.op = 'term' THEN 'dead' WHEN due0 > 1706486400 THEN 'pending' WHEN attempts >= 6 THEN 'dead' ELSE 'redeliver' END AS state FROM d)
SELECT consumer, seq, attempts, state, CASE WHEN state IN ('pending', 'redeliver') THEN due0 END AS due FROM s"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 7
    op = F.when(k == 0, "ack").when(k == 1, "nak").when(k == 2, "term").when(k == 3, "progress").otherwise("deliver")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("consumer"), F.col("user_id").alias("seq"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), op.alias("op"), F.when(k == 1, F.col("user_id") * 100).otherwise(0).alias("delay"))


@query(_STATE.format(ops=_OPS, acked="done.op = 'ack'"))
def consumer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks, delayed naks, terminations, progress and a limit of six deliveries; now is 2024-01-29."""
    return consumers.consumer_state(_log(spark, sf_dir), F.lit(1706486400), 86400, 6)


@query(_STATE.format(ops=_OPS.replace("WHEN 0 THEN 'ack'", "WHEN 0 THEN CASE WHEN user_id < 20 THEN 'ack' ELSE 'deliver' END"), acked="coalesce(done.op = 'ack', false) OR coalesce(seq <= top, false)"))
def consumer_ack_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("op", F.when((F.col("op") == "ack") & (F.col("seq") >= 20), "deliver").otherwise(F.col("op")))
    return consumers.consumer_state(log, F.lit(1706486400), 86400, 6, ack_all=True)


@query("SELECT wanted, buffered, CASE WHEN buffered >= wanted THEN wanted END AS fill, CASE WHEN buffered >= 1 THEN least(wanted, buffered) END AS anything, CASE WHEN buffered >= greatest(1, least(5, wanted)) THEN least(wanted, buffered) END AS five FROM (SELECT user_id % 10 + 1 AS wanted, event_id % 13 AS buffered FROM events)")
def fetch_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10 + 1).alias("wanted"), (F.col("event_id") % 13).alias("buffered"))
    a, b = F.col("wanted"), F.col("buffered")
    return e.select("wanted", "buffered", consumers.batch_size(a, b, "fill").alias("fill"), consumers.batch_size(a, b, "any_available").alias("anything"), consumers.batch_size(a, b, "at_least", 5).alias("five"))


_NAMES = "SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || '.' || user_id WHEN 1 THEN event_type || '..' || user_id WHEN 2 THEN event_type || '.>' ELSE event_type || '-' || user_id || ' x' END AS s FROM events"


@query(f"SELECT event_id, event_id % 4 IN (0, 2) AS subject_ok, false AS name_ok, s LIKE 'c%' AS by_glob FROM ({_NAMES})")
def subject_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t, u = F.col("event_id") % 4, F.col("event_type"), F.col("user_id").cast("string")
    s = F.when(k == 0, F.concat(t, F.lit("."), u)).when(k == 1, F.concat(t, F.lit(".."), u)).when(k == 2, F.concat(t, F.lit(".>"))).otherwise(F.concat(t, F.lit("-"), u, F.lit(" x")))
    return table(spark, sf_dir, "events").select("event_id", messages.valid_subject(s).alias("subject_ok"), messages.valid_name(s).alias("name_ok"), s.rlike(messages.glob_regex("c*")).alias("by_glob"))


@query("""SELECT event_id, event_type AS channel, 'all' AS subscriber FROM events UNION ALL SELECT event_id, event_type, 'c or e' FROM events WHERE event_type IN ('click', 'error')
UNION ALL SELECT event_id, event_type, 'view' FROM events WHERE event_type = 'view'""")
def channel_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("channel"))
    return messages.routed(m, "channel", {"all": "*", "c or e": "[ce][lr]*", "view": "v?ew"})
