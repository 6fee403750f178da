"""Scans, filters, top-k, aggregates, joins, arrays and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import query, table


@query("""
SELECT n_name, count(*) AS n_items, sum(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT)) AS revenue_e4
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
""")
def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 10000)).cast("long").alias("r"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    by = joined.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_items"), F.sum("r").alias("revenue_e4"))
    return by.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n_items", "revenue_e4")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT 100000")
def select_orderby_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    return table(spark, sf_dir, "events").where("event_type = 'click'").orderBy(F.desc("ts"), "event_id").limit(100_000).select("event_id", "user_id")


@query("SELECT user_id, count(*) AS c FROM events GROUP BY user_id ORDER BY c DESC, user_id LIMIT 10000")
def select_groupby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "user_id").limit(10_000)


@query("SELECT event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def select_where_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    return table(spark, sf_dir, "events").join(rich, "user_id", "left_semi").select("event_id")


@query("SELECT event_id, user_id, event_type FROM events")
def select_full_scan_proj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")


@query("SELECT event_type, CAST(round(sum(value * 100)) AS BIGINT) // count(*) AS mean_cents FROM events GROUP BY event_type")
def select_lc_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.sum(F.col("value") * 100)).cast("long").alias("s"), F.count(F.lit(1)).alias("n"))
    return by.selectExpr("event_type", "s div n AS mean_cents")


@query("SELECT count(*) AS n FROM documents WHERE text LIKE '%abc%'")
def select_string_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("text").like("%abc%")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey = 7")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey = 7").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id LIMIT 1000")
def kind_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").orderBy(F.desc("ts"), "event_id").limit(1000).select("event_id")


@query("SELECT event_id * 2 AS doubled, upper(event_type) AS kind, event_type || '.' || CAST(user_id % 10 AS VARCHAR) AS subject, CASE WHEN value > 10 THEN 'high' ELSE 'low' END AS level, user_id // 7 AS sevenths FROM events")
def computed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id * 2 AS doubled", "upper(event_type) AS kind", "concat(event_type, '.', string(user_id % 10)) AS subject", "if(value > 10, 'high', 'low') AS level", "user_id div 7 AS sevenths")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))


@query("SELECT l_orderkey FROM (SELECT l_orderkey, list(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_orderkey) WHERE list_contains(parts, 42)")
def array_has_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).where(F.array_contains("parts", 42)).select("l_orderkey")


@query("SELECT DISTINCT l_orderkey, l_partkey FROM lineitem")
def array_join_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("l_orderkey", F.explode("parts").alias("l_partkey"))


@query("SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS listed FROM lineitem GROUP BY l_orderkey")
def array_string_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("a")).select("l_orderkey", F.size("a").cast("long").alias("n"), F.array_join(F.transform("a", lambda x: x.cast("string")), ",").alias("listed"))


@query("SELECT n_nationkey, n_name AS looked_up, 2 AS n, 'key,name' AS keys FROM nation")
def map_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", F.create_map(F.lit("name"), F.col("n_name"), F.lit("key"), F.col("n_nationkey").cast("string")).alias("m")).select("n_nationkey", F.col("m")["name"].alias("looked_up"), F.size("m").alias("n"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"))


@query("SELECT o_orderkey, factor FROM orders JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 3)) AS r(priority, factor) ON o_orderpriority = priority")
def join_inner_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = spark.sql("SELECT * FROM VALUES ('1-URGENT', 5), ('2-HIGH', 3) AS r(priority, factor)")  # two rows
    return table(spark, sf_dir, "orders").join(F.broadcast(rates), F.col("o_orderpriority") == F.col("priority")).select("o_orderkey", "factor")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_anti_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(pending, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_discount > 0.05) AS n_if, CAST(sum(l_linenumber) AS BIGINT) AS total, CAST(coalesce(sum(CASE WHEN l_quantity > 1000 THEN l_linenumber END), 0) AS BIGINT) AS none FROM lineitem GROUP BY l_returnflag")
def agg_counts_and_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("n_if"), F.sum("l_linenumber").alias("total"),
        F.coalesce(F.sum(F.when(F.col("l_quantity") > 1000, F.col("l_linenumber"))), F.lit(0).cast("long")).alias("none"),
    )


@query("SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY l_linestatus")
def agg_totals_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    both = items.groupingSets([[items.l_linestatus], []], items.l_linestatus).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    return both.where("g = 0").select("l_linestatus", "n")


@query("SELECT n_regionkey, CAST(product(n_nationkey + 1) AS BIGINT) AS p, string_agg(n_name, ';' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
def udaf_product_and_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.product(F.col("n_nationkey") + 1).cast("long").alias("p"), F.array_join(F.sort_array(F.collect_list("n_name")), ";").alias("names"))


@query("SELECT p_partkey FROM part WHERE lower(p_brand) = 'brand#4' ORDER BY lower(p_name), p_partkey")
def collation_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_brand COLLATE UTF8_LCASE = 'bRAND#4'").selectExpr("p_partkey", "p_name COLLATE UTF8_LCASE AS k").orderBy("k", "p_partkey").select("p_partkey")


@query("SELECT c_nationkey AS k, 'c' AS kind FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.lit("c").alias("kind")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("s").alias("kind"))
    return a.unionByName(b)


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, sf_dir, "events").select(F.col("user_id").alias("k")))


@query("SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size > 10")
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey").subtract(table(spark, sf_dir, "part").where("p_size > 10").select("p_partkey"))
