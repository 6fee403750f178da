"""JSON Schema checks over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.functions.json_schema import Registry, conforms, violations

from .tables import query, spread, table

PROPS = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 20, "maximum": 79, "oneOf": [{"multipleOf": 2}, {"exclusiveMaximum": 50}]}}, "additionalProperties": False}
PART = {
    "$defs": {"size": {"type": "integer", "minimum": 5, "maximum": 40}},
    "type": "object", "required": ["name", "brand", "size", "tags"],
    "properties": {"name": {"type": "string", "minLength": 4, "maxLength": 60}, "brand": {"pattern": "^Brand#[1-3]"}, "size": {"$ref": "#/$defs/size"}, "tags": {"type": "array", "items": {"type": "string"}, "minItems": 2, "uniqueItems": True}},
}


@query("SELECT event_id, k BETWEEN 20 AND 79 AND (k % 2 = 0) <> (k < 50) AS valid FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def json_schema_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events"), "event_id").select("event_id", conforms(F.col("props"), PROPS).alias("valid"))


@query("SELECT p_partkey, length(p_name) BETWEEN 4 AND 60 AND regexp_matches(p_brand, '^Brand#[1-3]') AND p_size BETWEEN 5 AND 40 AND p_brand <> p_type AS valid FROM part")
def json_schema_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.array("p_brand", "p_type").alias("tags")))
    return spread(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", conforms(doc, PART).alias("valid"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (k >= 50) AS n_valid, min(event_id) FILTER (k < 50) AS first_invalid FROM (SELECT event_type, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type")
def json_schema_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's report: how many are valid, and the first that isn't."""
    checked = spread(table(spark, sf_dir, "events"), "event_id").select("event_type", "event_id", conforms(F.col("props"), {"properties": {"k": {"minimum": 50}}}).alias("ok"))
    return checked.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_valid"), F.min(F.when(~F.col("ok"), F.col("event_id"))).alias("first_invalid"))


_ID = "substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4) || CASE WHEN event_id % 3 = 0 THEN '' ELSE '-' END || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12)"


@query(f"SELECT event_id, {_ID} AS id, event_id % 3 <> 0 AS uuid, event_id % 40 BETWEEN 1 AND 31 AS day, event_id % 300 < 256 AS ip, event_id % 2 = 0 AS mail FROM events")
def js_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats where they assert: a uuid with or without one of its hyphens, dates, addresses."""
    k = F.col("event_id")
    ident = F.regexp_replace(F.md5(k.cast("string")), "^(.{8})(.{4})(.{4})(.{4})", F.when(k % 3 == 0, "$1-$2$3-$4-").otherwise("$1-$2-$3-$4-"))
    texts = {"uuid": ident, "day": F.concat(F.lit("2024-02-"), F.lpad((k % 40).cast("string"), 2, "0")), "ip": F.concat(F.lit("10.0.0."), (k % 300).cast("string")), "mail": F.concat(F.when(k % 2 == 0, "me").otherwise("a@b"), F.lit("@example.org"))}
    formats = {"uuid": "uuid", "day": "date", "ip": "ipv4", "mail": "email"}
    return spread(table(spark, sf_dir, "events"), "event_id").select("event_id", ident.alias("id"), *(conforms(F.to_json(F.struct(t.alias("x"))), {"properties": {"x": {"format": formats[n]}}}, formats=True).alias(n) for n, t in texts.items()))


@query("""SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view') THEN 'not_registered' WHEN event_id % 5 = 0 THEN 'not_json'
  WHEN (event_type = 'click' AND (k < 30 OR k % 2 = 0)) OR (event_type = 'view' AND k >= 50) THEN 'valid' ELSE 'invalid' END AS result
FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def js_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text is valid if one revision of its type takes it."""
    r = Registry()
    r.apply({"click": [{"properties": {"k": {"exclusiveMaximum": 30}}}], "view": [False]})
    r.merge({"click": [*r.types["click"], {"properties": {"k": {"multipleOf": 2}}}], "view": [{"properties": {"k": {"minimum": 50}}}]})
    text = F.when(F.col("event_id") % 5 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return spread(table(spark, sf_dir, "events"), "event_id").select("event_id", r.result(F.col("event_type"), text).alias("result"))


@query("""SELECT event_id, concat_ws(',', CASE WHEN k < 20 THEN '/properties/k/minimum@/k' END, CASE WHEN k > 79 THEN '/properties/k/maximum@/k' END, CASE WHEN (k % 2 = 0) = (k < 50) THEN '/properties/k/oneOf@/k' END) AS found
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def js_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = violations(F.col("props"), PROPS)
    return spread(table(spark, sf_dir, "events"), "event_id").select("event_id", F.array_join(F.transform(found, lambda x: F.concat(x["keyword_location"], F.lit("@"), x["instance_location"])), ",").alias("found"))


@query("SELECT p_partkey, round(p_retailprice * 100) % 5 = 0 AS fives, p_partkey % 2 = 0 AS large FROM part")
def js_exact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that are multiples of 0.05 exactly, and integers told apart beyond double precision."""
    price = F.round("p_retailprice", 2).cast("decimal(18,2)").cast("string")
    big = F.when(F.col("p_partkey") % 2 == 0, "9007199254740993").otherwise("9007199254740992")
    return spread(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", conforms(price, {"multipleOf": 0.05}).alias("fives"), conforms(big, {"const": 9007199254740993}).alias("large"))
