"""Queries on rows that only larger tables have, and the plans that keep their tasks small."""

import duckdb
import pytest
from pyspark.sql import functions as F

from skein.functions import encodings as enc
from skein.operators import keyvalue as kv
from skein.plans import catalog


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_time_spans_of_large_ids(spark, tmp_path):
    spark.sql("SELECT * FROM VALUES (0L), (499L), (1469399L), (3407197L), (4407197L), (5407197L) AS t(event_id)").write.parquet(f"{tmp_path}/events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(db.execute(catalog.oracle_sql()["time_spans"]).fetchall(), key=repr)
    assert rows_of(catalog.queries()["time_spans"](spark, str(tmp_path)).select("event_id", "ms", "minutes")) == want


def test_spans_are_exact(spark):
    spans = spark.sql("SELECT * FROM VALUES (42057987274999997L), (-42057987274999997L), (9223372036854775807L), (CAST(NULL AS BIGINT)) AS t(ns)")
    got = spans.select(*(enc.in_units(F.col("ns"), u) for u in ("us", "ms", "h"))).collect()
    assert list(map(tuple, got)) == [(42057987274999, 42057987274, 11682), (-42057987274999, -42057987274, -11682), (9223372036854775, 9223372036854, 2562047), (None, None, None)]


def test_bit_counts_hold_numbers_only(spark):
    bits = spark.sql("SELECT * FROM VALUES (1, 0L), (1, 63L), (1, 64L), (1, 64L), (1, -1L), (1, -64L), (1, 9223372036854775807L), (2, NULL), (3, NULL), (3, 5L), (NULL, 5L) AS t(k, b)")
    counted = kv.bit_counts(bits, "k", "b")
    assert rows_of(counted) == [(1, 6), (2, 0), (3, 1), (None, 1)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "bitmap" not in plan


@pytest.mark.parametrize("name,times", [("json_schema_built", 1), ("js_violations", 1), ("js_registry", 1), ("js_formats", 4)])
def test_a_text_is_parsed_once_for_each_schema(spark, sf, name, times):
    plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson") == times


def test_rows_of_a_small_file_are_spread(spark, sf):
    assert catalog.queries()["json_schema_built"](spark, sf).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_violations_keep_the_order_of_the_schema(spark):
    from skein.functions.json_schema import violations

    schema = {"$defs": {"s": {"minimum": 3}}, "type": "object", "allOf": [{"minProperties": 2}], "required": ["a"], "properties": {"a": {"$ref": "#/$defs/s", "type": "integer"}, "b": {"properties": {"c": False}}}}
    texts = ['{"a":1.5}', '{"a":5,"b":{"c":1}}', '{"b":7}', "[]", "{", '{"a":3,"b":{}}']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.transform(violations(F.col("t"), schema), lambda x: F.concat(x["keyword_location"], F.lit("@"), x["instance_location"]))).collect()
    want = [["/allOf/0/minProperties@", "/properties/a/$ref/minimum@/a", "/properties/a/type@/a"], ["/properties/b/properties/c@/b/c"], ["/allOf/0/minProperties@", "/required@"], ["/type@"], None, []]
    assert [r[0] for r in got] == want


@pytest.mark.parametrize("name", ["json_schema_props", "json_schema_built", "js_formats", "js_registry", "js_violations", "js_exact_numbers"])
def test_json_rows_of_few_row_groups_are_spread_by_their_key(spark, sf, name):
    df = catalog.queries()[name](spark, sf)
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def test_a_number_is_read_as_a_long_once(spark, sf):
    plan = catalog.queries()["js_violations"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LongType") == 1 and "transform(array(" not in plan


def test_violations_of_odd_numbers_and_texts(spark):
    from skein.functions.json_schema import violations

    schema = {"minimum": 20, "allOf": [{"enum": [21, 22.5, 9007199254740993, [1, {"a": 2}]]}], "oneOf": [{"multipleOf": 2}, {"exclusiveMaximum": 50}]}
    low, one, other = "/minimum", "/oneOf", "/allOf/0/enum"
    cases = {
        "21": [], "22.5": [], "21.0": [], "9007199254740993": [one], "9007199254740992": [other], "19": [low, other], "1e30": [other], "1" * 30: [other, one], '[1.0,{"a":2}]': [one], '[1,{"a":3}]': [other, one], '"x"': [other, one], "null": [other, one],
        "21],[21": None, "21]": None, "[21": None, '21,"v"': None, "21,21": None, "]": None, "": None, " 21 ": [], "21}": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", F.transform(violations(F.col("t"), schema), lambda x: x["keyword_location"]).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == cases


def test_suffixes_are_ordered_as_far_as_the_first_zero():
    import random

    import numpy as np

    from skein.llm.sentencepiece_codec import holds_zero, suffix_array

    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["a" * 200] * 3
    raw = b"\0".join(w.encode() for w in words) + b"\0"
    ended = [raw[i : i + 64].split(b"\0")[0] for i in suffix_array(np.frombuffer(raw, np.uint8), 64).tolist()]
    assert len(ended) == len(raw) and ended == sorted(ended)
    assert holds_zero(np.array([0x0102030405060700, 0x0101010101010180, 0xFF00FFFFFFFFFFFF, 0x8080808080808080], np.uint64)).tolist() == [True, False, True, False]
