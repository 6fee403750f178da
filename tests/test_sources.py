"""Errors, nulls and edge cases of sources, decoding, encodings, policies and stores."""

import pytest
from pyspark.sql import functions as F

from skein.functions import encodings as enc, values as val
from skein.functions.decoding import DecodeError, as_logical, decoded
from skein.functions.user import aggregated, register_scalar
from skein.operators import governance, keyvalue as kv
from skein.sources.binding import run_bound, scalar
from skein.sources.inserts import Sink, enforced
from skein.sources.shared import new_folder
from skein.streaming.consumers import sequenced
from skein.streaming.messages import glob_regex


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bound_values_stay_values(spark):
    evil = "'; DROP TABLE x; --"
    assert run_bound(spark, "SELECT {v:String} AS v, '{v:String} $1' AS q", v=evil).first() == (evil, "{v:String} $1")
    assert run_bound(spark, "SELECT $1 + $2 AS s, $1 AS again", 1, 2).first() == (3, 1)
    assert run_bound(spark, "SELECT {n:Int64} IS NULL AS none", n=None).first()[0] is True
    for sql, given in (("SELECT {v:String}", {}), ("SELECT {v:Odd}", {"v": 1}), ("SELECT 1", {"v": 1}), ("SELECT {v:String}", {"v": "a", "w": 1})):
        with pytest.raises(ValueError):
            run_bound(spark, sql, **given)


def test_scalar_is_one_by_one(spark):
    assert scalar(spark.range(1)) == 0
    for df in (spark.range(2), spark.range(0), spark.range(1).select("id", "id")):
        with pytest.raises(ValueError):
            scalar(df)


def test_sink_refuses_nulls_and_keeps_what_was_there(spark):
    schema = spark.sql("SELECT 1L AS id, 'a' AS name").schema
    assert not schema["id"].nullable
    sink = Sink(spark, new_folder(spark, "sink"), schema)
    assert sink.insert(spark.sql("SELECT 'x' AS name, 5L AS id"), token="one").rows == 1
    with pytest.raises(Exception, match="null in name"):
        sink.insert(spark.sql("SELECT 7L AS id, CAST(NULL AS STRING) AS name"), token="two")
    # the token that failed is free again
    assert sink.insert(spark.sql("SELECT 7L AS id, 'y' AS name"), token="two").inserts == 1 and sink.insert(spark.sql("SELECT 7L AS id, 'y' AS name"), token="two").duplicates == 1
    assert rows_of(sink.read()) == [(5, "x"), (7, "y")]
    with pytest.raises(ZeroDivisionError), sink.transaction():
        sink.insert(spark.sql("SELECT 9L AS id, 'z' AS name"))
        raise ZeroDivisionError
    assert sink.read().count() == 2


def test_constraints_raise(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, NULL), (NULL, 'b') AS t(id, name)")
    assert enforced(df, checks={"small": F.col("id") < 5}, unique=[["name"]]).count() == 3
    for rule in ({"not_null": ["id"]}, {"unique": [["id"]]}, {"checks": {"name": F.col("name") == "a"}}, {"references": {"name": df.select("name").where("name = 'a'")}}):
        with pytest.raises(ValueError, match="constraints broken"):
            enforced(df, **rule)


def test_decoding_raises_on_null_and_unnamed_values(spark):
    df = spark.sql("SELECT * FROM VALUES (CAST(0 AS TINYINT), 1.5F, X'FF00'), (CAST(9 AS TINYINT), NULL, NULL) AS t(e, f, b)")
    df = df.select(as_logical(F.col("e"), "e", "enum", names={0: "zero"}), "f", "b")
    assert decoded(df.where("e = 0"), {"e": "string", "f": "float64", "b": "bytes"}).first() == ("zero", 1.5, bytearray(b"\xff\x00"))
    assert decoded(df, {"f": "float32?"}).count() == 2
    for fields, match in (({"e": "string"}, "no name for 9"), ({"f": "float32"}, "f: null")):
        with pytest.raises(Exception, match=match):
            decoded(df, fields).collect()
    for fields in ({"e": "int8"}, {"f": "odd"}, {"none": "string"}):
        with pytest.raises(DecodeError):
            decoded(df, fields)


def test_encodings(spark):
    import base64

    raw = [b"", b"f", b"fo", b"foo", b"foob", b"fooba", b"foobar", b"\x00\xff" * 40, None]
    df = spark.createDataFrame([(x,) for x in raw], "x binary")
    for r in df.select("x", enc.base32_of(F.col("x")).alias("b32"), enc.base64_of(F.col("x")).alias("b64"), enc.base32_bytes(enc.base32_of(F.col("x"))).alias("back"), enc.hex_bytes(enc.hex_of(F.col("x"))).alias("hex")).collect():
        assert r.x is None and r.b32 is None or (r.b32, r.b64) == (base64.b32encode(r.x).decode(), base64.b64encode(r.x).decode()) and r.back == r.x == r.hex
    for f, bad in ((enc.hex_bytes, "abc"), (enc.hex_bytes, "zz"), (enc.base64_bytes, "ab="), (enc.base64_bytes, "a b="), (enc.base32_bytes, "my======"), (enc.base32_bytes, "M")):
        with pytest.raises(Exception, match="not "):
            spark.range(1).select(f(F.lit(bad))).collect()


def test_addresses(spark):
    import ipaddress

    texts = ["::", "::1", "1::", "2001:DB8:0:0:1::1", "1:0:0:2:0:0:0:3", "0:1:0:1:0:1:0:1", "::ffff:1.2.3.4", "fe80::1:0:0:0", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::"]
    bad = ["", ":", ":::", "1:2", "1::2::3", "g::", "12345::", "1:2:3:4:5:6:7:8:9", "::1.2.3", "::256.1.1.1", "1.2.3.4", None]
    df = spark.createDataFrame([(t,) for t in texts + bad], "t string")
    for r in df.select("t", enc.ipv6_bytes(F.col("t")).alias("b"), enc.ipv6_text(enc.ipv6_bytes(F.col("t"))).alias("back")).collect():
        if r.t in bad:
            assert r.b is None and r.back is None, r
        else:
            want = ipaddress.ip_address(r.t)
            text = want.compressed if want.ipv4_mapped is None else "::ffff:102:304"
            assert bytes(r.b) == want.packed and r.back == text, r


def test_strict_numbers(spark):
    df = spark.sql("SELECT * FROM VALUES ('12.30'), ('1.234'), ('1e2'), (''), ('-7'), (NULL) AS t(x)")
    assert [None if r[0] is None else str(r[0]) for r in df.select(enc.decimal_of(F.col("x"), 10, 2)).collect()] == ["12.30", None, None, None, "-7.00", None]
    for width, bad in (("int8", 128), ("uint8", -1), ("uint32", 1 << 32)):
        with pytest.raises(Exception, match="not in"):
            spark.range(1).select(val.in_width(F.lit(bad), width)).collect()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.sql("SELECT 1 div (id - id) FROM range(1)").collect()


def test_policies(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert governance.secured(df, "t", lambda t, c: "ignore" if c == "b" else "allow").first() == (1, None)
    for answer in ("deny", "odd"):
        with pytest.raises(governance.Denied):
            governance.secured(df, "t", lambda t, c: answer)
    assert governance.authorized(spark, "SELECT 5 AS x", {"select"}).first().x == 5
    for sql in ("DROP TABLE IF EXISTS nothing", "SHOW TABLES"):
        with pytest.raises(governance.Denied):
            governance.authorized(spark, sql, {"select", "unknown"})


def test_user_functions(spark):
    register_scalar(spark, "skein_twice", lambda a: a * 2, "long", 1)
    assert [r[0] for r in spark.sql("SELECT skein_twice(id) FROM range(3) ORDER BY id").collect()] == [0, 2, 4]
    with pytest.raises(Exception, match="takes 1 arguments"):
        spark.sql("SELECT skein_twice(id, id) FROM range(3)").collect()
    whole = aggregated(spark.range(10), [], "id", "s", lambda: 0, lambda s, v: s + v, lambda a, b: a + b, float)
    assert whole.collect()[0].s == 45.0


def test_key_value_edges(spark):
    store = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(key, value)")
    writes = spark.sql("SELECT * FROM VALUES (2, 'x', 1), (2, 'y', 2), (3, 'p', 1), (3, 'q', 2) AS t(key, value, at)")
    assert rows_of(kv.set_if_absent(store, writes, "at")) == [(1, "a"), (2, "b"), (3, "p")]
    assert rows_of(kv.set_if_present(store, writes, "at")) == [(1, "a"), (2, "y")]
    assert rows_of(kv.exists_count(spark.sql("SELECT * FROM VALUES (7, 1), (7, 1), (7, 9), (8, 9) AS t(r, key)"), store, "r")) == [(7, 2), (8, 0)]
    text = spark.sql("SELECT 'hello' AS t")
    cut = lambda a, b: text.select(kv.substring_of(F.col("t"), a, b)).first()[0]
    assert (cut(-3, -1), cut(0, -1), cut(1, 2), cut(3, 1), cut(-99, 1), cut(4, 99), cut(9, 12)) == ("llo", "hello", "el", "", "he", "o", "")
    with pytest.raises(Exception, match="not a list"):
        spark.sql("SELECT 'v' AS v, 'string' AS kind").select(kv.of_kind(F.col("v"), F.col("kind"), "list")).collect()
    assert rows_of(kv.delete_keys(store, spark.sql("SELECT 1 AS key"))) == [(2, "b")]


@pytest.mark.parametrize(("glob", "good", "bad"), [("news.*", ["news.a", "news."], ["new.a", "anews.a"]), ("h?llo", ["hello"], ["hllo"]), ("h[ae]llo", ["hallo"], ["hillo"]), ("h[^e]llo", ["hallo"], ["hello"]), (r"a\*b", ["a*b"], ["axb"]), ("a.b", ["a.b"], ["axb"])])
def test_globs(spark, glob, good, bad):
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    assert [r.t for r in df.where(F.col("t").rlike(glob_regex(glob))).collect()] == good


def test_sequence_numbers_of_a_hot_stream(spark):
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("stream"), F.xxhash64("id").alias("at"), "id")
    got = sequenced(df.union(df.limit(0)), "stream", ["at", "id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.stream, []).append((r.seq, r["at"], r.id))
    assert len(got) == 5000 and all([s for s, *_ in sorted(v)] == list(range(1, len(v) + 1)) and [x[1:] for x in sorted(v)] == sorted(x[1:] for x in v) for v in by.values())
