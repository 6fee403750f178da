"""JSON Schema expressions against cases with known verdicts."""

import pytest
from pyspark.sql import functions as F

from skein.functions.json_schema import conforms

#: schema, texts that are valid, texts that are not
CASES = [
    (True, ["1", "null", "{}", ' [1, {"v": 2}] '], ["{", "", None, "{}}", "1 2", "1,2", "1} x", '1,"w":2', '1,"v":2', "[1]]", "null x"]),
    (False, [], ["1", "null"]),
    ({"type": "integer"}, ["1", "1.0", "-3"], ["1.5", '"1"', "null", "true"]),
    ({"type": ["string", "null"]}, ['"a"', "null"], ["1", "[]"]),
    ({"const": {"a": [1, None]}}, ['{"a":[1,null]}', '{"a":[1.0,null]}'], ['{"a":[1]}', '{"a":[1,null],"b":1}', "1"]),
    ({"enum": [1, "x", False]}, ["1", '"x"', "false"], ["0", '"y"', "true", "null"]),
    ({"minimum": 2, "exclusiveMaximum": 5, "multipleOf": 0.5}, ["2", "4.5", '"text"'], ["1", "5", "2.25"]),
    ({"minLength": 2, "maxLength": 3, "pattern": "b"}, ['"ab"', '"éb"', "7"], ['"b"', '"abcd"', '"aa"']),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, ["[]", '["a"]', '["a",1,2]', "{}"], ["[1]", '["a","b"]']),
    ({"uniqueItems": True, "minItems": 1, "maxItems": 3}, ["[1,2]", '[{"a":1},{"a":2}]'], ["[]", "[1,1]", "[1,2,3,4]"]),
    ({"contains": {"type": "null"}, "maxContains": 1}, ["[null,1]"], ["[1]", "[null,null]"]),
    ({"required": ["a"], "properties": {"a": {"type": "null"}}, "additionalProperties": {"type": "integer"}}, ['{"a":null}', '{"a":null,"b":1}', "3"], ["{}", '{"a":1}', '{"a":null,"b":"x"}']),
    ({"patternProperties": {"^n_": {"type": "number"}}, "additionalProperties": False}, ["{}", '{"n_a":1}'], ['{"n_a":"x"}', '{"b":1}']),
    ({"propertyNames": {"maxLength": 2}, "minProperties": 1}, ['{"ab":1}'], ["{}", '{"abc":1}']),
    ({"dependentRequired": {"a": ["b"]}, "dependentSchemas": {"c": {"maxProperties": 1}}}, ['{"b":1}', '{"a":1,"b":2}', '{"c":1}'], ['{"a":1}', '{"c":1,"b":2}']),
    ({"if": {"type": "string"}, "then": {"minLength": 1}, "else": {"not": {"const": 0}}}, ['"a"', "1"], ['""', "0"]),
    ({"anyOf": [{"minimum": 5}, {"type": "string"}], "allOf": [{"not": {"const": "no"}}]}, ["7", '"a"'], ["1", '"no"']),
    ({"multipleOf": 0.01}, ["19.99", "4.35", "0.07", "1e2"], ["0.075"]),
    ({"const": 9007199254740993}, ["9007199254740993"], ["9007199254740992", "9007199254740993.5"]),
    ({"type": "integer"}, ["1" * 30, "1e50", "1" * 54], ["1.5e0"]),
    ({"pattern": r"^\p{Letter}+$"}, ['"héllo"'], ['"a1"', '"a\\n"']),
    ({"pattern": r"[[&]\s$"}, ['"[ "', '"&\\u00a0"'], ['"x "']),
    ({"$defs": {"a%b": {"minimum": 3}}, "$ref": "#/$defs/a%25b"}, ["3"], ["2"]),
    ({"$defs": {"x": {"$anchor": "here", "type": "string"}}, "$ref": "#here"}, ['"a"'], ["2"]),
    ({"$id": "http://a.example/root", "$defs": {"x": {"$id": "sub", "$defs": {"y": {"type": "null"}}}}, "$ref": "http://a.example/sub#/$defs/y"}, ["null"], ["2"]),
    ({"properties": {"a": True}, "allOf": [{"properties": {"b": True}}], "unevaluatedProperties": False}, ['{"a":1,"b":2}', "{}", "1"], ['{"c":1}']),
    ({"anyOf": [{"properties": {"a": {"const": 1}}, "required": ["a"]}, {"patternProperties": {"^x": True}}], "unevaluatedProperties": {"type": "string"}}, ['{"a":1,"x1":2}', '{"a":"s"}', '{"x":1}'], ['{"a":2}', '{"a":1,"b":2}']),
    ({"if": {"properties": {"k": {"const": 1}}, "required": ["k"]}, "then": {"properties": {"l": True}}, "unevaluatedProperties": False}, ['{"k":1,"l":1}'], ['{"k":2}', '{"l":1}']),
    ({"prefixItems": [True], "contains": {"type": "string"}, "unevaluatedItems": {"type": "null"}}, ['[1,"a",null]', '["a"]'], ['[1,"a",2]', "[1]"]),
    ({"$dynamicAnchor": "n", "$defs": {"t": {"$dynamicAnchor": "m", "type": "integer"}}, "properties": {"v": {"$dynamicRef": "#m"}}}, ['{"v":1}'], ['{"v":"a"}']),
    ({"$defs": {"p/q": {"oneOf": [{"minimum": 3}, {"maximum": 5}]}}, "$ref": "#/$defs/p~1q"}, ["1", "9"], ["4"]),
]


@pytest.mark.parametrize("schema,good,bad", CASES, ids=[str(i) for i in range(len(CASES))])
def test_verdicts(spark, schema, good, bad):
    rows = spark.createDataFrame([(t, t in good) for t in good + bad], "text string, expected boolean")
    wrong = rows.where(conforms(F.col("text"), schema) != F.col("expected"))
    assert [r.text for r in wrong.collect()] == []


@pytest.mark.parametrize("schema", [{"$ref": "#"}, {"properties": {"a": {"$ref": "#"}}}, {"$ref": "http://elsewhere/x"}, {"$ref": "#/$defs/none"}, {"$ref": "#none"}, {"pattern": "["}, {"$vocabulary": {"http://elsewhere/v": True}}])
def test_what_is_not_covered_raises(spark, schema):
    with pytest.raises(ValueError):
        conforms(F.col("text"), schema)


FORMAT_CASES = {
    "date": (["2024-02-31"], ["2024-13-01", "24-01-01", "2024-01-01x"]), "time": (["23:59:60Z", "00:00:00"], ["24:00:00", "1:00:00"]), "date-time": (["2024-01-01t00:00:00Z"], ["2024-01-01 00:00:00", "2024-01-01"]),
    "duration": (["P1Y", "PT5M"], ["1Y", "P", "P1y"]), "email": (["a@b.c"], ["a@b", "@b.c", "a@b.", "a@b@c.d"]), "hostname": (["a-b.example"], ["", "a_b", "é"]), "ipv4": (["1.2.3.4", "010.0.0.255"], ["1.2.3", "1.2.3.256", "1.2.3.4."]),
    "ipv6": (["::1"], [":", "g::"]), "uri": (["http://x", "urn:a"], ["x", "1:a"]), "uri-reference": (["a/b"], ["a b"]), "uuid": (["12345678-1234-1234-1234-123456789abc"], ["123456781234-1234-1234-123456789abc"]),
    "json-pointer": (["", "/a~0~1"], ["a", "/~2", "/~"]), "relative-json-pointer": (["0/a"], ["/a"]), "other": (["anything"], []),
}


@pytest.mark.parametrize("name", FORMAT_CASES)
def test_formats(spark, name):
    import json

    good, bad = FORMAT_CASES[name]
    rows = spark.createDataFrame([(json.dumps(t), t in good) for t in good + bad], "text string, expected boolean")
    assert [r.text for r in rows.where(conforms(F.col("text"), {"format": name}, formats=True) != F.col("expected")).collect()] == []
    assert rows.where(~conforms(F.col("text"), {"format": name})).count() == 0


def test_registry_is_changed_as_a_whole(spark):
    from skein.functions.json_schema import Registry

    r = Registry()
    r.apply({"a": [True]})
    with pytest.raises(ValueError):
        r.merge({"b": [{"type": "string"}], "c": [{"$ref": "#/none"}]})
    assert (set(r.types), r.generation) == ({"a"}, 1)
    got = spark.createDataFrame([("a", "1"), ("a", "{"), ("b", "1"), (None, "1")], "k string, t string").select(r.result(F.col("k"), F.col("t"))).collect()
    assert [x[0] for x in got] == ["valid", "not_json", "not_registered", "not_registered"]


def test_policies_for_fields():
    from skein.functions.json_schema import check_fields

    closed = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string"}}, "additionalProperties": False}
    check_fields(closed, False, False, False)
    for bad, policy in (({**closed, "required": []}, {"optional": False}), ({"items": {"type": ["null", "string"]}}, {"nullable": False}), ({"properties": {}}, {"open_objects": False})):
        check_fields(bad)
        with pytest.raises(ValueError):
            check_fields(bad, **policy)
