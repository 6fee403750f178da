"""JSON Schema (Draft 2020-12) as column expressions: a schema becomes one boolean Column over VARIANT.

Catalyst sees plain built-in functions, so a check runs inside the scan's stage without Python. Covered:
boolean schemas, all assertions and applicators, unevaluatedProperties and unevaluatedItems, references by
pointer, $anchor and $id (in the document or in resources given with it), and format where it is to assert.
$dynamicRef is followed where only one $dynamicAnchor has its name. A reference that recurs raises ValueError,
as an expression has no end of its own. Integers of up to 38 digits and decimals that fit 38 digits, 18 of them
behind the point, are compared exactly, other numbers in double precision. Patterns are translated from ECMA's dialect.
Text that isn't JSON, null text and objects that repeat a key are invalid under every schema but none raises.

A text is read once, and every value in it is bound, with its kind and members, before its assertions look at it;
so a check grows with its schema, not with the number of times that the schema names a value.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Context, Decimal
from itertools import groupby
from urllib.parse import unquote, urldefrag, urljoin

from pyspark.sql import Column, functions as F

from .encodings import let

NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")
EXACT = ("BIGINT", "DECIMAL")
_WIDE = Context(prec=100)
#: Long names of Unicode categories, and Java's short ones.
CATEGORIES = {
    "Letter": "L", "Lowercase_Letter": "Ll", "Uppercase_Letter": "Lu", "Titlecase_Letter": "Lt", "Modifier_Letter": "Lm", "Other_Letter": "Lo", "Mark": "M", "Number": "N", "digit": "Nd",
    "Decimal_Number": "Nd", "Letter_Number": "Nl", "Other_Number": "No", "Punctuation": "P", "punct": "P", "Symbol": "S", "Separator": "Z", "Space_Separator": "Zs", "Other": "C", "Control": "Cc",
}
_SPACES = r"\s\u00a0\ufeff\u2028\u2029\p{Zs}"


def ecma(pattern: str) -> str:
    """A pattern of ECMA's dialect in Java's; one that can't be read raises ValueError."""
    out, i, inside = "", 0, False
    while i < len(pattern):
        c, two = pattern[i], pattern[i : i + 2]
        if c == "\\":
            if m := re.match(r"\\(p|P)\{(?:(?:General_Category|gc)=)?(\w+)\}", pattern[i:]):
                out += f"\\{m[1]}{{{CATEGORIES.get(m[2], m[2])}}}"
                i += len(m[0])
                continue
            if m := re.match(r"\\(p|P)\{(?:Script|sc|Script_Extensions|scx)=(\w+)\}", pattern[i:]):
                out += f"\\{m[1]}{{Is{m[2]}}}"
                i += len(m[0])
                continue
            if m := re.match(r"\\u\{([0-9A-Fa-f]+)\}", pattern[i:]):
                out += f"\\x{{{m[1]}}}"
                i += len(m[0])
                continue
            if len(two) < 2:
                raise ValueError(f"pattern ends in a backslash: {pattern}")
            if two == "\\s":
                out += _SPACES if inside else f"[{_SPACES}]"
            elif two == "\\S" and not inside:
                out += f"[^{_SPACES}]"
            elif two[1].isalnum():
                out += two
            else:
                out += re.escape(two[1])
            i += 2
            continue
        if inside:
            inside = c != "]"
            out += "\\" + c if c in "[&" else c
        elif c == "[":
            if pattern[i : i + 3] == "[^]":
                out += r"[\s\S]"
                i += 3
                continue
            if two == "[]":
                out += "(?!)"
                i += 2
                continue
            inside = True
            out += "["
            if pattern[i + 1 : i + 2] == "^":
                out += "^"
                i += 1
        else:
            out += r"\z" if c == "$" else c
        i += 1
    if inside:
        raise ValueError(f"class without an end: {pattern}")
    return out


#: Rules of formats where they assert; deliberately coarse. Other names assert nothing.
FORMATS: dict[str, Callable[[Column], Column]] = {
    "date": lambda t: t.rlike(r"\A[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])\z"),
    "time": lambda t: t.rlike(r"\A(?:[01][0-9]|2[0-3]):[0-5][0-9]:(?:[0-5][0-9]|60)"),
    "date-time": lambda t: t.rlike(r"\A[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])[Tt](?:[01][0-9]|2[0-3]):[0-5][0-9]:(?:[0-5][0-9]|60)"),
    "duration": lambda t: t.rlike(r"\AP[0-9YMWDTHS]+\z"),
    "email": lambda t: t.rlike(r"\A[^@]+@[^@]*\.[^@]*[^@.]\z"),
    "hostname": lambda t: t.rlike(r"\A[A-Za-z0-9.-]{1,253}\z"),
    "ipv4": lambda t: t.rlike(r"\A(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.(?!\z)|\z)){4}\z"),
    "ipv6": lambda t: t.rlike(r"\A[0-9A-Fa-f:.]{2,45}\z"),
    "uri": lambda t: t.rlike(r"\A[A-Za-z][^:]*:"),
    "uri-reference": lambda t: ~t.contains(" "),
    "uuid": lambda t: t.rlike(r"\A[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\z"),
    "json-pointer": lambda t: t.rlike(r"\A(?:/(?:[^~]|~[01])*)?\z"),
    "relative-json-pointer": lambda t: t.rlike(r"\A[0-9]"),
}


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID or one of NUMBERS."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _all(parts: list[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def _any(parts: list[Column]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | p
    return out


def _count(parts: list[Column]) -> Column:
    out = F.lit(0)
    for p in parts:
        out = out + p.cast("int")
    return out


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _exact(x: object) -> Decimal:
    return x if isinstance(x, Decimal) else Decimal(repr(x) if isinstance(x, float) else x)


def _decimal(x: Decimal, scale: int) -> Column | None:
    """x as a literal of 38 digits, if it is one."""
    q = x.quantize(Decimal(1).scaleb(-scale), context=_WIDE) if abs(x) < Decimal(10) ** (38 - scale) and abs(x.as_tuple().exponent) < 60 else None
    return F.lit(f"{q:f}").cast(f"decimal(38,{scale})") if q is not None and q == x else None


def _is_long(x: Decimal) -> bool:
    return abs(x) < 1 << 63 and x == int(x)


def _whole(v: Column, kind: Column) -> Column:
    return F.when(kind == "BIGINT", _as(v, "bigint"))


def _number(v: Column, kind: Column, whole: Column, x: object, test: Callable[[Column, Column], Column]) -> Column:
    """test of a number against a literal: exact where both have an exact form, else in double precision."""
    x = _exact(x)
    forms = [test(whole, F.lit(int(x)))] if _is_long(x) else []
    forms += [F.when(kind.isin(*EXACT), test(_as(v, f"decimal(38,{s})"), lit)) for s in (18, 0) if (lit := _decimal(x, s)) is not None]
    return _sure(F.coalesce(*forms, test(_as(v, "double"), F.lit(float(x)))))


def _multiple(v: Column, kind: Column, whole: Column, x: object) -> Column:
    x = _exact(x)
    if x == 0:
        return F.lit(False)
    number = _as(v, "double")
    forms = [whole % F.lit(int(x)) == 0] if _is_long(x) else []
    forms += [F.when(kind.isin(*EXACT), _as(v, f"decimal(38,{s})") % lit == 0) for s in (18, 0) if (lit := _decimal(x, s)) is not None]
    quotient = number / F.lit(float(x))
    return _sure(F.coalesce(*forms, F.when(F.abs(quotient) == F.lit(float("inf")), number % F.lit(float(x)) == 0).otherwise(quotient == F.rint(quotient))))


def _type(kind: Column, v: Column, name: str) -> Column:
    if name == "number":
        return kind.isin(*NUMBERS)
    if name == "integer":
        return (kind == "BIGINT") | kind.isin(*NUMBERS[1:]) & _sure(F.coalesce(F.when(kind == "DECIMAL", _as(v, "decimal(38,18)") % 1 == 0), _as(v, "double") == F.rint(_as(v, "double"))))
    return kind == {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}[name]


def _equal(v: Column, kind: Column, whole: Column, value: object) -> Column:
    """Equality by value: numbers by number, arrays and objects member by member."""
    if value is None:
        return kind == "VOID"
    if isinstance(value, bool):
        return (kind == "BOOLEAN") & _sure(_as(v, "boolean") == F.lit(value))
    if isinstance(value, (int, float, Decimal)):
        return kind.isin(*NUMBERS) & _number(v, kind, whole, value, lambda a, b: a == b)
    if isinstance(value, str):
        return (kind == "STRING") & _sure(_as(v, "string") == F.lit(value))
    one = lambda e, x: let(e, lambda y: let(_kind(y), lambda k: _equal(y, k, _whole(y, k), x)))
    if isinstance(value, list):
        return (kind == "ARRAY") & _sure(let(_as(v, "array<variant>"), lambda a: (F.size(a) == len(value)) & _all([one(F.get(a, F.lit(i)), x) for i, x in enumerate(value)])))
    return (kind == "OBJECT") & _sure(let(_as(v, "map<string,variant>"), lambda m: (F.size(m) == len(value)) & _all([_sure(F.map_contains_key(m, F.lit(k))) & one(_member(m, k), x) for k, x in value.items()])))


def _member(m: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(name)), F.parse_json(F.lit("null")))


#: Keywords that hold a schema, a list of them, or a map of them.
_ONE = ("not", "if", "then", "else", "items", "contains", "additionalProperties", "propertyNames", "unevaluatedItems", "unevaluatedProperties")
_MANY, _NAMED = ("allOf", "anyOf", "oneOf", "prefixItems"), ("properties", "patternProperties", "dependentSchemas", "$defs")
VOCABULARIES = {f"https://json-schema.org/draft/2020-12/vocab/{n}" for n in ("core", "applicator", "unevaluated", "validation", "meta-data", "format-annotation", "content")}


@dataclass
class _Document:
    """A schema with the places of all its resources and anchors."""

    root: object
    resources: dict[str, object]
    formats: bool
    at: dict[str, object] = field(default_factory=dict)
    base: dict[int, str] = field(default_factory=dict)
    dynamic: dict[str, list[object]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for uri, schema in {"": self.root, **self.resources}.items():
            self.at[uri] = schema
            self._walk(schema, uri)

    def _walk(self, schema: object, base: str) -> None:
        if not isinstance(schema, dict):
            return
        if "$id" in schema:
            base = urldefrag(urljoin(base, schema["$id"]))[0]
            self.at[base] = schema
        self.base[id(schema)] = base
        for k in ("$anchor", "$dynamicAnchor"):
            if k in schema:
                self.at[f"{base}#{schema[k]}"] = schema
                if k == "$dynamicAnchor":
                    self.dynamic.setdefault(schema[k], []).append(schema)
        if unknown := [u for u, needed in schema.get("$vocabulary", {}).items() if needed and u not in VOCABULARIES]:
            raise ValueError(f"unknown vocabulary: {unknown}")
        for k in _ONE:
            self._walk(schema.get(k), base)
        for k in _MANY:
            for x in schema.get(k, []):
                self._walk(x, base)
        for k in _NAMED:
            for x in schema.get(k, {}).values():
                self._walk(x, base)

    def resolved(self, schema: dict, ref: str) -> object:
        base, part = urldefrag(urljoin(self.base.get(id(schema), ""), ref))
        if part and not part.startswith("/"):
            if f"{base}#{unquote(part)}" not in self.at:
                raise ValueError(f"no such anchor: {ref}")
            return self.at[f"{base}#{unquote(part)}"]
        if base not in self.at:
            raise ValueError(f"reference outside the documents: {ref}")
        at = self.at[base]
        for step in unquote(part).split("/")[1:]:
            step = step.replace("~1", "/").replace("~0", "~")
            try:
                at = at[int(step)] if isinstance(at, list) else at[step]
            except (KeyError, IndexError, ValueError, TypeError):
                raise ValueError(f"no such place: {ref}") from None
        if isinstance(at, dict) and id(at) not in self.base:
            self._walk(at, base)
        return at


#: keyword location, instance location, keyword
Place = tuple[str, str, str]
_NUMBERS = {"const", "enum", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"}
_TEXTS, _ITEMS = {"minLength", "maxLength", "pattern", "format"}, {"prefixItems", "items", "minItems", "maxItems", "uniqueItems", "contains", "unevaluatedItems"}
_MEMBERS = {"required", "minProperties", "maxProperties", "properties", "dependentRequired", "dependentSchemas", "propertyNames", "patternProperties", "additionalProperties", "unevaluatedProperties"}


@dataclass
class _Compiler:
    document: _Document

    def holds(self, value: Column, schema: object, seen: tuple[int, ...] = ()) -> Column:
        return self.verdicts(value, schema, seen)[1]

    def verdicts(self, value: Column, schema: object, seen: tuple[int, ...] = (), where: str = "", place: str = "", apart: bool = False) -> tuple[list[Place], Column]:
        """located, of a value that is computed once."""
        places: list[Place] = []

        def bound(v: Column, kind: Column) -> Column:
            own, out = self.located(v, kind, schema, seen, where, place, apart)
            places.extend(own)
            return out

        return places, let(value, lambda v: let(_kind(v), lambda kind: bound(v, kind)))

    def references(self, schema: dict) -> list[tuple[str, object]]:
        out = []
        if (ref := schema.get("$ref")) is not None:
            out.append(("$ref", self.document.resolved(schema, ref)))
        if (ref := schema.get("$dynamicRef")) is not None:
            target = self.document.resolved(schema, ref)
            name = ref.rpartition("#")[2]
            if isinstance(target, dict) and target.get("$dynamicAnchor") == name and len(self.document.dynamic.get(name, [])) > 1:
                raise ValueError(f"several dynamic anchors: {ref}")
            out.append(("$dynamicRef", target))
        return out

    def located(self, v: Column, kind: Column, schema: object, seen: tuple[int, ...], where: str, place: str, apart: bool, whole: Column | None = None) -> tuple[list[Place], Column]:
        """The places of all assertions, those of properties, allOf and references each for themselves, and their verdicts: an array if apart, else one for all. whole: v as a long, if that is bound."""
        if isinstance(schema, bool):
            return ([] if schema else [(where, place, "false")]), self.joined([] if schema else [(False, F.lit(False))], apart)
        if id(schema) in seen:
            raise ValueError(f"a reference recurs at {where or '#'}")
        if whole is None and _NUMBERS & schema.keys():
            places: list[Place] = []

            def again(n: Column) -> Column:
                own, out = self.located(v, kind, schema, seen, where, place, apart, n)
                places.extend(own)
                return out

            return places, let(_whole(v, kind), again)
        places = []

        def bound(text: Column, items: Column, members: Column) -> Column:
            own, parts = self.assertions(v, kind, whole, text, items, members, schema, (*seen, id(schema)), where, place, apart)
            places.extend(own)
            return self.joined(parts, apart)

        def used(keywords: set[str], of: str, value: Column, body: Callable[[Column], Column]) -> Column:
            return let(F.when(kind == of, value), body) if keywords & schema.keys() else body(value)

        out = used(_TEXTS, "STRING", _as(v, "string"), lambda t: used(_ITEMS, "ARRAY", _as(v, "array<variant>"), lambda i: used(_MEMBERS, "OBJECT", _as(v, "map<string,variant>"), lambda m: bound(t, i, m))))
        return places, out

    @staticmethod
    def joined(parts: list[tuple[bool, Column]], apart: bool) -> Column:
        """Verdicts (whether it is an array of some, and the column) behind one another, or all in one."""
        if not apart:
            return _all([p for _, p in parts])
        arrays = [c for some, g in groupby(parts, lambda p: p[0]) for c in ([p for _, p in g] if some else [F.array(*(p for _, p in g))])]
        return F.flatten(F.array(*arrays)) if arrays else F.array().cast("array<boolean>")

    def assertions(self, v: Column, kind: Column, whole: Column | None, text: Column, items: Column, members: Column, schema: dict, seen: tuple[int, ...], where: str, place: str, apart: bool) -> tuple[list[Place], list[tuple[bool, Column]]]:
        places: list[Place] = []
        parts: list[tuple[bool, Column]] = []

        def sub(value: Column, part: object) -> Column:
            return self.holds(value, part, seen)

        def same(part: object) -> Column:
            return self.located(v, kind, part, seen, "", "", False, whole)[1]

        def add(keyword: str, check: Column) -> None:
            places.append((f"{where}/{keyword}", place, keyword))
            parts.append((False, _sure(check)))

        def on(of: tuple[str, ...], keyword: str, check: Column) -> None:
            add(keyword, F.when(kind.isin(*of), _sure(check)).otherwise(F.lit(True)))

        def take(own: list[Place], verdicts: Column) -> None:
            if own:
                places.extend(own)
                parts.append((apart, verdicts))

        for keyword, target in self.references(schema):
            take(*self.located(v, kind, target, seen, f"{where}/{keyword}", place, apart, whole))
        if "type" in schema:
            names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            add("type", _any([_type(kind, v, n) for n in names]))
        if "const" in schema:
            add("const", _equal(v, kind, whole, schema["const"]))
        if "enum" in schema:
            add("enum", _any([_equal(v, kind, whole, x) for x in schema["enum"]]))

        compare: dict[str, Callable[[Column, Column], Column]] = {"minimum": lambda a, b: a >= b, "maximum": lambda a, b: a <= b, "exclusiveMinimum": lambda a, b: a > b, "exclusiveMaximum": lambda a, b: a < b}
        for k, test in compare.items():
            if k in schema:
                on(NUMBERS, k, _number(v, kind, whole, schema[k], test))
        if "multipleOf" in schema:
            on(NUMBERS, "multipleOf", _multiple(v, kind, whole, schema["multipleOf"]))
        if "minLength" in schema:
            on(("STRING",), "minLength", F.length(text) >= int(schema["minLength"]))
        if "maxLength" in schema:
            on(("STRING",), "maxLength", F.length(text) <= int(schema["maxLength"]))
        if "pattern" in schema:
            on(("STRING",), "pattern", text.rlike(ecma(schema["pattern"])))
        if self.document.formats and schema.get("format") in FORMATS:
            on(("STRING",), "format", FORMATS[schema["format"]](text))

        for i, part in enumerate(schema.get("allOf", [])):
            take(*self.located(v, kind, part, seen, f"{where}/allOf/{i}", place, apart, whole))
        if "anyOf" in schema:
            add("anyOf", _any([same(p) for p in schema["anyOf"]]))
        if "oneOf" in schema:
            add("oneOf", _count([same(p) for p in schema["oneOf"]]) == 1)
        if "not" in schema:
            add("not", ~same(schema["not"]))
        if "if" in schema:
            add("if", F.when(same(schema["if"]), same(schema.get("then", True))).otherwise(same(schema.get("else", True))))

        first = schema.get("prefixItems", [])
        for i, part in enumerate(first):
            on(("ARRAY",), f"prefixItems/{i}", (F.size(items) <= i) | sub(F.get(items, F.lit(i)), part))
        if "items" in schema:
            on(("ARRAY",), "items", F.forall(F.slice(items, len(first) + 1, F.greatest(F.size(items), F.lit(1))), lambda x: sub(x, schema["items"])))
        if "minItems" in schema:
            on(("ARRAY",), "minItems", F.size(items) >= int(schema["minItems"]))
        if "maxItems" in schema:
            on(("ARRAY",), "maxItems", F.size(items) <= int(schema["maxItems"]))
        if schema.get("uniqueItems"):
            on(("ARRAY",), "uniqueItems", F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) == F.size(items))
        if "contains" in schema:
            n = F.size(F.filter(items, lambda x: sub(x, schema["contains"])))
            on(("ARRAY",), "contains", n >= int(schema.get("minContains", 1)))
            if "maxContains" in schema:
                on(("ARRAY",), "maxContains", n <= int(schema["maxContains"]))
        if "unevaluatedItems" in schema:
            done = self.evaluated(v, {k: x for k, x in schema.items() if k != "unevaluatedItems"}, "ARRAY", schema)
            rest = F.filter(items, lambda x, i: ~F.array_contains(done, i))
            on(("ARRAY",), "unevaluatedItems", F.forall(rest, lambda x: sub(x, schema["unevaluatedItems"])))

        def has(name: str) -> Column:
            return _sure(F.map_contains_key(members, F.lit(name)))

        for name in schema.get("required", []):
            on(("OBJECT",), "required", has(name))
        if "minProperties" in schema:
            on(("OBJECT",), "minProperties", F.size(members) >= int(schema["minProperties"]))
        if "maxProperties" in schema:
            on(("OBJECT",), "maxProperties", F.size(members) <= int(schema["maxProperties"]))
        for name, part in schema.get("properties", {}).items():
            own, ok = self.verdicts(_member(members, name), part, seen, f"{where}/properties/{name}", f"{place}/{name}", apart)
            missing = F.array_repeat(F.lit(True), len(own)) if apart else F.lit(True)
            take(own, F.when((kind == "OBJECT") & has(name), ok).otherwise(missing))
        for name, needed in schema.get("dependentRequired", {}).items():
            on(("OBJECT",), "dependentRequired", ~has(name) | _all([has(n) for n in needed]))
        for name, part in schema.get("dependentSchemas", {}).items():
            on(("OBJECT",), f"dependentSchemas/{name}", ~has(name) | same(part))
        if "propertyNames" in schema:
            on(("OBJECT",), "propertyNames", F.forall(F.map_keys(members), lambda k: sub(k.cast("variant"), schema["propertyNames"])))
        patterns = {ecma(k): x for k, x in schema.get("patternProperties", {}).items()}
        for pattern, part in patterns.items():
            on(("OBJECT",), "patternProperties", F.forall(F.map_entries(members), lambda e: ~e["key"].rlike(pattern) | sub(e["value"], part)))  # noqa: B023  called at once
        if "additionalProperties" in schema:

            def named(key: Column) -> Column:
                return _any([key == F.lit(n) for n in schema.get("properties", {})] + [key.rlike(p) for p in patterns])

            on(("OBJECT",), "additionalProperties", F.forall(F.map_entries(members), lambda e: named(e["key"]) | sub(e["value"], schema["additionalProperties"])))
        if "unevaluatedProperties" in schema:
            done = self.evaluated(v, {k: x for k, x in schema.items() if k != "unevaluatedProperties"}, "OBJECT", schema)
            on(("OBJECT",), "unevaluatedProperties", F.forall(F.map_entries(members), lambda e: F.array_contains(done, e["key"]) | sub(e["value"], schema["unevaluatedProperties"])))
        return places, parts

    def evaluated(self, v: Column, schema: object, kind: str, source: dict | None = None) -> Column:
        """The names (OBJECT) or places (ARRAY) of v that a schema, where it holds, has evaluated."""
        none = F.array().cast("array<string>" if kind == "OBJECT" else "array<int>")
        if isinstance(schema, bool):
            return none
        parts = [none]

        def within(part: object) -> Column:
            return self.evaluated(v, part, kind)

        for _, target in self.references(source or schema):
            parts.append(within(target))
        parts += [within(p) for p in schema.get("allOf", [])]
        for k in ("anyOf", "oneOf"):
            parts += [F.when(self.holds(v, p), within(p)).otherwise(none) for p in schema.get(k, [])]
        if "if" in schema:
            parts.append(F.when(self.holds(v, schema["if"]), F.concat(within(schema["if"]), within(schema.get("then", True)))).otherwise(within(schema.get("else", True))))
        if kind == "OBJECT":
            members = _as(v, "map<string,variant>")
            keys = F.coalesce(F.map_keys(members), none)
            if "additionalProperties" in schema or "unevaluatedProperties" in schema:
                parts.append(keys)
            if schema.get("properties"):
                parts.append(F.array(*map(F.lit, schema["properties"])))
            parts += [F.filter(keys, lambda k: k.rlike(ecma(p))) for p in schema.get("patternProperties", {})]  # noqa: B023
            parts += [F.when(_sure(F.map_contains_key(members, F.lit(n))), within(p)).otherwise(none) for n, p in schema.get("dependentSchemas", {}).items()]
        else:
            items = F.coalesce(_as(v, "array<variant>"), F.array().cast("array<variant>"))
            places = F.transform(items, lambda x, i: i)
            if "items" in schema or "unevaluatedItems" in schema:
                parts.append(places)
            if schema.get("prefixItems"):
                parts.append(F.filter(places, lambda i: i < len(schema["prefixItems"])))
            if "contains" in schema:
                parts.append(F.filter(places, lambda i: self.holds(F.get(items, i), schema["contains"])))
        return F.concat(*parts)


def whole_json(text: Column) -> Column:
    """text as VARIANT; null where it isn't JSON as a whole. Spark's own parser passes over what follows the first value.

    The text is read as the first item of an array that a second one, the text's hash, closes: whatever ends the array early or
    adds items to it leaves another second item than that.
    """

    def parsed(t: Column, mark: Column) -> Column:
        return F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"'), mark, F.lit('"]')))

    def value(around: Column, mark: Column) -> Column:
        return F.when(F.try_variant_get(around, "$[1]", "string") == mark, F.try_variant_get(around, "$[0]", "variant"))

    return let(text, lambda t: let(F.xxhash64(t).cast("string"), lambda mark: let(parsed(t, mark), lambda around: value(around, mark))))


def _read(schema: object) -> object:
    return json.loads(schema, parse_float=Decimal) if isinstance(schema, (str, bytes)) else schema


def _compiler(schema: object, formats: bool = False, resources: dict[str, object] | None = None) -> _Compiler:
    return _Compiler(_Document(schema, {k: _read(x) for k, x in (resources or {}).items()}, formats))


def conforms(text: Column, schema: object, formats: bool = False, resources: dict[str, object] | None = None) -> Column:
    """Whether the JSON in text is valid under the schema (a dict, a bool, or its JSON). formats: they assert; resources: other documents by their URI."""
    schema = _read(schema)
    compiler = _compiler(schema, formats, resources)
    return _sure(let(whole_json(text), lambda v: F.when(v.isNotNull(), compiler.holds(v, schema))))


def violations(text: Column, schema: object, formats: bool = False, resources: dict[str, object] | None = None) -> Column:
    """An array of (keyword_location, instance_location, keyword) of what fails, in the schema's order; null where text isn't JSON.

    Members of objects, allOf and references are located one by one, what lies inside arrays and alternatives at their keyword.
    """
    schema = _read(schema)
    compiler = _compiler(schema, formats, resources)
    kind = "array<struct<keyword_location:string,instance_location:string,keyword:string>>"

    def failed(v: Column) -> Column:
        places, verdicts = compiler.verdicts(v, schema, apart=True)

        def listed(holds: Column) -> Column:
            names = [F.struct(F.lit(w).alias("keyword_location"), F.lit(p).alias("instance_location"), F.lit(k).alias("keyword")) for w, p, k in places]
            return F.filter(F.array(*names), lambda _, i: ~F.get(holds, i)) if names else F.array().cast(kind)

        return F.when(v.isNotNull(), let(verdicts, listed))

    return let(whole_json(text), failed)


class Registry:
    """Schemas by type, each in some revisions; a change is checked as a whole before it is taken."""

    def __init__(self) -> None:
        self.types: dict[str, list[object]] = {}
        self.generation = 0

    def apply(self, types: dict[str, list[object]]) -> None:
        """Replaces all types."""
        for revisions in types.values():
            if not revisions:
                raise ValueError("a type without a revision")
            for schema in revisions:
                conforms(F.lit("null"), schema)  # raises where it can't be compiled
        self.types, self.generation = dict(types), self.generation + 1

    def merge(self, types: dict[str, list[object]]) -> None:
        """Replaces or adds the given types; the others stay."""
        self.apply(self.types | types)

    def result(self, kind: Column, text: Column) -> Column:
        """valid (under one revision at least), invalid, not_json or not_registered."""
        types = {name: [_read(s) for s in revisions] for name, revisions in self.types.items()}

        def verdict(v: Column) -> Column:
            out = F.when(v.isNull(), "not_json")
            for name, revisions in types.items():
                out = out.when((kind == name) & _any([_compiler(s).holds(v, s) for s in revisions]), "valid")
            return out.otherwise("invalid")

        return F.when(~F.coalesce(kind.isin(*types), F.lit(False)), "not_registered").otherwise(let(whole_json(text), verdict))


def check_fields(schema: object, optional: bool = True, nullable: bool = True, open_objects: bool = True, where: str = "#") -> None:
    """Raises ValueError where a schema has fields that a policy forbids: not required, null beside another type, or objects open to other members."""
    schema = _read(schema)
    if not isinstance(schema, dict):
        return
    if not optional and (lost := [n for n in schema.get("properties", {}) if n not in schema.get("required", [])]):
        raise ValueError(f"{where}: optional fields {lost}")
    if not nullable and isinstance(schema.get("type"), list) and "null" in schema["type"]:
        raise ValueError(f"{where}: nullable")
    if not open_objects and "properties" in schema and schema.get("additionalProperties") is not False:
        raise ValueError(f"{where}: open to other members")
    parts = [(k, schema.get(k)) for k in _ONE] + [(f"{k}/{i}", x) for k in _MANY for i, x in enumerate(schema.get(k, []))] + [(f"{k}/{n}", x) for k in _NAMED for n, x in schema.get(k, {}).items()]
    for k, x in parts:
        check_fields(x, optional, nullable, open_objects, f"{where}/{k}")
