"""Text encodings and number forms as column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), computing value once. An aggregate over nothing ends with body; an item taken from an array would ask for the types of all that it holds on every row."""
    return F.aggregate(F.array(), value, lambda v, _: v, body)


def hex_of(data: Column) -> Column:
    return F.lower(F.hex(data))


def base64url(data: Column) -> Column:
    """URL alphabet, without padding."""
    return F.rtrim(F.translate(F.base64(data), "+/", "-_"), F.lit("="))


def hex_bytes(text: Column) -> Column:
    """The bytes of hex digits; an odd length or another character raises."""
    ok = text.rlike(r"\A(?:[0-9A-Fa-f]{2})*\z")
    return F.when(text.isNull() | ok, F.unhex(text)).otherwise(F.raise_error(F.concat(F.lit("not hex: "), text)).cast("binary"))


def base64_of(data: Column) -> Column:
    """Standard alphabet, padded, in one line."""
    return F.regexp_replace(F.base64(data), r"\s", "")


def base64_bytes(text: Column) -> Column:
    """The bytes of padded standard base64; anything else raises."""
    ok = text.rlike(r"\A(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z")
    return F.when(text.isNull() | ok, F.unbase64(text)).otherwise(F.raise_error(F.concat(F.lit("not base64: "), text)).cast("binary"))


_DIGITS32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of(data: Column) -> Column:
    """RFC 4648, padded: every five bytes are a number of eight digits."""
    n, digits = F.length(data), F.hex(data)
    last = F.ceil(n / 5).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), lambda i: F.lpad(F.conv(F.rpad(F.substr(digits, i * 10 + 1, F.lit(10)), 10, "0"), 16, 32), 8, "0"))
    text = F.translate(F.array_join(blocks, ""), _DIGITS32, _BASE32)
    kept = F.ceil(n * 8 / 5).cast("int")
    return F.when(n == 0, F.lit("")).otherwise(F.rpad(F.substr(text, F.lit(1), kept), last * 8, F.lit("=")))


def base32_bytes(text: Column) -> Column:
    """The bytes of padded RFC 4648 base32; anything else raises."""
    ok = text.rlike(r"\A(?:[A-Z2-7]{8})*(?:[A-Z2-7]{2}={6}|[A-Z2-7]{4}={4}|[A-Z2-7]{5}={3}|[A-Z2-7]{7}=)?\z")
    bare = F.rtrim(text, F.lit("="))
    n = F.floor(F.length(bare) * 5 / 8).cast("int")
    digits = F.translate(F.rpad(bare, F.length(text), F.lit("A")), _BASE32, _DIGITS32)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.length(text) / 8 - 1, F.lit(0)).cast("int")), lambda i: F.lpad(F.conv(F.substr(digits, i * 8 + 1, F.lit(8)), 32, 16), 10, "0"))
    raw = F.unhex(F.when(n == 0, F.lit("")).otherwise(F.substr(F.array_join(blocks, ""), F.lit(1), n * 2)))
    return F.when(text.isNull() | ok, raw).otherwise(F.raise_error(F.concat(F.lit("not base32: "), text)).cast("binary"))


def number_in(text: Column, base: int) -> Column:
    """The number that all digits of text write in a base up to 36, either case; null where there is another character or none."""
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"[:base]
    return F.when(F.lower(text).rlike(rf"\A[{digits}]+\z"), F.conv(text, base, 10).cast("decimal(20,0)"))


def decimal_of(text: Column, precision: int, scale: int) -> Column:
    """A plain decimal; null where text isn't one or has more digits than fit (none are rounded away)."""
    ok = text.rlike(rf"\A[+-]?[0-9]{{1,{precision}}}(?:\.[0-9]{{1,{scale}}})?\z" if scale else rf"\A[+-]?[0-9]{{1,{precision}}}\z")
    return F.when(ok, text.try_cast(f"decimal({precision},{scale})"))


def in_units(nanoseconds: Column, unit: str, exact: bool = True) -> Column:
    """A span of nanoseconds in whole units, cut towards zero; not exact: the quotient is a double, as where SQL's / is one."""
    size = {"us": 10**3, "ms": 10**6, "s": 10**9, "min": 60 * 10**9, "h": 3600 * 10**9}[unit]
    return F.call_function("div", nanoseconds, F.lit(size)) if exact else (nanoseconds / F.lit(size)).cast("long")


def ipv6_bytes(text: Column) -> Column:
    """The 16 bytes of an address; null where it isn't one. A dotted IPv4 end counts as two groups."""
    empty = F.array().cast("array<string>")

    def plain(t: Column) -> Column:
        tail = F.regexp_extract(t, r"([0-9.]+)\z", 1)
        pair = lambda v: F.concat(F.lower(F.hex(F.floor(v / 65536))), F.lit(":"), F.lower(F.hex(v % 65536)))
        return F.when(t.rlike(r"\."), F.concat(F.substr(t, F.lit(1), F.length(t) - F.length(tail)), let(ipv4_number(tail), pair))).otherwise(t)

    def groups(half: Column) -> Column:
        return F.when(half == "", empty).otherwise(F.split(half, ":", -1))

    def bytes_of(sides: Column) -> Column:
        left, right, n = sides["left"], sides["right"], F.size(sides["left"]) + F.size(sides["right"])
        ok = F.when(sides["halves"] == 1, n == 8).otherwise((sides["halves"] == 2) & (n <= 7)) & F.forall(F.concat(left, right), lambda g: g.rlike(r"\A[0-9A-Fa-f]{1,4}\z"))
        whole = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(8 - n, F.lit(0))), right)
        return F.when(ok, F.unhex(F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")))

    def split(halves: Column) -> Column:
        return F.struct(F.size(halves).alias("halves"), groups(F.get(halves, F.lit(0))).alias("left"), F.coalesce(groups(F.get(halves, F.lit(1))), empty).alias("right"))

    return let(let(F.split(let(text, plain), "::", -1), split), bytes_of)


def ipv6_text(data: Column) -> Column:
    """The canonical text of 16 bytes: lower case, no leading zeros, the first of the longest runs of zeros as ::."""

    def shortened(full: Column) -> Column:
        out = full
        for k in range(2, 9):  # the longest run is asked for first
            run = rf"(?:^|:)0(?::0){{{k - 1}}}(?:$|:)"
            out = F.when(full.rlike(run), F.array_join(F.split(full, run, 2), "::")).otherwise(out)
        return out

    def joined(digits: Column) -> Column:
        return F.when(digits.isNotNull(), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substr(digits, i * 4 + 1, F.lit(4)), r"^0{1,3}", "")), ":"))

    return let(F.when(F.length(data) == 16, F.lower(F.hex(data))), lambda d: let(joined(d), shortened))


def channel_name(text: Column, longest: int = 30) -> Column:
    """A name of at most longest letters, digits and underscores, and the CRC-16 of the whole text in hex."""
    return F.concat(F.substr(F.regexp_replace(text, "[^A-Za-z0-9_]", "_"), F.lit(1), F.lit(longest)), F.lit("_"), F.lpad(F.lower(F.hex(crc16(F.encode(text, "UTF-8")))), 4, "0"))


def ipv4_number(text: Column) -> Column:
    """The 32-bit number of a dotted address; null where it isn't one."""
    parts = F.transform(F.split(text, r"\.", -1), lambda p: p.try_cast("int"))
    ok = text.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & F.forall(parts, lambda p: p <= 255)
    return F.when(ok, F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p))


def ipv4_text(number: Column) -> Column:
    return F.concat_ws(".", *(F.shiftrightunsigned(number, k).bitwiseAND(F.lit(255)).cast("string") for k in (24, 16, 8, 0)))


@F.arrow_udf(T.IntegerType())
def crc16(column: pa.Array) -> pa.Array:
    """CRC-16 with polynomial 0x1021 and start 0, of bytes; all rows of a batch advance by one byte at a time."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    flat = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    length, crc = np.where(missing, 0, np.diff(at)), np.zeros(len(column), np.uint32)
    for k in range(int(length.max(initial=0))):
        on = np.flatnonzero(length > k)
        c = crc[on] ^ (flat[at[on] + k].astype(np.uint32) << np.uint32(8))
        for _ in range(8):
            c = np.where(c & 0x8000, (c << np.uint32(1)) ^ np.uint32(0x1021), c << np.uint32(1)) & np.uint32(0xFFFF)
        crc[on] = c
    return pa.array(crc.astype(np.int32), mask=missing)
