"""IP address parsing with built-in functions only.

Accepts what Python's ``ipaddress`` accepts: four decimal octets without
leading zeros for version 4; eight hex groups, at most one ``::``, an optional
dotted tail and an optional zone for version 6. Anything else gives NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# An octet 0-255 without leading zeros, and shapes built from it.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{OCTET}(?:\.{OCTET}){{3}}\z"
V4_TAIL = rf"^(.*:)({OCTET})\.({OCTET})\.({OCTET})\.({OCTET})\z"
HEX_GROUPS = r"^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,7})?\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used.

    A lambda's argument is bound at run time, so no optimizer rule copies it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ipv4_number(ip: Column) -> Column:
    """Dotted IPv4 as BIGINT."""
    total = F.lit(0).cast("bigint")
    for place, weight in enumerate((1 << 24, 1 << 16, 1 << 8, 1), start=1):
        octet = F.substring_index(F.substring_index(ip, ".", place), ".", -1)
        total = total + octet.try_cast("bigint") * F.lit(weight)
    return F.when(ip.rlike(IPV4), total)


def _hex_pair(high: Column, low: Column) -> Column:
    number = high.try_cast("int") * 256 + low.try_cast("int")
    return F.lower(F.hex(number))


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _six(body: Column) -> Column:
    """32 hex digits of an address without zone and dotted tail."""

    def from_sides(sides: Column) -> Column:
        head, tail = F.get(sides, F.lit(0)), F.coalesce(F.get(sides, F.lit(1)), F.lit(""))
        shaped = (F.size(sides) <= 2) & head.rlike(HEX_GROUPS) & tail.rlike(HEX_GROUPS)
        parts = F.struct(F.size(sides).alias("n"), _groups(head).alias("head"), _groups(tail).alias("tail"))
        return F.when(shaped, let(parts, from_parts))

    def from_parts(p: Column) -> Column:
        given = F.size(p["head"]) + F.size(p["tail"])
        complete = F.when(p["n"] == 2, given <= 7).otherwise(given == 8)
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - given, F.lit(0)))
        padded = F.transform(F.concat(p["head"], zeros, p["tail"]), lambda g: F.lpad(g, 4, "0"))
        return F.when(complete, F.lower(F.array_join(padded, "")))

    return let(F.split(body, "::"), from_sides)


def ipv6_hex(ip: Column) -> Column:
    """IPv6 as 32 hex digits. Texts without a colon go no further."""

    def without_tail(bare: Column) -> Column:
        part = lambda i: F.regexp_extract(bare, V4_TAIL, i)
        groups = F.concat(part(1), _hex_pair(part(2), part(3)), F.lit(":"), _hex_pair(part(4), part(5)))
        return F.when(F.contains(bare, F.lit(".")) & bare.rlike(V4_TAIL), groups).otherwise(bare)

    def parse(bare: Column) -> Column:
        return let(without_tail(bare), _six)

    unzoned = F.when(F.contains(ip, F.lit("%")), F.regexp_replace(ip, r"%[^%]+\z", "")).otherwise(ip)
    return F.when(F.contains(ip, F.lit(":")), let(unzoned, parse))


def hex_number(digits: Column) -> Column:
    """Sixteen hex digits as a signed 64-bit number."""
    return F.conv(digits, 16, -10).cast("bigint")


def high_bits(number: Column, kept: int, width: int) -> Column:
    """The leading ``kept`` of ``width`` bits; 0 if none are kept, NULL for NULL."""
    if kept == 0:
        return F.when(number.isNotNull(), F.lit(0).cast("bigint"))
    return number if kept == width else F.shiftrightunsigned(number, width - kept)
