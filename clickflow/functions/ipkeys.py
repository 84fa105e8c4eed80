"""Addresses and numbers as 16-byte keys whose byte order is the numeric order.

IPv4 stands at its IPv4-mapped place (``::ffff:a.b.c.d``), so both families share one key
space and no 128-bit arithmetic is needed to compare them. All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickflow.functions.ipv4 import ipv4_to_long

#: The first 12 bytes of an IPv4-mapped address.
V4_PREFIX_HEX = "00000000000000000000FFFF"
V4_FIRST, V4_LAST = V4_PREFIX_HEX + "00000000", V4_PREFIX_HEX + "FFFFFFFF"
_DIGITS, _LIMBS = 9, 5


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bytes_of(hex_text: str) -> Column:
    return F.unhex(F.lit(hex_text))


def ipv4_key(n: Column) -> Column:
    """Key of an IPv4 number; null outside 0..2^32-1."""
    inside = (n >= 0) & (n <= 4294967295)
    return F.when(inside, F.unhex(F.concat(F.lit(V4_PREFIX_HEX), F.lpad(F.hex(n.cast("long")), 8, "0"))))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def ipv6_key(c) -> Column:
    """Key of an IPv6 address (RFC 4291 text, one ``::`` at most, dotted tail allowed, no zone);
    null for anything else."""
    text = _c(c)
    none = F.array().cast("array<string>")

    def undotted(address: Column) -> Column:
        def grouped(number: Column) -> Column:
            low = F.concat(F.hex(F.shiftright(number, 16)), F.lit(":"), F.hex(number.bitwiseAND(F.lit(65535))))
            return F.concat(F.regexp_extract(address, "^(.*:)[^:]*$", 1), low)
        return F.when(address.contains("."), _let(ipv4_to_long(F.regexp_extract(address, "([^:]*)$", 1)), grouped)).otherwise(address)

    def groups(half: Column) -> Column:
        return F.when(half == "", none).otherwise(F.split(half, ":", -1))

    def sides(halves: Column) -> Column:
        right = F.when(F.size(halves) == 2, groups(F.get(halves, F.lit(1)))).otherwise(none)
        return F.struct(F.size(halves).alias("n"), groups(F.get(halves, F.lit(0))).alias("left"), right.alias("right"))

    def key(s: Column) -> Column:
        held = F.size(s["left"]) + F.size(s["right"])
        fits = F.when(s["n"] == 1, held == 8).otherwise((s["n"] == 2) & (held <= 7))
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(8) - held))
        shaped = fits & F.forall(F.concat(s["left"], s["right"]), lambda g: g.rlike("^[0-9A-Fa-f]{1,4}$"))
        hexed = F.array_join(F.transform(F.concat(s["left"], zeros, s["right"]), lambda g: F.lpad(g, 4, "0")), "")
        return F.when(shaped, F.unhex(hexed))

    # most text has no colon and needs no more than that
    made = _let(_let(undotted(text), lambda p: _let(F.split(p, "::", -1), sides)), key)
    return F.when(text.contains(":"), made)


def ip_key(c) -> Column:
    """Key of an address of either family, null for other text."""
    return F.coalesce(ipv4_key(ipv4_to_long(_c(c))), ipv6_key(c))


def decimal_key(c) -> Column:
    """Key of a number of up to 128 bits in decimal digits, null for other text. Long division of
    nine-digit limbs by 2^32, four times: decimals end at 38 digits."""
    text = F.when(_c(c).rlike("^[0-9]{1,39}$"), F.lpad(_c(c), _DIGITS * _LIMBS, "0"))
    limbs = F.array(*[F.substring(text, 1 + _DIGITS * i, _DIGITS).cast("long") for i in range(_LIMBS)])

    def divided(state: Column) -> Column:
        """(limbs, words) after one more division by 2^32."""
        start = F.struct(F.array().cast("array<bigint>").alias("q"), F.lit(0).cast("long").alias("r"))

        def step(acc: Column, limb: Column) -> Column:
            return _let(acc["r"] * F.lit(10 ** _DIGITS) + limb, lambda held: F.struct(
                F.concat(acc["q"], F.array(F.shiftright(held, 32))).alias("q"), held.bitwiseAND(F.lit(4294967295)).alias("r")))
        return _let(F.aggregate(state["limbs"], start, step), lambda d: F.struct(
            d["q"].alias("limbs"), F.concat(F.lpad(F.hex(d["r"]), 8, "0"), state["words"]).alias("words")))

    state = F.struct(limbs.alias("limbs"), F.lit("").alias("words"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(4)), state, lambda s, _: divided(s))
    return F.when(text.isNotNull(), _let(done, lambda s: F.when(F.forall(s["limbs"], lambda q: q == 0), F.unhex(s["words"]))))


def v4_number(key: Column) -> Column:
    """IPv4 number of a key in the IPv4-mapped space, null elsewhere."""
    return F.when(key.between(bytes_of(V4_FIRST), bytes_of(V4_LAST)), F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long"))
