"""Column conversions the Parquet reader needs, usable on any table.

All but ``wide_decimal_text`` are JVM-side column expressions.
"""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

MICROS_PER_UNIT = {"s": 1_000_000, "ms": 1_000, "us": 1, "ns": None}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ntz() -> Column:
    return F.expr(EPOCH_NTZ)


def micros_to_ntz(col) -> Column:
    """Microseconds since 1970-01-01 -> timestamp_ntz (UTC wall clock),
    independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", _c(col), epoch_ntz())


def ntz_to_micros(col) -> Column:
    """timestamp_ntz -> microseconds since 1970-01-01.

    Subtracting two timestamp_ntz values is zone-free interval arithmetic (no
    cast through the session zone, so no daylight-saving gap can shift it);
    the day-time interval, held as microseconds, is then read out as seconds
    with six decimals, exactly."""
    iv = _c(col) - epoch_ntz()
    return (iv.cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)).cast("bigint")


def ltz_to_utc_ntz(col) -> Column:
    """Instant (timestamp with local zone) -> its UTC wall clock as timestamp_ntz."""
    return micros_to_ntz(F.unix_micros(_c(col)))


def days_to_date(col) -> Column:
    """Days since 1970-01-01 (negative allowed) -> date."""
    return F.date_from_unix_date(_c(col).cast("int"))


def millis_to_date(col) -> Column:
    """Milliseconds since epoch -> date, flooring (so -1 ms is 1969-12-31)."""
    ms = _c(col).cast("bigint").cast("decimal(20,0)")
    return F.date_from_unix_date(F.floor(ms / F.lit(86_400_000)).cast("int"))


def epoch_to_datetime(col, unit: str = "us") -> Column:
    """Integer epoch in s / ms / us / ns -> timestamp_ntz, UTC wall clock,
    microsecond precision; nanoseconds are floored to microseconds."""
    c = _c(col).cast("bigint")
    if unit == "ns":
        # exact floor division in decimal: a double would lose digits above 2^53
        micros = F.floor(c.cast("decimal(20,0)") / F.lit(1000)).cast("bigint")
    elif unit in ("s", "ms", "us"):
        micros = c * F.lit(MICROS_PER_UNIT[unit])
    else:
        raise ValueError(f"unit must be s, ms, us or ns, not {unit!r}")
    return micros_to_ntz(micros)


def bool_to_int(col) -> Column:
    """C4: true/false -> 1/0 as tinyint, NULL stays NULL."""
    return _c(col).cast("tinyint")


WIDER = {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}


def unsigned_widen(col, bits: int) -> Column:
    """An unsigned integer of 8 to 64 bits, held as the signed integer of the same
    bits -> the type that holds it (smallint, int, bigint, decimal(20,0)).

    Below the sign bit nothing changes; a negative value stands for itself plus
    2^bits. NULL stays NULL."""
    if bits not in WIDER:
        raise ValueError(f"bits must be one of {sorted(WIDER)}")
    c = _c(col)
    if bits == 64:
        d = c.cast("decimal(20,0)")
        wide = F.when(c < 0, d + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(d)
    else:
        wide = c.cast("bigint").bitwiseAND(F.lit(2**bits - 1))
    return wide.cast(WIDER[bits])


def half_to_float(col) -> Column:
    """IEEE binary16 stored as 2 little-endian bytes -> float.

    Sign, exponent and mantissa are cut out with integer arithmetic; subnormals
    are m * 2^-24, exponent 31 is +/-inf (m = 0) or NaN.
    """
    b = _c(col)
    raw = F.conv(F.hex(b), 16, 10).cast("int")            # byte0 * 256 + byte1
    bits = F.shiftleft(raw.bitwiseAND(255), 8).bitwiseOR(F.shiftright(raw, 8))  # little endian
    sign = F.shiftright(bits, 15)
    exp = F.shiftright(bits, 10).bitwiseAND(31)
    man = bits.bitwiseAND(1023).cast("double")
    mag = (F.when(exp == 0, man * F.lit(2.0 ** -24))
           .when(exp == 31, F.when(man == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
           .otherwise(F.pow(F.lit(2.0), (exp - 15).cast("double")) * (F.lit(1.0) + man / F.lit(1024.0))))
    val = F.when(sign == 1, -mag).otherwise(mag)
    return F.when(F.length(b) == 2, val.cast("float"))


def _decimal_text(raw: bytes | None, scale: int) -> str | None:
    """One value of ``wide_decimal_text``."""
    if not raw:
        return None
    v = int.from_bytes(raw, "big", signed=True)
    # str() refuses integers of more than 4300 digits; Decimal takes any
    digits = (str(abs(v)) if len(raw) <= 1024 else format(Decimal(abs(v)), "f")).rjust(scale + 1, "0")
    text = f"{digits[:-scale]}.{digits[-scale:]}" if scale > 0 else digits
    return "-" + text if v < 0 else text


def wide_decimal_text(col, scale: int) -> Column:
    """Decimal of any precision stored as big-endian two's complement bytes
    -> exact decimal text. NULL or empty bytes: NULL.

    The one conversion that leaves the JVM, whose built-in arithmetic ends at 38
    digits: Arrow batches of bytes become Python integers of any size. Inside a
    lambda use ``wide_decimal_text_inside``, whose interpreted steps grow with the
    square of a value's bytes."""
    @F.arrow_udf("string")
    def text(raw: pa.Array) -> pa.Array:
        return pa.array([_decimal_text(x, scale) for x in raw.to_pylist()], pa.string())

    return text(_c(col))


def wide_decimal_text_inside(col, scale: int) -> Column:
    """``wide_decimal_text`` in built-in functions, for values inside arrays, maps and
    structs, where a Python function may not stand. A column is far faster the other way.

    The magnitude is kept as limbs of nine digits, least first. Every two bytes
    multiply the limbs by 2^16 and add the bytes, with the carry walking through
    the limbs; a last step adds the one of the two's complement. A byte string
    of n bytes needs at most n * 0.268 + 2 limbs. NULL or empty bytes: NULL."""
    b = _c(col)
    n = F.length(b)
    negative = F.conv(F.hex(F.substring(b, 1, 1)), 16, 10).cast("int") >= 128
    digits = F.hex(b)                                    # complement of a negative value, then + 1
    digits = F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
    groups = F.ceil(n / F.lit(2)).cast("int")
    padded = F.lpad(digits, groups * 4, F.lit("0"))
    parts = F.transform(F.sequence(F.lit(0), groups - 1), lambda i: F.conv(
        F.substr(padded, i * 4 + 1, F.lit(4)), 16, 10).cast("bigint"))
    zeros = F.transform(F.sequence(F.lit(1), F.ceil(n * F.lit(0.268)).cast("int") + 2),
                        lambda i: F.lit(0).cast("bigint"))
    limb = F.lit(1_000_000_000).cast("bigint")

    def step(limbs, factor, add):
        """limbs * factor + add."""
        # limb values stay below 2^53, so the division of a multiple is exact
        walked = F.aggregate(
            limbs, F.struct(add.alias("carry"), F.array().cast("array<bigint>").alias("out")),
            lambda s, x: F.struct(
                ((x * factor + s["carry"] - (x * factor + s["carry"]) % limb) / limb).cast("bigint").alias("carry"),
                F.concat(s["out"], F.array((x * factor + s["carry"]) % limb)).alias("out")))
        return walked["out"]

    limbs = F.aggregate(parts, zeros, lambda s, x: step(s, F.lit(1 << 16).cast("bigint"), x))
    limbs = step(limbs, F.lit(1).cast("bigint"), F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    text = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    text = F.regexp_replace(text, "^0+", "")
    text = F.when(F.length(text) <= scale, F.lpad(text, scale + 1, "0")).otherwise(text)
    if scale > 0:
        text = F.concat(F.substr(text, F.lit(1), F.length(text) - scale), F.lit("."), F.right(text, F.lit(scale)))
    text = F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), text)
    return F.when(n > 0, text)


def time_to_text(col, unit: str) -> Column:
    """Time of day as integer (s / ms / us / ns since midnight) -> 'HH:MM:SS[.f]'."""
    per_sec = {"s": 1, "ms": 1000, "us": 1_000_000, "ns": 1_000_000_000}[unit]
    c = _c(col).cast("bigint")
    secs = F.floor(c / F.lit(per_sec)).cast("bigint") if per_sec > 1 else c
    frac = F.pmod(c, F.lit(per_sec))
    hms = F.format_string("%02d:%02d:%02d", F.floor(secs / 3600).cast("int"),
                          F.pmod(F.floor(secs / 60), F.lit(60)).cast("int"),
                          F.pmod(secs, F.lit(60)).cast("int"))
    if per_sec == 1:
        return hms
    width = len(str(per_sec)) - 1
    return F.concat(hms, F.lit("."), F.lpad(frac.cast("string"), width, "0"))


def nested_to_text(col) -> Column:
    """Array / struct / map value -> JSON text."""
    return F.to_json(_c(col))


__all__ = ["unsigned_widen", "days_to_date", "millis_to_date", "epoch_to_datetime", "bool_to_int",
           "half_to_float", "wide_decimal_text",
           "wide_decimal_text_inside", "time_to_text", "nested_to_text",
           "micros_to_ntz", "ntz_to_micros", "ltz_to_utc_ntz", "epoch_ntz"]
