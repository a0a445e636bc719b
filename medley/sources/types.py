"""File type -> declared type conformance.

Two jobs:

* ``read_type(arrow_type)``: the Spark type to *read* a Parquet column as. It is
  Spark's own mapping except for the four kinds its reader refuses: half floats
  and decimals wider than 38 digits are read as their raw bytes, nanosecond
  timestamps and time-of-day values as integers.
* ``conform(col, ...)``: one column expression that turns the raw column into the
  declared type. When the raw type already equals the declared one the column
  is returned untouched, so Catalyst can still push filters into the scan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from medley.functions import conversions as conv

MODES = ("permissive", "strict")


@dataclass(frozen=True)
class RawKind:
    """How a raw column must be decoded before the cast to the declared type."""
    kind: str = "plain"          # plain | half | ts_ns | wide_decimal | time | nested
    unit: str = ""               # time unit for ts_ns / time
    scale: int = 0               # wide_decimal scale
    parts: tuple = ()            # nested: the kinds inside


def read_type(t: pa.DataType) -> tuple[T.DataType, RawKind]:
    """Spark read type for an Arrow (Parquet footer) type plus how to decode it."""
    if pa.types.is_boolean(t):
        return T.BooleanType(), RawKind()
    if pa.types.is_int8(t):
        return T.ByteType(), RawKind()
    if pa.types.is_int16(t) or pa.types.is_uint8(t):
        return T.ShortType(), RawKind()
    if pa.types.is_int32(t) or pa.types.is_uint16(t):
        return T.IntegerType(), RawKind()
    if pa.types.is_int64(t) or pa.types.is_uint32(t):
        return T.LongType(), RawKind()
    if pa.types.is_uint64(t):
        return T.DecimalType(20, 0), RawKind()
    if pa.types.is_float16(t):
        return T.BinaryType(), RawKind("half")
    if pa.types.is_float32(t):
        return T.FloatType(), RawKind()
    if pa.types.is_float64(t):
        return T.DoubleType(), RawKind()
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return T.StringType(), RawKind()
    if (pa.types.is_binary(t) or pa.types.is_large_binary(t)
            or pa.types.is_fixed_size_binary(t)):
        return T.BinaryType(), RawKind()
    if pa.types.is_date32(t) or pa.types.is_date64(t):
        return T.DateType(), RawKind()
    if pa.types.is_timestamp(t):
        if t.unit == "ns":
            return T.LongType(), RawKind("ts_ns", "ns")
        return (T.TimestampType() if t.tz else T.TimestampNTZType()), RawKind()
    if pa.types.is_time32(t):
        return T.IntegerType(), RawKind("time", t.unit)
    if pa.types.is_time64(t):
        return T.LongType(), RawKind("time", t.unit)
    if pa.types.is_decimal(t):
        if t.precision > 38:
            return T.BinaryType(), RawKind("wide_decimal", scale=t.scale)
        return T.DecimalType(t.precision, t.scale), RawKind()
    if pa.types.is_duration(t):
        return T.LongType(), RawKind()
    if pa.types.is_dictionary(t):
        return read_type(t.value_type)
    if pa.types.is_null(t):
        return T.IntegerType(), RawKind()
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        et, kind = read_type(t.value_type)
        return T.ArrayType(et, True), _nested(kind)
    if pa.types.is_map(t):
        kt, key_kind = read_type(t.key_type)
        vt, kind = read_type(t.item_type)
        return T.MapType(kt, vt, True), _nested(key_kind, kind)
    if pa.types.is_struct(t):
        inner = [read_type(f.type) for f in t]
        return (T.StructType([T.StructField(f.name, st, True) for f, (st, _) in zip(t, inner)]),
                _nested(*[kind for _, kind in inner]))
    raise TypeError(f"unsupported Parquet column type {t}")


def _nested(*parts: RawKind) -> RawKind:
    """A nested column needs decoding when something inside does."""
    return RawKind() if all(p.kind == "plain" for p in parts) else RawKind("nested", parts=parts)


_NATURAL = {"half": T.FloatType(), "ts_ns": T.TimestampNTZType(),
            "wide_decimal": T.StringType(), "time": T.StringType()}


def natural_type(raw: T.DataType, kind: RawKind) -> T.DataType:
    """The type a raw column decodes to."""
    if kind.kind != "nested":
        return _NATURAL.get(kind.kind, raw)
    if isinstance(raw, T.ArrayType):
        return T.ArrayType(natural_type(raw.elementType, kind.parts[0]), True)
    if isinstance(raw, T.MapType):
        return T.MapType(natural_type(raw.keyType, kind.parts[0]), natural_type(raw.valueType, kind.parts[1]), True)
    return T.StructType([T.StructField(f.name, natural_type(f.dataType, k), True)
                         for f, k in zip(raw.fields, kind.parts)])


def read_schema(schema: pa.Schema) -> tuple[T.StructType, list[RawKind]]:
    fields, kinds = [], []
    for f in schema:
        st, kind = read_type(f.type)
        fields.append(T.StructField(f.name, st, True))
        kinds.append(kind)
    return T.StructType(fields), kinds


def signature(schema: pa.Schema) -> str:
    """Positional footer signature: names and types in file order."""
    return json.dumps([[f.name, str(f.type)] for f in schema])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def decode(col: Column, kind: RawKind, raw: T.DataType | None = None) -> tuple[Column, T.DataType | None]:
    """Raw column -> natural Spark value (and its type when it changed)."""
    if kind.kind == "half":
        return conv.half_to_float(col), T.FloatType()
    if kind.kind == "ts_ns":
        return conv.epoch_to_datetime(col, "ns"), T.TimestampNTZType()
    if kind.kind == "wide_decimal":
        return conv.wide_decimal_text(col, kind.scale), T.StringType()
    if kind.kind == "nested":
        return _decode_nested(col, kind, raw), natural_type(raw, kind)
    return col, None


def _inside(col: Column, kind: RawKind, raw: T.DataType) -> Column:
    if kind.kind == "wide_decimal":
        return conv.wide_decimal_text_inside(col, kind.scale)
    return conv.time_to_text(col, kind.unit) if kind.kind == "time" else decode(col, kind, raw)[0]


def _decode_nested(col: Column, kind: RawKind, raw: T.DataType) -> Column:
    """Element by element, in built-in higher-order functions; NULL stays NULL."""
    if isinstance(raw, T.ArrayType):
        return F.transform(col, lambda x: _inside(x, kind.parts[0], raw.elementType))
    if isinstance(raw, T.MapType):
        keys = F.transform(F.map_keys(col), lambda x: _inside(x, kind.parts[0], raw.keyType))
        values = F.transform(F.map_values(col), lambda x: _inside(x, kind.parts[1], raw.valueType))
        return F.map_from_arrays(keys, values)
    fields = [_inside(col.getField(f.name), k, f.dataType).alias(f.name) for f, k in zip(raw.fields, kind.parts)]
    return F.when(col.isNotNull(), F.struct(*fields))


def conform(col: Column, raw_type: T.DataType, declared: T.DataType,
            kind: RawKind = RawKind(), mode: str = "permissive") -> Column:
    """One column expression converting a raw file column to the declared type.

    ``permissive`` (the reference's behaviour: a bad cell never stops the scan)
    uses ``try_cast`` and yields NULL; ``strict`` uses ANSI ``cast`` and fails.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if kind.kind == "time":
        if isinstance(declared, T.StringType):
            return conv.time_to_text(col, kind.unit)
        value, vt = col, raw_type
    else:
        value, vt = decode(col, kind, raw_type)
        vt = vt or raw_type
    if isinstance(vt, T.TimestampType) and not isinstance(declared, T.TimestampType):
        # instant -> UTC wall clock, independent of the session time zone
        value, vt = conv.ltz_to_utc_ntz(value), T.TimestampNTZType()
    if vt == declared:
        return value
    if isinstance(vt, T.BooleanType) and isinstance(declared, _NUMERIC):
        value = conv.bool_to_int(value)
        if isinstance(declared, T.ByteType):
            return value
    if isinstance(declared, T.StringType) and isinstance(vt, _NESTED):
        return conv.nested_to_text(value)
    if mode == "strict":
        return value.cast(declared)
    return value.try_cast(declared)


def may_refuse(raw: T.DataType, declared: T.DataType, kind: RawKind = RawKind()) -> bool:
    """Whether the conversion can turn a value into NULL (``permissive``)."""
    if kind.kind in ("time", "nested") or isinstance(declared, T.StringType):
        return kind.kind == "time" and not isinstance(declared, T.StringType)
    return natural_type(raw, kind) != declared


def raw_text(col: Column, raw: T.DataType, kind: RawKind = RawKind()) -> Column:
    """A raw cell as text: what it decodes to, binary as hexadecimal digits."""
    if kind.kind == "time":
        return conv.time_to_text(col, kind.unit)
    value, vt = decode(col, kind, raw)
    vt = vt or raw
    if isinstance(vt, T.BinaryType):
        return F.hex(value)
    if isinstance(vt, _NESTED):
        return conv.nested_to_text(value)
    if isinstance(vt, T.TimestampType):
        return conv.ltz_to_utc_ntz(value).cast("string")
    return value.cast("string")


def conform_sql(col: str, raw: T.DataType, declared: T.DataType, kind: RawKind = RawKind(),
                mode: str = "permissive") -> str:
    """``conform`` as SQL text, for the types that SQL's own reader can read."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if kind.kind != "plain":
        raise ValueError(f"column {col} holds a type that SQL cannot read from the file ({kind.kind})")
    if raw == declared:
        return col
    if isinstance(declared, T.StringType) and isinstance(raw, _NESTED):
        return f"to_json({col})"
    if isinstance(raw, T.TimestampType) and not isinstance(declared, T.TimestampType):
        col = f"timestampadd(MICROSECOND, unix_micros({col}), {conv.EPOCH_NTZ})"
    if isinstance(raw, T.BooleanType) and isinstance(declared, _NUMERIC):
        col = f"CAST({col} AS TINYINT)"
    verb = "CAST" if mode == "strict" else "TRY_CAST"
    return f"{verb}({col} AS {declared.simpleString()})"


def to_struct(schema) -> T.StructType:
    """Accept a StructType or a DDL string such as ``'id INT, name STRING'``."""
    if isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    raise TypeError("schema must be a StructType or a DDL string")


__all__ = ["read_type", "read_schema", "natural_type", "signature", "conform",
           "conform_sql", "may_refuse", "raw_text", "decode", "RawKind", "to_struct", "MODES"]
