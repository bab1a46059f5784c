"""Catalog type names, and values as the catalog's text."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T

from ..errors import LakeError

# Catalog type names and the Spark types they stand for.
NAMES = {
    "TINYINT": T.ByteType(), "INT1": T.ByteType(), "SMALLINT": T.ShortType(), "INT2": T.ShortType(), "SHORT": T.ShortType(),
    "INTEGER": T.IntegerType(), "INT4": T.IntegerType(), "INT": T.IntegerType(), "SIGNED": T.IntegerType(),
    "BIGINT": T.LongType(), "INT8": T.LongType(), "LONG": T.LongType(),
    "UTINYINT": T.ShortType(), "USMALLINT": T.IntegerType(), "UINTEGER": T.LongType(), "UBIGINT": T.DecimalType(20, 0),
    "HUGEINT": T.DecimalType(38, 0), "UHUGEINT": T.DecimalType(38, 0),
    "FLOAT": T.FloatType(), "FLOAT4": T.FloatType(), "REAL": T.FloatType(), "DOUBLE": T.DoubleType(), "FLOAT8": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "LOGICAL": T.BooleanType(),
    "VARCHAR": T.StringType(), "TEXT": T.StringType(), "STRING": T.StringType(), "CHAR": T.StringType(), "BPCHAR": T.StringType(), "NAME": T.StringType(),
    "BLOB": T.BinaryType(), "BYTEA": T.BinaryType(), "BINARY": T.BinaryType(), "VARBINARY": T.BinaryType(), "DATE": T.DateType(),
    "TIME": T.StringType(), "TIMETZ": T.StringType(), "TIME_NS": T.StringType(), "INTERVAL": T.StringType(), "UUID": T.StringType(), "JSON": T.StringType(),
    "ENUM": T.StringType(), "BIT": T.StringType(), "GEOMETRY": T.StringType(), "VARIANT": T.StringType(),
    "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMP_S": T.TimestampNTZType(), "TIMESTAMP_MS": T.TimestampNTZType(), "TIMESTAMP_US": T.TimestampNTZType(), "TIMESTAMP_NS": T.TimestampNTZType(),
    "TIMESTAMP WITHOUT TIME ZONE": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(), "TIMESTAMPTZ": T.TimestampType(), "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
}


def _split(text: str) -> list[str]:
    """Parts at commas outside parentheses and quotes."""
    parts, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(text):
        if c == '"':
            quoted = not quoted
        elif not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                parts.append(text[start:i].strip())
                start = i + 1
    return [*parts, text[start:].strip()]


def parse_type(name: str | None) -> T.DataType:
    """The Spark type of a catalog type; names of nested fields keep their case. Null is a string; unknown names raise."""
    if name is None:
        return T.StringType()
    text = name.strip()
    if text.endswith("]"):
        return T.ArrayType(parse_type(text[: text.rindex("[")]))
    head, _, rest = text.partition("(")
    head, inner = head.strip().upper(), rest[: rest.rindex(")")] if ")" in rest else ""
    if head in ("DECIMAL", "NUMERIC"):
        args = [int(x) for x in _split(inner)] if inner else [18, 3]
        return T.DecimalType(args[0], args[1] if len(args) > 1 else 0)
    if head == "LIST":
        return T.ArrayType(parse_type(inner))
    if head == "MAP":
        k, v = _split(inner)
        return T.MapType(parse_type(k), parse_type(v))
    if head == "STRUCT":
        fields = []
        for part in _split(inner):
            field, _, kind = part[1:].partition('"') if part.startswith('"') else part.partition(" ")
            fields.append(T.StructField(field, parse_type(kind.strip())))
        return T.StructType(fields)
    if head in NAMES:
        return NAMES[head]
    raise LakeError(f"unknown catalog type {name!r}")


def type_name(t: T.DataType) -> str:
    """The catalog type of a Spark type."""
    plain = {
        T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN",
        T.StringType: "VARCHAR", T.CharType: "VARCHAR", T.VarcharType: "VARCHAR", T.BinaryType: "BLOB", T.DateType: "DATE", T.TimestampType: "TIMESTAMPTZ", T.TimestampNTZType: "TIMESTAMP",
    }
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, T.ArrayType):
        return type_name(t.elementType) + "[]"
    if isinstance(t, T.MapType):
        return f"MAP({type_name(t.keyType)}, {type_name(t.valueType)})"
    if isinstance(t, T.StructType):
        return "STRUCT(" + ", ".join(f'"{f.name}" {type_name(f.dataType)}' for f in t.fields) + ")"
    return plain.get(type(t), "VARCHAR")


def is_scalar(t: T.DataType) -> bool:
    return not isinstance(t, (T.ArrayType, T.MapType, T.StructType))


def encode(value: Any, t: T.DataType) -> str | None:
    """A scalar as text; None for null and for NaN, whose order is not known."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        if value.tzinfo:
            value = value.astimezone(dt.UTC).replace(tzinfo=None)
        return value.isoformat(sep=" ", timespec="microseconds")
    return str(value)


def decode(text: str | None, t: T.DataType) -> Any:
    """A scalar from its text: what encode() made, or a literal of the catalog (quotes stripped); None if it can't be read."""
    if text is None or text.strip().upper() == "NULL":
        return None
    if isinstance(t, T.StringType):
        return text[1:-1].replace("''", "'") if len(text) >= 2 and text[0] == text[-1] == "'" else text
    text = text.strip().strip("'")
    try:
        if isinstance(t, T.BooleanType):
            return {"true": True, "t": True, "1": True, "false": False, "f": False, "0": False}[text.lower()]
        if isinstance(t, T.IntegralType):
            return int(text)
        if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType):
            return float(text)
        if isinstance(t, T.DecimalType):
            return Decimal(text)
        if isinstance(t, T.DateType):
            return dt.date.fromisoformat(text[:10])
        if isinstance(t, T.TimestampNTZType):
            return dt.datetime.fromisoformat(text).replace(tzinfo=None)
        if isinstance(t, T.TimestampType):
            at = dt.datetime.fromisoformat(text)
            return at if at.tzinfo else at.replace(tzinfo=dt.UTC)
        if isinstance(t, T.BinaryType):
            return bytes.fromhex(text)
    except (ValueError, KeyError, ArithmeticError):
        return None
    return None


def literal_sql(text: str | None, t: T.DataType) -> str | None:
    """SQL of a column's initial default, for Spark's EXISTS_DEFAULT; None if there is none or it can't be read."""
    value = decode(text, t) if is_scalar(t) else None
    if value is None or text == "" and not isinstance(t, T.StringType):
        return None
    if isinstance(t, T.StringType):
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(t, T.BinaryType):
        return f"X'{bytes(value).hex()}'"
    if isinstance(t, T.BooleanType):
        return str(value).lower()
    return f"CAST('{encode(value, t)}' AS {t.simpleString()})"


#: Widening that old files can be read through: from a type to wider ones.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType), T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType), T.FloatType: (T.DoubleType,),
}


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    if old == new or type(new) in _WIDER.get(type(old), ()):
        return True
    if isinstance(new, T.DecimalType):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}.get(type(old))
        if digits:
            return new.precision - new.scale >= digits
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return False
