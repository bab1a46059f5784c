import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from firnlake.errors import LakeError
from firnlake.functions.values import can_widen, decode, encode, literal_sql, parse_type, type_name


@pytest.mark.parametrize(
    ("name", "kind"),
    [
        ("int4", T.IntegerType()), ("UBIGINT", T.DecimalType(20, 0)), ("DECIMAL", T.DecimalType(18, 3)), ("numeric(9)", T.DecimalType(9, 0)), ("VARCHAR(10)", T.StringType()),
        ("TIMESTAMP WITH TIME ZONE", T.TimestampType()), ("timestamp", T.TimestampNTZType()), ("DECIMAL(4,1)[]", T.ArrayType(T.DecimalType(4, 1))), ("TIMESTAMP[]", T.ArrayType(T.TimestampNTZType())),
        ("LIST(INTEGER)", T.ArrayType(T.IntegerType())), ("MAP(VARCHAR, INTEGER[])", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
        ('STRUCT("aB" INTEGER, c STRUCT(d VARCHAR))', T.StructType([T.StructField("aB", T.IntegerType()), T.StructField("c", T.StructType([T.StructField("d", T.StringType())]))])), (None, T.StringType()),
    ],
)
def test_types_read_and_round_trip(name, kind):
    assert parse_type(name) == kind
    assert parse_type(type_name(kind)) == kind


def test_unknown_type_raises():
    with pytest.raises(LakeError):
        parse_type("NOSUCH")


@pytest.mark.parametrize(
    ("value", "kind"),
    [(-5, T.LongType()), (1.5, T.DoubleType()), (float("-inf"), T.DoubleType()), (Decimal("-1.50"), T.DecimalType(10, 2)), (True, T.BooleanType()), (dt.date(2020, 2, 29), T.DateType()), (dt.datetime(2020, 1, 2, 3, 4, 5, 6), T.TimestampNTZType()), ("a'b", T.StringType()), ("", T.StringType()), (b"\x00\xff", T.BinaryType())],
)
def test_values_round_trip(value, kind):
    assert decode(encode(value, kind), kind) == value


def test_what_cannot_be_read_is_none():
    assert encode(float("nan"), T.DoubleType()) is None
    assert decode("x", T.IntegerType()) is None
    assert decode("NULL", T.StringType()) is None
    assert literal_sql("", T.IntegerType()) is None
    assert literal_sql("'it''s'", T.StringType()) == "'it\\'s'"


def test_widening():
    assert can_widen(T.IntegerType(), T.LongType())
    assert can_widen(T.IntegerType(), T.DecimalType(12, 2))
    assert not can_widen(T.IntegerType(), T.ShortType())
    assert not can_widen(T.IntegerType(), T.StringType())
    assert not can_widen(T.DecimalType(10, 2), T.DecimalType(10, 1))
