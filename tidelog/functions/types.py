"""Type codes of the change stream, Spark types and the lake's type strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wire codes.
BOOLEAN, SMALLINT, INT, BIGINT, FLOAT, DOUBLE, DECIMAL, STRING, BYTES, DATE, TIMESTAMP, TIMESTAMPTZ, TEXT = range(1, 14)
_SIMPLE = {
    BOOLEAN: ("BOOLEAN", T.BooleanType()), SMALLINT: ("SMALLINT", T.ShortType()), INT: ("INT", T.IntegerType()), BIGINT: ("BIGINT", T.LongType()),
    FLOAT: ("FLOAT", T.FloatType()), DOUBLE: ("DOUBLE", T.DoubleType()), STRING: ("STRING", T.StringType()), BYTES: ("BYTES", T.BinaryType()), DATE: ("DATE", T.DateType()),
    TIMESTAMP: ("TIMESTAMP", T.TimestampNTZType()), TIMESTAMPTZ: ("TIMESTAMP WITH LOCAL TIME ZONE", T.TimestampType()), TEXT: ("STRING", T.StringType()),
}
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 18


def pack_typmod(precision: int, scale: int) -> int:
    return precision << 16 | scale


def unpack_typmod(typmod: int) -> tuple[int, int]:
    """(precision, scale); values that name no precision give the default."""
    precision, scale = typmod >> 16, typmod & 0xFFFF
    return (precision, scale) if typmod > 0 and 0 < precision <= 38 and scale <= precision else (DEFAULT_PRECISION, DEFAULT_SCALE)


def spark_type(code: int, typmod: int = -1) -> T.DataType:
    if code == DECIMAL:
        return T.DecimalType(*unpack_typmod(typmod))
    return _SIMPLE.get(code, _SIMPLE[STRING])[1]


def lake_type(kind: T.DataType, nullable: bool = True) -> str:
    """The type string; nested types keep Spark's own spelling."""
    if isinstance(kind, T.DecimalType):
        name = f"DECIMAL({kind.precision}, {kind.scale})"
    else:
        name = next((n for n, t in _SIMPLE.values() if t == kind), kind.simpleString().upper())
    return name if nullable else f"{name} NOT NULL"


def typmod_column(precision: Column, scale: Column) -> Column:
    return F.shiftleft(precision.cast("int"), 16).bitwiseOR(scale.cast("int"))


def typmod_parts(typmod: Column) -> tuple[Column, Column]:
    """(precision, scale) as ``unpack_typmod`` has them."""
    precision, scale = F.shiftright(typmod, 16), typmod.bitwiseAND(F.lit(0xFFFF))
    fits = (typmod > 0) & (precision > 0) & (precision <= 38) & (scale <= precision)
    return F.when(fits, precision).otherwise(DEFAULT_PRECISION), F.when(fits, scale).otherwise(DEFAULT_SCALE)
