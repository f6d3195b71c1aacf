"""Types of cells: value types of descriptors, and what stands for them in Spark, Arrow and numpy."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from hypercell.errors import InvalidTable


@dataclass(frozen=True)
class CellType:
    name: str
    spark: T.DataType
    arrow: pa.DataType
    numpy: type
    low: int | None = None
    high: int | None = None
    is_complex: bool = False

    @property
    def default(self):
        if self.name == "string":
            return ""
        if self.name == "timestamp":
            return datetime(1970, 1, 1)
        return False if self.name == "boolean" else self.spark_zero

    @property
    def spark_zero(self):
        return 0.0 if isinstance(self.spark, (T.FloatType, T.DoubleType)) else 0


def _int(name: str, spark: T.DataType, arrow: pa.DataType, kind: type) -> CellType:
    info = np.iinfo(kind)
    return CellType(name, spark, arrow, kind, int(info.min), int(info.max))


# Unsigned types widen in Spark, which has none; Arrow output narrows them again.
TYPES: dict[str, CellType] = {
    t.name: t
    for t in (
        CellType("boolean", T.BooleanType(), pa.uint8(), np.bool_, 0, 1),
        _int("char", T.ByteType(), pa.int8(), np.int8),
        _int("uchar", T.ShortType(), pa.uint8(), np.uint8),
        _int("short", T.ShortType(), pa.int16(), np.int16),
        _int("ushort", T.IntegerType(), pa.uint16(), np.uint16),
        _int("int", T.IntegerType(), pa.int32(), np.int32),
        _int("uint", T.LongType(), pa.uint32(), np.uint32),
        _int("int64", T.LongType(), pa.int64(), np.int64),
        CellType("float", T.FloatType(), pa.float32(), np.float32),
        CellType("double", T.DoubleType(), pa.float64(), np.float64),
        CellType("complex", T.FloatType(), pa.float32(), np.complex64, is_complex=True),
        CellType("dcomplex", T.DoubleType(), pa.float64(), np.complex128, is_complex=True),
        CellType("string", T.StringType(), pa.string(), np.object_),
        # Not a type of measurement tables, whose times are numbers: for DataFrames that have it.
        CellType("timestamp", T.TimestampNTZType(), pa.timestamp("us"), np.datetime64),
    )
}


def cell_type(name: str) -> CellType:
    """By value type, in any case."""
    try:
        return TYPES[name.lower()]
    except KeyError:
        raise InvalidTable(f"value type {name} is not supported") from None


def of_numpy(dtype: np.dtype) -> CellType:
    for t in TYPES.values():
        if t.name != "string" and np.dtype(t.numpy) == dtype:
            return t
    if dtype.kind == "M":
        return TYPES["timestamp"]
    if dtype.kind in "OUS":
        return TYPES["string"]
    raise InvalidTable(f"numpy type {dtype} is not supported")


def of_spark(kind: T.DataType) -> CellType:
    """The plain value type of a Spark scalar type."""
    found = {T.BooleanType: "boolean", T.ByteType: "char", T.ShortType: "short", T.IntegerType: "int", T.LongType: "int64", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp"}
    for spark, name in found.items():
        if isinstance(kind, spark):
            return TYPES[name]
    raise InvalidTable(f"Spark type {kind.simpleString()} has no value type")


def nested(kind: T.DataType, depth: int) -> T.DataType:
    for _ in range(depth):
        kind = T.ArrayType(kind)
    return kind


def depth_of(kind: T.DataType) -> tuple[int, T.DataType]:
    """Array levels and the element type below them."""
    n = 0
    while isinstance(kind, T.ArrayType):
        kind, n = kind.elementType, n + 1
    return n, kind
