"""Host type names and their Spark types; what a file's type becomes on import."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..errors import UnsupportedType

#: Names of scalar types in declarations.
HOST_TYPES: dict[str, T.DataType] = {
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "int2": T.ShortType(),
    "smallint": T.ShortType(),
    "int4": T.IntegerType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "int8": T.LongType(),
    "bigint": T.LongType(),
    "float4": T.FloatType(),
    "real": T.FloatType(),
    "float8": T.DoubleType(),
    "double": T.DoubleType(),
    "double precision": T.DoubleType(),
    "text": T.StringType(),
    "varchar": T.StringType(),
    "bytea": T.BinaryType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}
JSON_NAMES = ("json", "jsonb")
_SCALARS = (T.BooleanType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BinaryType, T.TimestampNTZType, T.DateType)
NAME_LIMIT = 63


@dataclass(frozen=True)
class ColumnDef:
    """A declared column. json: the column is a map, written as a JSON object."""

    name: str
    dtype: T.DataType
    json: bool = False


def parse_type(name: str) -> tuple[T.DataType, bool]:
    """Spark type of a host type name, and whether it is JSON. `x[]` is an array of x."""
    key = " ".join(name.lower().split())
    if key in JSON_NAMES:
        return T.StringType(), True
    if key.endswith("[]"):
        return T.ArrayType(parse_type(key[:-2])[0], True), False
    if key not in HOST_TYPES:
        raise UnsupportedType(f"type {name!r} is not supported")
    return HOST_TYPES[key], False


def host_name(dtype: T.DataType, json: bool = False) -> str:
    """The canonical host name of a column's type."""
    if json:
        return "jsonb"
    if isinstance(dtype, T.ArrayType):
        return host_name(dtype.elementType) + "[]"
    return next((k for k, v in HOST_TYPES.items() if v == dtype), dtype.simpleString())


def columns_of(declared) -> list[ColumnDef]:
    """Columns from pairs (name, host type name or Spark type), a dict of them, or a StructType."""
    if isinstance(declared, T.StructType):
        return [ColumnDef(f.name, f.dataType) for f in declared.fields]
    pairs = declared.items() if isinstance(declared, dict) else declared
    out = []
    for name, kind in pairs:
        dtype, json = parse_type(kind) if isinstance(kind, str) else (kind, False)
        out.append(ColumnDef(name, dtype, json))
    return out


def imported(name: str, dtype: T.DataType, strict: bool = True) -> ColumnDef:
    """The column that an import declares for a file's column."""
    if isinstance(dtype, T.ByteType):
        return ColumnDef(name, T.ShortType())
    if isinstance(dtype, T.TimestampType):
        return ColumnDef(name, T.TimestampNTZType())
    if isinstance(dtype, _SCALARS):
        return ColumnDef(name, dtype)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (*_SCALARS, T.ByteType, T.TimestampType)):
        return ColumnDef(name, T.ArrayType(imported(name, dtype.elementType).dtype, True))
    if isinstance(dtype, T.MapType) and not isinstance(dtype.keyType, (T.StructType, T.ArrayType, T.MapType)) and not isinstance(dtype.valueType, (T.StructType, T.ArrayType, T.MapType)):
        return ColumnDef(name, T.StringType(), True)
    if strict:
        raise UnsupportedType(f"column {name!r} of type {dtype.simpleString()} is not supported")
    return ColumnDef(name, dtype)
