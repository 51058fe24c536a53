"""Casts with host semantics, and maps as JSON text. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BindError

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def utc_wall_clock(col: Column, src: T.DataType) -> Column:
    """A timestamp without zone; zoned ones keep their UTC wall clock whatever the session's zone is."""
    if isinstance(src, T.TimestampType):
        return F.to_utc_timestamp(col, F.current_timezone()).cast("timestamp_ntz")
    return col


def text_of(col: Column, src: T.DataType) -> Column:
    """A value as the host prints it."""
    if isinstance(src, _FLOATS):
        return F.regexp_replace(col.cast("string"), r"\.0$", "")
    if isinstance(src, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(col)))
    return utc_wall_clock(col, src).cast("string")


def host_cast(col: Column, src: T.DataType, dst: T.DataType, name: str = "", strict: bool = True) -> Column:
    """col of type src as dst: floats round half to even, narrowing out of range is an error, arrays go by element."""
    if isinstance(src, T.TimestampType):
        col, src = utc_wall_clock(col, src), T.TimestampNTZType()
    if src == dst:
        return col
    if isinstance(src, T.ArrayType) != isinstance(dst, T.ArrayType):
        if isinstance(src, T.ArrayType):
            raise BindError(f"cannot convert a list column to the scalar type of column '{name}'")
        raise BindError(f"no cast for column '{name}' (from '{src.simpleString()}' to '{dst.simpleString()}')")
    if isinstance(src, T.ArrayType):
        if src.elementType == dst.elementType:
            return col
        return F.transform(col, lambda x: host_cast(x, src.elementType, dst.elementType, name, strict))
    if isinstance(src, T.StructType) or isinstance(dst, T.StructType):
        raise BindError(f"no cast for column '{name}' (from '{src.simpleString()}' to '{dst.simpleString()}')")
    if isinstance(dst, T.StringType):
        return text_of(col, src)
    if isinstance(src, _FLOATS) and isinstance(dst, _INTS):
        return F.rint(col.cast("double")).cast(dst)
    boolean = {type(src), type(dst)} & {T.BooleanType}
    if strict and boolean and {type(src), type(dst)} & {T.ByteType, T.ShortType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampNTZType}:
        raise BindError(f"no cast for column '{name}' (from '{src.simpleString()}' to '{dst.simpleString()}')")
    dates = (T.DateType, T.TimestampNTZType)
    numbers = (*_INTS, *_FLOATS)
    if (isinstance(src, dates) and isinstance(dst, (*numbers, T.BinaryType))) or (isinstance(dst, dates) and isinstance(src, (*numbers, T.BinaryType))):
        raise BindError(f"no cast for column '{name}' (from '{src.simpleString()}' to '{dst.simpleString()}')")
    return col.cast(dst)


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def map_to_json(col: Column, dtype: T.MapType, host_compat: bool = False) -> Column:
    """A map as a JSON object: keys as text, ordered by length and bytes, of repeated keys the last one.

    Numbers stay numbers, null stays null, booleans are true and false (texts t and f with host_compat), everything
    else is text.
    """
    kind = dtype.valueType

    def value(v: Column) -> Column:
        if isinstance(kind, (*_INTS, *_FLOATS)):
            shown = text_of(v, kind)
        elif isinstance(kind, T.BooleanType):
            shown = F.when(v, F.lit('"t"')).otherwise(F.lit('"f"')) if host_compat else v.cast("string")
        else:
            shown = quoted(text_of(v, kind))
        return F.when(v.isNull(), F.lit("null")).otherwise(shown)

    entries = F.transform(F.map_entries(col), lambda e: F.struct(F.octet_length(text_of(e["key"], dtype.keyType)).alias("size"), text_of(e["key"], dtype.keyType).alias("key"), value(e["value"]).alias("value")))
    # Entries i + 1 on are those after entry i: the last of equal keys stays.
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda x: x["key"] == e["key"]))
    shown = F.transform(F.array_sort(last), lambda e: F.concat(quoted(e["key"]), F.lit(": "), e["value"]))
    return F.when(col.isNotNull(), F.concat(F.lit("{"), F.array_join(shown, ", "), F.lit("}")))
