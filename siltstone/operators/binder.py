"""Binding: files to declared columns, by name, with casts and NULLs for columns that a file lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BindError
from ..functions.casts import host_cast, map_to_json
from ..functions.types import ColumnDef
from ..sources.footer import Footer, lower

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def arrow_fields(footer: Footer) -> tuple:
    """What decides how a file is read: names and types in order."""
    return tuple((f.name, str(f.type)) for f in footer.schema)


def _special(fields: tuple) -> tuple[bool, set[str]]:
    """Whether names differ by case only, and the columns with nanoseconds, which Spark reads as numbers on request."""
    names = [lower(n) for n, _ in fields]
    return len(set(names)) < len(names), {lower(n) for n, t in fields if t.startswith("timestamp[ns")}


def open_files(spark: SparkSession, paths: list[str], fields: tuple | None) -> DataFrame:
    """Files of one schema with all their columns; clashing names and nanoseconds need a session of their own."""
    clash, nanos = _special(fields) if fields else (False, set())
    if clash or nanos:
        own = spark.newSession()
        own.conf.set("spark.sql.caseSensitive", "true" if clash else "false")
        own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        if clash:
            # The first of each name only, matched by exact name in the session that reads.
            seen: dict[str, T.StructField] = {}
            for f in own.read.parquet(paths[0]).schema.fields:
                seen.setdefault(lower(f.name), f)
            return own.read.schema(T.StructType(list(seen.values()))).parquet(*paths)
        return own.read.parquet(*paths)
    return spark.read.parquet(*paths)


def _from_nanos(col: Column, kind: T.DataType) -> Column:
    """Nanoseconds since 1970 as a timestamp of whole microseconds."""
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _from_nanos(x, kind.elementType))
    micros = F.floor(col / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,0)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def bound_columns(df: DataFrame, columns: list[ColumnDef], nanos: set[str], strict: bool = True, host_compat: bool = False) -> list[Column]:
    """One expression per declared column. Of names that differ by case only, the file's first is taken."""
    fields: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        fields.setdefault(lower(f.name), f)
    out = []
    for c in columns:
        f = fields.get(lower(c.name))
        if f is None:
            out.append(F.lit(None).cast(c.dtype).alias(c.name))
            continue
        col, kind = df["`" + f.name.replace("`", "``") + "`"], f.dataType
        if lower(c.name) in nanos:
            col = _from_nanos(col, kind)
            kind = T.ArrayType(T.TimestampNTZType()) if isinstance(kind, T.ArrayType) else T.TimestampNTZType()
        if isinstance(kind, T.MapType) and (c.json or isinstance(c.dtype, T.StringType)):
            out.append(map_to_json(col, kind, host_compat).alias(c.name))
        elif isinstance(kind, T.MapType) and isinstance(c.dtype, T.MapType):
            out.append(col.cast(c.dtype).alias(c.name))
        elif isinstance(kind, T.MapType) or isinstance(c.dtype, T.MapType):
            raise BindError(f"no cast for column '{c.name}' (from '{kind.simpleString()}' to '{c.dtype.simpleString()}')")
        elif c.json:
            raise BindError(f"no cast for column '{c.name}' (from '{kind.simpleString()}' to 'jsonb')")
        elif not strict and kind == c.dtype:
            out.append(col.alias(c.name))
        else:
            out.append(host_cast(col, kind, c.dtype, c.name, strict).alias(c.name))
    return out


def empty(spark: SparkSession, columns: list[ColumnDef]) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(c.name, c.dtype, True) for c in columns]))


def bind(spark: SparkSession, files: list[tuple[str, Footer | None]], columns: list[ColumnDef], strict: bool = True, host_compat: bool = False) -> DataFrame:
    """All rows of files as the declared columns: one scan for each distinct schema, put together by union.

    Casts stand above the scan, never in its read schema; pushed filters and pruned columns pass through them where
    Spark can unwrap the cast.
    """
    if not files:
        return empty(spark, columns)
    groups: dict[tuple | None, list[str]] = {}
    for path, footer in files:
        groups.setdefault(arrow_fields(footer) if footer else None, []).append(path)
    if None in groups:  # other stores: schemas file by file, from Spark
        rest = groups.pop(None)
        by: dict[str, list[str]] = {}
        for p in rest:
            by.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
        parts = [(None, ps) for ps in by.values()]
    else:
        parts = []
    parts += list(groups.items())
    out = None
    for fields, paths in parts:
        df = open_files(spark, paths, fields)
        nanos = _special(fields)[1] if fields else set()
        one = df.select(*bound_columns(df, columns, nanos, strict, host_compat))
        if df.sparkSession is not spark:  # back into the caller's session; the empty branch is optimised away
            one = empty(spark, columns).unionByName(one)
        out = one if out is None else out.unionByName(one)
    return out
