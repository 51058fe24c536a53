"""Statistics and systematic samples of tables."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampNTZType, T.TimestampType, T.BooleanType)


def column_statistics(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, least and most as text. One pass over the table.

    Distinct counts are approximate unless exact_distinct; exact ones are found column by column, each by a pass over that
    column alone, so no row is expanded and no task holds all values.
    """
    aggs = [F.count("*").alias("rows")]
    cols = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields]
    countable = [not isinstance(f.dataType, T.MapType) for f in df.schema.fields]
    for i, (f, c) in enumerate(zip(df.schema.fields, cols)):
        aggs.append(F.sum(c.isNull().cast("long")).alias(f"n{i}"))
        aggs.append((F.approx_count_distinct(c) if countable[i] and not exact_distinct else F.lit(None).cast("long")).alias(f"d{i}"))
        ordered = isinstance(f.dataType, _ORDERED)
        aggs.append((F.min(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"l{i}"))
        aggs.append((F.max(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"m{i}"))
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(i).alias("_at"),
            F.lit(f.name).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("null_count"),
            F.col(f"d{i}").cast("long").alias("distinct_count"),
            F.col(f"l{i}").alias("min_value"),
            F.col(f"m{i}").alias("max_value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    out = one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    if exact_distinct and any(countable):
        counts = [df.select(c.alias("v")).where("v IS NOT NULL").distinct().agg(F.count("*").alias("d")).select(F.lit(i).alias("_at"), "d") for i, c in enumerate(cols) if countable[i]]
        out = out.join(reduce(lambda a, b: a.unionByName(b), counts), "_at", "left").withColumn("distinct_count", F.col("d")).drop("d")
    return out.drop("_at")


def _names(path: str) -> set[str]:
    """A path as Spark may show it: as a URI, with characters beyond ASCII as they are or not."""
    legal = "/-_.!~*'(),;:$&+=@"
    kept = "".join(c if ord(c) > 127 else quote(c, safe=legal) for c in path)
    shown = {path, kept, quote(path, safe=legal)}
    return shown | {re.sub(r"^(file:/*)?/", scheme, x) for x in shown for scheme in ("file:/", "file:///") if x.startswith(("/", "file:"))}


def every_nth(parts: list[tuple[DataFrame, list[tuple[str, int]]]], ratio: int) -> DataFrame:
    """Rows 0, ratio, 2 ratio, ... of files put in order, from one scan for each file schema.

    Each scan has its rows' file (_file) and place in it (_row), and comes with the rows that lie before each of its files.
    """
    picked = []
    for df, files in parts:
        names = [(n, before) for path, before in files for n in _names(path)]
        starts = df.sparkSession.createDataFrame(names, "_file string, _before long")
        joined = df.join(starts, "_file", "left")
        place = F.coalesce("_before", F.raise_error(F.concat(F.lit("unknown file "), F.col("_file"))).cast("long")) + F.col("_row")
        picked.append(joined.where(place % ratio == 0).drop("_row", "_file", "_before"))
    return reduce(lambda a, b: a.unionByName(b), picked)
