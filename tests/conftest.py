import datetime as dt
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _write(path, schema, groups):
    with pq.ParquetWriter(path, schema) as w:
        for rows in groups:
            w.write_table(pa.Table.from_pylist(rows, schema=schema))


@pytest.fixture(scope="session")
def files(tmp_path_factory):
    """Small files: two simple ones (lists, all kinds of scalars, two row groups), maps, two monthly parts."""
    # Names, rows and row groups below are fixed values: known results are asserted over them.
    out = tmp_path_factory.mktemp("files")
    day = lambda d, *t: dt.datetime(2018, 1, d, *t)
    base = [("one", pa.int64()), ("two", pa.list_(pa.int64())), ("three", pa.string()), ("four", pa.timestamp("us")), ("five", pa.date32()), ("six", pa.bool_())]
    names = [n for n, _ in base]
    full = pa.schema([*base, ("seven", pa.float64())])
    row = lambda v: dict(zip([*names, "seven"], v))
    g1 = [
        row((1, [1, 2, 3], "foo", day(1), dt.date(2018, 1, 1), True, 0.5)),
        row((2, [None, 5, 6], "bar", day(2), dt.date(2018, 1, 2), False, None)),
        row((3, [7, 8, 9], "baz", day(3), dt.date(2018, 1, 3), True, 1.0)),
    ]
    g2 = [
        row((4, [10, 11, 12], "uno", day(4, 0, 0, 10), dt.date(2018, 1, 4), False, 1.5)),
        row((5, [13, 14, 15], "dos", day(5, 0, 0, 0, 10000), dt.date(2018, 1, 5), False, None)),
        row((6, [16, 17, 18], "tres", day(6, 0, 0, 0, 10), dt.date(2018, 1, 6), False, 2.0)),
    ]
    (out / "simple").mkdir()
    _write(out / "simple/example1.parquet", full, [g1, g2])
    second = [(1, [19, 20], "eins", 1, True), (3, [21, 22], "zwei", 3, False), (5, [23, 24], "drei", 5, True), (7, [25, 26], "vier", 7, False), (9, [27, 28], "fünf", 9, True)]
    rows = [dict(zip(names, (a, b, c, day(d), dt.date(2018, 1, d), f))) for a, b, c, d, f in second]
    _write(out / "simple/example2.parquet", pa.schema(base), [rows, []])
    (out / "complex").mkdir()
    maps = pa.schema([("one", pa.map_(pa.int32(), pa.string())), ("two", pa.map_(pa.date32(), pa.int16())), ("three", pa.int32())])
    d = lambda k: dt.date(2018, 1, k)
    _write(
        out / "complex/example3.parquet",
        maps,
        [[{"one": [(1, "foo"), (2, "bar"), (3, "baz")], "two": [(d(1), 10), (d(2), 15)], "three": 1}, {"one": [(4, "test1"), (5, "test2")], "two": [(d(3), 20), (d(4), 25)], "three": 2}]],
    )
    part = pa.schema([("id", pa.int64()), ("token", pa.int64()), ("date", pa.timestamp("us")), ("num", pa.int64())])
    (out / "partition").mkdir()
    for k, values in ((1, [(1, 1, 10), (1, 1, 23), (2, 2, 9), (3, 2, 38)]), (2, [(1, 1, 59), (2, 2, 1), (2, 2, 32), (3, 2, 96)])):
        _write(out / f"partition/part{k}.parquet", part, [[{"id": i, "token": t, "date": dt.datetime(2018, k, n + 1), "num": v} for n, (i, t, v) in enumerate(values)]])
    return out
