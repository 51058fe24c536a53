"""Parquet footers: row groups and their statistics, read once per version of a file."""

from __future__ import annotations

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JError

from ..errors import OptionError
from .options import local_path

READERS = 16
CACHE_FILES = 10_000
#: What is read of a file of another store at first.
TAIL_BYTES = 64 << 10


@dataclass(frozen=True)
class Stats:
    least: object
    most: object
    nulls: int | None


@dataclass(frozen=True)
class RowGroup:
    number: int  # from 1
    rows: int
    stats: dict[str, Stats]  # by lower-cased leaf path; absent without minimum and maximum


@dataclass(frozen=True)
class Footer:
    path: str
    groups: tuple[RowGroup, ...]
    schema: object  # Arrow
    size: int

    @property
    def rows(self) -> int:
        return sum(g.rows for g in self.groups)


_cache: dict[tuple, Footer] = {}
_lock = threading.Lock()


def lower(name: str) -> str:
    """Lower case of A to Z only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in name)


class _Tail:
    """The end of a file of another store, read as if the rest were there."""

    def __init__(self, data: bytes, size: int):
        self.data, self.size, self.at, self.closed = data, size, size, False

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def read(self, n: int = -1) -> bytes:
        start = self.at - (self.size - len(self.data))
        if start < 0:
            raise ValueError("only the end of the file is here")
        out = self.data[start:] if n is None or n < 0 else self.data[start : start + n]
        self.at += len(out)
        return out

    def close(self) -> None:
        self.closed = True


def _session():
    """The calling thread's session."""
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def _stored_footer(path: str, spark):
    """(key, reader of metadata and schema) of a file that Spark's file systems reach; None without a session."""
    if spark is None:
        return None
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    status = store.getFileStatus(where)
    size = status.getLen()

    def end(n: int) -> bytes:
        stream = store.open(where)
        try:
            stream.seek(size - n)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
        finally:
            stream.close()

    def read():
        data = end(min(size, TAIL_BYTES))
        need = int.from_bytes(data[-8:-4], "little") + 8
        if need > len(data):
            data = end(min(size, need))
        meta = pq.read_metadata(pa.PythonFile(_Tail(data, size), mode="r"))
        return meta, meta.schema.to_arrow_schema()

    return (path, status.getModificationTime(), size), read


def read_footer(path: str, spark=None) -> Footer | None:
    """The footer of a file, by Spark's file systems where it isn't local; None if it can't be read there, so that Spark
    prunes its row groups alone."""
    local = local_path(path)
    if local is None:
        try:
            stored = _stored_footer(path, spark or _session())
        except Py4JError:
            stored = None
        if stored is None:
            return None
        key, read = stored
        size = key[2]
    else:
        stat = os.stat(local)
        key, size = (local, stat.st_mtime_ns, stat.st_size), stat.st_size

        def read():
            with pq.ParquetFile(local) as f:
                return f.metadata, f.schema_arrow

    if (found := _cache.get(key)) is not None:
        return found
    meta, schema = read()
    groups = []
    for k in range(meta.num_row_groups):
        g, stats = meta.row_group(k), {}
        for c in range(g.num_columns):
            col = g.column(c)
            name = lower(col.path_in_schema)
            s = col.statistics if col.is_stats_set else None
            if s is not None and s.has_min_max and name not in stats:
                try:
                    stats[name] = Stats(s.min, s.max, s.null_count if s.has_null_count else None)
                except (ValueError, NotImplementedError):
                    pass  # a type whose statistics can't be shown is not pruned by
        groups.append(RowGroup(k + 1, g.num_rows, stats))
    out = Footer(path, tuple(groups), schema, size)
    with _lock:
        if len(_cache) >= CACHE_FILES:
            _cache.clear()
        _cache[key] = out
    return out


def _entries(path: str, spark) -> list[tuple[str, bool]] | None:
    """(path, whether it is a directory) of what a directory holds; None if it is no directory or can't be looked at."""
    local = local_path(path)
    if local is not None:
        if not os.path.isdir(local):
            return None
        with os.scandir(local) as found:
            return [(f"{path.rstrip('/')}/{e.name}", e.is_dir()) for e in found]
    if spark is None:
        return None
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        store = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not store.getFileStatus(where).isDirectory():
            return None
        return [(f"{path.rstrip('/')}/{s.getPath().getName()}", s.isDirectory()) for s in store.listStatus(where)]
    except Py4JError:
        return None


def listed(paths: list[str], spark=None) -> list[str]:
    """The files that the paths name: a directory stands for the files in it, by name, as Spark writes a table.

    Names that begin with _ or . are no data. Directories in a directory are refused, as their rows would be left out.
    """
    out = []
    for p in paths:
        entries = _entries(p, spark or _session())
        if entries is None:
            out.append(p)
            continue
        data = sorted((x, nested) for x, nested in entries if not x.rsplit("/", 1)[1].startswith(("_", ".")))
        for x, nested in data:
            if nested:
                raise OptionError(f"directory '{p}' holds the directory '{x}'; name its files instead")
        out += [x for x, _ in data]
    return out


def read_footers(paths: list[str]) -> list[Footer | None]:
    if len(paths) < 2:
        return [read_footer(p) for p in paths]
    spark = _session()  # other threads have none
    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(lambda p: read_footer(p, spark), paths))
