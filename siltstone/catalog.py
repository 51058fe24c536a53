"""Declared tables: create, alter, drop, import."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .errors import OptionError, TableError
from .functions.types import ColumnDef, columns_of, host_name, imported
from .operators.binder import _special, arrow_fields, open_files
from .sources.footer import listed, lower, read_footer
from .sources.options import TableOptions, call_function, check_function, local_path, options_from_json, quote_path


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[ColumnDef, ...]
    options: TableOptions

    def to_ddl(self) -> str:
        """The declaration as text, with names, paths and values quoted."""
        q = lambda s: '"' + s.replace('"', '""') + '"'
        v = lambda s: "'" + str(s).replace("'", "''") + "'"
        cols = ", ".join(f"{q(c.name)} {host_name(c.dtype, c.json)}" for c in self.columns)
        opts = ", ".join(f"{k} {v(x)}" for k, x in self.options.raw.items())
        return f"CREATE FOREIGN TABLE {q(self.name)} ({cols}) OPTIONS ({opts})"


@dataclass
class PartitionedTable:
    """A range-partitioned parent: children with [lo, hi) bounds on key; None is open."""

    name: str
    key: str
    children: list[tuple[object, object, str]] = field(default_factory=list)


def inferred_columns(spark: SparkSession, path: str, strict: bool = True) -> tuple[ColumnDef, ...]:
    """Columns of a file by its own schema, of a directory by its first file's."""
    files = listed([path], spark)
    if not files:
        raise TableError(f"no parquet files found in '{path}'")
    path = files[0]
    footer = read_footer(path)
    fields = arrow_fields(footer) if footer else None
    nanos = _special(fields)[1] if fields else set()
    out, seen = [], set()
    from pyspark.sql import types as T

    for f in open_files(spark, [path], fields).schema.fields:
        if lower(f.name) in seen:
            continue
        seen.add(lower(f.name))
        if lower(f.name) in nanos:
            ntz = T.TimestampNTZType()
            out.append(ColumnDef(f.name, T.ArrayType(ntz) if isinstance(f.dataType, T.ArrayType) else ntz))
        else:
            out.append(imported(f.name, f.dataType, strict))
    return tuple(out)


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, TableDef] = {}
        self.parents: dict[str, PartitionedTable] = {}
        self.functions: dict[str, Callable] = {}

    def register_function(self, name: str, f: Callable) -> None:
        """A listing function: takes the JSON argument (a dict or None), gives a list of paths."""
        self.functions[name] = f

    def _free(self, name: str) -> None:
        if name in self.tables or name in self.parents:
            raise TableError(f'table "{name}" already exists')

    def create_table(self, name: str, columns, options: dict[str, str]) -> TableDef:
        self._free(name)
        out = TableDef(name, tuple(columns_of(columns)), TableOptions.parse(options, self.functions))
        self.tables[name] = out
        return out

    def alter_table(self, name: str, add: dict | None = None, set: dict | None = None, drop: list | None = None) -> TableDef:  # noqa: A002
        """Changed options, validated together."""
        old = self.get(name)
        raw = dict(old.options.raw)
        for k in add or {}:
            if k in raw:
                raise OptionError(f'option "{k}" provided more than once')
        for k in [*(set or {}), *(drop or [])]:
            if k not in raw:
                raise OptionError(f'option "{k}" not found')
        raw |= {**(add or {}), **(set or {})}
        for k in drop or []:
            raw.pop(k)
        out = TableDef(name, old.columns, TableOptions.parse(raw, self.functions))
        self.tables[name] = out
        return out

    def drop_table(self, name: str) -> None:
        if self.tables.pop(name, None) is None and self.parents.pop(name, None) is None:
            raise TableError(f'table "{name}" does not exist')

    def get(self, name: str) -> TableDef:
        if name not in self.tables:
            raise TableError(f'table "{name}" does not exist')
        return self.tables[name]

    def create_partitioned(self, name: str, key: str, children: list[tuple[object, object, str]]) -> PartitionedTable:
        self._free(name)
        for _, _, child in children:
            self.get(child)
        out = PartitionedTable(name, key, list(children))
        self.parents[name] = out
        return out

    def import_schema(self, directory: str, limit_to: list[str] | None = None, except_: list[str] | None = None, options: dict | None = None) -> list[TableDef]:
        """One table for each *.parquet file of a directory, named by its stem."""
        local = local_path(directory)
        if local is None or not os.path.isdir(local):
            raise TableError(f"cannot open directory '{directory}'")
        out = []
        for entry in sorted(os.listdir(local)):
            stem, ext = os.path.splitext(entry)
            path = os.path.join(local, entry)
            if ext != ".parquet" or not os.path.isfile(path):
                continue
            if (limit_to is not None and stem not in limit_to) or stem in (except_ or []):
                continue
            raw = {"filename": quote_path(path), **(options or {})}
            self._free(stem)
            found = TableDef(stem, inferred_columns(self.spark, path), TableOptions.parse(raw, self.functions))
            self.tables[stem] = found
            out.append(found)
        return out

    def _files(self, table, server, func, arg) -> list[str]:
        for what, value in (("table name", table), ("server", server), ("function", func)):
            if not value:
                raise TableError(f"{what} is mandatory")
        if isinstance(arg, str):
            try:
                arg = json.loads(arg)
            except ValueError:
                raise OptionError("invalid input syntax for type json") from None
        return call_function(func, check_function(func, self.functions), arg)

    def import_parquet(self, table: str, schema: str | None, server: str, func: str, arg=None, options=None) -> TableDef:
        """A table over the files that func lists once, with the first file's columns."""
        files = self._files(table, server, func, arg)
        if not files:
            raise TableError("no parquet files found")
        raw = {**options_from_json(options), "filename": " ".join(map(quote_path, files))}
        self._free(table)
        out = TableDef(table, inferred_columns(self.spark, files[0]), TableOptions.parse(raw, self.functions))
        self.tables[table] = out
        return out

    def import_parquet_explicit(self, table: str, schema: str | None, server: str, attnames: list[str], atttypes: list[str], func: str, arg=None, options=None) -> TableDef:
        """The same with given columns."""
        if attnames is None or atttypes is None or len(attnames) != len(atttypes):
            raise TableError("number of attributes and types must be equal")
        if any(n is None for n in attnames) or any(t is None for t in atttypes):
            raise TableError("attribute names and types must not be null")
        files = self._files(table, server, func, arg)
        raw = {**options_from_json(options), "filename": " ".join(map(quote_path, files))}
        return self.create_table(table, list(zip(attnames, atttypes)), raw)
