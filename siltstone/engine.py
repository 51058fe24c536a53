"""The engine: declared tables as DataFrames and views, with pruning, order, explanations and statistics."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog, TableDef
from .errors import OptionError, TableError
from .operators.binder import bind, bound_columns, empty, open_files, arrow_fields, _special
from .operators.statistics import column_statistics, every_nth
from .plans.planner import EngineConf, FilePlan, ScanPlan, choose_reader, constants, disjoint_in_order, needed_order, prune, usable_order
from .plans.predicates import Predicate, _comparable, extract, scans
from .sources.footer import Footer, listed, lower, read_footers

#: A file up to this size is sorted in one task, in its own order; larger ones go through a range exchange.
ONE_TASK_BYTES = 256 << 20
#: Files that an ordered concatenation may have; each is a scan of its own in the plan. Small ones are one scan and task.
CONCAT_FILES, SMALL_BYTES = 256, 64 << 20


def asc(keys: list[str]) -> list[Column]:
    """Ascending with nulls last, as the host sorts."""
    return [F.col(k).asc_nulls_last() for k in keys]


def _plain_path(path: str) -> str:
    """A path as it is compared: local ones without their scheme."""
    return re.sub(r"^file:/+", "/", path)


class Engine(Catalog):
    def __init__(self, spark: SparkSession, conf: EngineConf | None = None):
        super().__init__(spark)
        self.conf = conf or EngineConf()

    # -- planning -------------------------------------------------------------------------------------------------

    def _footers(self, table: TableDef) -> list[tuple[str, Footer | None]]:
        files = listed(table.options.files(self.functions), self.spark)
        return list(zip(files, read_footers(files)))

    def plan(self, name: str, where=None, order_by: list[str] | None = None) -> ScanPlan:
        """Files and row groups that the query needs, the order that the files give, and the reader."""
        table = self.get(name)
        declared = {lower(c.name) for c in table.columns}
        for k in table.options.sorted:
            if lower(k) not in declared:
                raise OptionError(f'invalid attribute name "{k}" in option "sorted"')
        footers = self._footers(table)
        predicates = extract(self.spark, where)
        return self._plan(table, footers, predicates, order_by or [])

    def _plan(self, table: TableDef, footers, predicates: list[Predicate], order_by: list[str]) -> ScanPlan:
        json_columns = {lower(c.name) for c in table.columns if c.json}
        usable = [p for p in predicates if p.op == "has_key" or lower(p.column) not in json_columns]
        files = prune(footers, usable)
        live = [f for f in files if f.groups is None or f.groups]
        const = constants(predicates)
        need = needed_order(order_by, const)
        got = usable_order(table.options.sorted, order_by, const)
        reader = choose_reader(len(live), bool(got), table.options.max_open_files, self.conf)
        served = len(got) == len(need) and (reader != "Multifile" or not need or table.options.files_in_order)
        total = sum(f.rows for _, f in footers if f is not None)
        return ScanPlan(files, reader, got, bool(need) and not served and bool(live), sum(f.rows for f in files), total)

    # -- reading --------------------------------------------------------------------------------------------------

    def _pruned(self, table: TableDef, where) -> tuple[list[tuple[str, Footer | None]], list[FilePlan]]:
        footers = self._footers(table)
        predicates = extract(self.spark, where)
        json_columns = {lower(c.name) for c in table.columns if c.json}
        files = prune(footers, [p for p in predicates if p.op == "has_key" or lower(p.column) not in json_columns])
        keep = [x for x, f in zip(footers, files) if f.groups is None or f.groups]
        return keep, files

    def table(self, name: str, where=None, columns: list[str] | None = None, host_compat: bool = False) -> DataFrame:
        """A table's rows; files are listed and pruned now. where is applied in full, statistics only skip files."""
        if name in self.parents:
            return self._parent(name, where, columns)
        table = self.get(name)
        keep, _ = self._pruned(table, where)
        wanted = list(table.columns)
        df = bind(self.spark, keep, wanted, host_compat=host_compat) if keep else empty(self.spark, wanted)
        df = self._filter(df, table, where)
        return df.select(*columns) if columns else df

    def _filter(self, df: DataFrame, table: TableDef | None, where) -> DataFrame:
        if where is None:
            return df
        if isinstance(where, str):
            return df.where(where)
        for p in [x if isinstance(x, Predicate) else Predicate(*x) for x in where]:
            c, v = F.col(p.column), F.lit(p.value)
            json = table is not None and any(lower(x.name) == lower(p.column) and x.json for x in table.columns)
            if p.op == "has_key":
                cond = F.array_contains(F.json_object_keys(c), F.lit(str(p.value))) if json else F.map_contains_key(c, v)
            else:
                cond = {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v, "=": c == v}[p.op]
            df = df.where(cond)
        return df

    def pruned_children(self, name: str, where=None) -> list[str]:
        """Children whose [lo, hi) interval the condition can meet."""
        parent = self.parents[name]
        predicates = [p for p in extract(self.spark, where) if lower(p.column) == lower(parent.key)]

        def meets(lo, hi) -> bool:
            for p in predicates:
                sample = lo if lo is not None else hi
                try:
                    v = _comparable(p.value, sample)
                    low, high = (x.encode() if isinstance(x, str) else x for x in (lo, hi))
                    if p.op in ("=", "<", "<=") and low is not None and not (low < v if p.op == "<" else low <= v):
                        return False
                    if p.op in ("=", ">", ">=") and high is not None and not v < high:
                        return False
                except (TypeError, ValueError, ArithmeticError):
                    continue
            return True

        return [child for lo, hi, child in parent.children if meets(lo, hi)]

    def _parent(self, name: str, where, columns) -> DataFrame:
        children = self.pruned_children(name, where)
        if not children:
            first = self.get(self.parents[name].children[0][2])
            out = empty(self.spark, list(first.columns))
            return out.select(*columns) if columns else out
        return reduce(lambda a, b: a.unionByName(b), [self.table(c, where, columns) for c in children])

    def ordered_scan(self, name: str, order_by: list[str], where=None) -> DataFrame:
        """Rows in order, nulls last. A declared order saves the exchange where it can be relied on:

        one file of moderate size is read by one task; files in order, if their statistics prove it, are sorted one by
        one and put together; a range-partitioned parent ordered by its key is its children in order. Rows are sorted
        within files in any case, so a wrong promise can't give a wrong order.
        """
        need = needed_order(order_by, constants(extract(self.spark, where)))
        if name in self.parents:
            parent = self.parents[name]
            if need and lower(need[0]) == lower(parent.key):
                kids = self.pruned_children(name, where)
                bounds = {c: (lo, hi) for lo, hi, c in parent.children}
                if kids and len(kids) <= CONCAT_FILES and self._in_bounds(parent.key, kids, bounds):
                    kids.sort(key=lambda c: (bounds[c][0] is not None, bounds[c][0]))
                    parts = [self.table(c, where).coalesce(1).sortWithinPartitions(*asc(need)) for c in kids]
                    return reduce(lambda a, b: a.union(b), parts)
            df = self.table(name, where)
            return df.orderBy(*asc(need)) if need else df
        table = self.get(name)
        plan = self.plan(name, where, order_by)
        keep, _ = self._pruned(table, where)
        if not need or not keep:
            return self.table(name, where)
        footers = [f for _, f in keep]
        small = all(f is not None and f.size <= ONE_TASK_BYTES for f in footers)
        if small and len(keep) == 1 and len(plan.order) == len(need):
            return self._filter(bind(self.spark, keep, list(table.columns)), table, where).coalesce(1).sortWithinPartitions(*asc(need))
        in_order = table.options.files_in_order and plan.order and len(keep) <= CONCAT_FILES
        if small and in_order and sum(f.size for f in footers) <= SMALL_BYTES:
            return self.table(name, where).coalesce(1).sortWithinPartitions(*asc(need))
        if small and in_order and disjoint_in_order(footers, need[0]):
            parts = [self._filter(bind(self.spark, [x], list(table.columns)), table, where).coalesce(1).sortWithinPartitions(*asc(need)) for x in keep]
            return reduce(lambda a, b: a.union(b), parts)
        return self.table(name, where).orderBy(*asc(need))

    def _in_bounds(self, key: str, kids: list[str], bounds: dict) -> bool:
        """Whether statistics prove that the children's rows keep their bounds, which are not enforced on reading."""
        for c in kids:
            lo, hi = bounds[c]
            for _, f in self._footers(self.get(c)):
                if f is None:
                    return False
                for g in f.groups:
                    s = g.stats.get(lower(key))
                    if g.rows and (s is None or s.nulls != 0):
                        return False
                    try:
                        if g.rows and ((lo is not None and s.least < _comparable(lo, s.least)) or (hi is not None and s.most >= _comparable(hi, s.most))):
                            return False
                    except (TypeError, ValueError):
                        return False
        return True

    def sql(self, query: str, args: dict | list | None = None) -> DataFrame:
        """A statement over declared tables; those that it names are listed anew and registered as views.

        What Spark's optimiser makes of the statement, parameters included, says what each scan is filtered by. Files
        that no scan needs by their statistics, and partitions with nothing but such files, are left out of the views.
        """
        words = {w.lower() for w in re.findall(r"\w+", query)}
        named = [n for n in [*self.tables, *self.parents] if n.lower() in words]
        leaves = dict.fromkeys(c for n in named for c in ([k for _, _, k in self.parents[n].children] if n in self.parents else [n]))
        listed = {n: self._footers(self.get(n)) for n in leaves}

        def run() -> DataFrame:
            for n in named:
                if n in self.parents:
                    kids = [c for _, _, c in self.parents[n].children]
                    live = [c for c in kids if listed[c]] or kids[:1]
                    df = reduce(lambda a, b: a.unionByName(b), [self._bound(c, listed[c]) for c in live])
                else:
                    df = self._bound(n, listed[n])
                df.createOrReplaceTempView(n)
            return self.spark.sql(query, args=args) if args is not None else self.spark.sql(query)

        df = run()
        footers = {_plain_path(p): f for files in listed.values() for p, f in files}
        seen: set[str] = set()
        needed: set[str] = set()
        for paths, predicates in scans(df._jdf.queryExecution().optimizedPlan()):
            own = [p for p in map(_plain_path, paths) if p in footers]
            seen.update(own)
            needed.update(f.path for f in prune([(p, footers[p]) for p in own], predicates) if f.groups is None or f.groups)
        idle = seen - needed
        if idle:
            listed = {n: [x for x in files if _plain_path(x[0]) not in idle] for n, files in listed.items()}
            df = run()
        return df

    def _bound(self, name: str, files: list[tuple[str, Footer | None]]) -> DataFrame:
        columns = list(self.get(name).columns)
        return bind(self.spark, files, columns) if files else empty(self.spark, columns)

    # -- explanations and statistics --------------------------------------------------------------------------------

    def explain_scan(self, name: str, where=None, order_by: list[str] | None = None) -> DataFrame:
        """One row for each row group that is read: file, row_group (from 1), row_count."""
        import os

        plan = self.plan(name, where, order_by)
        rows = [(os.path.basename(f.path), g, f.group_rows[g]) for f in plan.files if f.groups for g in f.groups]
        return self.spark.createDataFrame(rows, "file string, row_group int, row_count long")

    def explain_text(self, name: str, where=None, order_by: list[str] | None = None) -> str:
        return self.plan(name, where, order_by).text()

    def analyze(self, name: str, exact_distinct: bool = False) -> DataFrame:
        """Statistics of each column."""
        return column_statistics(self.table(name), exact_distinct)

    def sample(self, name: str, target: int) -> DataFrame:
        """About target rows: every n-th row of the files put in order, n = total / target; all if there are fewer."""
        if target < 1:
            raise TableError("target must be positive")
        table = self.get(name)
        footers = self._footers(table)
        if not footers or all(f is not None and not f.rows for _, f in footers):
            return empty(self.spark, list(table.columns))
        counts = [f.rows if f is not None else self.spark.read.parquet(p).count() for p, f in footers]
        ratio = max(1, sum(counts) // target)
        groups: dict[tuple | None, list[tuple[str, int]]] = {}
        before = 0
        for (path, footer), n in zip(footers, counts):
            key = arrow_fields(footer) if footer else (path,)
            groups.setdefault(key, []).append((path, before))
            before += n
        parts = []
        for key, files in groups.items():
            fields = key if key and isinstance(key[0], tuple) else None
            df = open_files(self.spark, [p for p, _ in files], fields)
            nanos = _special(fields)[1] if fields else set()
            cols = bound_columns(df, list(table.columns), nanos)
            parts.append((df.select(*cols, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")), files))
        return every_nth(parts, ratio)
