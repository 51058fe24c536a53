"""Derived inputs: slices of the given tables with several files, row groups, types and shapes, for queries and tests."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from .sources.options import local_path

VERSION = 1


def _orders(src) -> pa.Table:
    return pq.read_table(f"{src}/orders.parquet")


def _cut(t: pa.Table, n: int) -> list[pa.Table]:
    size = -(-t.num_rows // n) or 1
    return [t.slice(i * size, size) for i in range(n)]


def order_groups(src: str, out: str) -> None:
    """orders in one file of eight row groups."""
    t = _orders(src)
    pq.write_table(t, f"{out}/orders.parquet", row_group_size=-(-t.num_rows // 8) or 1)


def order_slices(src: str, out: str) -> None:
    """orders in four disjoint files in key order."""
    for k, t in enumerate(_cut(_orders(src), 4)):
        pq.write_table(t, f"{out}/part{k}.parquet", row_group_size=-(-t.num_rows // 2) or 1)


def order_mixed(src: str, out: str) -> None:
    """orders dealt row by row to three files, each in key order."""
    t = _orders(src)
    for k in range(3):
        pq.write_table(t.take(pa.array(range(k, t.num_rows, 3))), f"{out}/mix{k}.parquet")


def order_missing(src: str, out: str) -> None:
    """orders in two files; the second lacks o_orderstatus."""
    a, b = _cut(_orders(src), 2)
    pq.write_table(a, f"{out}/a.parquet")
    pq.write_table(b.drop_columns(["o_orderstatus"]), f"{out}/b.parquet")


def order_years(src: str, out: str) -> None:
    """orders by year of o_orderdate."""
    t = _orders(src)
    years = pc.year(t["o_orderdate"])
    for y in sorted(set(years.to_pylist())):
        pq.write_table(t.filter(pc.equal(years, y)), f"{out}/y{y}.parquet")


def customer_types(src: str, out: str) -> None:
    """customer in two files; c_nationkey is int32 in one and int64 in the other."""
    a, b = _cut(pq.read_table(f"{src}/customer.parquet"), 2)
    pq.write_table(a, f"{out}/a.parquet")
    at = b.schema.get_field_index("c_nationkey")
    pq.write_table(b.set_column(at, "c_nationkey", b["c_nationkey"].cast(pa.int64())), f"{out}/b.parquet")


def part_upper(src: str, out: str) -> None:
    """part with upper-case column names in another order."""
    t = pq.read_table(f"{src}/part.parquet")
    t = t.rename_columns([n.upper() for n in t.column_names])
    pq.write_table(t.select(list(reversed(t.column_names))), f"{out}/part.parquet")


def label_flags(src: str, out: str) -> None:
    """labels with quality as a boolean, sorted by it, in small row groups."""
    t = pq.read_table(f"{src}/labels.parquet").sort_by([("quality", "ascending"), ("doc_id", "ascending")])
    at = t.schema.get_field_index("quality")
    t = t.set_column(at, "quality", pc.equal(t["quality"], 1))
    pq.write_table(t, f"{out}/labels.parquet", row_group_size=-(-t.num_rows // 6) or 1)


def event_maps(src: str, out: str) -> None:
    """events with a map of one key, event_type to user_id, sorted by the key, in four files."""
    t = pq.read_table(f"{src}/events.parquet").sort_by([("event_type", "ascending"), ("event_id", "ascending")])
    pairs = [[(k, v)] for k, v in zip(t["event_type"].to_pylist(), t["user_id"].to_pylist())]
    t = pa.table({"event_id": t["event_id"], "m": pa.array(pairs, pa.map_(pa.string(), pa.int64()))})
    for k, s in enumerate(_cut(t, 4)):
        pq.write_table(s, f"{out}/m{k}.parquet")


def import_dir(src: str, out: str) -> None:
    """nation and region in a directory, with a file that is no table."""
    for n in ("nation", "region"):
        shutil.copyfile(f"{src}/{n}.parquet", f"{out}/{n}.parquet")
    with open(f"{out}/notes.txt", "w") as f:
        f.write("no table\n")


MAKERS: dict[str, Callable[[str, str], None]] = {f.__name__: f for f in (order_groups, order_slices, order_mixed, order_missing, order_years, customer_types, part_upper, label_flags, event_maps, import_dir)}


def _shared() -> str:
    """The folder that driver and executors share, as a local path; the temp folder where it is unset, on one machine."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    base = spark.conf.get("spark.checkpoint.dir", None) if spark else None
    if base:
        local = local_path(base)
        if local is None:
            raise RuntimeError(f"derived inputs are written through local paths, and {base} is none")
        return local
    if spark and spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.gettempdir()


def derived(sf_dir: str, name: str) -> str:
    """The folder of a derived input, made once for each version of the data."""
    stamp = [(n, os.stat(f"{sf_dir}/{n}").st_size, os.stat(f"{sf_dir}/{n}").st_mtime_ns) for n in sorted(os.listdir(sf_dir))]
    key = hashlib.sha1(json.dumps([VERSION, os.path.realpath(sf_dir), stamp]).encode()).hexdigest()[:16]
    root = os.path.join(_shared(), f"siltstone-{os.getuid()}", key)
    out = os.path.join(root, name)
    if not os.path.isdir(out):
        os.makedirs(root, exist_ok=True)
        made = tempfile.mkdtemp(dir=root)
        MAKERS[name](sf_dir, made)
        try:
            os.rename(made, out)
        except OSError:  # another process was first
            shutil.rmtree(made, ignore_errors=True)
    return out


def paths(folder: str) -> list[str]:
    return [os.path.join(folder, n) for n in sorted(os.listdir(folder)) if n.endswith(".parquet")]
