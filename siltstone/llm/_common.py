"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
import zlib
from contextlib import contextmanager, suppress
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPACES = " \t\n\v\f\r"


_SHIPPED: set[str] = set()
SPLITS = "spark.sql.files.minPartitionNum"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once for each application, so they need no copy of their own.

    Also fixes how scans are cut into partitions: by default that follows the number of cores, which changes when
    executors are lost or join, and rows are told apart by their place in several jobs.
    """
    context = spark.sparkContext
    if not spark.conf.get(SPLITS, None):
        spark.conf.set(SPLITS, str(max(context.defaultParallelism, 8)))
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    if package.parent.is_dir():  # else it was imported from an archive that was sent already
        path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(str(path))


def pick(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The named columns, cast, found by exact name first and by case-insensitive name next.

    Other columns are dropped, so extra columns never clash, not even ones that differ by case only.
    """
    ship(df.sparkSession)
    names = df.columns
    lower = [n.lower() for n in names]
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    out = []
    for name, kind in kinds.items():
        at = names.index(name) if name in names else lower.index(name.lower())
        out.append(F.col(f"_c{at}").cast(kind).alias(name))
    return flat.select(*out)


def shared_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir).

    Where the setting is absent, a local folder stands in for it on one machine, as in tests; a cluster needs the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession):
    """Shuffle files of the jobs inside go when each job ends, as what they made is written by then."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    ship(spark)
    path = shared_dir(spark)
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that materialise() wrote, once nothing reads them any more; others are left alone."""
    for t in tables:
        path = getattr(t, "_stored", None)
        if path:
            jvm, context = t.sparkSession._jvm, t.sparkSession.sparkContext
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)


def release_memory() -> None:
    """Give memory that is free but still held back to the system: Arrow's pool and glibc's arenas."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """run, a function on Arrow batches, whose worker gives its free memory back when a task ends.

    Workers stay for later tasks and lie idle while the JVM works, and an executor's memory counts them all.
    """

    def task(batches):
        yield from run(batches)
        release_memory()

    return task


def crc32_text(col):
    """crc32 of a value written as text."""
    return F.crc32(col.cast("string").cast("binary"))


def crc32_of_id(value) -> int:
    return zlib.crc32(str(value).encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
