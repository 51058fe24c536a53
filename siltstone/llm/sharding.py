"""Uniform sharding by a hypergeometric communication matrix.

How many rows each input partition sends to each output block follows a multivariate hypergeometric law, so it is
drawn first, exactly. The matrix is never held: the partitions are halved again and again, each half's share of every
block is drawn from a generator seeded by the half, and a task follows the halves that it is in down to its own row. It
needs the partitions' counts and one number a block, so blocks keep their size however many partitions there are. Each
partition then permutes its rows locally, the rows are exchanged, and each block is permuted again by a random key.
Shard sizes are exact (counts differ by one at most) and every arrangement is equally likely.

Defined results: a null text counts no bytes (size 1, crc32 of the empty text); null ids, repeated rows and ties are
ordinary rows; very long texts travel as they are, and count as one row; an empty table gives an empty result; other
columns travel along untouched.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialise, pick, table

#: Rows that a block holds at most.
BLOCK_ROWS = 32_768
#: Blocks whose share is drawn together, in populations that are too large for numpy.
GROUP_BLOCKS = 1_024
#: Tasks that blocks are dealt to at most; each looks at one block at a time.
MOST_TASKS = 100_000
#: numpy draws hypergeometric numbers below this population only.
NUMPY_LIMIT = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good items among draws without replacement, for any population."""
    total = good + bad
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if draws == total:
        return good
    if total < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    # Rejection from the ratio of uniforms around the mode, with log-factorials.
    def log_p(k: int) -> float:
        return -sum(math.lgamma(x + 1) for x in (k, good - k, draws - k, bad - draws + k))

    low, high = max(0, draws - bad), min(draws, good)
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    p = good / total
    sd = math.sqrt(draws * p * (1 - p) * (total - draws) / (total - 1) + 0.5)
    top, wide = log_p(mode), 1.7156 * sd + 0.8989
    while True:
        u, v = rng.random(), rng.random()
        k = math.floor(mode + 0.5 + wide * (v - 0.5) / max(u, 1e-12))
        if low <= k <= high and 2 * math.log(max(u, 1e-300)) <= log_p(k) - top:
            return k


def _share(rng: np.random.Generator, left: np.ndarray, draws: int, limit: int) -> np.ndarray:
    """How many of each kind are among draws without replacement from left, for any population."""
    total = int(left.sum())
    if total < limit:
        return rng.multivariate_hypergeometric(left, draws, method="marginals")
    if len(left) > GROUP_BLOCKS:  # groups first, then the kinds of each group
        edge = np.arange(0, len(left), GROUP_BLOCKS)
        got = _share(rng, np.add.reduceat(left, edge), draws, limit)
        return np.concatenate([_share(rng, left[e : e + GROUP_BLOCKS], int(n), limit) for e, n in zip(edge.tolist(), got)])
    out = np.zeros(len(left), np.int64)
    for b, n in enumerate(left.tolist()):
        x = hypergeometric(rng, n, total - n, draws)
        out[b], draws, total = x, draws - x, total - n
    return out


def matrix_row(p: int, before: np.ndarray, capacity: np.ndarray, seed: int, limit: int = NUMPY_LIMIT) -> np.ndarray:
    """How many rows partition p sends to each block: row p of an exact draw of the whole matrix.

    before: rows of the partitions before each one, and of all. Row sums are the partitions' counts, column sums capacity.
    """
    lo, hi, own = 0, len(before) - 1, np.array(capacity, np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.Generator(np.random.PCG64([seed, 1, lo, hi]))
        first = _share(rng, own, int(before[mid] - before[lo]), limit)
        lo, hi, own = (lo, mid, first) if p < mid else (mid, hi, own - first)
    return own


def communication_matrix(counts: list[int], capacity: list[int], seed: int, limit: int = NUMPY_LIMIT) -> np.ndarray:
    """All rows, for small cases."""
    before = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    return np.stack([matrix_row(p, before, capacity, seed, limit) for p in range(len(counts))])


def block_sizes(total: int, n_shards: int, block_rows: int, least_blocks: int = 1) -> tuple[int, np.ndarray]:
    """Blocks of a shard, and the rows of every block, shard by shard: they differ by one at most in a shard."""
    k = max(1, math.ceil(total / n_shards / block_rows), math.ceil(least_blocks / n_shards))
    k = min(k, max(1, total // n_shards))
    base, over = divmod(total, n_shards)
    shard = np.arange(n_shards) < over
    each, more = np.divmod(base + shard.astype(np.int64), k)
    return k, (each[:, None] + (np.arange(k) < more[:, None])).ravel()


def hypergeometric_shards(
    df: DataFrame, n_shards: int = 16, seed: int = 17, stable: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """df with shard (int) and slot (long, gapless from 0 in each shard), uniformly at random.

    stable: the partitions of df hold the same rows in the same order each time they are computed, as those of a
    Parquet scan do. Otherwise df is written to the shared folder first, so a recomputed task can't change its rows.
    Clashing columns named shard or slot in df are an error of the caller; rename them first.
    """
    spark = df.sparkSession
    if not stable:
        df = materialise(df)
    parts = df.rdd.getNumPartitions()

    def count(batches):
        from pyspark import TaskContext
        import pyarrow as pa

        n = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"p": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([n], pa.int64())})

    narrow = df.select(F.lit(1).cast("byte").alias("one"))
    found = {r.p: r.n for r in narrow.mapInArrow(count, "p int, n long").collect()}
    before = np.concatenate([[0], np.cumsum([found.get(p, 0) for p in range(parts)], dtype=np.int64)])
    total = int(before[-1])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    k, capacity = block_sizes(total, n_shards, block_rows, 2 * tasks)
    base, over = divmod(total, n_shards)
    sent = spark.sparkContext.broadcast(before)  # one number a partition
    asked = (n_shards, block_rows, 2 * tasks)

    def scatter(batches):
        from pyspark import TaskContext
        import pyarrow as pa

        p = TaskContext.get().partitionId()
        row = matrix_row(p, sent.value, block_sizes(total, *asked)[1], seed)
        rng = np.random.Generator(np.random.PCG64([seed, 2, p]))
        dest = rng.permutation(np.repeat(np.arange(len(row), dtype=np.int32), row))
        done = 0
        for b in batches:
            n = b.num_rows
            own = dest[done : done + n]
            key = rng.integers(-(2**63), 2**63 - 1, n, dtype=np.int64)
            done += n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(key)], names=[*b.schema.names, "_block", "_key"])

    names = df.columns
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    schema = T.StructType([*flat.schema.fields, T.StructField("_block", T.IntegerType()), T.StructField("_key", T.LongType())])
    moved = flat.mapInArrow(scatter, schema).repartition(max(tasks, min(len(capacity), MOST_TASKS)), "_block")
    w = Window.partitionBy("_block").orderBy("_key")
    shard = F.floor(F.col("_block") / k).cast("int")
    block = (F.col("_block") % k).cast("long")
    size = F.lit(base) + F.when(shard < over, 1).otherwise(0)
    each = F.floor(size / k).cast("long")
    start = block * each + F.least(block, size - each * k)
    out = moved.withColumn("_row", F.row_number().over(w).cast("long"))
    return out.select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)],
        shard.alias("shard"),
        (start + F.col("_row") - 1).cast("long").alias("slot"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards; law rows: shard sizes differ by one row at most."""
    docs = pick(table(spark, sf_dir, "documents"), {"doc_id": "long", "text": "string"})
    dealt = hypergeometric_shards(docs, 16, stable=True)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op4_sharding": op4_sharding}
ORACLES: dict[str, str] = {}
